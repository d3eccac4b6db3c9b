"""Reports as JSON lines and CSV.

Every path is a folder of part files, as Spark writes it. Undefined metrics are
written as explicit nulls; by default Spark would leave the field out.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritally.operators.slices import SLICES
from veritally.sources import csv


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header. An empty table still gets its header."""
    df.write.mode("overwrite").options(**csv.WRITE).csv(path)


def slices_document(slices: DataFrame) -> DataFrame:
    """Error slices as one row with a struct per slice. There are seven of them."""
    metrics = F.struct("n", "n_correct", "accuracy")
    return slices.agg(
        *[F.max(F.when(F.col("slice") == s, metrics)).alias(s) for s in SLICES]
    )


MANIFEST = "manifest"
_MANIFEST_ROW = "published long, run string, reports array<string>"


class ReportSet:
    """The reports of one run, which become visible together or not at all.

    Each run writes into a folder of its own, and as its last step adds one row to the
    manifest beside these folders. That is one commit of one file, so whoever looks reports up
    (:func:`current_reports`) finds the set of the last run that came to its end: not those of a run
    that failed on the way, and never a mixture. Earlier sets stay until their owner clears them.
    """

    def __init__(self, spark: SparkSession, out_dir: str, names: Iterable[str]):
        self.spark, self.out_dir = spark, out_dir.rstrip("/")
        self.run = uuid.uuid4().hex
        self.names = tuple(names)
        if len(set(self.names)) < len(self.names) or MANIFEST in self.names:
            raise ValueError(f"reports need different names, and none may be called {MANIFEST}")
        self.paths = {n: _report_path(self.out_dir, self.run, n) for n in self.names}

    def publish(self) -> dict[str, str]:
        """Make the set the current one; the paths of its reports."""
        before = _published(self.spark, self.out_dir)
        number = max((r["published"] for r in before), default=0) + 1
        row = self.spark.createDataFrame([(number, self.run, list(self.names))], _MANIFEST_ROW)
        row.coalesce(1).write.mode("append").json(f"{self.out_dir}/{MANIFEST}")
        return self.paths


def _report_path(out_dir: str, run: str, name: str) -> str:
    return f"{out_dir}/run-{run}/{name}"


def _published(spark: SparkSession, out_dir: str) -> list:
    try:
        return spark.read.schema(_MANIFEST_ROW).json(f"{out_dir}/{MANIFEST}").collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def current_reports(spark: SparkSession, out_dir: str) -> dict[str, str]:
    """Paths by name of the set that was published last; empty if there is none.

    Two runs that end at the same moment may get one number; then the run with the larger name counts.
    """
    found = _published(spark, out_dir.rstrip("/"))
    if not found:
        return {}
    last = max(found, key=lambda r: (r["published"], r["run"]))
    return {n: _report_path(out_dir.rstrip("/"), last["run"], n) for n in last["reports"]}

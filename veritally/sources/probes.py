"""Probe sets: hand-written texts with an expected label and a category."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from veritally.sources import csv

PROBE_COLUMNS = {
    "text": StringType(),
    "expected_label": IntegerType(),
    "category": StringType(),
    "notes": StringType(),
}


def load_probes(spark: SparkSession, path: str) -> DataFrame:
    """Read a probe CSV (a file, or a folder of files with the same header).

    Columns are found by name, extra ones stay as strings, and a label that is no integer
    fails the read; see :func:`~veritally.sources.csv.read_by_name`.
    """
    wanted = StructType([StructField(c, t) for c, t in PROBE_COLUMNS.items()])
    return csv.read_by_name(spark, path, wanted, "probe file")

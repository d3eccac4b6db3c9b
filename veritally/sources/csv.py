"""One CSV dialect for all readers and writers.

Quotes are doubled inside quoted fields, a field may span lines, and blanks
around a value belong to it: by default Spark strips them when it writes.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from veritally.sources import csv_ranges
from veritally.sources.schema import require_columns, require_names

#: Files up to this size are read by one task each, larger ones in ranges.
WHOLE_FILE_BYTES = 32 << 20

READ = {"header": "true", "multiLine": "true", "escape": '"'}
WRITE = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_by_name(
    spark: SparkSession,
    path: str,
    wanted: StructType,
    what: str,
    whole_file_bytes: int = WHOLE_FILE_BYTES,
) -> DataFrame:
    """A CSV file or folder with the types of ``wanted``, matched by name.

    With a schema given, Spark would silently fill a missing column with nulls and report
    the schema's names, so the header is read on its own first. Its order gives the
    order of the columns; extra ones stay as strings. A file with another header and a
    value that doesn't fit its type fail the read.

    As fields may span lines, Spark reads a file in one task. That is done as long as no file is
    larger than ``whole_file_bytes``; otherwise files are read in ranges
    (:mod:`~veritally.sources.csv_ranges`), with the same result.
    """
    try:
        largest = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0]
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no {what} at {path}") from error
        raise
    if (largest or 0) > whole_file_bytes:
        return _read_in_ranges(spark, path, wanted, what)
    header = spark.read.options(**READ).csv(path)
    require_columns(header, wanted.names, what)
    strict = {"mode": "FAILFAST", "enforceSchema": "false"}
    return spark.read.schema(_typed(header.columns, wanted)).options(**READ, **strict).csv(path)


def _typed(columns: list[str], wanted: StructType) -> StructType:
    types = {f.name: f.dataType for f in wanted}
    return StructType([StructField(c, types.get(c, StringType())) for c in columns])


def _read_in_ranges(spark: SparkSession, path: str, wanted: StructType, what: str) -> DataFrame:
    records = csv_ranges.read_records(spark, path)
    header = csv_ranges.header_of(records, path)
    require_names(header or [], wanted.names, what)
    fields = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in _typed(header, wanted)]
    rows = records.where("start > 0 OR place > 0")
    strict = {"mode": "FAILFAST", "multiLine": "true", "escape": '"'}
    return rows.select(F.from_csv("record", ", ".join(fields), strict).alias("row")).select("row.*")

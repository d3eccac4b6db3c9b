"""Labelled corpora: one DataFrame, with splits as a column rather than tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from veritally.sources import csv
from veritally.sources.schema import require_columns, require_names


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: StructType | str | None = None,
) -> DataFrame:
    """Read one corpus table from Parquet, ORC, JSON lines or CSV with a header.

    Text formats need a schema: inference would read the whole corpus once more. Its
    columns must stand in the source, in any order: for CSV in the header, which all files
    must share, for JSON in some line. JSON writers leave null fields out, so all lines are looked at;
    their keys are grouped on the map side. A value that doesn't fit its
    type fails the job rather than turning into a null.
    """
    if fmt not in ("json", "csv"):
        return spark.read.format(fmt).load(path)
    if schema is None:
        raise ValueError(f"give a schema to read {fmt}")
    wanted = _struct(spark, schema)
    if fmt == "csv":
        return csv.read_by_name(spark, path, wanted, "corpus").select(*wanted.names)
    keys = spark.read.text(path).select(F.explode(F.json_object_keys("value")).alias("key"))
    found = keys.where(F.col("key").isin(*wanted.names)).distinct().collect()
    require_names([r["key"] for r in found], wanted.names, "corpus")
    return spark.read.schema(wanted).option("mode", "FAILFAST").json(path)


def _struct(spark: SparkSession, schema: StructType | str) -> StructType:
    return spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema


def read_splits(
    spark: SparkSession,
    paths: Mapping[str, str],
    fmt: str = "parquet",
    schema: StructType | str | None = None,
) -> DataFrame:
    """Read tables that come already split, adding their name as ``split``."""
    if not paths:
        raise ValueError("no split given")
    parts = [
        read_table(spark, path, fmt, schema).withColumn("split", F.lit(name))
        for name, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def load_labelled(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    label: str = "toxic",
) -> DataFrame:
    """Join texts with their labels where the corpus keeps them apart.

    Rows whose label is missing stay out, as they do in a corpus that holds only
    labelled rows. No broadcast hint: the label table grows with the corpus, so
    the choice is left to the sizes Spark measures at run time. Operators that
    need only facts about a text should project those from ``documents`` first,
    which keeps the text itself out of the shuffle.
    """
    require_columns(documents, [key], "documents")
    require_columns(labels, [key, label], "labels")
    return documents.join(labels.select(key, F.col(label).alias("toxicity")), key)

"""Exact dedup by distributed MSD radix partitioning.

Texts are split by their length in bytes and then by successive slices of bytes,
each slice longer than the one before. A group that has become a single row is
finished, and so is one whose bytes have ended: its texts are equal because every
byte agreed. No digest takes part in that decision.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritally.session import store_table

FIRST_SLICE = 64
GROWTH = 32


def exact_duplicates(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    first_slice: int = FIRST_SLICE,
    growth: int = GROWTH,
) -> DataFrame:
    """One row per row of ``docs``: key, keep_id, group_size, kept, text_sha256.

    Of equal texts the largest key stays. Null texts count as empty. Null keys rank
    below all others; a group of null keys keeps a null. A key that occurs twice with
    the same text is kept in both rows; with different texts the rows are judged apart.
    Other columns are ignored, whatever their names. No rows give no rows.

    The first split needs only lengths and prefixes, so texts are moved once, and only
    those of groups with two rows or more are looked at again. Hot groups are counted on
    the map side; the joins that hand the counts back can be split by Spark. They are merge
    joins at every size, so that the cost follows the input without a jump.
    """
    rows = docs.select(
        F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_rest")
    ).withColumn("_size", F.octet_length("_rest"))
    slice_end, step = first_slice, first_slice
    here = rows.withColumn("_slice", _head(step))
    groups = _numbered(here.groupBy("_size", "_slice"), "radix_groups")
    narrow = here.select("_key", "_size", "_slice", F.sha2("_rest", 256).alias("_sha"))
    shared = groups.select("_size", "_slice", "_group", "_n", "_keep")
    finished = [_single(narrow.join(shared.hint("merge"), ["_size", "_slice"], "left_anti"))]
    level = here.join(shared.hint("merge"), ["_size", "_slice"]).select(
        "_key", "_group", "_size", "_n", "_keep", "_rest"
    )
    level = store_table(_advance(level, step, F.sha2("_rest", 256)), "radix_level")
    while True:
        finished.append(_ended(level, slice_end))
        active = level.where(F.col("_n").isNotNull() & (F.col("_size") > slice_end))
        if active.isEmpty():
            break
        step = slice_end * (growth - 1)
        slice_end += step
        here = active.drop("_n", "_keep").withColumn("_slice", _head(step))
        groups = _numbered(here.groupBy("_group", "_slice"), "radix_groups").withColumnRenamed(
            "_group", "_next"
        )
        split = here.join(
            groups.withColumnRenamed("_parent", "_group").hint("merge"), ["_group", "_slice"], "left"
        ).select("_key", F.col("_next").alias("_group"), "_size", "_n", "_keep", "_rest", "_sha")
        level = store_table(_advance(split, step, F.col("_sha")), "radix_level")
    return reduce(DataFrame.unionByName, finished).select(
        F.col("_key").alias(key),
        F.col("_keep").alias("keep_id"),
        F.col("_n").alias("group_size"),
        F.col("_key").eqNullSafe(F.col("_keep")).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def _head(step: int) -> Column:
    return F.substring("_rest", 1, step)


def _numbered(grouped, name: str) -> DataFrame:
    """Groups of two rows or more, numbered; stored, so that the numbers stay."""
    counted = grouped.agg(F.count(F.lit(1)).alias("_n"), F.max("_key").alias("_keep"))
    if "_group" in counted.columns:
        counted = counted.withColumnRenamed("_group", "_parent")
    kept = counted.where("_n > 1").withColumn("_group", F.monotonically_increasing_id())
    return store_table(kept, name)


def _advance(level: DataFrame, step: int, digest: Column) -> DataFrame:
    """Take the digest while the whole text is here, then cut the bytes that are used up."""
    rest = F.expr(f"substring(_rest, {step + 1})")
    return level.select(
        "_key", "_group", "_size", "_n", "_keep", digest.alias("_sha"), rest.alias("_rest")
    )


def _ended(level: DataFrame, slice_end: int) -> DataFrame:
    """Rows that are alone after the split, and groups without further bytes."""
    alone = level.where(F.col("_n").isNull())
    whole = level.where(F.col("_n").isNotNull() & (F.col("_size") <= slice_end))
    return _single(alone).unionByName(whole.select("_key", "_keep", "_n", "_sha"))


def _single(rows: DataFrame) -> DataFrame:
    return rows.select("_key", F.col("_key").alias("_keep"), F.lit(1).cast("long").alias("_n"), "_sha")

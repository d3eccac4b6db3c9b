"""Rows and scores that come in tables of their own."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.session import store_table
from veritally.sources.schema import require_columns

ALIGNED = "aligned"
#: What can be wrong with a key: no score, no row, more than one of either, or no key at all.
PROBLEMS = ("missing", "orphan", "double", "no_key")


@dataclass(frozen=True)
class Alignment:
    """Rows with their score, the keys that have no such row, and how many keys have which status."""

    rows: DataFrame
    problems: DataFrame
    counts: dict[str, int]


def align_scores(
    rows: DataFrame,
    scores: DataFrame,
    key: str = "doc_id",
    allowed: Collection[str] = (),
) -> Alignment:
    """Each row with the columns of the one score that has its key.

    Both tables meet in one shuffle by the key and every key gets a status: ``aligned`` (one row and
    one score), ``missing`` (no score), ``orphan`` (no row), ``double`` (several rows or
    scores, also equal ones) or ``no_key`` (null). A plain join would drop the first two, multiply
    the third and say nothing. Problems that aren't ``allowed`` fail the call with their counts;
    allowed ones are routed to ``problems`` (key, status, n_rows, n_scores), and their rows
    are not among ``rows``. All null keys together are one entry there, and in ``counts``.

    Keys are counted on the map side first, so neither nulls nor a key with a third
    of all rows meet in one task. What was aligned is stored, since it is used more than once.
    Tables share the key and no other column.
    """
    require_columns(rows, [key], "rows")
    require_columns(scores, [key], "scores")
    unknown = sorted(set(allowed) - set(PROBLEMS))
    if unknown:
        raise ValueError(f"no such problems: {unknown}; there are {list(PROBLEMS)}")
    mine, theirs = ([c for c in df.columns if c != key] for df in (rows, scores))
    both = sorted(set(mine) & set(theirs))
    if both:
        raise ValueError(f"rows and scores both have columns {both}")
    if rows.schema[key].dataType != scores.schema[key].dataType:
        raise ValueError(f"keys are {rows.schema[key].dataType} and {scores.schema[key].dataType}")
    # A column of its own makes sure that a struct has a field.
    left = F.struct(F.lit(True).alias("_here"), *[F.col(c) for c in mine])
    right = F.struct(F.lit(True).alias("_here"), *[F.col(c) for c in theirs])
    left_rows = rows.select(F.col(key).alias("_key"), left.alias("_row"))
    right_rows = scores.select(F.col(key).alias("_key"), right.alias("_score"))
    met = left_rows.unionByName(right_rows, allowMissingColumns=True).groupBy("_key").agg(
        F.count("_row").alias("n_rows"),
        F.count("_score").alias("n_scores"),
        F.first("_row", ignorenulls=True).alias("_row"),
        F.first("_score", ignorenulls=True).alias("_score"),
    )
    status = (
        F.when(F.col("_key").isNull(), "no_key")
        .when((F.col("n_rows") > 1) | (F.col("n_scores") > 1), "double")
        .when(F.col("n_scores") == 0, "missing")
        .when(F.col("n_rows") == 0, "orphan")
        .otherwise(ALIGNED)
    )
    stored = store_table(met.withColumn("status", status), "aligned")
    counts = {r["status"]: r["n"] for r in stored.groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()}
    wrong = {s: counts[s] for s in PROBLEMS if s in counts and s not in allowed}
    if wrong:
        named = ", ".join(f"{n} {s}" for s, n in wrong.items())
        raise ValueError(f"rows and scores don't align by '{key}': {named}")
    fine = F.col("status") == ALIGNED
    columns = [*[F.col(f"_row.{c}") for c in mine], *[F.col(f"_score.{c}") for c in theirs]]
    return Alignment(
        stored.where(fine).select(F.col("_key").alias(key), *columns),
        stored.where(~fine).select(F.col("_key").alias(key), "status", "n_rows", "n_scores"),
        counts,
    )


class TableScorer:
    """A scorer that takes the scores of a table, one for each key.

    ``scores`` has the key, ``toxic_prob`` and perhaps ``logits``. A text without exactly one score
    fails the run. Scores of other rows are left alone: a table may cover all splits.
    """

    def __init__(self, scores: DataFrame, key: str = "doc_id"):
        require_columns(scores, [key, "toxic_prob"], "scores")
        self.key = key
        self.scores = scores.select(key, *[c for c in ("toxic_prob", "logits") if c in scores.columns])

    def __call__(self, df: DataFrame) -> DataFrame:
        return align_scores(df, self.scores, self.key, allowed=("orphan",)).rows

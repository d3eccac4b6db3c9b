"""Deterministic splits, exact subsamples and per-label samples."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritally.functions.hashing import digest, unit_interval
from veritally.operators.lookup import fetch_by_key
from veritally.sources.schema import require_columns

TRAIN, VALIDATION, TEST = "train", "validation", "test"

# Hex digits of the digest that form a subsampling bucket: 65,536 buckets.
_BUCKET_DIGITS = 4


def check_ratios(val_ratio: float, test_ratio: float) -> None:
    if val_ratio < 0 or test_ratio < 0 or val_ratio + test_ratio >= 1.0:
        raise ValueError(
            f"validation and test ratios must leave rows to train on, got {val_ratio} and {test_ratio}"
        )


def assign_splits(
    df: DataFrame,
    key: str = "doc_id",
    val_ratio: float = 0.1,
    test_ratio: float = 0.1,
    seed: int = 42,
    present: Collection[str] | None = None,
) -> DataFrame:
    """Fill the ``split`` column from a hash of the key.

    ``present`` names the splits the corpus came with; by default they are looked up in
    its ``split`` column, and a corpus without one is all ``train``. With only ``train``, all
    rows are divided three ways. With ``train`` and ``test``, validation rows
    are carved out of ``train`` and the ratio counts train rows only. With all
    three, nothing changes. A map-only step: no shuffle, no sort, and a row
    keeps its split when the corpus grows.
    """
    check_ratios(val_ratio, test_ratio)
    names = set(splits_present(df) if present is None else present)
    if TRAIN not in names or names - {TRAIN, VALIDATION, TEST}:
        raise ValueError(f"cannot use splits {sorted(names)}")
    if VALIDATION in names and TEST not in names:
        raise ValueError("a corpus with a validation split must also have a test split")
    if names == {TRAIN, VALIDATION, TEST}:
        return require_columns(df, ["split"])
    require_columns(df, [key])
    u = unit_interval(F.col(key), seed)
    if names == {TRAIN} and "split" in df.columns and present is not None:
        raise ValueError("the corpus has a split column; leave out 'present' or name its splits")
    if names == {TRAIN}:
        split = (
            F.when(u < test_ratio, TEST)
            .when(u < test_ratio + val_ratio, VALIDATION)
            .otherwise(TRAIN)
        )
    else:
        require_columns(df, ["split"])
        split = F.when((F.col("split") == TRAIN) & (u < val_ratio), VALIDATION).otherwise(
            F.col("split")
        )
    return df.withColumn("split", split)


def splits_present(df: DataFrame) -> list[str]:
    """Names in the ``split`` column. There are three at most, so a few rows are read back."""
    if "split" not in df.columns:
        return [TRAIN]
    found = [r["split"] for r in df.select("split").distinct().limit(5).collect()]
    unknown = sorted(map(str, set(found) - {TRAIN, VALIDATION, TEST}))
    if unknown:
        raise ValueError(f"unknown splits {unknown}")
    return found or [TRAIN]


def split_sizes(df: DataFrame) -> DataFrame:
    require_columns(df, ["split"])
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def subsample(
    df: DataFrame,
    max_train: int | None,
    max_eval: int | None,
    key: str = "doc_id",
    seed: int = 42,
) -> DataFrame:
    """Keep exactly ``max_train`` train rows and ``max_eval`` of each other split.

    The rows kept are those with the smallest digests. A limit over a global
    sort would push every kept row through one task, so the last digest to keep
    is found first, on keys alone: digests are counted per bucket, the bucket
    where a split reaches its limit is found among at most 65,536 counts, and
    only that bucket, about 1/65,536 of a split, is ranked. The rows themselves
    then pass a plain filter, without any shuffle. ``key`` must identify a row.
    """
    require_columns(df, [key, "split"])
    if max_train is None and max_eval is None:
        return df
    if any(limit is not None and limit < 0 for limit in (max_train, max_eval)):
        raise ValueError("subsample limits cannot be negative")

    limit = F.when(F.col("split") == TRAIN, F.lit(max_train)).otherwise(F.lit(max_eval))
    # A split limited to nothing has no digest to cut at.
    kept = df.where(limit.isNull() | (limit > 0))
    # Not the digest that assigns splits: a sample must not hug the edge of one.
    salt = f"{seed}:sample"
    place = F.struct(digest(F.col(key), salt).alias("digest"), F.col(key).alias("key"))

    places = kept.where(limit.isNotNull()).select("split", place.alias("place"))
    bucket = F.substring("place.digest", 1, _BUCKET_DIGITS)
    counts = places.groupBy("split", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("split").orderBy("bucket"))
    before = F.col("upto") - F.col("n")
    cuts = (
        counts.withColumn("upto", upto)
        .withColumn("limit", limit.cast("bigint"))
        .where((F.col("upto") >= F.col("limit")) & (before < F.col("limit")))
        .select("split", "bucket", (F.col("limit") - before).alias("room"))
    )
    # One row per split at most, here and below, so neither broadcast can grow.
    rank = F.row_number().over(Window.partitionBy("split").orderBy("place"))
    last = (
        places.withColumn("bucket", bucket)
        .join(F.broadcast(cuts), ["split", "bucket"])
        .withColumn("rank", rank)
        .where(F.col("rank") == F.col("room"))
        .select("split", F.col("place").alias("_last"))
    )
    return (
        kept.join(F.broadcast(last), "split", "left")
        .where(F.col("_last").isNull() | (place <= F.col("_last")))
        .select(*df.columns)
    )


def sample_per_label(
    df: DataFrame,
    label: str = "labels",
    n: int = 5,
    key: str = "doc_id",
    seed: int = 0,
    texts: DataFrame | None = None,
) -> DataFrame:
    """``n`` rows of each of the two labels, picked by digest.

    Rows are picked on (key, label) alone and the rest of their columns fetched
    afterwards, from ``texts`` or from ``df`` itself. Spark drops all but ``n`` rows per label on the map side, so a
    label that holds most of the corpus sends no more to its task than a rare one.
    """
    require_columns(df, [key, label])
    order = Window.partitionBy(label).orderBy(digest(F.col(key), seed), key)
    picked = (
        df.select(key, label)
        .where(F.col(label).isin(0, 1))
        .withColumn("pick", F.row_number().over(order))
        .where(F.col("pick") <= n)
    )
    source = df.drop(label) if texts is None else texts
    return fetch_by_key(picked, source, key, max_rows=2 * n)

"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies. Their prefix sum,
shifted by one random offset, is cut at the integers: a document is emitted once for
each integer that its share crosses.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
CLASSES_PER_OCTAVE = 8
BUCKET_DIGITS = 3
SEED = "mix-1"


def word_count(text: Column) -> Column:
    """Number of words; 0 for null. Each word with the space around it shrinks to one letter."""
    shrunk = F.regexp_replace(text, rf"[\x20\x09-\x0D]*{WORD}[\x20\x09-\x0D]*", "w")
    return F.when(text.rlike(WORD), F.length(shrunk)).otherwise(0).cast("long")


def offset(seed: str) -> float:
    """The random offset in [0, 1): 32 bits of a digest of the seed."""
    return int(hashlib.md5(seed.encode()).hexdigest()[:8], 16) / 2**32


def size_class(size: Column) -> Column:
    """Eighths of a power of two, in integers; 0 for empty documents."""
    bits = F.length(F.bin(size))
    eighths = F.floor(size * CLASSES_PER_OCTAVE / F.pow(F.lit(2.0), bits - 1))
    return F.when(size > 0, bits * CLASSES_PER_OCTAVE + eighths - CLASSES_PER_OCTAVE).otherwise(
        0
    ).cast("int")


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_COPIES,
) -> DataFrame:
    """Per source of ``sizes`` (source, size): source_size and target.

    Sources by code point, null last, take the weights in turn. What a source cannot take
    beyond ``most`` times its size is shared anew by weight among the others, so all that
    stay below get the same amount per weight. Sources are sorted by the amount at which
    they fill up; with the first i of them full, the rest is level i, which rises as long
    as sources do fill and falls after that: the largest is the one that holds. One row
    per source is sorted in one task, never documents. Sources without words get 0.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn % len(weights) + 1)
    cap = (F.col("source_size") * most).cast("double")
    filled = sources.withColumn("weight", weight).withColumn("cap", cap)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything).cast("double") * share
    full = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    levels = filled.withColumn("level", (total - full) / F.sum("weight").over(after))
    water = F.max("level").over(everything)
    return levels.select(
        "source", "source_size", F.least("cap", water * F.col("weight")).alias("target")
    )


def mix_counts(docs: DataFrame, **options) -> DataFrame:
    """Per row of ``docs``: key, size, source_size, target, copies and taken (copies x size).

    Options are those of :func:`draw_copies`, which also says how odd rows are treated.
    """
    key = options.get("key", "doc_id")
    return draw_copies(docs.select(key, *_inputs(options)), **options).select(
        f"_row.{key}",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, repeated as often as they are taken."""
    drawn = draw_copies(docs, keep=tuple(docs.columns), **options).where("copies > 0")
    copy = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return drawn.select("_row", copy.alias("_copy")).select("_row.*")


def _inputs(options: dict) -> tuple[str, str]:
    return options.get("text", "text"), options.get("source", "source")


def draw_copies(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_COPIES,
    seed: str = SEED,
    keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """Per row of ``docs``: _row (the columns of ``keep``), size, source_size, target, copies.

    Within a source, documents are ordered by size class and then by a digest of key and
    seed, so the sum taken comes close to the target whatever the sizes. Positions come
    from counts per cell (source, class, bucket of the digest) and a rank inside the cell, so
    a source with a third of all rows is spread over many tasks. Reruns agree.

    Null texts have size 0. Documents of size 0 and those of sources without words are drawn
    like others and add nothing. A null source is a source; a null key ranks as an
    empty name. Whole repeats of a row are rows of their own. Columns that aren't
    kept are ignored, kept ones may have any names. No rows give no rows.
    """
    rows = docs.select(
        F.struct(*(keep if keep is not None else (key,))).alias("_row"),
        F.col(key).alias("key"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
    )
    draw = F.md5(F.concat_ws(":", F.lit(seed), F.col("key").cast("string")))
    rows = rows.withColumn("draw", draw).withColumn("class", size_class(F.col("size")))
    rows = rows.withColumn("bucket", F.substring("draw", 1, BUCKET_DIGITS))
    targets = source_targets(rows.select("source", "size"), weights, share, most)
    counts = rows.groupBy("source", "class", "bucket").agg(F.count(F.lit(1)).alias("n"))
    running = Window.partitionBy("source").orderBy("class", "bucket")
    starts = counts.withColumn("start", F.sum("n").over(running) - F.col("n")).drop("n")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    cells = _same(starts, targets, "source").withColumn("expected", copies)
    joined = _same(rows, cells, "source", "class", "bucket")
    inside = Window.partitionBy("source", "class", "bucket").orderBy("draw", "key")
    rank = F.col("start") + F.row_number().over(inside)
    u = offset(seed)
    crossed = F.floor(u + F.col("expected") * F.col("rank")) - F.floor(
        u + F.col("expected") * (F.col("rank") - 1)
    )
    return joined.withColumn("rank", rank).select(
        "_row", "size", "source_size", "target", crossed.cast("long").alias("copies")
    )


def _same(left: DataFrame, right: DataFrame, *names: str) -> DataFrame:
    """Inner join on columns that may be null."""
    renamed = right.withColumnsRenamed({n: f"right_{n}" for n in names})
    on = [F.col(n).eqNullSafe(F.col(f"right_{n}")) for n in names]
    return left.join(renamed, on).drop(*[f"right_{n}" for n in names])

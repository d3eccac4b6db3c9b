"""Vocabulary and fixed-length encoding."""

from __future__ import annotations

import json
import zlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritally.functions.text import TOKEN, WHITESPACE, token_count, tokens
from veritally.session import store_table
from veritally.sources.schema import require_columns

# Ids of the special tokens.
PAD_ID, UNKNOWN_ID, START_ID, END_ID = 0, 1, 2, 3
FIRST_TOKEN_ID = 4

DEFAULT_VOCABULARY = 5000
DEFAULT_MAX_LENGTH = 128

# Up to this size the vocabulary travels inside the plan; a larger one is joined.
LARGEST_VOCABULARY = 100_000

# Tokens that are at least this share of all places are salted; there can't be more of them.
HOT_TOKENS = 1000


def build_vocabulary(
    df: DataFrame, size: int = DEFAULT_VOCABULARY, text: str = "text"
) -> DataFrame:
    """``token, n, id`` for the most frequent tokens, equal counts by token.

    Tokens are counted on the map side first, so a token in every text is no
    hot key. Ids follow from a window over the ``size`` rows that are left. A vocabulary of
    more than ``LARGEST_VOCABULARY`` tokens is ranked in ranges instead of one task.
    """
    require_columns(df, [text])
    if size < 1:
        raise ValueError("the vocabulary needs at least one token")
    counts = (
        df.select(F.explode(tokens(F.col(text))).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if size > LARGEST_VOCABULARY:
        return _ranked_in_ranges(counts, size)
    top = counts.orderBy(F.desc("n"), "token").limit(size)
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "token"))
    return top.select("token", "n", (rank + (FIRST_TOKEN_ID - 1)).cast("int").alias("id"))


def _ranked_in_ranges(counts: DataFrame, size: int) -> DataFrame:
    """The first ``size`` tokens with their ids, ranked within ranges of the order.

    Ranges are cut by count and token, so the many tokens with one count are spread too. They
    are used twice, for their sizes and for the ranks within, and stored so that they stay.
    """
    ordered = counts.repartitionByRange(F.desc("n"), F.col("token"))
    ranged = store_table(ordered.withColumn("range_id", F.spark_partition_id()), "token_ranges")
    # One row per range: as many as shuffle partitions.
    before = Window.orderBy("range_id").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("range_id").agg(F.count(F.lit(1)).alias("size"))
    starts = sizes.select("range_id", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("range_id").orderBy(F.desc("n"), "token")
    wanted = ranged.join(F.broadcast(starts.where(F.col("start") < size)), "range_id")
    rank = wanted.withColumn("rank", F.col("start") + F.row_number().over(inside))
    first = rank.where(F.col("rank") <= size)
    return first.select("token", "n", (F.col("rank") + (FIRST_TOKEN_ID - 1)).cast("int").alias("id"))


def with_token_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``n_tokens``: untruncated, with both boundary tokens."""
    require_columns(df, [text])
    return df.withColumn("n_tokens", token_count(F.col(text)))


def _named(vocabulary: DataFrame) -> DataFrame:
    return vocabulary.where("token IS NOT NULL").select("token", F.col("id").cast("int").alias("id"))


def _known(vocabulary: DataFrame) -> DataFrame:
    """One id per token, the smallest where a table has several; no null tokens."""
    return _named(vocabulary).groupBy("token").agg(F.min("id").alias("id"))


def _small_vocabulary(vocabulary: DataFrame, largest: int) -> list[tuple[str, int]] | None:
    """All entries, or None if there are more than ``largest``.

    As many rows of the table are looked at first: if they hold more tokens, the rest of a
    large vocabulary need not be grouped to know it.
    """
    first = _named(vocabulary).limit(largest + 1).collect()
    if len({r["token"] for r in first}) > largest:
        return None
    entries = _known(vocabulary).limit(largest + 1).collect() if len(first) > largest else _smallest(first)
    return [(token, i) for token, i in entries] if len(entries) <= largest else None


def _smallest(rows: list[tuple[str, int]]) -> list[tuple[str, int]]:
    found: dict[str, int] = {}
    for token, i in rows:
        ids = [j for j in (found.get(token), i) if j is not None]
        found[token] = min(ids, default=None)
    return list(found.items())


def _lookup_table(entries: list[tuple[str, int]]) -> tuple[Column, int]:
    """The vocabulary as a constant: an array of small maps, indexed by a hash.

    Spark searches a map from its first key to its last, so one map of thousands
    of tokens would be slow.
    """
    width = max(1, 2 * len(entries))
    table: list[dict[str, int]] = [{} for _ in range(width)]
    for token, token_id in entries:
        table[zlib.crc32(token.encode()) % width][token] = token_id
    # A literal JSON text is parsed once, while the query is optimised.
    constant = F.from_json(F.lit(json.dumps(table)), "array<map<string,int>>")
    return constant, width


def _ids_from_table(rows: DataFrame, entries: list[tuple[str, int]]) -> DataFrame:
    """``_tokens`` replaced by ``_ids`` within the row."""
    table, width = _lookup_table(entries)

    def token_id(token: Column) -> Column:
        slot = F.crc32(token.cast("binary")) % width
        return F.coalesce(
            F.try_element_at(F.get(table, slot.cast("int")), token), F.lit(UNKNOWN_ID)
        )

    return rows.withColumn("_ids", F.transform("_tokens", token_id)).drop("_tokens")


def lookup_ids(rows: DataFrame, vocabulary: DataFrame, hot_tokens: int = HOT_TOKENS) -> DataFrame:
    """``_tokens`` replaced by ``_ids``, in the same order, by a join with ``vocabulary``.

    Tokens leave their rows with a row number and a position, meet the vocabulary by a shuffle and
    return by row number; other columns stay where they are. The vocabulary may have any size:
    nothing of it is collected or broadcast. It is read once, and only what the rows hold of it is
    grouped and sorted: the distinct tokens of the rows are stored, and Spark joins by their size.

    A token that makes up one in ``hot_tokens`` of all places or more is hot. There are at most that
    many, so they are broadcast; each is salted in proportion to its share, and its entry
    in the vocabulary goes to every salt. No task gets more than about one part in ``hot_tokens`` of
    a single token. Row numbers are stored, since a second run would deal out others.
    """
    numbered = store_table(rows.withColumn("_row", F.monotonically_increasing_id()), "token_rows")
    places = numbered.select("_row", F.posexplode("_tokens").alias("_place", "token"))
    total = numbered.agg(F.sum(F.size("_tokens"))).first()[0] or 0
    counts = store_table(places.groupBy("token").agg(F.count(F.lit(1)).alias("n")), "token_counts")
    share = F.col("n") * hot_tokens
    hot = counts.where(share >= F.lit(total)).select(
        "token", F.ceil(share / F.lit(max(total, 1))).cast("int").alias("_salts")
    )
    hot = store_table(hot, "hot_tokens")
    salts = F.coalesce("_salts", F.lit(1))
    salted = places.join(F.broadcast(hot), "token", "left").select(
        "_row", "_place", "token", F.pmod(F.xxhash64("_row"), salts).cast("int").alias("_salt")
    )
    held = _known(vocabulary.join(counts.select("token"), "token", "left_semi"))
    entries = held.join(F.broadcast(hot), "token", "left").select(
        "token", "id", F.explode(F.sequence(F.lit(0), salts - 1)).alias("_salt")
    )
    found = salted.join(entries.hint("merge"), ["token", "_salt"], "left")
    placed = F.struct("_place", F.coalesce("id", F.lit(UNKNOWN_ID)).alias("id"))
    ids = found.groupBy("_row").agg(F.array_sort(F.collect_list(placed))["id"].alias("_ids"))
    back = numbered.drop("_tokens").join(ids.hint("merge"), "_row", "left").drop("_row")
    return back.withColumn("_ids", F.coalesce("_ids", F.array().cast("array<int>")))


def encode_fixed_length(
    df: DataFrame,
    vocabulary: DataFrame,
    max_length: int = DEFAULT_MAX_LENGTH,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id", "labels"),
    largest_constant: int = LARGEST_VOCABULARY,
) -> DataFrame:
    """``input_ids`` and ``attention_mask``, both exactly ``max_length`` long.

    Tokens beyond the length are cut, the two boundary tokens added, the rest
    padded. ``vocabulary`` has ``token`` and ``id``, and any size. Up to ``largest_constant``
    tokens the lookup happens within the row: exploding tokens to join them
    with the vocabulary has to gather every text again afterwards, which only a vocabulary that is
    too large for the plan is worth (:func:`lookup_ids`).
    """
    require_columns(df, [text, *keep])
    require_columns(vocabulary, ["token", "id"], "vocabulary")
    if max_length < 2:
        raise ValueError("max_length must leave room for the boundary tokens")
    # The part that holds the first tokens is cut out before it is split, so that the rest of
    # a long text costs nothing.
    head = F.regexp_extract(
        F.coalesce(F.col(text), F.lit("")),
        f"^(?:[{WHITESPACE}]*+(?:{TOKEN})){{0,{max_length - 2}}}+",
        0,
    )
    rows = df.select(*keep, F.slice(tokens(head), 1, max_length - 2).alias("_tokens"))
    entries = _small_vocabulary(vocabulary, largest_constant)
    found = lookup_ids(rows, vocabulary) if entries is None else _ids_from_table(rows, entries)
    used = F.size("_ids") + 2
    spare = F.lit(max_length) - used
    return (
        found.withColumn(
            "input_ids",
            F.concat(
                F.array(F.lit(START_ID)),
                F.col("_ids"),
                F.array(F.lit(END_ID)),
                F.array_repeat(F.lit(PAD_ID), spare),
            ),
        )
        .withColumn(
            "attention_mask",
            F.concat(F.array_repeat(F.lit(1), used), F.array_repeat(F.lit(0), spare)),
        )
        .select(*keep, "input_ids", "attention_mask")
    )

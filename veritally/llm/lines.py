"""Line dedup by winnowing.

Lines are hashed, and of every ``window`` consecutive lines the least hash is a fingerprint. Any
run of that many lines that stands twice therefore shares a fingerprint. Positions
of shared fingerprints are joined; to both sides of each, the windows that contain it are
matched, and neighbouring matches grow together to runs. The first place of a run
stays, all later ones go. A single line of ``long_line`` words or more is a run as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritally.session import store_table

WINDOW = 2
LONG_LINE = 50
_SOLID = r"[^\x20\x09-\x0D]"
_WORD = _SOLID + "+"


def repeated_lines(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    long_line: int | None = LONG_LINE,
) -> DataFrame:
    """Windows of lines that stand earlier too: row, lines (their numbers, from 0).

    Lines end at a line feed. Blank ones are passed over: they neither part a run nor belong to
    it. A window is ``window`` consecutive other lines, or one line that has ``long_line`` words or
    more (None: no single line is a window because of its length); it is later if the same lines stand
    anywhere before, by key and line number. Null keys are replaced by a hash of the text.
    Whole rows that repeat are one place. A key belongs to one text.

    Counting fingerprints and windows starts on the map side, and the joins can be split,
    so a line that a third of the documents share doesn't end in one task.
    """
    places = store_table(_rows(docs, key, text).select("row", _windows("text", window, long_line)), "line_windows")
    spots = places.groupBy("mark").agg(
        F.min(F.struct("row", "spot")).alias("low"), F.max(F.struct("row", "spot")).alias("high")
    )
    shared = spots.where("low <> high").select("mark")
    met = places.join(shared.hint("merge"), "mark").drop("spot")
    place = F.struct("row", "lines")
    first = met.groupBy("mark", "one", "two").agg(F.min(place).alias("first"))
    later = met.join(first.hint("merge"), ["mark", "one", "two"]).where(place != F.col("first"))
    return later.select("row", "lines")


def remove_repeated_lines(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    long_line: int | None = LONG_LINE,
    keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """Per row of ``docs``: _row (the columns of ``keep``, or the key), n_lines, n_removed, kept_text.

    The lines that stay keep their order and are joined by line feeds. A null or empty text has no
    lines and stays empty. See :func:`repeated_lines` for what counts as repeated.
    """
    later = repeated_lines(docs, key=key, text=text, window=window, long_line=long_line)
    numbers = later.select("row", F.explode("lines").alias("line")).groupBy("row")
    gone = numbers.agg(F.collect_set("line").alias("gone"))
    rows = _rows(docs, key, text, F.struct(*(keep or (key,))).alias("_row"))
    joined = rows.join(gone.hint("merge"), "row", "left")
    lines = F.when(F.col("text") == "", F.array().cast("array<string>")).otherwise(
        F.split("text", "\n", -1)
    )
    removed = F.coalesce("gone", F.array().cast("array<int>"))
    kept = F.filter(lines, lambda line, i: ~F.array_contains(removed, i))
    return joined.select(
        "_row",
        F.size(lines).cast("long").alias("n_lines"),
        F.size(removed).cast("long").alias("n_removed"),
        F.when(F.col("gone").isNull(), F.col("text"))
        .otherwise(F.array_join(kept, "\n"))
        .alias("kept_text"),
    )


def _rows(docs: DataFrame, key: str, text: str, *more: Column) -> DataFrame:
    row = F.coalesce(F.col(key).cast("long"), F.xxhash64(text))
    return docs.select(row.alias("row"), *more, F.coalesce(F.col(text), F.lit("")).alias("text"))


def _windows(text: str, window: int, long_line: int | None) -> Column:
    """Rows mark (fingerprint), spot (its line), one, two (128 bits of hash) and lines.

    The fingerprint of a window is the least line hash, of equals the last.
    """
    lines = F.transform(
        F.split(text, "\n", -1),
        lambda line, i: F.struct(
            F.xxhash64(F.lit(1), line).alias("one"),
            F.xxhash64(F.lit(2), line).alias("two"),
            i.alias("i"),
            line.rlike(_SOLID).alias("solid"),
            _is_long(line, long_line).alias("long"),
        ),
    )
    solid = F.filter(lines, lambda x: x["solid"])
    parts = [F.slice(solid, i + 1, F.greatest(F.size(solid) - (window - 1), F.lit(0))) for i in range(window)]
    zipped = F.arrays_zip(*[p.alias(f"l{i}") for i, p in enumerate(parts)])

    def one_window(w: Column) -> Column:
        mine = [w[f"l{i}"] for i in range(window)]
        pairs = [F.struct(m["one"].alias("h"), (-m["i"]).alias("at")) for m in mine]
        least = F.array_min(F.array(*pairs))
        return F.struct(
            least["h"].alias("mark"),
            (-least["at"]).alias("spot"),
            F.xxhash64(*[m["one"] for m in mine]).alias("one"),
            F.xxhash64(*[m["two"] for m in mine]).alias("two"),
            F.array(*[m["i"] for m in mine]).alias("lines"),
        )

    windows = F.transform(zipped, one_window)
    if long_line is None or window == 1:
        return F.inline(windows)

    def one_line(m: Column) -> Column:
        return F.struct(
            m["one"].alias("mark"),
            m["i"].alias("spot"),
            F.xxhash64(F.lit("line"), m["one"]).alias("one"),
            F.xxhash64(F.lit("line"), m["two"]).alias("two"),
            F.array(m["i"]).alias("lines"),
        )

    return F.inline(F.concat(windows, F.transform(F.filter(solid, lambda x: x["long"]), one_line)))


def _is_long(line: Column, words: int | None) -> Column:
    """Whether a line has so many words; short ones are told by their length, without counting."""
    if words is None:
        return F.lit(False)
    return (F.length(line) >= 2 * words - 1) & (F.regexp_count(line, F.lit(_WORD)) >= words)

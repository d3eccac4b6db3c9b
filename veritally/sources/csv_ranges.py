"""Large CSV files whose fields may span lines, read by many tasks.

A file is cut in byte ranges, and whoever reads a range can't tell whether it begins inside a quoted
field. What it can tell is on which side of a quote each line begins, compared with the
first: a line of a range begins a record either if the quotes before it in the range are even, or if
they are odd, and which of the two holds for the whole range follows from the quotes of all
ranges before it. So quotes are counted per range first, a prefix sum over the ranges settles each
one's side, and every range then puts its own lines together. Only records that cross a border
are moved: their pieces, at most two a range, are joined afterwards.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veritally.session import let_workers_import, store_table

#: Ranges are known to all tasks, a path and two numbers each. More need larger ranges.
MOST_RANGES = 1_000_000

_PIECES = "file string, start long, place long, kind string, piece string"
_RECORD, _HEAD, _TAIL = "record", "head", "tail"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Whole CSV records: file, start (of the range it begins in), place (line there), record.

    Quotes are doubled inside quoted fields, so outside of them their number is even. Records end
    at a line feed or at a carriage return with a line feed; the latter, where a record
    ends with it, is taken for a plain line feed inside its fields as well. Empty lines
    between records are left out. Ranges are as long as ``spark.sql.files.maxPartitionBytes``
    allows; a compressed file is one range.

    Files are read three times, twice without what the quotes are around: for the
    quotes, for the pieces at borders, and for the records. Texts aren't shuffled. A file
    that ends inside quotes ends with one record more, which a strict parser refuses.
    """
    let_workers_import(spark)
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    odd = lines.groupBy("file", "start").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).cast("int").alias("inside")
    ranges = store_table(odd.select("file", "start", inside), "csv_ranges")
    found = ranges.count()
    if found > MOST_RANGES:
        raise ValueError(f"{found} ranges; raise spark.sql.files.maxPartitionBytes")
    # Without a shuffle, so that the lines of a range stay together and in order.
    pieces = lines.join(F.broadcast(ranges), ["file", "start"]).mapInArrow(_assemble, _PIECES)
    records = pieces.where(F.col("kind") == _RECORD).select("file", "start", "place", F.col("piece").alias("record"))
    every = records.unionByName(_across_borders(pieces))
    ended = F.when(
        F.endswith("record", F.lit("\r")),
        F.replace(F.expr("substring(record, 1, length(record) - 1)"), F.lit("\r\n"), F.lit("\n")),
    ).otherwise(F.col("record"))
    return every.withColumn("record", ended).where("record <> ''")


def _across_borders(pieces: DataFrame) -> DataFrame:
    """Records made of the tail of a range and the heads of those after it."""
    parts = store_table(pieces.where(F.col("kind") != _RECORD), "csv_pieces")
    # Two rows per range at most.
    upto = Window.partitionBy("file").orderBy("start", "place").rowsBetween(Window.unboundedPreceding, 0)
    tails = F.sum((F.col("kind") == _TAIL).cast("int")).over(upto).alias("tails")
    grouped = parts.select("*", tails).groupBy("file", "tails")
    joined = F.array_sort(F.collect_list(F.struct("start", "place", "piece"))).alias("parts")
    return grouped.agg(joined).select(
        "file", "parts.start", "parts.place", F.array_join("parts.piece", "\n").alias("record")
    ).select("file", F.col("start")[0].alias("start"), F.col("place")[0].alias("place"), "record")


def header_of(records: DataFrame, path: str) -> list[str] | None:
    """The names in the first record of each file, which must be the same; None without files."""
    first = records.where("start = 0 AND place = 0").select("record").distinct().limit(2).collect()
    names = [next(csv.reader([r["record"].removeprefix("\ufeff")])) for r in first]
    if any(n != names[0] for n in names):
        raise ValueError(f"files in {path} have different headers: {names}")
    return names[0] if names else None


# Tasks --------------------------------------------------------------------------


class _Range:
    """The lines of one range as they come, put together to records."""

    def __init__(self, file: str, start: int, inside: int):
        self.file, self.start = file, start
        self.odd = inside  # quotes so far, counted from where the file is outside of quotes
        self.at = 0  # lines so far
        self.begun: int | None = -1 if inside else None  # line of the open record; -1: it began before
        self.open: list[str] = []
        self.rows: list[tuple] = []

    def take(self, lines: pa.Array) -> None:
        quotes = pc.count_substring(lines, '"').to_numpy()
        before = (self.odd + np.r_[0, np.cumsum(quotes)]) % 2
        values = lines.to_pylist()
        begins = np.flatnonzero(before[:-1] == 0)
        edges = [*begins.tolist(), len(values)]
        self.open += values[: edges[0]]
        for at, after in zip(edges, edges[1:]):
            self._close(_RECORD)
            self.begun, self.open = self.at + at, values[at:after]
        self.at += len(values)
        self.odd = int(before[-1])

    def _close(self, kind: str) -> None:
        if self.begun is not None:
            kind = _HEAD if self.begun < 0 else kind
            self.rows.append((self.file, self.start, self.begun, kind, "\n".join(self.open)))
        self.begun, self.open = None, []

    def end(self) -> None:
        self._close(_TAIL if self.odd else _RECORD)

    def pieces(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = zip(*self.rows)
            types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            names = ["file", "start", "place", "kind", "piece"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
            self.rows = []


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current: _Range | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        files, starts = batch.column("file").dictionary_encode(), batch.column("start").to_numpy()
        which = files.indices.to_numpy()
        new = np.r_[True, (which[1:] != which[:-1]) | (starts[1:] != starts[:-1])]
        edges = [*np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            name = (files.dictionary[int(which[a])].as_py(), int(starts[a]))
            if current is None or name != (current.file, current.start):
                if current:
                    current.end()
                    yield from current.pieces()
                current = _Range(*name, batch.column("inside")[a].as_py())
            current.take(batch.column("value").slice(a, b - a))
            yield from current.pieces()
    if current:
        current.end()
        yield from current.pieces()

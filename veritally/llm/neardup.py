"""Near-duplicate classes by ProbMinHash.

Shingles of five words, weighted by how often a text has them, arrive as Poisson processes
whose rates are the weights. Each register keeps the shingle that arrives first, and a text
stops once no arrival can still win a register. Two registers agree with the
probability Jaccard similarity of the texts. Texts that agree on a band of registers
are compared exactly: each with the most central text of its bucket, and where that leaves
it apart, with the other texts around that centre.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.llm.components import connected_components
from veritally.llm.words import Sequences, Slice, find_words, hash_ranges, mix, slices
from veritally.session import store_table

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 24
ROWS = 5
BLOCK_ROWS = 256

_U = np.uint64


def near_duplicate_classes(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per row of ``docs``: key, class_id (least key of the class), n_links.

    Equal texts are one class whatever they hold. Different texts are linked if the
    probability Jaccard similarity of their weighted shingles is ``similarity`` or more; classes
    are the connected components. ``n_links`` counts the verified links of a text to others;
    links inside a class that its links already imply aren't sought. A text with fewer words
    than a shingle has one shingle, a text without words is linked to nothing; null counts as
    empty. A null key is replaced by a hash of the text. A key belongs to one text; whole rows
    may repeat. Other columns are ignored.
    """
    row = F.coalesce(F.col(key).cast("long"), F.xxhash64(text))
    named = docs.select(F.col(key).alias("key"), row.alias("row"), F.col(text).alias("text"))
    digests = named.select("key", "row", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"))
    first = digests.groupBy("digest").agg(F.min("row").alias("first"))
    members = store_table(digests.join(first.hint("merge"), "digest").select("key", "row", "first"), "copies")
    texts = named.select("row", "text")
    distinct = members.where("row = first").select("row").distinct()
    sketches = texts.mapInArrow(_sketch_task(shingle, bands, rows), "row long, buckets array<long>")
    places = sketches.join(distinct.hint("merge"), "row").select("row", F.explode("buckets").alias("bucket"))
    links = store_table(_links(texts, places.distinct(), shingle, similarity), "near_links")
    classes = connected_components(links).withColumnRenamed("node", "first")
    ends = links.select("a").unionAll(links.select("b")).groupBy("a").agg(F.count("a").alias("n_links"))
    labelled = classes.join(ends.withColumnRenamed("a", "first"), "first", "left")
    return members.join(labelled, "first", "left").select(
        F.col("key").alias(key),
        F.coalesce("component", "first").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def _links(texts: DataFrame, places: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Verified links between rows that share a bucket: a, b, similarity.

    A bucket's hub is its most central row, the one with most company in all of its
    buckets, and every row is compared with the hubs of its buckets. Rows that end up in another
    component than their hub are then compared with all rows around that hub, block by
    block, so no link between components is lost and no group meets in one task.
    """
    places = store_table(places, "bucket_rows")
    sizes = places.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    company = places.join(sizes.hint("merge"), "bucket")
    central = store_table(company.groupBy("row").agg(F.sum("n").alias("company")), "bucket_company")
    company = company.select("bucket", "row").join(central.hint("merge"), "row")
    best = F.max(F.struct("company", (-F.col("row")).alias("minus")))
    hubs = company.groupBy("bucket").agg((-best["minus"]).alias("hub"))
    around = company.select("bucket", "row").join(hubs.hint("merge"), "bucket")
    stars = store_table(around.where("row <> hub").select("hub", "row").distinct(), "stars")
    cut = texts.join(central.select("row").hint("merge"), "row").mapInArrow(
        _shingle_task(shingle), "row long, shingles binary, counts binary"
    )
    sets = store_table(cut.dropDuplicates(["row"]), "shingles")
    ours = sets.toDF("row", "b_shingles", "b_counts")
    theirs = sets.toDF("hub", "a_shingles", "a_counts")
    full = stars.join(ours.hint("merge"), "row").join(theirs.hint("merge"), "hub")
    compared = full.withColumnsRenamed({"hub": "a", "row": "b"}).mapInArrow(
        _similarity_task, "a long, b long, similarity double"
    )
    links = store_table(compared.where(F.col("similarity") >= similarity), "star_links")
    return links.unionByName(_links_around(stars, links, sets, similarity))


def _links_around(stars: DataFrame, links: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links between rows apart from their hub and the other rows around it.

    Rows go to blocks of about ``BLOCK_ROWS``, and each pair of blocks is one group.
    """
    found = connected_components(links)
    mine = found.toDF("row", "component")
    hubs = found.toDF("hub", "main")
    named = (
        stars.join(mine.hint("merge"), "row", "left")
        .join(hubs.hint("merge"), "hub", "left")
        .select("hub", "row", F.coalesce("component", "row").alias("component"), F.coalesce("main", "hub").alias("main"))
    )
    named = store_table(named, "star_components")
    apart = F.col("component") != F.col("main")
    counts = named.groupBy("hub").agg(F.count_if(apart).alias("n_apart"), F.count(F.lit(1)).alias("n"))
    plan = counts.where("n_apart > 0 AND n > 1").select(
        "hub",
        F.ceil(F.col("n_apart") / BLOCK_ROWS).alias("rows_of_blocks"),
        F.ceil(F.col("n") / BLOCK_ROWS).alias("columns_of_blocks"),
    )
    spread = named.join(plan.hint("merge"), "hub").join(sets.hint("merge"), "row")
    place = ["hub", "i", "j"]
    columns = [*place, "row", "component", "shingles", "counts"]

    def dealt(rows: DataFrame, own: str, own_blocks: str, other: str, other_blocks: str) -> DataFrame:
        block = F.pmod(F.xxhash64("row"), F.col(own_blocks))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other_blocks) - 1))
        return rows.withColumn(own, block).withColumn(other, every).select(*columns)

    probes = dealt(spread.where(apart), "i", "rows_of_blocks", "j", "columns_of_blocks")
    others = dealt(spread, "j", "columns_of_blocks", "i", "rows_of_blocks")
    # Both sides come from one table: new columns tell them apart.
    others = others.toDF(*[f"other_{c}" for c in columns]).toDF(*columns)
    return (
        probes.groupBy(*place)
        .cogroup(others.groupBy(*place))
        .applyInArrow(_block_task(similarity), "a long, b long, similarity double")
    )


# Tasks --------------------------------------------------------------------------


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def weighted_shingles(part: Slice, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of the texts of a slice: text, hash, count, in this order."""
    words = find_words(part)
    sequences = Sequences(hash_ranges(part.data, words.starts, words.ends))
    count = np.diff(words.edges)
    shingles = np.where(count > 0, np.maximum(count - n + 1, 1), 0)
    text = np.repeat(np.arange(len(count)), shingles)
    first = words.edges[text] + np.arange(len(text)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    hashes = sequences.of(first, np.minimum(first + n, words.edges[text + 1]))
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])][: len(text)])
    return text[new], hashes[new], np.diff(np.r_[new, len(text)])


def prob_minhash(
    text: np.ndarray, elements: np.ndarray, weights: np.ndarray, n_texts: int, k: int
) -> np.ndarray:
    """Per text ``k`` registers, each with the element that arrives there first (0: no element).

    Round by round, each element that may still win draws its next arrival and a register. An
    element drops out once its clock is past the latest register of its text.
    """
    latest = np.full(n_texts * k, np.inf)
    winner = np.zeros(n_texts * k, _U)
    clock = np.zeros(len(elements))
    alive = np.arange(len(elements))
    step = 0
    with np.errstate(over="ignore"):
        while len(alive):
            step += 1
            draw = mix(elements[alive] + _U(step) * _U(0x9E3779B97F4A7C15))
            clock[alive] -= np.log(((draw >> _U(11)).astype(np.float64) + 1.0) * 2.0**-53) / weights[alive]
            register = (mix(draw ^ _U(0x632BE59BD9B4E019)) >> _U(32)) * _U(k) >> _U(32)
            slot = text[alive] * k + register.astype(np.int64)
            time = clock[alive]
            ahead = np.flatnonzero(time < latest[slot])
            np.minimum.at(latest, slot[ahead], time[ahead])
            won = ahead[time[ahead] == latest[slot[ahead]]]
            winner[slot[won]] = elements[alive[won]]
            limit = latest.reshape(n_texts, k).max(axis=1)
            alive = alive[time < limit[text[alive]]]
    return winner.reshape(n_texts, k)


def _sketch_task(shingle: int, bands: int, rows: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = _column(batch, "row").to_numpy()
            for part in slices(_column(batch, "text")):
                text, elements, counts = weighted_shingles(part, shingle)
                filled, text = np.unique(text, return_inverse=True)
                if len(filled) == 0:
                    continue
                registers = prob_minhash(text, elements, counts.astype(float), len(filled), bands * rows)
                at = np.arange(len(filled) * bands + 1) * rows
                # each band is a short sequence of its own; its number goes in as well
                joined = Sequences(registers.reshape(-1)).of(at[:-1], at[1:])
                number = np.tile(np.arange(bands, dtype=_U), len(filled))
                with np.errstate(over="ignore"):
                    bucket = mix(joined + number * _U(0xD1B54A32D192ED03)).view(np.int64)
                offsets = pa.array(np.arange(len(filled) + 1) * bands, pa.int32())
                yield pa.record_batch(
                    {
                        "row": keys[part.rows.start : part.rows.stop][filled],
                        "buckets": pa.ListArray.from_arrays(offsets, pa.array(bucket)),
                    }
                )

    return task


def _shingle_task(shingle: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = _column(batch, "row").to_numpy()
            for part in slices(_column(batch, "text")):
                text, hashes, counts = weighted_shingles(part, shingle)
                cuts = np.searchsorted(text, np.arange(len(part.rows) + 1))
                both = list(zip(cuts[:-1], cuts[1:]))
                counts = counts.astype(np.uint32)
                yield pa.record_batch(
                    {
                        "row": keys[part.rows.start : part.rows.stop],
                        "shingles": pa.array([hashes[a:b].tobytes() for a, b in both], pa.binary()),
                        "counts": pa.array([counts[a:b].tobytes() for a, b in both], pa.binary()),
                    }
                )

    return task


def _block_task(similarity: float):
    """Links between two blocks of rows; of a row, one link to each other component at most.

    For one row at a time, the sums of minima and of maxima over common shingles are taken for
    the whole other block. They bound the similarity from above, so it is worked out for few.
    """

    def compare(probes: pa.Table, others: pa.Table) -> pa.Table:
        links: list[tuple[int, int, float]] = []
        if probes.num_rows and others.num_rows:
            sets, weights = _unpacked(others)
            cuts = np.cumsum([0] + [len(x) for x in sets])
            every, ids = np.unique(np.concatenate(sets), return_inverse=True)
            counts = np.concatenate(weights).astype(float)
            totals = np.add.reduceat(counts, cuts[:-1])
            keys, components = others["row"].to_pylist(), others["component"].to_numpy()
            mine = zip(probes["row"].to_pylist(), probes["component"].to_pylist(), *_unpacked(probes))
            for row, component, elements, own in mine:
                dense = np.zeros(len(every))
                at = np.minimum(np.searchsorted(every, elements), len(every) - 1)
                known = every[at] == elements
                dense[at[known]] = own[known]
                here = dense[ids]
                low = np.add.reduceat(np.minimum(here, counts), cuts[:-1])
                high = np.add.reduceat(np.where(here > 0, np.maximum(here, counts), 0), cuts[:-1])
                bound = high / (own.sum() + totals - low)
                done = {component}
                for k in np.flatnonzero(bound >= similarity - 1e-9):
                    if components[k] not in done:
                        value = probability_jaccard(elements, own, sets[k], weights[k])
                        if value >= similarity:
                            done.add(components[k])
                            links.append((row, keys[k], value))
        a, b, value = zip(*links) if links else ((), (), ())
        return pa.table(
            {"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "similarity": pa.array(value, pa.float64())}
        )

    return compare


def _unpacked(rows: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray]]:
    sets = [np.frombuffer(x.as_buffer(), _U) for x in rows["shingles"]]
    return sets, [np.frombuffer(x.as_buffer(), np.uint32) for x in rows["counts"]]


def _similarity_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = ["a_shingles", "a_counts", "b_shingles", "b_counts"]
        columns = [_column(batch, n) for n in names]
        found = [
            probability_jaccard(
                np.frombuffer(columns[0][i].as_buffer(), _U),
                np.frombuffer(columns[1][i].as_buffer(), np.uint32),
                np.frombuffer(columns[2][i].as_buffer(), _U),
                np.frombuffer(columns[3][i].as_buffer(), np.uint32),
            )
            for i in range(batch.num_rows)
        ]
        yield pa.record_batch(
            {"a": _column(batch, "a"), "b": _column(batch, "b"), "similarity": pa.array(found, pa.float64())}
        )


def probability_jaccard(
    a: np.ndarray, a_counts: np.ndarray, b: np.ndarray, b_counts: np.ndarray
) -> float:
    """Sum over common elements d of 1 / sum over all e of max(x_e / x_d, y_e / y_d).

    Elements are sorted by x / y once; the maximum is x's share above d and y's share below,
    so running sums give every term. For equal weights it is the Jaccard similarity.
    """
    every = np.union1d(a, b)
    x, y = np.zeros(len(every)), np.zeros(len(every))
    x[np.searchsorted(every, a)] = a_counts
    y[np.searchsorted(every, b)] = b_counts
    ratio = np.divide(x, y, out=np.full(len(x), np.inf), where=y > 0)
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    x_above = np.r_[np.cumsum(x[::-1])[::-1], 0.0]
    y_below = np.r_[0.0, np.cumsum(y)]
    both = (x > 0) & (y > 0)
    at = np.searchsorted(ratio, ratio[both], "left")
    return float(np.sum(1.0 / (x_above[at] / x[both] + y_below[at] / y[both])))

"""Nearest neighbours by inner product, with a vantage-point tree per shard.

Vectors are parted by length first, into shells that differ by a quarter at most. Within a shell
vectors are scaled by its longest and get one more component, so that all have length one; the
order by inner product is then the order by distance from the query's direction, and the
triangle inequality holds. Shards are the cells around pivots in a shell, large cells split further.

A query first searches the cell that promises most, without any bound from outside. What it finds
there bounds the search of the others: cells that can't hold anything better are not visited,
and inside a shard the branches that can't. How near a cell may come follows from its radius, and
from the plane halfway between its pivot and the query's own.

A cell or branch is left out if ``factor`` times its least possible distance is beyond the bound.
Factor one is exact; a larger one visits less and may miss neighbours. It only ever counts for a
query that holds as many candidates as it asks for; until then nothing is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritally.session import store_table

K = 20
FACTOR = 1.5
SAMPLE = 2048
SHARD_ROWS = 4096
QUERIES_AT_ONCE = 4096
LEAF = 128
#: Longest to shortest vector of a shell, at most.
SHELL = 1.25
_SLACK = 1e-9

_ANSWERS = "query_id long, vec_id long, score double"
_PLACED = "cell long, distance double, key long, v array<double>"
_ROUTED = "cell long, least double, key long, v array<double>"


def usable_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """key and v (doubles) of rows whose vector can take part.

    Vectors that are null, empty, zero or hold null or non-finite components are left out,
    and so are null keys. The dimension is the most frequent one, of equals the largest;
    vectors of another dimension are left out.
    """
    v = F.transform(vector, lambda x: x.cast("double"))
    cast = rows.select(F.col(key).cast("long").alias("key"), v.alias("v")).where("key IS NOT NULL")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("v", lambda x: x != 0)
    good = cast.where(F.col("v").isNotNull() & F.coalesce(fine, F.lit(False)) & F.coalesce(some, F.lit(False)))
    sizes = good.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size"))
    first = sizes.first()
    return good.where(F.size("v") == (first["size"] if first else 0))


def nearest_neighbours(
    rows: DataFrame,
    is_query: F.Column,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    factor: float = FACTOR,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best other rows of each query.

    Scores are sums in double precision, component by component. Ties go to the smaller key.
    A query with fewer candidates gets all of them, one without any gets no row. Keys name
    rows: a key that occurs twice counts once per different vector, and never as its own
    neighbour. Of equal vectors only the ``k + 1`` smallest keys can be among anyone's best, so
    copies beyond these are set aside before the search; this changes no result.

    Pivots are vectors picked by a hash of the key, one per ``shard_rows`` and ``SAMPLE`` at most; all
    vectors are indexed. Queries of a shard are answered in blocks.
    """
    spark = rows.sparkSession
    good = usable_vectors(rows.withColumn("_asked", is_query).select(key, vector, "_asked"), key, vector)
    asked = usable_keys(rows, is_query, key)
    copies = F.row_number().over(Window.partitionBy("v").orderBy("key"))
    points = good.distinct().withColumn("copy", copies).where(F.col("copy") <= k + 1).drop("copy")
    points = points.withColumns({"length": _length("v")}).withColumn("shell", _shell(F.col("length")))
    points = store_table(points, "points")
    # One row per quarter of length that occurs.
    shells = points.groupBy("shell").agg(F.max("length").alias("top"), F.count(F.lit(1)).alias("n")).collect()
    if not shells:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tops = {r.shell: r.top for r in shells}
    pivots = min(SAMPLE, math.ceil(sum(r.n for r in shells) / shard_rows))
    sample = points.orderBy(F.xxhash64(F.lit("pivot"), "key"), "key").limit(pivots).collect()
    lifted = _lifted(np.array([r.v for r in sample]), np.array([tops[r.shell] for r in sample]))
    space = Space(lifted, tops, k, factor)
    shared = spark.sparkContext.broadcast(space)
    cells = store_table(points.select("key", "v", "shell").mapInArrow(_cell_task(shared), _PLACED), "cells")
    stats = cells.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("distance").alias("far"), F.min("distance").alias("near")
    )
    found = {r.cell: r for r in stats.collect()}
    names = np.array(sorted(found), np.int64)
    columns = [np.array([getattr(found[c], x) for c in names.tolist()]) for x in ("near", "far", "n")]
    borders = spark.sparkContext.broadcast(Borders(names, *columns))
    queries = store_table(good.join(asked.hint("merge"), "key").distinct(), "queries")
    home = store_table(queries.mapInArrow(_home_task(shared, borders), _ROUTED), "home")
    first = store_table(_search(cells, home.withColumn("held", F.lit(None).cast("double")), found, space, shard_rows), "near_answers")
    held = _best(first, k).where(F.col("rank") == k).select(F.col("query_id").alias("key"), F.col("score").alias("held"))
    known = queries.join(held.hint("merge"), "key", "left")
    routed = known.mapInArrow(_route_task(shared, borders), f"{_ROUTED}, held double")
    elsewhere = routed.join(home.select("cell", "key").distinct().hint("merge"), ["cell", "key"], "left_anti")
    elsewhere = store_table(elsewhere, "routed")
    rest = store_table(_search(cells, elsewhere, found, space, shard_rows), "far_answers")
    for broadcast in (shared, borders):
        broadcast.unpersist()
    return _best(first.unionByName(rest), k).select("query_id", "rank", "vec_id", "score")


def usable_keys(rows: DataFrame, is_query: F.Column, key: str) -> DataFrame:
    return rows.where(is_query).select(F.col(key).cast("long").alias("key")).distinct()


def _length(v: str) -> F.Column:
    """Euclidean length, scaled by the largest component so that squares don't overflow."""
    top = F.array_max(F.transform(v, F.abs))
    return top * F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + (x / top) * (x / top)))


def _shell(length: F.Column) -> F.Column:
    """Number of the shell; vectors of length one are in the middle of theirs."""
    return F.floor(F.log(length) / math.log(SHELL) + 0.5).cast("int")


def _best(answers: DataFrame, k: int) -> DataFrame:
    once = answers.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search(cells: DataFrame, asking: DataFrame, found: dict, space: Space, shard_rows: int) -> DataFrame:
    """Best rows of the cells for the queries that go there, shard by shard and block by block."""
    spark = cells.sparkSession
    load = {r.cell: r["count"] for r in asking.groupBy("cell").count().collect()}
    plan = spark.createDataFrame(
        [
            (c, math.ceil(r.n / shard_rows), math.ceil(load[c] / QUERIES_AT_ONCE))
            for c, r in found.items()
            if c in load
        ],
        "cell long, salts int, blocks int",
    )
    planned = F.broadcast(plan)  # one row per cell, of which there are no more than pivots in a shell
    place = ["cell", "salt", "block"]
    shards = (
        cells.join(planned, "cell")
        .withColumn("salt", F.pmod(F.xxhash64("key"), F.col("salts").cast("long")))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    queries = (
        asking.join(planned, "cell")
        .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks").cast("long")).cast("int"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts").cast("long") - 1)))
    )
    return (
        shards.select(*place, "key", "v")
        .groupBy(*place)
        .cogroup(queries.select(*place, "key", "v", "held").groupBy(*place))
        .applyInArrow(_search_task(space.k, space.factor), _ANSWERS)
    )


@dataclass
class Space:
    """Pivots of length one, the longest vector of each shell, and what is looked for."""

    pivots: np.ndarray
    tops: dict[int, float]
    k: int
    factor: float


@dataclass
class Borders:
    """Cells with the least and largest distance from their pivot, and their rows."""

    cells: np.ndarray
    near: np.ndarray
    far: np.ndarray
    n: np.ndarray

    def pivots(self, space: Space) -> np.ndarray:
        return self.cells % len(space.pivots)

    def tops(self, space: Space) -> np.ndarray:
        return np.array([space.tops[s] for s in (self.cells // len(space.pivots)).tolist()])


def _lifted(vectors: np.ndarray, tops: np.ndarray) -> np.ndarray:
    """Vectors scaled by the longest of their shell, with the component that makes them one long."""
    scaled = vectors / tops[:, None]
    return np.c_[scaled, np.sqrt(np.maximum(1 - (scaled**2).sum(axis=1), 0))]


def _directions(queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Queries of length one, with a last component of zero, and their lengths."""
    top = np.abs(queries).max(axis=1, keepdims=True)
    scaled = queries / top
    lengths = np.sqrt((scaled**2).sum(axis=1))
    return np.c_[scaled / lengths[:, None], np.zeros(len(queries))], lengths * top[:, 0]


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of vectors that are one long."""
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def _bound(score: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """Distance that goes with an inner product; below zero where no vector gets so far.

    ``reach`` is the length of the query times that of the longest vector.
    """
    square = 2 - 2 * score / reach
    return np.where(square < -1e-12, -1.0, np.sqrt(np.maximum(square, 0)))


def least_distances(directions: np.ndarray, space: Space, border: Borders) -> np.ndarray:
    """Least possible distance of each query from the vectors of each cell.

    Vectors of a cell are at least as near to its pivot as to any other, also to the one nearest
    to the query, so they lie beyond the plane halfway between the two.
    """
    every = _distance(directions, space.pivots)
    pivots = border.pivots(space)
    distance = every[:, pivots]
    ring = np.maximum(np.maximum(distance - border.far, border.near - distance), 0)
    home = every.argmin(axis=1)
    nearest = every[np.arange(len(every)), home]
    apart = _distance(space.pivots[home], space.pivots)[:, pivots]
    beyond = np.where(apart > 1e-6, (distance**2 - nearest[:, None] ** 2) / (2 * np.maximum(apart, 1e-6)), 0)
    return np.maximum(np.maximum(ring, beyond) - 1e-7, 0)


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed from the first component to the last."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i] * b[:, i]
    return total


@dataclass
class Node:
    """A vantage point (row), its two branches with their range of distances, or leaf rows."""

    rows: np.ndarray
    point: int = -1
    near: Node | None = None
    far: Node | None = None
    near_range: tuple[float, float] = (0.0, 0.0)
    far_range: tuple[float, float] = (0.0, 0.0)


def build_tree(lifted: np.ndarray, leaf: int = LEAF) -> Node:
    """Split rows at the median distance from a vantage point, until ``leaf`` rows are left."""

    def build(rows: np.ndarray) -> Node:
        if len(rows) <= leaf:
            return Node(rows)
        spot = rows[len(rows) // 2]
        rest = rows[rows != spot]
        distance = _distance(lifted[spot : spot + 1], lifted[rest])[0]
        order = np.argsort(distance, kind="stable")
        half = len(order) // 2
        low, high = order[:half], order[half:]
        return Node(
            rows[:0],
            int(spot),
            build(rest[low]),
            build(rest[high]),
            (distance[low[0]], distance[low[-1]]),
            (distance[high[0]], distance[high[-1]]),
        )

    return build(np.arange(len(lifted)))


class Search:
    """Best ``k`` rows of one shard for a block of queries.

    ``held`` is the score of a query's ``k``-th candidate from elsewhere; NaN if it has none.
    """

    def __init__(self, vectors, keys, queries, query_keys, held, top, k, factor):
        self.vectors, self.keys, self.lifted = vectors, keys, _lifted(vectors, np.full(len(vectors), top))
        self.queries, self.query_keys = queries, query_keys
        self.directions, lengths = _directions(queries)
        self.reach = lengths * top
        self.scores = np.full((len(queries), k), -np.inf)
        self.found = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.least = np.where(np.isnan(held), -np.inf, held)
        none = np.isnan(held)
        self.bounds = np.where(none, np.inf, _bound(np.where(none, 0, held), self.reach))
        # Nothing is relaxed for a query that may yet have to take what is there.
        self.factor = factor
        self.factors = np.where(none, 1.0, factor)

    def run(self, node: Node, asking: np.ndarray) -> None:
        if node.point < 0:
            self._take(node.rows, asking)
            return
        spot = np.array([node.point])
        self._take(spot, asking)
        distance = _distance(self.directions[asking], self.lifted[spot])[:, 0]
        middle = (node.near_range[1] + node.far_range[0]) / 2
        inside = distance <= middle
        for first, second, mine in ((node.near, node.far, inside), (node.far, node.near, ~inside)):
            for branch in (first, second):
                low, high = node.near_range if branch is node.near else node.far_range
                least = np.maximum(np.maximum(distance - high, low - distance) - 1e-7, 0)
                open_ = mine & (self.factors[asking] * least <= self.bounds[asking] + _SLACK)
                if open_.any():
                    self.run(branch, asking[open_])

    def _take(self, rows: np.ndarray, asking: np.ndarray) -> None:
        rough = self.queries[asking] @ self.vectors[rows].T
        least = np.maximum(self.scores[asking, -1], self.least[asking])
        slack = _SLACK * np.maximum(self.reach[asking], 1)
        q, r = np.nonzero(rough >= (least - slack)[:, None])
        other = self.keys[rows[r]] != self.query_keys[asking[q]]
        q, r = q[other], r[other]
        if len(q) == 0:
            return
        score = exact_scores(self.queries[asking[q]], self.vectors[rows[r]])
        touched, turn = np.unique(q, return_inverse=True)
        k = self.scores.shape[1]
        who = asking[touched]
        owner = np.r_[np.repeat(np.arange(len(who)), k), turn]
        scores = np.r_[self.scores[who].ravel(), score]
        keys = np.r_[self.found[who].ravel(), self.keys[rows[r]]]
        order = np.lexsort((keys, -scores, owner))
        owner = owner[order]
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        best = order[place < k]
        self.scores[who] = scores[best].reshape(-1, k)
        self.found[who] = keys[best].reshape(-1, k)
        full = self.scores[who, -1]
        some = np.isfinite(full)
        who, full = who[some], full[some]
        self.bounds[who] = np.minimum(self.bounds[who], _bound(full, self.reach[who]))
        self.factors[who] = self.factor


# Tasks --------------------------------------------------------------------------


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _cell_task(shared):
    """The cell of each vector: its shell, and the nearest pivot."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = shared.value
        for batch in batches:
            if batch.num_rows == 0:
                continue
            shell = _column(batch, "shell").to_numpy().astype(np.int64)
            tops = np.array([space.tops[s] for s in shell.tolist()])
            distance = _distance(_lifted(_matrix(_column(batch, "v")), tops), space.pivots)
            nearest = distance.argmin(axis=1)
            yield pa.record_batch(
                {
                    "cell": shell * len(space.pivots) + nearest,
                    "distance": distance[np.arange(len(nearest)), nearest],
                    "key": _column(batch, "key"),
                    "v": _column(batch, "v"),
                }
            )

    return task


def _home_task(shared, borders):
    """The cells that promise most, as many as it takes to have more rows than are asked for."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, border = shared.value, borders.value
        for batch in batches:
            if batch.num_rows == 0:
                continue
            column, keys = _column(batch, "v"), _column(batch, "key")
            directions, lengths = _directions(_matrix(column))
            least = least_distances(directions, space, border)
            promise = border.tops(space) * (1 - least**2 / 2)
            order = np.argsort(-promise, axis=1, kind="stable")
            rows = np.cumsum(border.n[order], axis=1)
            q, place = np.nonzero((rows - border.n[order]) <= space.k)
            c = order[q, place]
            yield pa.record_batch(
                {
                    "cell": border.cells[c],
                    "least": least[q, c],
                    "key": keys.take(pa.array(q)),
                    "v": column.take(pa.array(q)),
                }
            )

    return task


def _route_task(shared, borders):
    """The cells that the bound doesn't exclude; all of them for a query that holds too few."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, border = shared.value, borders.value
        tops = border.tops(space)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            column, keys = _column(batch, "v"), _column(batch, "key")
            held = _column(batch, "held").to_numpy(zero_copy_only=False).astype(float)
            directions, lengths = _directions(_matrix(column))
            least = least_distances(directions, space, border)
            bound = _bound(np.nan_to_num(held)[:, None], lengths[:, None] * tops)
            open_ = np.isnan(held)[:, None] | (space.factor * least <= bound + _SLACK)
            q, c = np.nonzero(open_)
            yield pa.record_batch(
                {
                    "cell": border.cells[c],
                    "least": least[q, c],
                    "key": keys.take(pa.array(q)),
                    "v": column.take(pa.array(q)),
                    "held": pa.array(held[q], from_pandas=True),
                }
            )

    return task


def _search_task(k: int, factor: float):
    def search(shard: pa.Table, asking: pa.Table) -> pa.Table:
        empty = {"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())}
        if shard.num_rows == 0 or asking.num_rows == 0:
            return pa.table(empty)
        vectors, queries = _matrix(shard["v"]), _matrix(asking["v"])
        order = np.argsort(shard["key"].to_numpy(), kind="stable")
        vectors, keys = vectors[order], shard["key"].to_numpy()[order]
        query_keys = asking["key"].to_numpy()
        held = asking["held"].to_numpy().astype(float)
        top = float(_directions(vectors)[1].max())
        run = Search(vectors, keys, queries, query_keys, held, top, k, factor)
        run.run(build_tree(run.lifted), np.arange(len(queries)))
        q, place = np.nonzero(np.isfinite(run.scores))
        return pa.table(
            {"query_id": query_keys[q], "vec_id": run.found[q, place], "score": run.scores[q, place]}
        )

    return search

"""Nearest neighbours: whole results, vectors of all lengths, and what is not visited."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from veritally.llm import neighbours as N


def frame(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")


def by_hand(x, q, k=20):
    scores = N.exact_scores(np.broadcast_to(x[q], x.shape), x)
    order = np.lexsort((np.arange(len(x)), -scores))
    return [int(i) for i in order if i != q][:k]


def found_by(spark, x, **options):
    rows = N.nearest_neighbours(frame(spark, x), F.col("vec_id") % 20 == 0, **options).collect()
    found = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append(r.vec_id)
    return found


def recall(found, x):
    wanted = {q: by_hand(x, q) for q in range(0, len(x), 20)}
    assert {q: len(v) for q, v in found.items()} == {q: len(v) for q, v in wanted.items()}  # none is short
    return sum(len(set(found[q]) & set(v)) for q, v in wanted.items()) / sum(map(len, wanted.values()))


def spheres(seed, n, d):
    x = np.random.default_rng(seed).normal(size=(n, d))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_every_query_is_answered_in_full(spark):
    """Fewer vectors than could be pivots: a bound is exact from the start, and relaxing it must not lose rows."""
    x = spheres(1, 1200, 64)
    assert recall(found_by(spark, x), x) >= 0.9


@pytest.mark.parametrize("shard_rows", [64, 500])
def test_varying_lengths(spark, shard_rows):
    r = np.random.default_rng(7)
    x = r.normal(size=(2000, 16)) * r.lognormal(0, 1, size=(2000, 1))
    assert recall(found_by(spark, x, shard_rows=shard_rows), x) >= 0.9
    got = found_by(spark, x, shard_rows=shard_rows, factor=1.0)
    assert all(got[q] == by_hand(x, q) for q in got)


def test_extreme_lengths(spark):
    r = np.random.default_rng(8)
    x = r.normal(size=(300, 5)) * 10.0 ** r.integers(-120, 120, size=(300, 1))
    got = found_by(spark, x, factor=1.0, shard_rows=32)
    assert all(got[q] == by_hand(x, q) for q in range(0, 300, 20))


def test_hot_equal_vectors(spark):
    x = spheres(3, 900, 12)
    x[300:600] = x[5]
    for factor in (1.0, 1.5):
        got = found_by(spark, x, shard_rows=64, factor=factor)
        assert recall(got, x) >= 0.9
        assert got[300] == [5, *range(301, 320)] and got[0][:1] == by_hand(x, 0)[:1]


def clustered(seed, n, d, centres=20):
    r = np.random.default_rng(seed)
    c = r.normal(size=(centres, d))
    x = c[r.integers(0, centres, n)] + 0.4 * r.normal(size=(n, d))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_least_distances_are_bounds_and_exclude_cells():
    x = clustered(5, 3000, 32)
    lifted = N._lifted(x, np.ones(len(x)) * 1.001)
    space = N.Space(lifted[:40], {0: 1.001}, 20, 1.0)
    distance = N._distance(lifted, space.pivots)
    cell = distance.argmin(axis=1)
    mine = distance[np.arange(len(x)), cell]
    cells = np.unique(cell)
    border = N.Borders(
        cells,
        np.array([mine[cell == c].min() for c in cells]),
        np.array([mine[cell == c].max() for c in cells]),
        np.array([(cell == c).sum() for c in cells]),
    )
    directions, lengths = N._directions(x[::50])
    least = N.least_distances(directions, space, border)
    real = N._distance(directions, lifted)
    for j, c in enumerate(cells):
        assert (least[:, j] <= real[:, cell == c].min(axis=1) + 1e-12).all()
    kth = -np.sort(-(x[::50] @ x.T), axis=1)[:, 20]
    visited = least <= N._bound(kth, lengths * 1.001)[:, None]
    assert visited.mean() < 0.3  # most cells can't hold a neighbour of most queries


def test_clustered_vectors_visit_few_cells(spark, monkeypatch):
    x = clustered(6, 2400, 32)
    routed = {}
    store = N.store_table

    def counting(df, name):
        kept = store(df, name)
        if name in ("home", "routed"):
            routed[name] = kept.count()
        return kept

    monkeypatch.setattr(N, "store_table", counting)
    assert recall(found_by(spark, x, shard_rows=100), x) >= 0.9
    assert sum(routed.values()) < 0.6 * 120 * 24  # queries x cells


def test_relaxing_waits_for_candidates():
    """A query without enough rows takes whatever there is, however far the factor goes."""
    x = spheres(9, 400, 8)
    run = N.Search(x, np.arange(400), x[:3], np.arange(3), np.full(3, np.nan), 1.0, 20, 50.0)
    run.run(N.build_tree(run.lifted, leaf=4), np.arange(3))
    assert np.isfinite(run.scores).all()

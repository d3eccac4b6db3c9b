"""Metrics that a caller brings along, over all rows, wherever they are.

A metric is four functions: an empty state, a state taken further by a batch of logits and labels,
two states made one, and numbers out of a state. Tasks take their rows into one state each; the
states are then merged in a tree of groups of bounded size. So neither rows nor states ever
meet in one task, and a metric needs no more than memory for a few of its states.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Mapping
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.session import let_workers_import, store_table
from veritally.sources.schema import require_columns

#: States that one task merges.
FAN_IN = 32

_STATES = "place long, states binary"


class Metric(Protocol):
    """What a metric has to offer. States travel by pickle."""

    #: The names of the numbers that ``finish`` gives.
    names: tuple[str, ...]

    def init(self) -> Any: ...

    def update(self, state: Any, logits: np.ndarray, labels: np.ndarray) -> Any:
        """``logits``: one row of doubles per text, ``labels``: one long each. Neither is empty."""

    def merge(self, left: Any, right: Any) -> Any: ...

    def finish(self, state: Any) -> Mapping[str, float | None]: ...


def evaluate_metrics(
    df: DataFrame,
    metrics: Mapping[str, Metric],
    logits: str = "logits",
    label: str = "labels",
    fan_in: int = FAN_IN,
) -> DataFrame:
    """One row with a double per metric and name, called ``<metric>_<name>``.

    Rows without logits or label take no part; logits are arrays of one length. No rows give what
    ``finish`` makes of an empty state. States are merged in the order of the tasks that made
    them, so the same partitions give the same sums. A number may be None.

    A metric whose ``finish`` leaves out a name, or gives one it didn't announce, fails the job.
    """
    require_columns(df, [logits, label])
    if not metrics:
        raise ValueError("no metric given")
    if fan_in < 2:
        raise ValueError("merging needs at least two states at a time")
    let_workers_import(df.sparkSession)
    chosen = dict(metrics)
    columns = {(m, n): f"{m}_{n}" for m, metric in chosen.items() for n in metric.names}
    if len(set(columns.values())) < len(columns):
        raise ValueError(f"metrics share a name: {sorted(columns.values())}")
    rows = df.where(F.col(logits).isNotNull() & F.col(label).isNotNull()).select(
        F.col(logits).cast("array<double>").alias("logits"), F.col(label).cast("long").alias("labels")
    )
    # One state per task that had rows, and an empty one, so that there is always a result.
    parts = rows.mapInArrow(_update_task(chosen), "states binary")
    parts = parts.select((F.spark_partition_id() + 1).cast("long").alias("place"), "states")
    empty = pickle.dumps({m: metric.init() for m, metric in chosen.items()})
    first = df.sparkSession.range(0, 1, 1, 1).select(F.col("id").alias("place"), F.lit(empty).alias("states"))
    states = store_table(parts.unionByName(first), "metric_states")
    left = states.agg(F.max("place")).first()[0] + 1
    while left > 1:
        group = F.expr(f"place div {fan_in}").alias("group")
        states = states.groupBy(group).applyInArrow(_merge_task(chosen), _STATES)
        left = -(-left // fan_in)
        if left > 1:
            states = store_table(states, "metric_states")
    kinds = ", ".join(f"`{c}` double" for c in columns.values())
    return states.mapInArrow(_finish_task(chosen, columns), kinds)


# Tasks --------------------------------------------------------------------------


def _update_task(metrics: Mapping[str, Metric]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            logits, labels = batch.column("logits"), batch.column("labels").to_numpy()
            widths = set(logits.value_lengths().to_pylist())
            if len(widths) > 1:
                raise ValueError(f"logits have different lengths: {sorted(widths)}")
            table = logits.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            states = states or {m: metric.init() for m, metric in metrics.items()}
            states = {m: metric.update(states[m], table, labels) for m, metric in metrics.items()}
        if states:
            yield pa.record_batch({"states": pa.array([pickle.dumps(states)], pa.binary())})

    return task


def _merge_task(metrics: Mapping[str, Metric]):
    def task(key: tuple, group: pa.Table) -> pa.Table:
        packed = group.sort_by("place")["states"].to_pylist()
        merged = pickle.loads(packed[0])
        for raw in packed[1:]:
            other = pickle.loads(raw)
            merged = {m: metric.merge(merged[m], other[m]) for m, metric in metrics.items()}
        place = pa.array([key[0].as_py()], pa.int64())
        return pa.table({"place": place, "states": pa.array([pickle.dumps(merged)], pa.binary())})

    return task


def _finish_task(metrics: Mapping[str, Metric], columns: Mapping[tuple[str, str], str]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("states").to_pylist():
                found = {}
                for m, state in pickle.loads(raw).items():
                    numbers = metrics[m].finish(state)
                    if set(numbers) != set(metrics[m].names):
                        raise ValueError(f"metric '{m}' gave {sorted(numbers)}, not {sorted(metrics[m].names)}")
                    found |= {columns[m, n]: numbers[n] for n in metrics[m].names}
                yield pa.record_batch({c: pa.array([found[c]], pa.float64()) for c in columns.values()})

    return task

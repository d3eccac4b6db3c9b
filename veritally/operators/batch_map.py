"""A caller's own function over batches of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from veritally.session import let_workers_import
from veritally.sources.schema import require_columns

#: A batch of columns in, columns by name out: arrays, lists or numpy arrays of equal length.
BatchFunction = Callable[[pa.RecordBatch], Mapping[str, object]]

DEFAULT_BATCH = 1000


def map_batches(
    df: DataFrame,
    function: BatchFunction | None,
    schema: StructType | str,
    inputs: Sequence[str] | None = None,
    keep: Sequence[str] | None = None,
    batch_size: int = DEFAULT_BATCH,
    load: Callable[[], BatchFunction] | None = None,
) -> DataFrame:
    """``keep`` columns of each row with the columns that ``function`` makes of it.

    The function gets Arrow batches of at most ``batch_size`` rows with the ``inputs`` columns
    (default: all) and returns the columns of ``schema``. It answers row by row: as many values
    in each column as the batch has rows, in their order. The kept columns (default: all that
    ``schema`` doesn't replace) never pass through the function and can't be lost, shifted or
    changed by it. A function that needs a model gives ``load`` instead, which runs once per task
    and returns the function.

    The job fails, with the reason, if a column is missing or extra, if a column has another
    number of values, or if a value doesn't fit its type; Spark doesn't see such rows. An error
    of the function fails the job as well. Nulls go in as nulls and may come out. An empty frame
    gives no rows, and the function isn't called. Batches don't span tasks, so a function may
    depend on the rows of a batch only at the risk of its own results. There is no shuffle.
    """
    if (function is None) == (load is None):
        raise ValueError("give either a function or what loads one")
    if batch_size < 1:
        raise ValueError("a batch needs at least one row")
    made = df.sparkSession.createDataFrame([], schema).schema if isinstance(schema, str) else schema
    given = list(df.columns if inputs is None else inputs)
    kept = [c for c in df.columns if c not in made.names] if keep is None else list(keep)
    require_columns(df, [*given, *kept])
    both = sorted(set(kept) & set(made.names))
    if both:
        raise ValueError(f"columns {both} are kept and made")
    needed = [c for c in df.columns if c in given or c in kept]
    out = StructType([*[df.schema[c] for c in kept], *made.fields])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply, types = None, None
        for whole in batches:
            for at in range(0, whole.num_rows, batch_size):
                batch = whole.slice(at, batch_size)
                apply = apply or (load() if load else function)
                found = _checked(apply(batch.select(given)), made.names, batch.num_rows)
                types = types or _arrow_types(made)
                columns = {c: batch.column(batch.schema.get_field_index(c)) for c in kept}
                columns |= {c: _typed(c, found[c], types[c]) for c in made.names}
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    let_workers_import(df.sparkSession)
    return df.select(*needed).mapInArrow(task, out)


def _checked(found: Mapping[str, object], names: Sequence[str], rows: int) -> dict[str, object]:
    if isinstance(found, pa.RecordBatch | pa.Table):
        found = {c: found.column(i) for i, c in enumerate(found.schema.names)}
    if not isinstance(found, Mapping):
        raise TypeError(f"the function returned {type(found).__name__}, not columns by name")
    missing, extra = sorted(set(names) - set(found)), sorted(set(found) - set(names))
    if missing or extra:
        raise ValueError(f"the function's columns don't fit the schema: missing {missing}, extra {extra}")
    for name in names:
        if len(found[name]) != rows:
            raise ValueError(f"column '{name}' has {len(found[name])} values for {rows} rows")
    return dict(found)


def _typed(name: str, values: object, kind: pa.DataType) -> pa.Array:
    try:
        if isinstance(values, pa.ChunkedArray):
            values = values.combine_chunks()
        if isinstance(values, pa.Array):
            return values.cast(kind)
        return pa.array(values, kind, from_pandas=True)
    except (pa.ArrowInvalid, pa.ArrowTypeError, pa.ArrowNotImplementedError, TypeError) as error:
        raise ValueError(f"column '{name}' doesn't fit {kind}: {error}") from error


def _arrow_types(schema: StructType) -> dict[str, pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_schema

    return {f.name: f.type for f in to_arrow_schema(schema)}

"""Column checks made on the driver, before any data is read."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def require_columns(df: DataFrame, required: Iterable[str], what: str = "input") -> DataFrame:
    require_names(df.columns, required, what)
    return df


def require_names(present: Iterable[str], required: Iterable[str], what: str = "input") -> None:
    present = list(present)
    missing = sorted(set(required) - set(present))
    if missing:
        raise ValueError(f"{what} lacks columns {missing}; it has {present}")

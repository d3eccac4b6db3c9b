"""Fetching wide columns late, for a few rows picked on narrow ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The picked rows hold a key and a few numbers, so this many stay within a few MB.
MAX_BROADCAST_ROWS = 10_000


def fetch_by_key(picked: DataFrame, source: DataFrame, key: str, max_rows: int) -> DataFrame:
    """Join ``picked`` with the columns of ``source``.

    ``max_rows`` is the proven bound on the rows of ``picked``. Within the limit
    the picked side is broadcast and texts are read without a shuffle; beyond it
    Spark joins the two sides by key.
    """
    small = F.broadcast(picked) if max_rows <= MAX_BROADCAST_ROWS else picked
    return source.join(small, key)

"""Reproducible pseudo-random keys.

md5 of ``id:salt`` is stable across Spark versions, partitionings and engines,
so membership never depends on row order and never moves as data grows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 4294967296.0


def digest(key: Column, salt: object) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(f":{salt}")))


def hash32(key: Column, salt: object) -> Column:
    """First 32 bits of the digest, as a non-negative BIGINT."""
    return F.conv(F.substring(digest(key, salt), 1, 8), 16, 10).cast("bigint")


def unit_interval(key: Column, salt: object) -> Column:
    """A number in [0, 1) that depends only on the key and the salt."""
    return hash32(key, salt) / F.lit(HASH_RANGE)

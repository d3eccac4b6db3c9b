"""Guarded ratios.

ANSI mode makes x/0 an error, and the operators differ in what an undefined
metric is: a zero in threshold metrics, a null in probe and slice metrics.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_or_null(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(ratio_or_null(part, whole), F.lit(0.0))


def rounded(value: Column, digits: int = 4) -> Column:
    return F.round(value, digits)

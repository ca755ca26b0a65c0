"""Rounding and means that do not depend on how rows were split into tasks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimloom.functions import as_column

# Run records hold seconds, percents and megabytes with at most four decimals.
_EXACT = "decimal(28,4)"


def round_half_even(c: Column | str, digits: int) -> Column:
    """Round a double the way array libraries do: scale, nearest with ties to even, scale back."""
    scale = F.lit(10.0**digits)
    return F.rint(as_column(c) * scale) / scale


def exact(c: Column | str) -> Column:
    """Recorded figure as a decimal, so that sums come out alike in any order."""
    return as_column(c).cast(_EXACT)


def exact_sum(c: Column | str) -> Column:
    return F.sum(exact(c)).cast("double")


def exact_mean(c: Column | str) -> Column:
    """Mean of the non-null values; null without any."""
    return F.try_divide(exact_sum(c), F.count(as_column(c)))

"""Keep one row per key.

``row_number() = 1`` is planned with a group limit before the shuffle: every
map task sends at most one row per key, so a key that a third of all rows share
costs one row per map task. ``fan_in`` adds a salted round for inputs with so
many map tasks that even this is too much for one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _top_row(df: DataFrame, keys: Sequence, order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def _columns(names: Sequence) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def keep_first(df: DataFrame, keys: Sequence, order: Sequence, fan_in: int = 0) -> DataFrame:
    """First row per key in ``order``; null keys count as one value."""
    order = _columns(order)
    if fan_in:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(fan_in)))
        df = _top_row(salted, [*keys, "_salt"], order).drop("_salt")
    return _top_row(df, keys, order)


def keep_last(df: DataFrame, keys: Sequence, order: Sequence, fan_in: int = 0) -> DataFrame:
    """Last row per key in ``order``."""
    order = _columns(order)
    if fan_in:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(fan_in)))
        df = _top_row(salted, [*keys, "_salt"], [c.desc() for c in order]).drop("_salt")
    return _top_row(df, keys, [c.desc() for c in order])


def distinct_reviews(reviews: DataFrame, order: Sequence = ("input_order",)) -> DataFrame:
    """One row per review_url, the earliest; all rows without one count as the same review."""
    return keep_first(reviews, ["review_url"], order)

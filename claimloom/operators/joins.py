"""Lookups that hold when one key, or null, owns a large share of the rows.

No side is broadcast by hint: adaptive execution broadcasts a side whose
measured size is under ``spark.sql.autoBroadcastJoinThreshold``, merges sorted
sides beyond it, and splits the partitions of a key too big for one task. Rows
with a null key match nothing; they are spread instead of meeting in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def skew_join(left: DataFrame, right: DataFrame, on: str, spread_by: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on a string key with a ``right`` that has each key once, for left, left_semi, left_anti or inner.

    A null key gets a stand-in that no right key equals, made from
    ``spread_by`` (columns that tell equal rows apart, so that a recomputed
    task spreads alike). Building the plan runs no job.
    """
    stand_in = F.concat(F.lit("\0"), F.xxhash64(*spread_by).cast("string"))
    left = left.withColumn("_key", F.coalesce(F.col(on), stand_in))
    # Spark splits a hot key only between two fresh shuffles; a right side grouped by the key would go without one.
    right = right.withColumn("_key", F.concat(F.col(on), F.lit(""))).drop(on)
    return left.join(right, "_key", how).drop("_key")

"""Exact-size, repeatable random samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw_key(key: str, seed: int = 42) -> Column:
    """A number per row that looks random but follows from key and seed; a null key has one as well."""
    return F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f":{seed}")))


def sample_rows(df: DataFrame, n: int | None, key: str, seed: int = 42) -> DataFrame:
    """At most ``n`` rows drawn by ``key``, which must be unique; all of them when n is None.

    Each task keeps its own n best rows before they meet, so the cost of a draw
    is n rows per task, whatever the input's size.
    """
    return df if n is None else df.orderBy(draw_key(key, seed), key).limit(n)


def sample_per_file(df: DataFrame, files: Sequence[str], n: int | None, key: str, file: str = "file", seed: int = 42) -> DataFrame:
    """At most ``n`` rows of each listed file, in one scan; each task keeps ``n`` rows of a file before they meet."""
    listed = df.filter(F.col(file).isin(*files))
    if n is None:
        return listed
    drawn = Window.partitionBy(file).orderBy(draw_key(key, seed), key)
    return listed.withColumn("_draw", F.row_number().over(drawn)).filter(F.col("_draw") <= n).drop("_draw")

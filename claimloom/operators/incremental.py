"""Feeds polled again and again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.operators.joins import skew_join


def new_posts(feed: DataFrame, stored: DataFrame, spread_by: Sequence[str] = ("post_text", "pub_date")) -> DataFrame:
    """Feed rows whose guid is not stored yet.

    A row without guid is always new, and copies inside the feed are kept.
    """
    known = stored.select("guid").filter(F.col("guid").isNotNull()).distinct()
    return skew_join(feed, known, "guid", spread_by, "left_anti").select(*feed.columns)


def append_new_posts(stored: DataFrame, feed: DataFrame, **options) -> DataFrame:
    """Stored rows followed by the feed's new ones; absent columns are null."""
    return stored.unionByName(new_posts(feed, stored, **options), allowMissingColumns=True)

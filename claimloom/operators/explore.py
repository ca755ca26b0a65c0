"""Exploration tables over raw, fetched and curated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.dates import parse_datetime
from claimloom.functions.numbers import round_half_even
from claimloom.functions.ratings import label_from_rating
from claimloom.functions.urls import PUBLISHER_SITES

MAX_AGE_DAYS = 180


def status_histogram(fetched: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Rows per HTTP status, those without an answer included, null last."""
    counted = fetched.groupBy(*within, "http_status").agg(F.count("*").alias("n"))
    return counted.orderBy(*within, F.col("http_status").asc_nulls_last())


def class_balance(df: DataFrame) -> DataFrame:
    counted = df.filter(F.col("label").isNotNull()).groupBy("label").agg(F.count("*").alias("n"))
    return counted.orderBy(F.col("n").desc(), "label")


def top_unmapped_ratings(df: DataFrame, rating: str = "textual_rating", n: int = 15) -> DataFrame:
    """The most frequent ratings that give no label; the report is a top n.

    Ratings are counted first, so that only distinct ones are matched.
    """
    counted = df.filter(F.col(rating).isNotNull()).groupBy(F.col(rating).alias("rating")).agg(F.count("*").alias("n"))
    return counted.filter(label_from_rating("rating").isNull()).orderBy(F.col("n").desc(), "rating").limit(n)


def file_summary(rows: DataFrame, file: str = "file") -> DataFrame:
    """Per input file: its label, rows kept, rows with article text."""
    return rows.groupBy(file).agg(
        F.min("label").alias("label"),
        F.count("*").alias("rows_kept"),
        F.count("article_text").alias("rows_with_article_text"),
    )


def text_coverage(fetched: DataFrame) -> DataFrame:
    """Rows, answered fetches, usable texts, images, and the share of rows with text."""
    has_text = F.col("article_text").isNotNull()
    return fetched.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("http_status") == 200).alias("fetched_ok"),
        F.count_if(has_text).alias("with_text"),
        F.count_if(F.col("image_url").isNotNull()).alias("with_image"),
        round_half_even(F.try_divide(F.count_if(has_text), F.count("*")), 4).alias("text_share"),
    )


def preview_rows(df: DataFrame, present: str, columns: Sequence[str], order: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows, in ``order``, that have ``present``."""
    return df.filter(F.col(present).isNotNull()).orderBy(*order).limit(n).select(*columns)


def publisher_site_filter(
    reviews: DataFrame, sites: Sequence[str] = PUBLISHER_SITES, column: str = "review_publisher_site"
) -> DataFrame:
    """Reviews of the listed publishers."""
    return reviews.filter(F.col(column).isin(*sites))


def max_age_filter(
    reviews: DataFrame, as_of: str | Column, days: int = MAX_AGE_DAYS, column: str = "review_date", pivot_year: int | None = None
) -> DataFrame:
    """Reviews with a readable date at most ``days`` before ``as_of`` (a UTC timestamp)."""
    now = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    cutoff = now - F.make_dt_interval(F.lit(days))
    return reviews.filter(parse_datetime(column, pivot_year) >= cutoff)

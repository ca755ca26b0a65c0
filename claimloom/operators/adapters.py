"""Raw columns of each collection -> canonical columns.

An adapter is a ``DataFrame -> DataFrame`` function; supporting another
collection means writing one and adding it to ``ADAPTERS``. Whether the result
has a ``label`` column decides if ratings are mapped later, not whether the
label is null.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.schema import LABELS, RAW_REVIEWS, column_or_null, require_columns

# Bookkeeping columns that pass through every adapter when the input has them.
ORDER, DATASET = "input_order", "dataset"


def input_position(df: DataFrame) -> list[str]:
    """Bookkeeping columns the frame has: together they order its rows as they came in."""
    return [c for c in (DATASET, ORDER) if c in df.columns]


def _text(value: str | None) -> Column:
    return F.lit(value).cast("string")


def _select(df: DataFrame, **columns: Column) -> DataFrame:
    return df.select(*input_position(df), *[c.alias(name) for name, c in columns.items()])


def adapt_factcheck_api(df: DataFrame) -> DataFrame:
    """Claim reviews of the fact-check search API. No label: the rating is mapped."""
    require_columns(df, RAW_REVIEWS.fieldNames(), "google_factcheck")
    return _select(
        df,
        source=F.lit("google_factcheck"),
        claim_text=F.col("claim_text"),
        claimant=F.col("claimant"),
        claim_date=F.col("claim_date"),
        article_title=F.col("review_title"),
        article_text=F.col("article_text"),
        article_url=F.col("review_url"),
        image_url=_text(None),
        publisher_name=F.col("review_publisher_name"),
        publisher_site=F.col("review_publisher_site"),
        published_at=F.col("review_date"),
        textual_rating_raw=F.col("textual_rating"),
        language_code=F.col("language_code"),
    )


def adapt_post_feed(df: DataFrame) -> DataFrame:
    """Posts of one publisher's feed. They carry no verdict: label is there, and null."""
    require_columns(df, ("post_text", "guid"), "bluesky_afp")
    return _select(
        df,
        source=F.lit("bluesky_afp"),
        claim_text=F.col("post_text"),
        claimant=_text(None),
        claim_date=column_or_null(df, "pub_date"),
        article_title=_text(None),
        article_text=column_or_null(df, "article_text"),
        article_url=column_or_null(df, "article_url"),
        image_url=column_or_null(df, "image_url"),
        publisher_name=F.lit("AFP Factuel"),
        publisher_site=F.lit("factuel.afp.com"),
        published_at=column_or_null(df, "pub_date"),
        textual_rating_raw=_text(None),
        label=_text(None),
        language_code=F.lit("fr"),
    )


def adapt_news_links(df: DataFrame, label: str | None = None) -> DataFrame:
    """News links of one file, which holds one label only, or of several with a ``label`` column."""
    if label is None and "label" in df.columns:
        verdict = checked_label("label", "fakenewsnet")
    elif label in LABELS:
        verdict = F.lit(label)
    else:
        raise ValueError(f"fakenewsnet: label must be one of {LABELS}, not {label!r}")
    require_columns(df, ("news_url", "title"), "fakenewsnet")
    return _select(
        df,
        source=F.lit("fakenewsnet"),
        claim_text=F.col("title"),
        claimant=_text(None),
        claim_date=_text(None),
        article_title=F.col("title"),
        article_text=column_or_null(df, "article_text"),
        article_url=F.col("news_url"),
        image_url=_text(None),
        publisher_name=_text(None),
        publisher_site=_text(None),
        published_at=_text(None),
        textual_rating_raw=verdict,
        label=verdict,
        language_code=F.lit("en"),
    )


def adapt_labeled_articles(df: DataFrame) -> DataFrame:
    """Articles that come with a label. One outside the domain fails the job that reads it."""
    require_columns(df, ("title", "text", "label"), "isot")
    label = checked_label("label", "isot")
    return _select(
        df,
        source=F.lit("isot"),
        # A row without a title is dropped early; naming the label here has it checked before that.
        claim_text=F.when(label.isNull() | label.isNotNull(), F.col("title")),
        claimant=_text(None),
        claim_date=column_or_null(df, "date"),
        article_title=F.col("title"),
        article_text=F.col("text"),
        article_url=_text(None),
        image_url=_text(None),
        publisher_name=_text(None),
        publisher_site=_text(None),
        published_at=column_or_null(df, "date"),
        textual_rating_raw=F.col("label"),
        label=label,
        language_code=F.lit("en"),
    )


def checked_label(column: str, who: str) -> Column:
    """The label, or a failure naming the first one outside the domain: no separate pass."""
    label = F.col(column)
    message = F.concat(F.lit(f"{who}: unexpected label value "), label)
    return F.when(label.isNull() | label.isin(*LABELS), label).otherwise(F.raise_error(message))


def offending_labels(df: DataFrame, column: str = "label") -> DataFrame:
    """Label values outside the domain, with row counts."""
    return (
        df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*LABELS))
        .groupBy(F.col(column).alias("label"))
        .agg(F.count("*").alias("n"))
    )


# Collection names users select adapters by.
ADAPTERS: dict[str, Callable[..., DataFrame]] = {
    "google_factcheck": adapt_factcheck_api,
    "bluesky_afp": adapt_post_feed,
    "fakenewsnet": adapt_news_links,
    "fakenewsnet_gossipcop_fake": partial(adapt_news_links, label="fake"),
    "fakenewsnet_gossipcop_true": partial(adapt_news_links, label="true"),
    "fakenewsnet_politifact_fake": partial(adapt_news_links, label="fake"),
    "fakenewsnet_politifact_true": partial(adapt_news_links, label="true"),
    "isot": adapt_labeled_articles,
}


def adapt(df: DataFrame, source: str, **options) -> DataFrame:
    """Apply the adapter registered as ``source``."""
    if source not in ADAPTERS:
        raise ValueError(f"unknown source {source!r}; available: {sorted(ADAPTERS)}")
    return ADAPTERS[source](df, **options)

"""Stored web pages (url, http_status, html): usable content, dead links, attachment to claims.

``http_status`` is null where the fetch got no answer at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.functions.html import article_text, preview_image
from claimloom.functions.html_tree import article_text_nested
from claimloom.functions.text import MIN_ARTICLE_CHARS, min_length
from claimloom.operators.adapters import ORDER
from claimloom.operators.dedup import keep_first
from claimloom.operators.joins import skew_join
from claimloom.schema import RAW_LINKS

# Answers that mean the page is gone for good. 403 and 500 do not.
DEAD_STATUSES = (404, 410)


def page_content(pages: DataFrame, min_chars: int = MIN_ARTICLE_CHARS, nested: bool = False) -> DataFrame:
    """Article text and preview image per page; both null unless the answer was 200.

    ``nested`` repeats the paragraphs inside an unclosed one, as a tree parser does.
    """
    body = F.when(F.col("http_status") == 200, F.col("html"))
    # min_length names the text twice: its own step computes it once.
    return pages.withColumns({
        "article_text": article_text_nested(body) if nested else article_text(body),
        "image_url": preview_image(body, "url"),
    }).withColumn("article_text", min_length("article_text", min_chars)).drop("html")


def is_dead():
    return F.col("http_status").isNull() | F.col("http_status").isin(*DEAD_STATUSES)


def drop_dead_links(df: DataFrame) -> DataFrame:
    return df.filter(~is_dead())


def dead_links(df: DataFrame) -> DataFrame:
    return df.filter(is_dead())


def prune_source_dead_rows(source: DataFrame, checked: DataFrame, key: str = "id") -> DataFrame:
    """Source rows, original columns, without those ``checked`` found dead; unchecked rows stay."""
    gone = dead_links(checked).select(key).distinct()
    return source.join(gone, key, "left_anti").select(*RAW_LINKS.fieldNames())


def attach_page_text(
    claims: DataFrame,
    pages: DataFrame,
    url: str = "article_url",
    page_order: Sequence[str] = (ORDER,),
    spread_by: Sequence[str] = (ORDER,),
    min_chars: int = MIN_ARTICLE_CHARS,
    nested: bool = False,
    fan_in: int = 0,
) -> DataFrame:
    """Claims with http_status, article_text and image_url of their page; nulls without address or page.

    A page is parsed once however many claims point at it, and only if one
    does. HTML that will not be read travels in no shuffle: that of an answer
    other than 200, and that of a page no claim names.
    """
    named = claims.select(F.col(url).alias("url")).filter(F.col("url").isNotNull()).distinct()
    readable = pages.withColumn("html", F.when(F.col("http_status") == 200, F.col("html")))
    one_each = keep_first(readable.join(named, "url", "left_semi"), ["url"], page_order, fan_in)
    content = page_content(one_each, min_chars, nested).select(
        F.col("url").alias(url), "http_status", "article_text", "image_url"
    )
    fetched = [c for c in ("http_status", "article_text", "image_url") if c in claims.columns]
    return skew_join(claims.drop(*fetched), content, url, spread_by, "left")

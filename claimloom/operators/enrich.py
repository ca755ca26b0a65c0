"""Derived columns of a cleaned row."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.ids import record_id
from claimloom.functions.text import text_length
from claimloom.schema import column_or_null


def run_stamp(moment: datetime | None = None) -> str:
    return (moment or datetime.now(timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")


def stamp_ingested_at(ingested_at: str | None = None) -> Column:
    """One time for all rows of a run, so that a recomputed task writes the same."""
    return F.lit(ingested_at or run_stamp())


def enrich_claims(df: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """Row id, text length and ingest time."""
    url, text = column_or_null(df, "article_url"), column_or_null(df, "article_text")
    return df.withColumns({
        "record_id": record_id("source", url, "claim_text", text),
        "article_text_length": text_length(text),
        "ingested_at": stamp_ingested_at(ingested_at),
    })

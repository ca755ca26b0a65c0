"""Column contracts: canonical claims, raw inputs per source, star tables, run records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _L, _D, _B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _field(name: str, dtype: T.DataType, role: str, about: str, required: bool = False) -> T.StructField:
    return T.StructField(name, dtype, True, {"role": role, "required": required, "description": about})


# Names, order, roles and required flags are the output contract.
CANONICAL = T.StructType([
    _field("record_id", _S, "identifier", "16 hex digits that identify the row by its content", True),
    _field("source", _S, "provenance", "collection the row belongs to", True),
    _field("claim_text", _S, "nlp_text", "statement that was checked", True),
    _field("claimant", _S, "metadata", "person or body that made the statement"),
    _field("claim_date", _S, "metadata", "when the statement was made, ISO 8601 UTC"),
    _field("article_title", _S, "nlp_text", "headline of the review or article"),
    _field("article_text", _S, "nlp_text", "body of the review or article"),
    _field("article_text_length", _L, "metadata", "code points in article_text, 0 without text"),
    _field("article_url", _S, "provenance", "address of the review or article"),
    _field("image_url", _S, "multimodal_image", "address of an image shown with the claim"),
    _field("has_valid_image", _B, "multimodal_image", "image_url looks like an image file"),
    _field("publisher_name", _S, "metadata", "who published the review"),
    _field("publisher_site", _S, "metadata", "web domain of the publisher"),
    _field("published_at", _S, "metadata", "when the review came out, ISO 8601 UTC"),
    _field("textual_rating_raw", _S, "provenance", "verdict in the publisher's own words"),
    _field("label", _S, "classification_target", "fake or true", True),
    _field("language_code", _S, "metadata", "BCP-47 language tag"),
    _field("ingested_at", _S, "provenance", "when this run handled the row, ISO 8601 UTC", True),
])

LABELS = ("fake", "true")
REQUIRED = tuple(f.name for f in CANONICAL.fields if f.metadata["required"])


def fields_with_role(role: str) -> list[str]:
    return [f.name for f in CANONICAL.fields if f.metadata["role"] == role]


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, _S) for n in names])


# Raw inputs. Every column is a string: inference would turn a label file that
# only says "true" into booleans, and a title "1984" into a number.
RAW_REVIEWS = _strings(
    "claim_text", "claimant", "claim_date", "review_publisher_name", "review_publisher_site",
    "review_url", "review_title", "review_date", "textual_rating", "language_code", "article_text",
)
RAW_LINKS = _strings("id", "news_url", "title", "tweet_ids")
RAW_ARTICLES = _strings("title", "text", "subject", "date")
FEED_ITEM = _strings("link", "description", "pubDate", "guid")

CLAIM_PAYLOAD = T.StructType([
    T.StructField("claims", T.ArrayType(T.StructType([
        T.StructField("text", _S),
        T.StructField("claimant", _S),
        T.StructField("claimDate", _S),
        T.StructField("claimReview", T.ArrayType(T.StructType([
            T.StructField("publisher", _strings("name", "site")),
            T.StructField("url", _S),
            T.StructField("title", _S),
            T.StructField("reviewDate", _S),
            T.StructField("textualRating", _S),
            T.StructField("languageCode", _S),
        ]))),
    ]))),
    T.StructField("nextPageToken", _S),
])

# Star tables.
SOURCE_DIM = _strings("name", "first_loaded_at")
PUBLISHER_DIM = _strings("name", "site")
CLAIM_RECORD = T.StructType([
    T.StructField(n, t) for n, t in [
        ("record_id", _S), ("source", _S), ("publisher_name", _S), ("claim_text", _S), ("claimant", _S),
        ("claim_date", _S), ("article_title", _S), ("article_text", _S), ("article_text_length", _L),
        ("article_url", _S), ("image_url", _S), ("has_valid_image", T.IntegerType()), ("published_at", _S),
        ("textual_rating_raw", _S), ("label", _S), ("language_code", _S), ("ingested_at", _S),
    ]
])

# Run history.
DROP_REASONS = ("rows_dropped_missing_text", "rows_dropped_duplicate", "rows_dropped_label")
COUNTERS = ("rows_read", "rows_exported", "rows_loaded", *DROP_REASONS)
_STEPS = T.MapType(_S, _D)
RUN_RECORD = T.StructType([
    T.StructField("source", _S),
    T.StructField("run_timestamp", _S),
    T.StructField("duration_seconds", _D),
    T.StructField("step_durations", _STEPS),
    T.StructField("rows_read", _L),
    T.StructField("rows_exported", _L),
    T.StructField("rows_loaded", _L),
    T.StructField("pct_valid", _D),
    *[T.StructField(n, _L) for n in DROP_REASONS],
    T.StructField("peak_memory_mb", _D),
])
# Sums over the runs of a source and day.
RUN_PARTIAL = T.StructType([
    T.StructField("source", _S),
    T.StructField("day", T.DateType()),
    T.StructField("runs", _L),
    *[T.StructField(f"{n}_sum", T.DecimalType(38, 4)) for n in ("pct_valid", "duration_seconds", "peak_memory_mb")],
    *[T.StructField(f"{n}_n", _L) for n in ("pct_valid", "duration_seconds", "peak_memory_mb")],
    T.StructField("durations", T.BinaryType()),
])
PHASE_SNAPSHOT = T.StructType([
    T.StructField("source", _S),
    T.StructField("run_timestamp", _S),
    T.StructField("phase_no", T.IntegerType()),
    T.StructField("elapsed_seconds", _D),
    T.StructField("step_durations", _STEPS),
    T.StructField("counts", T.MapType(_S, _L)),
    T.StructField("peak_memory_mb", _D),
])


def require_columns(df: DataFrame, names, who: str) -> DataFrame:
    """Raise when raw columns are absent; reads the plan's schema only."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{who}: raw input lacks column(s) {missing}")
    return df


def column_or_null(df: DataFrame, name: str, dtype: T.DataType = _S) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def project(df: DataFrame, contract: T.StructType = CANONICAL) -> DataFrame:
    """Contract columns in contract order and type; absent ones become null."""
    return df.select([
        column_or_null(df, f.name, f.dataType).cast(f.dataType).alias(f.name, metadata=f.metadata or {})
        for f in contract.fields
    ])

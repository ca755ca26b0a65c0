"""Readers of raw inputs. Schemas are explicit: nothing is inferred."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.functions.dates import parse_datetime
from claimloom.functions.text import na_tokens_to_null, strip
from claimloom.functions.urls import last_url_in_text
from claimloom.operators.adapters import ORDER
from claimloom.operators.dedup import distinct_reviews
from claimloom.operators.sampling import sample_rows
from claimloom.schema import CLAIM_PAYLOAD, FEED_ITEM, RAW_ARTICLES, RUN_RECORD
from claimloom.sources.records import BLOCK, FILE, csv_records, feed_items

# Doubled quotes and line breaks inside quoted fields, as CSV writers of other tools produce them. A row with more or
# fewer fields than its header fails the job instead of giving shifted values; so does a file whose header differs.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "mode": "FAILFAST", "enforceSchema": False}
# One record at a time; ``multiLine`` leaves line breaks inside fields as they are.
RECORD_OPTIONS = {"quote": '"', "escape": '"', "mode": "FAILFAST", "multiLine": "true"}


def _in_input_order(df: DataFrame) -> DataFrame:
    """Number rows so that they sort as they stand in the files, file after file and block after block."""
    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.withColumn(ORDER, position)


def read_raw_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    ordered: bool = True,
    multi_line: bool = True,
) -> DataFrame:
    """Raw CSV as strings, columns by the names in its header, missing-value tokens null, with ``input_order``.

    Columns of ``schema`` come first, in its order; those the files lack are
    absent, so that ``require_columns`` sees it; others follow. Files below one
    path share a header; give paths with different headers one by one. Large
    files are read in blocks by many tasks. Without ``multi_line``, for files
    known to hold no line break inside a field, one scan is enough; with it
    the texts are scanned twice, and records that hold line breaks are
    shuffled.
    """
    def one(at: str) -> DataFrame:
        header = spark.read.options(header=True, multiLine=multi_line, quote='"', escape='"').csv(at).columns
        found = T.StructType([T.StructField(name, T.StringType()) for name in header])
        if multi_line:
            return _parsed(csv_records(spark, at), found, ordered)
        rows = spark.read.options(**CSV_OPTIONS).schema(found).csv(at)
        return _in_input_order(rows) if ordered else rows

    paths = [path] if isinstance(path, str) else list(path)
    raw = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [one(p) for p in paths])
    return na_tokens_to_null(_contract_first(raw, schema))


def _ddl(found: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` string" for f in found.fields)


def _parsed(records: DataFrame, found: T.StructType, ordered: bool) -> DataFrame:
    """Numbered records as rows of ``found``; the first one of each file has to be that header."""
    first = F.col("record") == 1
    line = F.when(first, F.ltrim(F.col("line"), F.lit("\ufeff"))).otherwise(F.col("line"))
    rows = records.select(FILE, "record", F.from_csv(line, _ddl(found), RECORD_OPTIONS).alias("row"))
    names = [f.name for f in found.fields]
    same = F.lit(True)
    for k, name in enumerate(names):
        field = F.coalesce(F.col("row").getField(name), F.lit(f"_c{k}"))
        same = same & (F.lower(field) == name.lower())
    other = F.raise_error(F.concat(F.lit("the header differs from the first one in "), F.col(FILE))).cast("boolean")
    kept = rows.where(F.when(first, F.when(same, False).otherwise(other)).otherwise(True))
    position = F.struct(F.col(FILE).alias("file"), F.lit(0).cast("long").alias("block"), F.col("record").alias("row"))
    return kept.select("row.*", *[position.alias(ORDER)] if ordered else [])


def _contract_first(raw: DataFrame, schema: T.StructType) -> DataFrame:
    listed = [name for name in schema.fieldNames() if name in raw.columns]
    return raw.select(*listed, *[F.col(f"`{name}`") for name in raw.columns if name not in listed])


def read_raw_parquet(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Raw rows landed as Parquet, which splits within a file, with ``input_order`` from file and row number.

    Columns go by name as in ``read_raw_csv``, and those of ``schema`` are read as strings; columns of any file count.
    """
    raw = spark.read.option("mergeSchema", True).parquet(*([path] if isinstance(path, str) else path))
    position = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    texts = {name: F.col(name).cast("string") for name in schema.fieldNames() if name in raw.columns}
    return na_tokens_to_null(_contract_first(raw.withColumn(ORDER, position).withColumns(texts), schema))


def labeled_file_union(
    spark: SparkSession,
    files: Sequence[tuple[str, str]],
    schema: T.StructType = RAW_ARTICLES,
    max_rows_per_file: int | None = None,
    key: str = ORDER,
) -> DataFrame:
    """Label files of (path, label), each tagged with its label, in the order given; samples are drawn by ``key``, unique in a file."""
    def tagged(position: int, path: str, label: str) -> DataFrame:
        rows = sample_rows(read_raw_csv(spark, path, schema), max_rows_per_file, key)
        order = F.struct(F.lit(position).alias("position"), F.col(ORDER).alias("at"))
        return rows.withColumns({"label": F.lit(label), ORDER: order})

    return reduce(DataFrame.unionByName, [tagged(i, path, label) for i, (path, label) in enumerate(files)])


def flatten_claim_reviews(payloads: DataFrame) -> DataFrame:
    """Search payloads -> one row per (claim, review). Claims without reviews have none.

    Later rows with an address already seen are dropped; ``input_order`` must
    order the payloads.
    """
    claims = payloads.select(F.col(ORDER).alias("_page"), F.posexplode("claims").alias("_claim_no", "claim"))
    reviews = claims.select("_page", "_claim_no", "claim", F.posexplode("claim.claimReview").alias("_review_no", "review"))
    flat = reviews.select(
        F.struct("_page", "_claim_no", "_review_no").alias(ORDER),
        F.col("claim.text").alias("claim_text"),
        F.col("claim.claimant").alias("claimant"),
        F.col("claim.claimDate").alias("claim_date"),
        F.col("review.publisher.name").alias("review_publisher_name"),
        F.col("review.publisher.site").alias("review_publisher_site"),
        F.col("review.url").alias("review_url"),
        F.col("review.title").alias("review_title"),
        F.col("review.reviewDate").alias("review_date"),
        F.col("review.textualRating").alias("textual_rating"),
        F.col("review.languageCode").alias("language_code"),
    )
    return distinct_reviews(flat)


def read_claim_payloads(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Stored answers of the claim search, one JSON document per file or per line."""
    raw = spark.read.schema(CLAIM_PAYLOAD).option("multiLine", not one_per_line).json(path)
    return flatten_claim_reviews(_in_input_order(raw))


def feed_posts(items: DataFrame, pivot_year: int | None = None) -> DataFrame:
    """Feed items -> post_url, post_text, pub_date, guid, article_url.

    The article is usually the last link a post mentions. Unreadable dates are null.
    """
    carried = [c for c in (ORDER,) if c in items.columns]
    text = strip(F.coalesce("description", F.lit("")))
    return items.select(
        *carried,
        F.col("link").alias("post_url"),
        text.alias("post_text"),
        parse_datetime("pubDate", pivot_year).alias("pub_date"),
        "guid",
        last_url_in_text(text).alias("article_url"),
    )


def parse_post_feed(spark: SparkSession, path: str) -> DataFrame:
    """Stored RSS documents, one row per item, with ``input_order``; a large document is read by many tasks."""
    items = feed_items(spark, path)
    position = F.struct(F.col(FILE).alias("file"), F.col(BLOCK).alias("block"), F.col("_item").alias("row"))
    read = items.select(F.from_xml("xml", FEED_ITEM, {"rowTag": "item"}).alias("item"), position.alias(ORDER))
    return feed_posts(read.select("item.*", ORDER))


def read_run_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Run history with ``run_timestamp`` as a UTC timestamp; empty, same schema, before the first run."""
    try:
        runs = spark.read.schema(RUN_RECORD).json(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        runs = spark.createDataFrame([], RUN_RECORD)
    return runs.withColumn("run_timestamp", F.col("run_timestamp").try_cast("timestamp"))

"""Star tables as functions of (stored table, batch) -> next table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.operators.adapters import input_position
from claimloom.operators.dedup import keep_first, keep_last
from claimloom.schema import CLAIM_RECORD


def sink_values(df: DataFrame, contract: T.StructType = CLAIM_RECORD, beside: Sequence[str] = ()) -> DataFrame:
    """Values as the store holds them: booleans 0/1, NaN null, timestamps ISO text; contract columns and those ``beside`` only."""
    columns = []
    for field in contract.fields:
        value, dtype = F.col(field.name), df.schema[field.name].dataType
        if isinstance(dtype, (T.DoubleType, T.FloatType)):
            value = F.when(~F.isnan(value), value)
        elif isinstance(dtype, T.TimestampType):
            value = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ssxxx")
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns, *beside)


def new_sources(dim: DataFrame, batch: DataFrame, loaded_at: str) -> DataFrame:
    """The batch's sources that the dimension lacks."""
    named = batch.select(F.col("source").alias("name")).filter(F.col("name").isNotNull()).distinct()
    return named.join(dim, "name", "left_anti").withColumn("first_loaded_at", F.lit(loaded_at))


def upsert_source_dim(dim: DataFrame, batch: DataFrame, loaded_at: str) -> DataFrame:
    """Dimension plus the batch's new sources; a known one keeps its first load time."""
    return dim.unionByName(new_sources(dim, batch, loaded_at))


def new_publishers(dim: DataFrame, batch: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """The batch's publishers that the dimension lacks, each with the first site seen."""
    order = order or input_position(batch)
    named = batch.filter(F.col("publisher_name").isNotNull()).select(
        F.col("publisher_name").alias("name"), F.col("publisher_site").alias("site"), *order
    )
    return keep_first(named, ["name"], order).select("name", "site").join(dim, "name", "left_anti")


def upsert_publisher_dim(dim: DataFrame, batch: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """Dimension plus the batch's new publishers.

    Known publishers stay as they are, also one stored without a site.
    """
    return dim.unionByName(new_publishers(dim, batch, order))


def upsert_claims(target: DataFrame, batch: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """Target with the batch's rows replacing those of the same record_id; the batch's last copy wins.

    The batch is read twice, for its ids and for its rows. Its ids are broadcast
    only while they are few; the target is not shuffled then.
    """
    latest = sink_values(keep_last(batch, ["record_id"], order or input_position(batch)))
    kept = target.join(latest.select("record_id"), "record_id", "left_anti")
    return kept.select(*CLAIM_RECORD.fieldNames()).unionByName(latest)


def load_summary(batch: DataFrame) -> DataFrame:
    """Sources, publishers and rows of the batch itself, whatever the store already held."""
    pairs = batch.groupBy("source", "publisher_name").agg(F.count("*").alias("n"))
    return pairs.agg(
        F.count_distinct("source").alias("sources"),
        F.count_distinct("publisher_name").alias("publishers"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("claim_records"),
    )

"""Curate and load raw rows as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from claimloom.plans.curate import curate_claims
from claimloom.plans.load import load_batch


def start_curation(
    raw: DataFrame,
    source: str,
    root: str,
    checkpoint: str,
    ingested_at: str | None = None,
    pivot_year: int | None = None,
    fan_in: int = 0,
) -> StreamingQuery:
    """Each micro-batch is curated into a delta of the star at ``root`` and committed.

    A batch's commit carries the stream's checkpoint folder and the batch's
    number. A batch that runs again finds that and writes nothing, so after a
    restart every batch is in the store as one delta.
    """
    def curate_and_load(batch: DataFrame, batch_id: int) -> None:
        claims = curate_claims({source: batch}, ingested_at, pivot_year, keep_order=True, fan_in=fan_in)
        load_batch(batch.sparkSession, root, claims, checkpoint, batch_id, ingested_at)

    return (
        raw.writeStream.foreachBatch(curate_and_load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

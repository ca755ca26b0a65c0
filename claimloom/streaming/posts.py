"""A feed polled repeatedly, as a stream of poll results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimloom.operators.incremental import new_posts
from claimloom.session import folder_exists, shared_dir
from claimloom.streaming.seen import BUCKETS, SeenKeys


def stream_checkpoint(spark: SparkSession, name: str) -> str:
    """Stable checkpoint folder of a named stream, in shared storage."""
    return f"{shared_dir(spark).rstrip('/')}/claimloom/streams/{name}"


def dedup_posts_stream(posts: DataFrame, event_time: str = "pub_date", forget_after: str | None = None) -> DataFrame:
    """Each guid once, whenever it returns; posts without guid always pass.

    The state holds every guid seen (keep it in the RocksDB store on a cluster).
    ``forget_after`` bounds it: guids are dropped that long past the newest
    post, which must exceed the time a post stays listed in the feed. A guid
    returning later passes again, and a new post older than that is late and
    lost, so set it only for feeds that list posts in order.
    """
    named, unnamed = posts.filter(F.col("guid").isNotNull()), posts.filter(F.col("guid").isNull())
    if forget_after is None:
        return named.dropDuplicates(["guid"]).unionByName(unnamed)
    timed = named.withWatermark(event_time, forget_after)
    return timed.dropDuplicatesWithinWatermark(["guid"]).unionByName(unnamed.withWatermark(event_time, forget_after))


def start_post_dedup(posts: DataFrame, output: str, checkpoint: str, **options) -> StreamingQuery:
    """Write each post once to ``output``, reading what is available now."""
    return (
        dedup_posts_stream(posts, **options)
        .writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def _seed(spark: SparkSession, output: str, seen: SeenKeys, batch_id: int) -> None:
    """Fill a store that is not there yet with what earlier polls left in ``output``."""
    if folder_exists(spark, seen.root) or not folder_exists(spark, output):
        return
    stored = spark.read.schema("guid string, poll long").option("basePath", output).parquet(f"{output}/poll=*")
    seen.remember(stored.where(F.col("poll") < batch_id), -1)


def start_post_append(
    posts: DataFrame, output: str, checkpoint: str, spread_by: Sequence[str] = ("post_text", "pub_date"), buckets: int = BUCKETS
) -> StreamingQuery:
    """The batch contract poll by poll: append what is not stored, forget nothing.

    Keeps no state: guids are looked up in a store beside the posts
    (``SeenKeys``), of which a poll reads the buckets it meets. So copies
    inside one poll stay, no guid ever returns, and no post is too late. Each
    poll owns a folder, which a repeated poll overwrites; it doesn't see its
    own first try.
    """
    def append(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = SeenKeys(spark, f"{output}/_seen", buckets=buckets)
        _seed(spark, output, seen, batch_id)
        folder = f"{output}/poll={batch_id}"
        new_posts(batch, seen.among(batch, before=batch_id), spread_by).write.mode("overwrite").parquet(folder)
        fresh = spark.read.schema(batch.schema).parquet(folder)
        seen.remember(fresh, batch_id)
        seen.tidy(seen.met(fresh), before=batch_id)

    return (
        posts.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

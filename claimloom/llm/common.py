"""What the operators of this subpackage share: tables, scratch tables, word rules, sized lookups, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from claimloom.session import scratch_dir, shared_dir

#: ASCII white space, and a word between it, as regular expressions for Spark and DuckDB alike.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: A lookup side of so many narrow rows (tens of MB) is broadcast; a larger one is joined by a shuffle.
LOOKUP_ROWS = 200_000
#: A node with over so many edges, and so many times those of a mean task, is dealt out over all tasks.
HOT_ROWS, HOT_SHARE = 100_000, 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and safe from lost executors."""
    path = scratch_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Removes scratch tables that ``written`` made and nothing reads any more; frames made of anything else stay."""
    for frame in frames:
        spark, shared = frame.sparkSession, shared_dir(frame.sparkSession).rstrip("/")
        for folder in {file.rsplit("/", 1)[0] for file in frame.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            if f"{shared}/claimloom/llm-" in folder:
                path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def written_counting(df: DataFrame, name: str, **figures: Column) -> tuple[DataFrame, dict]:
    """``written`` and, from the same pass, aggregates over its rows."""
    seen = Observation()
    out = written(df.observe(seen, *[c.alias(k) for k, c in figures.items()]), name)
    return out, seen.get


def task_slots(spark: SparkSession) -> int:
    """Partitions that the session gives a shuffle."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def hash60(col: Column) -> Column:
    """The first 60 bits of the MD5 of ``col`` as text; null hashes as the empty text. SQL engines agree on it."""
    digits = F.substring(F.md5(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return F.conv(digits, 16, 10).cast("long")


def held_out(doc_id: str = "doc_id") -> Column:
    """The rows that no model may learn from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def small_or_shuffled(small: DataFrame, rows: int) -> DataFrame:
    """``small`` marked for broadcast if its known number of rows allows it, else left to a shuffled join."""
    return F.broadcast(small) if rows <= LOOKUP_ROWS else small


def with_lowest(rows: DataFrame, low: Column, edges: int, slots: int) -> DataFrame:
    """``rows(a, b)`` with ``low`` of all rows of the same ``a``; nodes with many of the ``edges`` rows are dealt out over ``slots`` salts."""
    per_node = rows.groupBy("a").agg(low.alias("low"), F.count(F.lit(1)).alias("n"))
    if edges <= HOT_ROWS:  # none can be hot
        return rows.join(per_node.select("a", "low"), "a").select("a", "b", "low")
    hot = (F.col("n") > HOT_ROWS) & (F.col("n") * slots > HOT_SHARE * edges)
    salts = F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(slots - 1))).otherwise(F.array(F.lit(0)))).alias("salt")
    busy = per_node.where(hot).select("a", F.lit(True).alias("hot"))
    dealt = (rows.join(F.broadcast(busy), "a", "left")
             .withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("b"), F.lit(slots)).cast("int")).otherwise(0)))
    return dealt.join(per_node.select("a", "low", salts), ["a", "salt"]).select("a", "b", "low")


def components(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)`` of long ids: ``(node, component)``, the smallest id reachable.

    Alternating stars: each round hangs every node's larger neighbours on its
    smallest one, then its smaller ones. Each round is a table in the shared
    folder, so lineage stays short, and takes the place of the last one. The
    neighbours of a node that has more than a task's share of them are dealt
    out over all tasks; there are fewer such nodes than tasks.
    Nodes without an edge are not returned. Raises if ``max_rounds`` do not
    settle.
    """
    def sign(df: DataFrame) -> dict[str, Column]:
        return {"n": F.count(F.lit(1)), "h": F.bit_xor(F.xxhash64("a", "b"))}

    slots = task_slots(edges.sparkSession)

    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, was = written_counting(now, f"{name}-edges", **sign(edges))
    for _ in range(max_rounds):
        if not was["n"]:
            break
        # Large star: neighbours above a node hang on the smallest of it and its neighbours.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (with_lowest(both, F.least(F.min("b"), F.col("a")), 2 * was["n"], slots).where("b > a")
                 .select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct())
        # Small star: a node and its smaller neighbours hang on the smallest neighbour.
        joined = with_lowest(large, F.min("b"), was["n"], slots)
        small = (joined.select(F.col("b").alias("a"), F.col("low").alias("b"))
                 .unionByName(joined.select("a", F.col("low").alias("b"))).where("a <> b").distinct())
        before = now
        now, got = written_counting(small, f"{name}-edges", **sign(small))
        discard(before)
        if (got["n"], got["h"]) == (was["n"], was["h"]):
            break
        was = got
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = now.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())


def bounded_batches(spark: SparkSession) -> None:
    """Hand Python workers batches bounded in rows, so that long texts don't add up to a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")

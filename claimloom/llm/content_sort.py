"""Exact dedup by content sort: range-partitioned normalised texts, sorted outside memory, neighbours compared in full.

Texts are equal when they are identical without ASCII white space; null counts
as empty. Of equal texts the row with the most code points in its original
text stays, then the one with the smallest id (a null id last).

* Sampled splitters range-partition the rows by the start of the normalised
  text, then its digest, so the splitters on the driver stay short however
  long the texts are. Sorting within the partitions brings equal texts next to
  each other; the window compares the whole texts of neighbours.
* A group so large that it would fill a task of its own is dealt out over all
  tasks by a salt; its runs, one row per task, are put together at the end.
  Such groups are found by exact sums per digest; by their definition there
  are at most ``2 * LARGE`` of them per partition, which bounds the broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.common import SPACE, task_slots, text_or_empty, written, written_counting

#: Code points of the normalised text in the splitters.
PREFIX = 32
#: A group holding over 1/LARGE of a mean partition's rows or characters is dealt out.
LARGE = 2


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Nulls: a null text is an empty one, a null id sorts last and may be the id
    that stays. Repeated rows (equal ids too) are members of one group of
    which exactly one row is kept. Other columns are ignored. An empty table
    gives an empty result.
    """
    slots = task_slots(docs.sparkSession)
    plain = docs.select(
        "doc_id",
        F.length(text_or_empty()).alias("chars"),
        F.regexp_replace(text_or_empty(), SPACE + "+", "").alias("body"),
    ).withColumn("digest", F.unhex(F.sha2(F.col("body").cast("binary"), 256)))

    sizes, total = written_counting(
        plain.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("c")),
        "digest-sizes", n=F.coalesce(F.sum("n"), F.lit(0)), c=F.coalesce(F.sum("c"), F.lit(0)))
    share = LARGE * slots
    large = sizes.where((F.col("n") > 1) & ((F.col("n") * share > total["n"]) | (F.col("c") * share > total["c"])))

    # A group of few rows keeps salt 0 and so is one run.
    salt = F.when(F.col("large"), F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(slots)))
    dealt = (plain.join(F.broadcast(large.select("digest", F.lit(True).alias("large"))), "digest", "left")
             .withColumn("salt", F.coalesce(salt, F.lit(0)))
             .withColumn("start", F.substring("body", 1, PREFIX))
             .repartitionByRange(slots, "start", "digest", "salt"))
    run = Window.partitionBy("start", "digest", "salt", "body")
    best = run.orderBy(F.desc("chars"), F.asc_nulls_last("doc_id"))
    runs = written(
        dealt.select(
            "doc_id", "chars", "digest", "salt", F.coalesce("large", F.lit(False)).alias("large"),
            F.row_number().over(best).alias("place"),
            F.first("doc_id").over(best).alias("run_keep"),
            F.count(F.lit(1)).over(run).alias("run_size")),
        "runs")

    # The runs of a large group: at most one row for each task.
    merged = (runs.where("large and place = 1").groupBy("digest")
              .agg(F.min(F.struct((-F.col("chars")).alias("less"), F.col("doc_id").isNull().alias("none"),
                                  F.col("doc_id"), F.col("salt"))).alias("top"),
                   F.sum("run_size").alias("size"))
              .select("digest", F.col("top.doc_id").alias("top_id"), F.col("top.salt").alias("top_salt"), "size"))
    first = F.col("place") == 1
    return runs.join(F.broadcast(merged), "digest", "left").select(
        "doc_id",
        F.when(F.col("large"), F.col("top_id")).otherwise(F.col("run_keep")).alias("keep_id"),
        F.when(F.col("large"), F.col("size")).otherwise(F.col("run_size")).cast("long").alias("group_size"),
        F.when(F.col("large"), first & (F.col("salt") == F.col("top_salt"))).otherwise(first).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))

"""Mixing sources to target weights by hash thresholds.

Each source has a target number of words. Whole rounds through a source (0, 1
or 2) are given to every document; the rest of the target is a budget that a
hash threshold meets: a document gets one more copy if its hash lies below its
source's threshold. Thresholds come from histograms: words are summed by
source and the leading bits of the hash, the bucket in which the running sum
passes the budget is the boundary, and only its rows are summed again by the
next bits, until the boundary is a single hash. Nothing is sorted but at most
``2 ** BITS`` sums a source, and the last filter is a comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.common import WORD, hash60, small_or_shuffled, text_or_empty, written, written_counting

#: Bits of the hash that one histogram resolves; the hash has 60.
BITS, HASH_BITS = 12, 60
#: Weights of the sources in code point order, null last, repeating.
WEIGHTS = (5, 2, 1)
#: Words of the mix, as a share of all words; most rounds through one source.
SHARE, MOST = 1.5, 2


def word_count(col: Column) -> Column:
    return F.regexp_count(F.coalesce(col, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sums: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``sums(source, source_size)`` with ``target``.

    Targets follow the weights and stop at ``most`` times the source's size;
    what is cut off goes to the others by weight until none is above. In order
    of size by weight the stopped sources come first, so the level that the
    others share follows from running sums over one row for each source.
    """
    named = Window.orderBy(F.asc_nulls_last("source"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(named) - 1, F.lit(len(weights))).cast("int") + 1)
    by_ratio = Window.orderBy("ratio", F.asc_nulls_last("source"))
    before, after = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.col("wanted") - F.coalesce(F.sum("stop").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    return (
        sums.withColumn("weight", weight).withColumn("stop", F.lit(float(most)) * F.col("source_size"))
        .withColumn("ratio", F.col("stop") / F.col("weight"))
        .withColumn("wanted", F.lit(float(share)) * F.sum("source_size").over(everything))
        .withColumn("level", level)
        .withColumn("fits", F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level")))
        .withColumn("level", F.min("fits").over(everything)["level"])
        .select("source", "source_size", F.least("stop", F.coalesce(F.col("level") * F.col("weight"), F.col("stop"))).alias("target"))
    )


def _hashed(docs: DataFrame, seed: str) -> DataFrame:
    """``docs`` with the hash ``_h``, of the id and the seed; of the text too where an id is null or repeated, so that its rows can be told apart."""
    ids = docs.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(F.count(F.lit(1)).alias("_n"))
    repeated, seen = written_counting(ids.where("_n > 1").select("_id"), "repeated-ids", n=F.count(F.lit(1)))
    marked = docs.withColumn("_shared", F.col("doc_id").isNull())
    if seen["n"]:
        marked = docs.join(small_or_shuffled(repeated, seen["n"]), F.col("doc_id") == F.col("_id"), "left")
        marked = marked.withColumn("_shared", F.col("doc_id").isNull() | F.col("_id").isNotNull()).drop("_id")
    own = F.when(F.col("_shared"), F.concat(F.lit("\t"), F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256))).otherwise("")
    return marked.withColumn("_h", hash60(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), own))).drop("_shared")


def _looked_up(rows: DataFrame, side: DataFrame, n: int, how: str = "inner") -> DataFrame:
    """``rows`` with what a table of ``n`` rows says of their source."""
    side = side.withColumnRenamed("source", "_its_source")
    return rows.join(small_or_shuffled(side, n), F.col("source").eqNullSafe(F.col("_its_source")), how).drop("_its_source")


def _thresholds(sized: DataFrame, weights: tuple[int, ...], share: float, most: int) -> tuple[DataFrame, int]:
    """``source, source_size, target, rounds, below`` for each source of ``sized(source, size, h)``, and how many there are."""
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets, seen = written_counting(
        source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
        .withColumn("rounds", rounds), "targets", n=F.count(F.lit(1)))

    # (source, left: budget still open, prefix: leading bits of the boundary)
    edge = targets.select("source", (F.col("target") - F.col("rounds") * F.col("source_size")).alias("left"), F.lit(0).cast("long").alias("prefix")).where("left > 0")
    unit = F.lit(0).cast("long")
    for used in range(0, HASH_BITS, BITS):
        rest = HASH_BITS - used
        bucket = F.shiftrightunsigned("h", rest - BITS)
        inside = _looked_up(sized, edge, seen["n"]).where(F.shiftrightunsigned("h", rest) == F.col("prefix")) if used else _looked_up(sized, edge, seen["n"])
        sums = inside.groupBy("source", "left", bucket.alias("prefix")).agg(F.sum("size").alias("words"))
        running = F.sum("words").over(Window.partitionBy("source").orderBy("prefix"))
        edge = (sums.withColumn("running", running).where("running > left")
                .groupBy("source").agg(F.min(F.struct("prefix", "running", "words", "left")).alias("e"))
                .select("source", (F.col("e.left") - (F.col("e.running") - F.col("e.words"))).alias("left"),
                        F.col("e.prefix").alias("prefix"), F.col("e.words").alias("unit")))
        unit = F.col("unit")
    # The boundary hash itself is taken if that comes nearer to the budget.
    threshold = edge.select("source", (F.col("prefix") + F.when(F.col("left") * 2 >= unit, 1).otherwise(0)).alias("below"))
    cut = targets.join(threshold.withColumnRenamed("source", "cut_source"), F.col("source").eqNullSafe(F.col("cut_source")), "left")
    cut = written(cut.select("source", "source_size", "target", "rounds", F.coalesce("below", F.lit(0)).alias("below")), "thresholds")
    return cut, seen["n"]


def _copies(h: str) -> Column:
    return (F.col("rounds") + F.when(F.col(h) < F.col("below"), 1).otherwise(0)).cast("int")


def _sized(hashed: DataFrame) -> DataFrame:
    return written(hashed.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.col("_h").alias("h")), "sizes")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = "") -> DataFrame:
    """One row per row of ``docs(doc_id, text, source)``: ``doc_id, source, size, source_size, target, copies, taken``.

    A null text has size 0, a null source is a source of its own, the last. A
    document's hash comes from its id and ``seed``, so reruns agree; rows of a
    null or repeated id are told apart by their texts, and only those that
    repeat id and text are taken or left together. Equal texts under different
    ids are different documents. An empty table gives an empty result; other
    columns are ignored.
    """
    sized = _sized(_hashed(docs.select("doc_id", "text", "source"), seed))
    cut, n = _thresholds(sized, weights, share, most)
    return _looked_up(sized, cut, n, "left").withColumn("copies", _copies("h")).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = "") -> DataFrame:
    """The rows of ``docs`` as often as ``mix`` takes them; the columns are those of ``docs``.

    Each row is held against its own source's threshold, where it lies.
    """
    cut, n = _thresholds(_sized(_hashed(docs.select("doc_id", "text", "source"), seed)), weights, share, most)
    rows = docs.select("doc_id", "text", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    taken = _looked_up(_hashed(rows, seed), cut, n).withColumn("copies", _copies("_h")).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")

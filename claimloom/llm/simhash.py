"""SimHash near-duplicates found by multi-index hashing.

A fingerprint is one or more 64-bit lanes; a lane has two segments of 32 bits.
Fingerprints that differ in ``find_bits`` bits or fewer agree in some segment
up to a small Hamming ball: with ``m`` segments and ``r = find_bits``, the
first ``r % m + 1`` segments need radius ``r // m``, the others one less. Every
fingerprint stands in one table for each segment; its balls are enumerated and
looked up there, and complete distances are verified. Of two neighbours at
distance one the one whose bit is set looks the other up, so a ball costs about
16 probes instead of 33.

A bucket of the tables with over ``CROWD`` entries isn't paired off: all its
visitors are verified against its ``PIVOTS`` smallest entries first, and then
only pairs that are still in different components and agree in one of
``find_bits + 1`` parts of the lane's other segment, which pairs within
``find_bits`` do. Pairs within a component could add no more to it, so
components are exact, and members that have only the bucket in common aren't
paired at all.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm.common import bounded_batches, components, discard, small_or_shuffled, text_or_empty, written, written_counting
from claimloom.llm.words import shingle_hashes

CROWD, PIVOTS = 64, 32


def _lane(h: np.ndarray, lane: int) -> np.ndarray:
    """Lane 0 holds the hashes as they are, the others a mix of them (the finaliser of splitmix64)."""
    if lane:
        with np.errstate(over="ignore"):
            h = h + np.uint64(0x9E3779B97F4A7C15 * lane % 2**64)
            h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            h = h ^ (h >> np.uint64(31))
    return h


def simhash(text: str | None, shingle: int, lanes: int = 1) -> list[int]:
    """The fingerprint of one text as signed 64-bit lanes: bits set in over half the shingle hashes; zero without words."""
    ones, n = np.zeros((lanes, 64), dtype=np.int64), 0
    for h in shingle_hashes(text, shingle):
        n += len(h)
        for lane in range(lanes):
            for at in range(0, len(h), 1 << 16):
                bits = np.unpackbits(_lane(h[at:at + (1 << 16)], lane).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                ones[lane] += bits.sum(axis=0, dtype=np.uint32)
    return np.packbits(ones * 2 > n, axis=1, bitorder="little").view("<i8").ravel().tolist()


def fingerprint(text: Column, shingle: int = 3, lanes: int = 1) -> Column:
    @F.pandas_udf(T.ArrayType(T.LongType()))
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle, lanes) for t in texts], dtype=object)

    return of(text)


def distance(a: str, b: str, lanes: int) -> Column:
    """Differing bits of two columns of lanes."""
    total = F.lit(0)
    for k in range(lanes):
        total = total + F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k]))
    return total


def _segments(nodes: DataFrame, lanes: int, find_bits: int, probes: bool) -> DataFrame:
    """``(key, id)``: the entries of all tables, or the keys to look up around them."""
    m = 2 * lanes
    radius, extra = divmod(find_bits, m)
    if radius > 1:
        raise ValueError(f"{find_bits} bits need balls beyond radius 1 in {m} segments; take more lanes")
    keys = []
    for s in range(m):
        value = F.shiftrightunsigned(F.col("lanes")[s // 2], 32 * (s % 2)).bitwiseAND(F.lit(0xFFFFFFFF))
        name = F.lit(s << 32)
        if not probes:
            keys.append(F.array(value.bitwiseOR(name)))
        elif (radius if s <= extra else radius - 1) >= 1:
            keys.append(_cleared(value, name))
    return nodes.select("id", F.explode(F.concat(*keys) if len(keys) > 1 else keys[0]).alias("key"))


def _cleared(value: Column, name: Column) -> Column:
    """The keys of the segments that lack one of the bits set in ``value``."""
    set_bits = F.filter(F.sequence(F.lit(0), F.lit(31)), lambda i: F.getbit(value, i) == 1)
    return F.transform(set_bits, lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i).bitwiseXOR(value).bitwiseOR(name))


def _pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct pairs of ids that share a key."""
    met = a.select("key", F.col("id").alias("x")).join(b.select("key", F.col("id").alias("y")), "key").where("x <> y")
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def hamming_links(nodes: DataFrame, lanes: int, bits: int) -> Callable[[DataFrame], DataFrame]:
    """Keeps those of given pairs ``(a, b)`` whose fingerprints differ in at most ``bits`` bits."""
    left = nodes.select(F.col("id").alias("a"), F.col("lanes").alias("lanes_a"))
    right = nodes.select(F.col("id").alias("b"), F.col("lanes").alias("lanes_b"))
    return lambda pairs: pairs.join(left, "a").join(right, "b").where(distance("lanes_a", "lanes_b", lanes) <= bits).select("a", "b")


def links(nodes: DataFrame, lanes: int, find_bits: int, verify: Callable[[DataFrame], DataFrame], crowd: int = CROWD) -> DataFrame:
    """Links ``(a, b)``, ``a < b``, among ``nodes(id, lanes)``: verified pairs of the buckets, by the plan above.

    ``nodes`` is read several times: pass a written table with distinct ids.
    ``verify`` keeps the pairs ``(a, b)`` that are links. The result connects
    the same nodes as all links among pairs within ``find_bits`` would.
    """
    table, probes = _segments(nodes, lanes, find_bits, False), _segments(nodes, lanes, find_bits, True)
    sizes = table.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("pivot"))
    crowds, seen = written_counting(sizes.where(F.col("n") > crowd), "crowds", n=F.count(F.lit(1)))
    few = table.join(crowds, "key", "left_anti") if seen["n"] else table
    shared = few.join(sizes.where("n > 1").select("key"), "key", "left_semi")
    pairs = _pairs(shared, shared).unionByName(_pairs(probes, few))
    if not seen["n"]:
        return written(verify(pairs.distinct()), "links")

    visitors = written(
        table.withColumn("entry", F.lit(True)).unionByName(probes.withColumn("entry", F.lit(False)))
        .join(crowds.select("key"), "key", "left_semi"), "visitors")
    place = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    pivots = visitors.where("entry").withColumn("place", place).where(F.col("place") <= PIVOTS)
    first = written(verify(pairs.unionByName(_pairs(visitors, pivots)).distinct()), "links")

    # What is in different components after that, and shares a crowded bucket: one side is outside the bucket's largest component.
    parts = components(first, "crowd").withColumnRenamed("node", "id")
    tagged = written(visitors.join(parts, "id", "left").withColumn("part", F.coalesce("component", "id")).select("key", "id", "entry", "part"), "tagged")
    largest = tagged.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(F.max_by("part", F.struct("n", "part")).alias("largest"))
    outside = tagged.join(largest, "key").where("part <> largest").select(*tagged.columns)
    return first.unionByName(written(verify(_across(outside, tagged, nodes, find_bits).distinct()), "links"))


def _across(some: DataFrame, every: DataFrame, nodes: DataFrame, find_bits: int) -> DataFrame:
    """Pairs of ids ``(a, b)`` of different parts that share a bucket and agree in a part of the lane's other segment.

    Both frames have ``key, id, entry, part``; one of a pair has to be an entry.
    """
    segment = F.shiftright("key", 32)
    lane = F.get("lanes", F.floor(segment / 2).cast("int"))
    other = F.when(segment % 2 == 0, F.shiftrightunsigned(lane, 32)).otherwise(lane).bitwiseAND(F.lit(0xFFFFFFFF))
    cuts = [32 * k // (find_bits + 1) for k in range(find_bits + 2)]
    pieces = F.array(*[F.shiftright("other", low).bitwiseAND(F.lit((1 << high - low) - 1)) for low, high in zip(cuts, cuts[1:], strict=False)])

    def refined(rows: DataFrame) -> DataFrame:
        told = rows.join(nodes, "id").withColumn("other", other)
        return told.select("key", "id", "entry", "part", F.posexplode(pieces).alias("piece", "value"))

    a, b = refined(some).alias("a"), refined(every).alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("key", "piece", "value")]
    met = a.join(b, same).where("a.part <> b.part and (a.entry or b.entry)")
    return met.select(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b"))


def _parts(prints: DataFrame, bits: int) -> DataFrame:
    """``(fp, part)`` for distinct fingerprints of a written table: the smallest fingerprint reachable over links."""
    # A node's id is its fingerprint.
    nodes = prints.select(F.col("fp").alias("id"), F.array("fp").alias("lanes"))
    parts = components(links(nodes, 1, bits, hamming_links(nodes, 1, bits)), "simhash")
    return prints.join(parts.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("component", "fp").alias("part"))


def near_groups(docs: DataFrame, shingle: int = 3, bits: int = 2) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, fingerprint, component_id``.

    Fingerprints link at ``bits`` or fewer differing bits (at most 3); the
    component of a row is the smallest id reachable over links, its own
    included. Equal fingerprints are one node. A null text has no words and so
    fingerprint zero; a null id never names a component, but its row links
    others; a component of null ids alone has a null id. Other columns are
    ignored; an empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    marked = written(docs.select("doc_id", fingerprint(F.col("text"), shingle)[0].alias("fp")), "fingerprints")
    classes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint-classes")
    joined = classes.join(_parts(classes.select("fp"), bits), "fp")
    smallest = joined.groupBy("part").agg(F.min("first_id").alias("component_id"))
    named = joined.select("fp", "part").join(smallest, "part").select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _digest() -> Column:
    """Of a text; a null text counts as empty."""
    return F.unhex(F.sha2(text_or_empty().cast("binary"), 256))


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 2) -> DataFrame:
    """The rows of ``docs(doc_id, text, ...)`` without near-duplicates: one row of each group stays, all its columns as they are.

    Groups are those of ``near_groups``: components of links between
    fingerprints that differ in at most ``bits`` bits. Of a group the row with
    the smallest id stays (null ids last, then the smallest digest of the
    text); of rows that repeat id and text one stays. A null text is an empty
    one; texts without words are alike.
    """
    bounded_batches(docs.sparkSession)
    marked = written(docs.select("doc_id", _digest().alias("digest"), fingerprint(F.col("text"), shingle)[0].alias("fp")), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"))
    units = marked.groupBy("fp", "doc_id", "digest").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct(order.alias("at"), "digest", "n")).alias("m")
    classes = written(units.groupBy("fp").agg(best), "fingerprint-classes")
    parts = _parts(classes.select("fp"), bits)
    firsts = classes.join(parts, "fp").select("part", "m.*").groupBy("part").agg(F.min(F.struct("at", "digest", "n")).alias("m"))
    firsts = written(firsts.select("m.at.doc_id", "m.digest", "m.n"), "firsts")
    # What goes: all other rows, and for now the rows that stay but are repeated.
    stays = firsts.where("n = 1").select(F.col("doc_id").alias("_near_id"), F.col("digest").alias("_near_digest"))
    same = F.col("doc_id").eqNullSafe(F.col("_near_id")) & (F.col("digest") == F.col("_near_digest"))
    goes, gone = written_counting(marked.select("doc_id", "digest").distinct().join(stays, same, "left_anti")
                                  .select(F.col("doc_id").alias("_near_id"), F.col("digest").alias("_near_digest")), "goes", n=F.count(F.lit(1)))
    discard(marked, classes)
    told = docs.select("doc_id", _digest().alias("digest"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    out = told.join(small_or_shuffled(goes, gone["n"]), same, "left_anti").select("row.*")
    repeated, more = written_counting(firsts.where("n > 1").select(F.col("doc_id").alias("_near_id"), F.col("digest").alias("_near_digest")), "repeated", n=F.count(F.lit(1)))
    discard(firsts)
    if more["n"]:
        once = (told.join(small_or_shuffled(repeated, more["n"]), same, "left_semi")
                .dropDuplicates(["doc_id", "digest"]))
        out = out.unionByName(once.select("row.*"))
    return out

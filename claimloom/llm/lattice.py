"""Embedding near-duplicates by lattice hashing.

Unit vectors whose cosine is 0.98 lie 0.2 apart. Each of ``TABLES`` tables
projects them on 16 random directions, which keeps distances, and decodes each
half of the projection to the nearest point of the E8 lattice: the two points
are the vector's cell. A vector stands in its own cell and looks into
``PROBES`` neighbouring ones, those whose lattice points are nearest to its
projection. Two vectors meet where one stands and the other stands or looks;
what meets is verified by its cosine in double precision. Chance meetings take
about one in 10^7 of all pairs, so cells hold near vectors and little else.

* Equal vectors of a label are one class with a weight; only classes are hashed.
* Cells are found from keys and ids alone; vectors are moved only into cells
  where something meets. Cells that hold the same vectors in the same parts
  count once.
* No pair of vectors is ever a row. A cell is a matrix product in a task, which
  gives each vector its number of links there, and a spanning forest for the
  components. A pair counts only in the first cell where it meets, which both
  cells' keys tell.
* A cell of many vectors is cut into chunks of ``CHUNK``, and each pair of
  chunks is a task's work of its own; nothing is capped.

Which pairs meet is chance: the recall is measured in the tests (0.9 is
demanded; about 0.98 at a cosine of 0.98, more above).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache
from itertools import combinations, product
from math import fsum

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import bounded_batches, components, small_or_shuffled, written, written_counting

TABLES, PROBES, SCALE = 4, 3, 0.7
#: Lattice points of a cell.
HALVES = 2
#: Vectors of a cell that one side of a matrix product holds.
CHUNK = 2_048
COSINE = 0.98
#: Vectors that are hashed at a time.
SLICE = 4_096


@cache
def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8: steps to the neighbouring lattice points."""
    steps = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            steps.append(v)
    steps += [np.array(v) for v in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(steps)


def _even(y: np.ndarray) -> np.ndarray:
    """The nearest whole vectors of an even sum: round, and where the sum is odd round the least certain coordinate the other way."""
    near = np.rint(y)
    odd = np.flatnonzero(near.sum(axis=1) % 2 != 0)
    off = (y - near)[odd]
    worst = np.abs(off).argmax(axis=1)
    near[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return near


def nearest(y: np.ndarray) -> np.ndarray:
    """The nearest points of E8, rows of eight: whole vectors of even sum, or those moved by a half."""
    whole, halves = _even(y), _even(y - 0.5) + 0.5
    closer = ((y - whole) ** 2).sum(axis=1) <= ((y - halves) ** 2).sum(axis=1)
    return np.where(closer[:, None], whole, halves)


@cache
def directions(size: int, tables: int, scale: float, seed: int) -> np.ndarray:
    """Random directions for vectors of ``size`` components, a block of columns for each table."""
    return np.random.default_rng([seed, size]).normal(size=(size, tables * HALVES * 8)) * scale


def _hashed(points: np.ndarray, table: int) -> np.ndarray:
    """A cell's points as one 64-bit number (mixed as splitmix64 does)."""
    h = np.full(len(points), 0x9E3779B97F4A7C15 * (table + 1) % 2**64, np.uint64)
    with np.errstate(over="ignore"):
        for column in np.rint(points * 2).astype(np.int64).view(np.uint64).T:
            h = (h ^ column) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(29)
            h *= np.uint64(0x94D049BB133111EB)
            h ^= h >> np.uint64(32)
    return h.view(np.int64)


def cells(unit: np.ndarray, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE, seed: int = 5) -> np.ndarray:
    """For unit vectors, tables by ``1 + probes`` cell codes: the own cell of each table, then the neighbouring ones nearest to the vector."""
    out = np.empty((len(unit), tables, 1 + probes), np.int64)
    projected = unit @ directions(unit.shape[1], tables, scale, seed)
    step, width, rows = neighbours(), HALVES * 8, np.arange(len(unit))
    for t in range(tables):
        y = projected[:, t * width:(t + 1) * width]
        points = np.hstack([nearest(y[:, h:h + 8]) for h in range(0, width, 8)])
        out[:, t, 0] = _hashed(points, t)
        # A step's gain: how much nearer the neighbouring point lies than its kind does on average.
        gain = np.hstack([(y - points)[:, h:h + 8] @ step.T for h in range(0, width, 8)])
        best = np.argpartition(-gain, probes - 1, axis=1)[:, :probes] if probes else np.empty((len(unit), 0), int)
        best = np.take_along_axis(best, np.argsort(-np.take_along_axis(gain, best, 1), axis=1, kind="stable"), 1)
        for k in range(probes):
            moved = points.copy()
            half, which = np.divmod(best[:, k], len(step))
            for h in range(HALVES):
                at = rows[half == h]
                moved[at, h * 8:h * 8 + 8] += step[which[half == h]]
            out[:, t, 1 + k] = _hashed(moved, t)
    return out


def unit_vectors(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, first by their largest component, so that squares neither overflow nor vanish."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors ** 2).sum(axis=1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    """The cosine of two vectors, sums exactly rounded: for pairs at the threshold."""
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return fsum(a * b) / (fsum(a * a) * fsum(b * b)) ** 0.5


class Cell:
    """Vectors of one size that stand in a cell or look into it: rows of ids, weights, labels, codes and the part they take in the cell."""

    def __init__(self, rows: list[tuple], least: float):
        ids, weights, labels, vectors, codes, part = zip(*rows, strict=True)
        self.ids, self.weights = np.array(ids), np.array(weights)
        self.labels = np.array(labels)
        self.vectors = np.array(vectors)
        self.units = unit_vectors(self.vectors)
        self.codes = np.array(codes)  # ids, tables, own and neighbouring cells
        part = np.array(part)
        self.table, self.stands = part // self.codes.shape[2], part % self.codes.shape[2] == 0
        self.code = self.codes.reshape(len(self.ids), -1)[np.arange(len(self.ids)), part]
        self.least = least

    def _linked(self, x: np.ndarray, y: np.ndarray, labels: bool) -> np.ndarray:
        product = self.units[x] @ self.units[y].T
        linked = product >= self.least
        for i, j in np.argwhere(np.abs(product - self.least) < 1e-12):
            linked[i, j] = cosine(self.vectors[x[i]], self.vectors[y[j]]) >= self.least
        # Keys are hashes: rows of other codes or labels may have come here by chance.
        linked &= self.code[x][:, None] == self.code[y][None, :]
        linked &= self.stands[x][:, None] | self.stands[y][None, :]
        if labels:
            linked &= self.labels[x][:, None] == self.labels[y][None, :]
        return linked

    def _met_before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which of the pairs met in an earlier table, or in this one in a cell of a smaller code."""
        before = np.zeros(len(i), bool)
        for t in range(self.codes.shape[1]):
            a, b = self.codes[i, t], self.codes[j, t]
            at_b, at_a = (a[:, 1:] == b[:, :1]).any(axis=1), (b[:, 1:] == a[:, :1]).any(axis=1)
            same = a[:, 0] == b[:, 0]
            earlier = t < self.table[i]
            here = (t == self.table[i]) & ~same & ((at_b & (b[:, 0] < self.code[i])) | (at_a & (a[:, 0] < self.code[i])))
            before |= (earlier & (same | at_a | at_b)) | here
        return before

    def links(self, x: np.ndarray, y: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """``(id, links first met here, an id reachable by links here)`` for the vectors with a link between ``x`` and ``y``.

        ``x`` and ``y`` are the same rows, whose pairs count once, or have none in common.
        """
        within = x is y
        both = x if within else np.concatenate((x, y))
        at = np.full(len(self.ids), -1)
        at[both] = np.arange(len(both))
        found, root = np.zeros(len(both), np.int64), np.arange(len(both))
        labels = len(set(self.labels[both].tolist())) > 1
        adjacent = np.zeros((len(x), len(y)), bool)
        for s in range(0, len(x), 256):
            strip = x[s:s + 256]
            linked = self._linked(strip, y, labels)
            if within:
                linked &= strip[:, None] < y[None, :]
            adjacent[s:s + 256] = linked
            i, j = np.nonzero(linked)
            i, j = strip[i], y[j]
            first = ~self._met_before(i, j)
            np.add.at(found, at[i[first]], self.weights[j[first]])
            np.add.at(found, at[j[first]], self.weights[i[first]])
        i, j = np.nonzero(adjacent)
        if not len(i):
            return
        i, j = at[x[i]], at[y[j]]
        while True:  # every vector takes the least root of its partners until none changes
            low = root.copy()
            np.minimum.at(low, i, root[j])
            np.minimum.at(low, j, root[i])
            low = np.minimum(low, low[low])
            if (low == root).all():
                break
            root = low
        met = np.zeros(len(both), bool)
        met[i] = met[j] = True
        for k in np.flatnonzero(met).tolist():
            yield int(self.ids[both[k]]), int(found[k]), int(self.ids[both[root[k]]])


def _coded(embeddings: pd.Series) -> Iterator[tuple[int, np.ndarray]]:
    """The codes of vectors of any sizes: position and codes."""
    sizes = np.array([len(e) for e in embeddings], dtype=np.int64)
    for size in np.unique(sizes):
        of_size = np.flatnonzero(sizes == size)
        for s in range(0, len(of_size), SLICE):
            at = of_size[s:s + SLICE]
            codes = cells(unit_vectors(np.stack([np.asarray(embeddings.iloc[k], dtype=float) for k in at])))
            yield from zip(at.tolist(), codes.reshape(len(at), -1), strict=True)


def _groups(frames: Iterable[pd.DataFrame]) -> Iterator[list[tuple]]:
    """The rows of each cell and pair of chunks, which follow one another, over batches."""
    now, rows = None, []
    for frame in frames:
        for key, low, high, *row in frame.itertuples(index=False, name=None):
            if (key, low, high) != now:
                if rows:
                    yield rows
                now, rows = (key, low, high), []
            rows.append((low, high, *row))
    if rows:
        yield rows


def _links(least: float, tables: int):
    def found(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        for rows in _groups(frames):
            low, high = rows[0][:2]
            by_size: dict[int, list[tuple]] = {}
            for _, _, chunk, cid, weight, label, vector, codes, part in rows:
                by_size.setdefault(len(vector), []).append((chunk, (cid, weight, label, vector, codes.reshape(tables, -1), part)))
            for same in by_size.values():
                cell = Cell([row for _, row in same], least)
                chunks = np.array([chunk for chunk, _ in same])
                x = np.flatnonzero(chunks == low)
                y = x if low == high else np.flatnonzero(chunks == high)
                if len(x) and len(y):
                    out += cell.links(x, y)
            if len(out) >= 10_000:
                yield pd.DataFrame(out, columns=["id", "n", "root"])
                out = []
        yield pd.DataFrame(out, columns=["id", "n", "root"])

    return found


def similar_vectors(vectors: DataFrame, least: float = COSINE, chunk: int = CHUNK) -> DataFrame:
    """One row per row of ``vectors(vec_id, embedding, label)``: ``vec_id, n_links, component_id, kept``.

    Vectors of equal labels that are not null link if their cosine is
    ``least`` or more and the tables let them meet; vectors of different sizes
    do not link. ``n_links`` counts the other rows linked directly, copies
    included; the component of a row is the smallest id reachable over links,
    its own included, and the row whose id that is is kept. A vector that is
    null, empty or zero, or holds null or non-finite components, links with
    nothing. Repeated ids are vectors of their own; a null id never names a
    component unless it is alone or among null ids, and is kept then. Other
    columns are ignored; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    numbers = F.col("embedding")
    sound = (F.col("label").isNotNull() & (F.size(numbers) > 0) & F.exists(numbers, lambda x: x != 0)
             & F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))))
    rows = vectors.select("vec_id", F.when(F.coalesce(sound, F.lit(False)), numbers).alias("embedding"), F.col("label").cast("string").alias("label"))
    digest = F.when(F.col("embedding").isNotNull(), F.unhex(F.sha2(F.to_json(F.struct("label", "embedding")).cast("binary"), 256)))
    marked = rows.withColumn("digest", digest)

    @F.pandas_udf("array<long>")
    def coded(embeddings: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(embeddings), dtype=object)
        for k, codes in _coded(embeddings):
            out.iat[k] = codes
        return out

    # Copies are one class; its number is made once and written.
    classes = (marked.where("digest is not null").groupBy("digest")
               .agg(F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("first_id"))
               .select(F.monotonically_increasing_id().alias("id"), "*", coded("embedding").alias("codes")))
    classes = written(classes, "vector-classes")
    key = F.xxhash64("label", F.size("embedding"), "code")
    entries = classes.select("id", "label", "embedding", F.posexplode("codes").alias("part", "code")).select(key.alias("key"), "id", "part")
    stands = F.pmod("part", F.lit(1 + PROBES)) == 0
    # Cells where one stands and another stands or looks. Of cells with the same vectors in the same parts the first
    # is enough: pairs first met in one of them met there. Narrow sums, combined before they are shuffled.
    sizes = entries.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(stands).alias("home"), F.min(F.floor(F.col("part") / (1 + PROBES))).alias("table"),
        F.bit_xor(F.xxhash64("id", stands)).alias("x"), F.bit_xor(F.xxhash64("id", stands, F.lit(7))).alias("y")).where("n > 1 and home > 0")
    alike = sizes.groupBy("n", "x", "y").agg(F.min(F.struct("table", "key")).alias("m"))
    kept, left = written_counting(alike.select("m.key", "n"), "cells-once", n=F.count(F.lit(1)))
    parts = F.ceil(F.col("n") / chunk).cast("int")
    placed = (entries.join(small_or_shuffled(kept, left["n"]), "key")
              .withColumn("chunk", F.pmod(F.xxhash64("id", "key"), parts).cast("int"))
              .select("key", "id", "part", "chunk", F.explode(F.sequence(F.lit(0), parts - 1)).alias("other")))
    pairs = placed.select("key", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "chunk", "id", "part")
    filled = pairs.join(classes.select("id", "weight", "label", "embedding", "codes"), "id")
    order = ["key", "low", "high"]
    blocks = (filled.repartition(*order).sortWithinPartitions(*order, "id")
              .select(*order, "chunk", "id", "weight", "label", F.col("embedding").cast("array<double>"), "codes", "part"))
    links = written(blocks.mapInPandas(_links(least, TABLES), "id long, n long, root long"), "vector-links")

    reach = components(links.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")), "vectors")
    named = (classes.select("id", "digest", "weight", "first_id")
             .join(links.groupBy("id").agg(F.sum("n").alias("n")), "id", "left")
             .join(reach.withColumnRenamed("node", "id"), "id", "left")
             .withColumn("part", F.coalesce("component", "id")))
    lowest = named.groupBy("part").agg(F.min("first_id").alias("component_id"))
    told = named.join(lowest, "part").select("digest", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return (marked.select("vec_id", "digest").join(told, "digest", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))

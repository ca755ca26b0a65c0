"""Language identification by rank-order profiles of character n-grams.

A profile is a language's most frequent n-grams in order. A document's own
most frequent n-grams are ranked the same way; its distance to a profile is
the sum over them of how far out of place they stand there, ``PROFILE`` for an
n-gram that the profile lacks. The nearest profile names the language.

N-grams are taken of the whole lower-cased text: letters, with one boundary
mark between words. Ties in frequency go by the n-gram's code points, so ranks
depend on the text alone.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.llm.common import bounded_batches, hash60, held_out, small_or_shuffled, written_counting

#: Lengths of n-grams, up to 3: a 64-bit key holds three code points of 21 bits.
ORDERS = (1, 2, 3)
#: The boundary mark within a key; no letter has this code point, and unlike 0 it shows in the key.
MARK = 1
#: N-grams in a profile, and of a document.
PROFILE = 300
#: Most documents for each language that profiles are made of.
SAMPLE_PER_LANGUAGE = 3_000
#: Parts that a language's documents are drawn from first.
PARTS = 64
#: Characters of a text that are looked at together.
PIECE = 1 << 20

UNKNOWN = "und"


def _letters(text: str) -> np.ndarray:
    """Code points of the letters of ``text``, 0 for any other character."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    known, where = np.unique(points, return_inverse=True)
    letter = np.array([chr(p).isalpha() for p in known.tolist()], dtype=bool)
    return np.where(letter[where], points, 0)


def ngram_counts(text: str | None, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of a whole text's n-grams, in order of key; none if it has no letter.

    0 is the boundary mark: any run of other characters is one, and both ends
    are. Long texts are worked on in pieces; the last two points go on to the
    next piece, so what comes out doesn't depend on where they are cut.
    """
    text = (text or "").lower()
    parts, carried = [], np.zeros(1, np.int64)
    for start in range(0, max(1, len(text)), piece):
        new = _letters(text[start:start + piece])
        points = np.concatenate((carried, new, [0] if start + piece >= len(text) else []))
        points = points[(points != 0) | np.append(True, points[:-1] != 0)].astype(np.int64)
        known = len(carried)
        marked = np.where(points == 0, MARK, points)
        found = []
        for n in ORDERS:
            # Those that end behind what the last piece has seen.
            first, m = max(0, known - n + 1), len(points) - n + 1
            if m <= first:
                continue
            key = np.zeros(m - first, dtype=np.int64)
            for k in range(n):
                key = (key << 21) | marked[first + k:m + k]
            # Marks stand at the ends of an n-gram only, and not alone.
            inside = points[first:m] != 0 if n == 1 else np.ones(m - first, dtype=bool)
            for k in range(1, n - 1):
                inside &= points[first + k:m + k] != 0
            found.append(key[inside])
        if found:
            parts.append(np.unique(np.concatenate(found), return_counts=True))
        carried = points[-2:]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(parts) == 1:
        return parts[0]
    keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(where, np.concatenate([c for _, c in parts])).astype(np.int64)


def ranked(keys: np.ndarray, counts: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """The ``most`` most frequent keys in order; ties by key."""
    return keys[np.argsort(-counts, kind="stable")[:most]]


@dataclass(frozen=True)
class Profiles:
    languages: tuple[str, ...]
    #: For each language its n-grams in order.
    ranks: tuple[np.ndarray, ...]

    def distances(self, mine: np.ndarray) -> np.ndarray:
        """Out-of-place distance of a document's ranked n-grams to every profile."""
        out = np.zeros(len(self.languages))
        place = np.arange(len(mine))
        for i, (keys, at) in enumerate(self._sorted):
            found = np.minimum(np.searchsorted(keys, mine), len(keys) - 1)
            there = keys[found] == mine
            out[i] = np.where(there, np.abs(at[found] - place), PROFILE).sum()
        return out

    @property
    def _sorted(self) -> list[tuple[np.ndarray, np.ndarray]]:
        if "_cache" not in self.__dict__:
            orders = [np.argsort(r) for r in self.ranks]
            object.__setattr__(self, "_cache", [(r[o], o) for r, o in zip(self.ranks, orders, strict=True)])
        return self.__dict__["_cache"]


def identify(text: str | None, profiles: Profiles) -> tuple[str, float]:
    """Language and score of one text; the score is the margin to the second nearest profile, as a share of the worst distance."""
    mine = ranked(*ngram_counts(text))
    if not len(mine) or not profiles.languages:
        return UNKNOWN, 0.0
    far = profiles.distances(mine) / (PROFILE * len(mine))
    order = np.argsort(far, kind="stable")
    other = far[order[1]] if len(order) > 1 else 1.0
    return profiles.languages[order[0]], float(np.clip(0.5 + (other - far[order[0]]), 0.0, 1.0))


def _counted(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """N-gram counts by language of a part of the sample."""
    by: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    for frame in frames:
        for lang, text in zip(frame["lang"], frame["text"], strict=True):
            by.setdefault(lang, []).append(ngram_counts(text))
    for lang, parts in by.items():
        keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        counts = np.bincount(where, np.concatenate([c for _, c in parts]), minlength=len(keys)).astype(np.int64)
        yield pd.DataFrame({"lang": lang, "key": keys, "n": counts})


def fit(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Profiles:
    """Profiles from at most ``per_language`` documents of each language, chosen by a hash of the id; never from held-out rows.

    Rows with a null id, text or language teach nothing. Every other language
    gets a profile, ``PROFILE`` keys that every task holds.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    drawn = [hash60(F.concat(F.lit("sample"), F.col("doc_id").cast("string"))), F.col("doc_id")]
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    ids = known.select("doc_id", "lang").distinct().withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)))
    for keys in (["lang", "part"], ["lang"]):  # so that one language's last draw is among ``PARTS * per_language`` ids
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*drawn))
        ids = ids.withColumn("place", place).where(F.col("place") <= per_language)
    ids, seen = written_counting(ids.select("doc_id", "lang"), "language-ids", n=F.count(F.lit(1)))
    chosen = known.select("doc_id", "lang", "text").join(small_or_shuffled(ids, seen["n"]), ["doc_id", "lang"], "left_semi")
    # An id counts once, with its smallest text.
    chosen = chosen.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    counts = chosen.select("lang", "text").mapInPandas(_counted, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))
    top = Window.partitionBy("lang").orderBy(F.desc("n"), "key")
    best = counts.withColumn("place", F.row_number().over(top)).where(F.col("place") <= PROFILE)
    languages = best.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "key"))).alias("top"))
    rows = sorted(languages.collect(), key=lambda r: r["lang"])
    return Profiles(tuple(r["lang"] for r in rows), tuple(np.array([x["key"] for x in r["top"]], dtype=np.int64) for r in rows))


def languages(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1); only ``text`` is looked at.

    A text that is null or has no letter is ``und`` with score 0, as is every
    text if nothing was learned. At equal distances the first language in code
    point order is taken. Columns named ``lang_pred`` or ``score`` are replaced.
    """
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("lang_pred string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([identify(t, profiles) for t in texts], columns=["lang_pred", "score"])

    kept = docs.drop("lang_pred", "score")
    return kept.withColumn("_p", predicted("text")).select(*kept.columns, "_p.lang_pred", "_p.score")


def language_predictions(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs(doc_id, text, lang)``."""
    return languages(docs.select("doc_id", "text"), fit(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")

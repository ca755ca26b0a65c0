"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text are densities of a fixed and of a learned lexicon,
how near their hits stand to second-person words, and rates of capitals,
punctuation and obfuscation. The learned lexicon holds words and word starts
of the labelled sample that stand out in toxic documents; it is chosen
greedily, each entry for the toxic documents that no earlier one covers, so
the other words of a text that was copied often don't get in.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm.common import bounded_batches, hash60, held_out, written_counting
from claimloom.llm.labelled import SAMPLE_ROWS, labelled_sample

#: Insults of four languages, in lower case.
INSULTS = frozenset("""
    idiot idiots moron morons loser losers scum clown clowns trash garbage stupid dumb pathetic worthless disgusting
    bastard jerk fool imbecile vermin filth freak coward creep pig rat
    trottel depp vollidiot arschloch dummkopf abschaum widerlich wertlos erbärmlich versager
    imbécile crétin connard abruti salaud ordure minable débile dégoûtant raclure
    idiota imbécil estúpido estúpida basura escoria cretino payaso asqueroso patético inútil
""".split())
#: Second-person words of four languages.
SECOND_PERSON = frozenset("you your yours yourself ur u du dich dir dein deine euch ihr tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros tus".split())
#: Signs that stand for letters.
LOOKALIKES = str.maketrans("@4301!$57|€£", "aaeoiisstiel")

#: Words between a hit and a second-person word that count as near.
NEAR = 5
#: Letters of words that can be entries, and of their starts; least log-odds of an entry.
WORD_LETTERS, STEMS, LEAST_ODDS = (3, 30), (4, 5, 6, 7, 8), 1.7
#: Toxic documents that an entry has to add, at least, and as a share of all toxic ones.
LEAST_DOCS, LEAST_SHARE = 2, 0.008
#: Log-odds from which an entry is a strong one; strong and weak ones are counted apart.
STRONG_ODDS = 3.0
#: Of the sample, one document in so many calibrates and is kept from the trees.
CALIBRATE_ONE_IN = 4
TREES, DEPTH = 20, 3
THRESHOLD = 0.3

HIT, LEARNED, DISGUISED, SECOND, CAPITALS, MIXED, STRETCHED, WEAK = (1 << k for k in range(8))
N_FEATURES = 19
_EDGE = re.compile(r"^\W+|[\W_]+$")
_STRETCH = re.compile(r"(\w)\1{2,}")
_UPPER = bytes(range(65, 91))
_SIGNS = bytes(b for b in range(33, 127) if not chr(b).isalnum())


@dataclass
class Lexicon:
    """Learned entries: whole words, and starts of words marked by a star, strong and weak ones."""

    strong: frozenset[str] = frozenset()
    weak: frozenset[str] = frozenset()
    #: Flags of the tokens met so far; emptied when it grows beyond ``REMEMBERED``.
    flags: dict[str, int] = field(default_factory=dict, repr=False)
    REMEMBERED = 300_000

    def __getstate__(self):
        return {"strong": self.strong, "weak": self.weak, "flags": {}}

    def flag(self, token: str) -> int:
        word = _EDGE.sub("", token.lower())
        plain = word.isalpha()
        out = HIT if word in INSULTS else 0
        entries = {word, *(word[:n] + "*" for n in STEMS if len(word) > n)}
        if not entries.isdisjoint(self.strong):
            out |= LEARNED
        if not entries.isdisjoint(self.weak):
            out |= WEAK
        if word in SECOND_PERSON:
            out |= SECOND
        if len(word) > 1 and token.isupper():
            out |= CAPITALS
        if not plain or _STRETCH.search(word):
            raw = token.lower().strip(".,;:?\"'()[]")
            opened = re.sub(r"[\W_\d]+", "", raw.translate(LOOKALIKES))
            opened = {opened, _STRETCH.sub(r"\1", opened), _STRETCH.sub(r"\1\1", opened)}
            if not out & HIT and (opened & INSULTS or opened & self.strong):
                out |= DISGUISED
            if any(c.isalpha() for c in raw) and not plain:
                out |= MIXED
            if _STRETCH.search(word):
                out |= STRETCHED
        return out

    def flags_of(self, tokens: list[str]) -> np.ndarray:
        known = self.flags
        if new := set(tokens).difference(known):
            if len(known) + len(new) > self.REMEMBERED:
                known.clear()
                new = set(tokens)
            known.update((t, self.flag(t)) for t in new)
        return np.fromiter(map(known.__getitem__, tokens), dtype=np.uint8, count=len(tokens))


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """Dense features of one whole text; those of an empty one are zeros."""
    text = text or ""
    tokens = text.split()
    if not tokens:
        return [0.0] * N_FEATURES
    flags = lexicon.flags_of(tokens)
    n = len(tokens)
    hit = flags & (HIT | LEARNED | DISGUISED | WEAK) != 0
    at, second = np.flatnonzero(hit), np.flatnonzero(flags & SECOND)
    near = 0
    if len(at) and len(second):
        place = np.searchsorted(second, at)
        gap = np.minimum(np.abs(second[np.minimum(place, len(second) - 1)] - at), np.abs(second[np.maximum(place - 1, 0)] - at))
        near = int((gap <= NEAR).sum())

    def count(flag: int) -> int:
        return int(np.count_nonzero(flags & flag))

    data = text.encode("utf-8", "surrogatepass")
    size = len(data)
    found = [count(flag) for flag in (HIT, LEARNED, WEAK, DISGUISED)]
    return [
        *(k / n for k in found), *map(math.log1p, found),
        len(at) / n, near / max(1, len(at)), len(second) / n, count(CAPITALS) / n,
        (size - len(data.translate(None, _UPPER))) / size, data.count(b"!") / size, data.count(b"?") / size,
        (size - len(data.translate(None, _SIGNS))) / size, count(MIXED) / n, count(STRETCHED) / n, math.log1p(n),
    ]


def _entries(text: str) -> set[str]:
    """The words of a text, and their starts marked by a star."""
    words = {w for w in (_EDGE.sub("", t.lower()) for t in set(text.split())) if WORD_LETTERS[0] <= len(w) <= WORD_LETTERS[1] and w.isalpha()}
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) > n}


def _counted(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For the entries of a part of the sample: in how many toxic and other documents."""
    by_label = {1: Counter(), 0: Counter()}
    for frame in frames:
        for text, label in zip(frame["text"], frame["label"], strict=True):
            by_label[int(label == 1)].update(_entries(text))
    toxic, clean = by_label[1], by_label[0]
    yield pd.DataFrame([(e, toxic[e], clean[e]) for e in toxic.keys() | clean.keys()], columns=["entry", "toxic", "clean"])


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """The lexicon of ``sample(doc_id, text, label)``, a bounded sample: words of 3 to 30 letters and their starts, by the share of toxic documents they add."""
    size = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic")).first()
    toxic, clean = size["toxic"] or 0, size["n"] - (size["toxic"] or 0)
    if not toxic or not clean:
        return Lexicon()
    counts = (sample.mapInPandas(_counted, "entry string, toxic long, clean long")
              .groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    least = max(LEAST_DOCS, math.ceil(LEAST_SHARE * toxic))
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    # As many as a bounded sample has words.
    candidates = {r["entry"]: r["odds"] for r in counts.withColumn("odds", odds).where((F.col("toxic") >= least) & (F.col("odds") >= LEAST_ODDS)).collect()}

    def marks(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([(str(i), e) for i, t in zip(frame["doc_id"], frame["text"], strict=True) for e in _entries(t) & candidates.keys()], columns=["doc_id", "entry"])

    covers: dict[str, set[str]] = {}
    for row in sample.where("label = 1").mapInPandas(marks, "doc_id string, entry string").toLocalIterator():
        covers.setdefault(row["entry"], set()).add(row["doc_id"])
    return _chosen(covers, candidates, least)


def _chosen(covers: dict[str, set[str]], odds: dict[str, float], least: int) -> Lexicon:
    """Greedy cover: the entry of most weight among the documents that are left, again and again.

    Every entry adds ``least`` documents, so there are at most ``1 / LEAST_SHARE`` of them.
    """
    strong, weak = set(), set()
    left = set().union(*covers.values()) if covers else set()
    while True:
        entry, docs = max(covers.items(), key=lambda x: (len(x[1]) * odds[x[0]], x[0]), default=("", set()))
        if len(docs) < least:
            break
        (strong if odds[entry] >= STRONG_ODDS else weak).add(entry)
        left -= docs
        covers = {e: d & left for e, d in covers.items() if len(d & left) >= least}
    return Lexicon(frozenset(strong), frozenset(weak))


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: object | None
    calibration: object | None
    #: Score of every text if the sample holds one class, or nothing.
    constant: float = 0.0


def with_features(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def dense(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t, lexicon) for t in texts], dtype=object)

    return docs.withColumn("_features", array_to_vector(dense("text")))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Fit on at most ``rows`` labelled documents; rows that ``held_out`` marks are never learned from."""
    bounded_batches(docs.sparkSession)
    sample = labelled_sample(docs, labels, label, rows)
    lexicon = learn_lexicon(sample)
    dense = with_features(sample, lexicon).withColumn("calibrates", hash60(F.concat(F.lit("fold"), F.col("doc_id").cast("string"))) % CALIBRATE_ONE_IN == 0)
    ready, seen = written_counting(dense.select("label", "_features", "calibrates").coalesce(8), "toxicity-sample",
                                   ones=F.count_if(F.expr("label = 1 and not calibrates")), zeros=F.count_if(F.expr("label = 0 and not calibrates")),
                                   other_ones=F.count_if(F.expr("label = 1 and calibrates")), other_zeros=F.count_if(F.expr("label = 0 and calibrates")))
    if not seen["ones"] or not seen["zeros"]:
        return ToxicityModel(lexicon, None, None, float(bool(seen["ones"])))
    trees = GBTClassifier(featuresCol="_features", labelCol="label", predictionCol="_predicted", maxIter=TREES, maxDepth=DEPTH, seed=7)
    trees = trees.setProbabilityCol("_probability").setRawPredictionCol("_raw").fit(ready.where("not calibrates"))
    if not seen["other_ones"] or not seen["other_zeros"]:
        return ToxicityModel(lexicon, trees, None)
    margins = trees.transform(ready.where("calibrates")).select("label", vector_to_array("_raw")[1].alias("_margin"))
    calibration = IsotonicRegression(featuresCol="_margin", labelCol="label", predictionCol="_score").fit(margins.withColumn("label", F.col("label").cast("double")))
    return ToxicityModel(lexicon, trees, calibration)


def score(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted``; only ``text`` is looked at.

    A null text is an empty one and is scored too. Without labelled rows of
    both classes every row gets one constant score. Equal texts get equal
    scores. Columns of ``docs`` named ``score`` or ``predicted`` are replaced.
    """
    bounded_batches(docs.sparkSession)
    kept = docs.drop("score", "predicted")
    if model.trees is None:
        scored = kept.withColumn("score", F.lit(model.constant))
    else:
        scored = model.trees.transform(with_features(kept, model.lexicon)).withColumn("_margin", vector_to_array("_raw")[1])
        if model.calibration is None:
            scored = scored.withColumn("_score", vector_to_array("_probability")[1])
        else:
            scored = model.calibration.transform(scored)
        scored = scored.withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "_score")))
    return scored.select(*kept.columns, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    model = fit(docs, labels)
    return score(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "score", "predicted")

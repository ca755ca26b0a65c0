"""Quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage of its whole text is encoded
(shares of character classes, hashed byte pairs, repetition and word shapes),
a gated attention learned from document labels weighs them, and the weighted
representation is scored. Labels exist for documents only; what in a document
speaks for or against it is learned.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm.common import bounded_batches, held_out, written
from claimloom.llm.labelled import labelled_sample

#: Words in a passage.
PASSAGE = 64
#: Most labelled documents that are learned from, and most passages of one of them, drawn over its whole text.
SAMPLE_ROWS, SAMPLE_PASSAGES = 8_000, 400
HIDDEN, GATES, EPOCHS, BATCH, RATE = 24, 12, 40, 128, 0.01
THRESHOLD = 0.7

PAIRS = 16
CLASSES = 8
WIDTH = CLASSES + PAIRS + 8


def _class_table() -> np.ndarray:
    """For each byte: lower-case letter, capital, digit, space, stop, other sign, bar or bracket, byte beyond ASCII."""
    out = np.full(256, 5, dtype=np.int64)
    for b in range(256):
        c = chr(b)
        if b >= 128:
            out[b] = 7
        elif c.islower():
            out[b] = 0
        elif c.isupper():
            out[b] = 1
        elif c.isdigit():
            out[b] = 2
        elif c == " ":
            out[b] = 3
        elif c in ".,;:!?'\"-":
            out[b] = 4
        elif c in "|<>{}[]()/\\":
            out[b] = 6
    return out


_CLASS = _class_table()


def encode_passages(text: str | None) -> np.ndarray:
    """One row for each passage of a whole text; a text without words is one passage of zeros."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    n = len(words)
    if not n:
        return np.zeros((1, WIDTH), dtype=np.float32)
    passages = -(-n // PASSAGE)
    data = np.frombuffer(b" ".join(words), dtype=np.uint8)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    begins = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))[::PASSAGE]
    sizes = np.diff(np.append(begins, len(data)))
    of_byte = np.repeat(np.arange(passages), sizes)
    classes = np.bincount(of_byte * CLASSES + _CLASS[data], minlength=passages * CLASSES).reshape(passages, CLASSES)
    pair = (data[:-1].astype(np.int64) * 31 + data[1:]) % PAIRS
    pairs = np.bincount(of_byte[:-1] * PAIRS + pair, minlength=passages * PAIRS).reshape(passages, PAIRS)

    of_word = np.arange(n) // PASSAGE
    count = np.bincount(of_word, minlength=passages)
    ids = np.fromiter(map(hash, words), dtype=np.int64, count=n)  # only ever compared within this text
    again = np.bincount(of_word[1:], weights=ids[1:] == ids[:-1], minlength=passages)
    padded = np.full(passages * PASSAGE, np.iinfo(np.int64).max)
    padded[:n] = ids
    padded = np.sort(padded.reshape(passages, PASSAGE), axis=1)
    distinct = 1 + (padded[:, 1:] != padded[:, :-1]).sum(axis=1) - (count < PASSAGE)
    mean = np.bincount(of_word, weights=lengths, minlength=passages) / count
    spread = np.sqrt(np.maximum(0, np.bincount(of_word, weights=lengths.astype(float) ** 2, minlength=passages) / count - mean ** 2))
    short = np.bincount(of_word, weights=lengths <= 3, minlength=passages) / count
    longest = np.maximum.reduceat(lengths, np.arange(0, n, PASSAGE))
    return np.column_stack([
        classes / sizes[:, None], pairs / sizes[:, None], again / count, distinct / count, np.minimum(mean, 50) / 10, np.minimum(spread, 50) / 10,
        short, np.log1p(longest), count / PASSAGE, np.full(passages, np.log1p(n) / 10),
    ]).astype(np.float32)


def drawn_passages(bag: np.ndarray) -> np.ndarray:
    """At most ``SAMPLE_PASSAGES`` of a text's passages, in order; which ones follows from their number."""
    if len(bag) <= SAMPLE_PASSAGES:
        return bag
    return bag[np.sort(np.random.default_rng(len(bag)).permutation(len(bag))[:SAMPLE_PASSAGES])]


@dataclass
class AttentionModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    #: Score of every text if the sample holds one class, or nothing.
    constant: float | None = None

    def _forward(self, x: np.ndarray, bag: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        h = np.tanh(x @ w["encode"] + w["encode_bias"])
        t, g = np.tanh(h @ w["attend"]), 1 / (1 + np.exp(-(h @ w["gate"])))
        e = (t * g) @ w["weigh"]
        begins = np.flatnonzero(np.diff(bag, prepend=-1))  # bags follow one another, none is empty
        a = np.exp(e - np.maximum.reduceat(e, begins)[bag])
        a /= np.add.reduceat(a, begins)[bag]
        z = np.add.reduceat(a[:, None] * h, begins, axis=0)
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "p": 1 / (1 + np.exp(-np.clip(z @ w["score"] + w["score_bias"], -30, 30)))}

    def score(self, passages: np.ndarray) -> float:
        if self.constant is not None:
            return self.constant
        x = (passages - self.mean) / self.scale
        return float(self._forward(x, np.zeros(len(x), dtype=np.int64))["p"][0])

    def gradients(self, x: np.ndarray, bag: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss over the bags."""
        w, f = self.weights, self._forward(x, bag)
        h, t, g, a, z = f["h"], f["t"], f["g"], f["a"], f["z"]
        d_logit = (f["p"] - y) / len(y)
        d_z = (d_logit[:, None] * w["score"])[bag]
        d_a = (d_z * h).sum(axis=1)
        d_e = a * (d_a - np.bincount(bag, a * d_a, len(y))[bag])
        d_tg = d_e[:, None] * w["weigh"]
        d_t, d_g = d_tg * g * (1 - t ** 2), d_tg * t * g * (1 - g)
        d_h = (a[:, None] * d_z + d_t @ w["attend"].T + d_g @ w["gate"].T) * (1 - h ** 2)
        return {"encode": x.T @ d_h, "encode_bias": d_h.sum(axis=0), "attend": h.T @ d_t, "gate": h.T @ d_g, "weigh": (t * g).T @ d_e,
                "score": z.T @ d_logit, "score_bias": d_logit.sum()}


def train(bags: list[np.ndarray], labels: list[int], seed: int = 5) -> AttentionModel:
    """Adam on the log loss; deterministic for bags in a given order."""
    if len(set(labels)) < 2:
        return AttentionModel(np.zeros(WIDTH), np.ones(WIDTH), {}, float(labels[0]) if labels else 0.0)
    every = np.concatenate(bags)
    rng = np.random.default_rng(seed)
    start = {"encode": (WIDTH, HIDDEN), "attend": (HIDDEN, GATES), "gate": (HIDDEN, GATES), "weigh": (GATES,), "score": (HIDDEN,)}
    weights = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) for k, s in start.items()} | {"encode_bias": np.zeros(HIDDEN), "score_bias": np.zeros(())}
    model = AttentionModel(every.mean(axis=0), every.std(axis=0) + 1e-6, weights)
    scaled = [(b - model.mean) / model.scale for b in bags]
    y = np.array(labels, dtype=float)
    first, second, step = {k: 0.0 for k in weights}, {k: 0.0 for k in weights}, 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(bags), BATCH):
            chosen, step = order[at:at + BATCH], step + 1
            bag = np.repeat(np.arange(len(chosen)), [len(scaled[i]) for i in chosen])
            rate = RATE * (1 - epoch / EPOCHS)
            for k, d in model.gradients(np.concatenate([scaled[i] for i in chosen]), bag, y[chosen]).items():
                first[k] = 0.9 * first[k] + 0.1 * d
                second[k] = 0.999 * second[k] + 0.001 * d ** 2
                weights[k] = weights[k] - rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> AttentionModel:
    """Fit on at most ``rows`` labelled documents; rows that ``held_out`` marks are never learned from."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf(T.BinaryType())
    def encoded(texts: pd.Series) -> pd.Series:
        return pd.Series([drawn_passages(encode_passages(t)).tobytes() for t in texts], dtype=object)

    sample = labelled_sample(docs, labels, label, rows)
    bags = written(sample.select("doc_id", "label", encoded("text").alias("bag")), "bags")
    found = bags.orderBy("doc_id").toPandas()
    return train([np.frombuffer(b, dtype=np.float32).reshape(-1, WIDTH) for b in found["bag"]], found["label"].astype(int).tolist())


def score(docs: DataFrame, model: AttentionModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted``; only ``text`` is looked at.

    A null text is an empty one; texts without words are one passage of zeros
    and are scored too. Equal texts get equal scores. Without labelled rows of
    both classes every row gets one constant score. Columns of ``docs`` named
    ``score`` or ``predicted`` are replaced.
    """
    bounded_batches(docs.sparkSession)

    @F.pandas_udf(T.DoubleType())
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(encode_passages(t)) for t in texts], dtype=float)

    kept = docs.drop("score", "predicted")
    out = kept.withColumn("score", scored("text"))
    return out.select(*kept.columns, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    model = fit(docs, labels)
    return score(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "score", "predicted")

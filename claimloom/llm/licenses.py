"""License scans through a positional index of rare words.

Templates are phrases of license texts with a label. Each word of a template
is posted with its position. How rare a word is comes from the corpus: the
documents that hold it, counted over all of them. In a document the words of
templates are looked up from the rarest on: every occurrence of a template's
rarest word that stands there proposes the start that its position implies,
and the occurrences of the other words are intersected with the starts they
imply. A label needs its mandatory key phrases, word for word. Templates that
are no base phrase may lack some other words (``LEAST_SHARE`` of the weight
must be there), which is what the scan adds to plain phrase search.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm.common import bounded_batches

#: A word: A-Z in lower case, digits, and everything beyond ASCII.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Share of a template's weight that has to stand in place, key phrases included.
LEAST_SHARE = 0.7


@dataclass(frozen=True)
class Template:
    label: str
    phrase: str
    #: Phrases within it that must be there word for word; a base phrase is its own key.
    keys: tuple[str, ...] = ()
    base: bool = False


#: The base phrases and their labels.
BASE = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
)
#: Characteristic sentences of common licenses and their mandatory key phrases.
TEMPLATES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge",)),
    Template("mit", "licensed under the mit license", ("mit license",)),
    Template("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0", ("apache org licenses license 2 0",)),
    Template("gpl", "licensed under the gnu general public license version", ("gnu general public license",)),
    Template("gpl", "redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("gnu general public license",)),
    Template("lgpl", "licensed under the terms of the gnu lesser general public license", ("gnu lesser general public license",)),
    Template("agpl", "licensed under the terms of the gnu affero general public license", ("gnu affero general public license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("cc-by-nc", "creative commons attribution noncommercial", ("creative commons", "noncommercial")),
    Template("cc-by", "licensed under a creative commons attribution license", ("creative commons attribution",)),
    Template("cc0", "creative commons cc0 public domain dedication", ("cc0",)),
    Template("reserved", "all rights reserved", ("all rights reserved",)),
)


def license_words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


def document_frequencies(docs: DataFrame, words: Sequence[str]) -> tuple[dict[str, int], int]:
    """In how many rows of ``docs(text)`` each of the given words stands, and how many rows there are; counted over whole texts."""
    wanted = {w.encode() for w in words}
    bounded_batches(docs.sparkSession)

    def counted(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, n = dict.fromkeys(wanted, 0), 0
        for frame in frames:
            for text in frame["text"]:
                n += 1
                for w in wanted.intersection(license_words(text)):
                    found[w] += 1
        yield pd.DataFrame([("", n), *((w.decode(), k) for w, k in found.items())], columns=["word", "n"])

    rows = docs.select("text").mapInPandas(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = {r["word"]: r["n"] for r in rows}
    return counts, counts.pop("", 0)


_NONE = (np.zeros(0, dtype=np.int64), np.zeros(0))


@dataclass
class PositionalIndex:
    """Postings of the templates' words, each with its weight."""

    templates: tuple[Template, ...]
    idf: dict[bytes, float]
    #: For each template its words, and of them the order in which they are looked up: rarest first.
    phrases: list[list[bytes]] = field(init=False)
    orders: list[list[int]] = field(init=False)
    keys: list[list[list[bytes]]] = field(init=False)

    def __post_init__(self):
        self.phrases = [license_words(t.phrase) for t in self.templates]
        self.orders = [sorted(range(len(p)), key=lambda k, p=p: (-self.idf.get(p[k], 0.0), k)) for p in self.phrases]
        self.keys = [[license_words(k) for k in (t.keys or (t.phrase,))] for t in self.templates]

    def occurrences(self, words: list[bytes]) -> dict[bytes, np.ndarray]:
        """The positions of template words in a document."""
        found: dict[bytes, list[int]] = {}
        known = self.idf
        for at, word in enumerate(words):
            if word in known:
                found.setdefault(word, []).append(at)
        return {w: np.array(p, dtype=np.int64) for w, p in found.items()}

    def starts(self, k: int, at: dict[bytes, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Where template ``k`` may begin, by relative positions, and the share of its weight that stands in place there.

        A base phrase keeps the starts on which all words agree. Another
        template is proposed by each of its words that is rarer than the
        share it may lack.
        """
        phrase, order = self.phrases[k], self.orders[k]
        weights = {j: max(self.idf.get(phrase[j], 0.0), 1e-9) for j in order}
        total = sum(weights.values())
        if self.templates[k].base:
            if any(phrase[j] not in at for j in order):
                return _NONE
            starts = at[phrase[order[0]]] - order[0]
            for j in order[1:]:
                starts = starts[np.isin(starts + j, at[phrase[j]])]
            return starts, np.ones(len(starts))
        proposed, lacking = [], 0.0
        for j in order:
            if lacking > (1 - LEAST_SHARE) * total:
                break  # without all rarer words the share can't be reached
            if phrase[j] in at:
                proposed.append(at[phrase[j]] - j)
            lacking += weights[j]
        if not proposed:
            return _NONE
        starts = np.unique(np.concatenate(proposed))
        share = np.zeros(len(starts))
        for j in order:
            if phrase[j] in at:
                share += weights[j] / total * np.isin(starts + j, at[phrase[j]])
        return starts[share >= LEAST_SHARE], share[share >= LEAST_SHARE]

    def scan(self, text: str | None) -> tuple:
        """``(n_words, n_base, first_word, last_word, base_labels, labels, score)`` of one text."""
        words = license_words(text)
        at = self.occurrences(words)
        places, base, labels, best = [], set(), set(), 0.0
        for k, template in enumerate(self.templates):
            if template.base:
                starts, _ = self.starts(k, at)
                if len(starts):
                    places.append(starts)
                    base.add(template.label)
                    best = 1.0
                continue
            starts, share = self.starts(k, at)
            for start, s in zip(starts.tolist(), share.tolist(), strict=True):
                window = words[max(0, start): start + len(self.phrases[k])]
                if all(_holds(window, key) for key in self.keys[k]):
                    labels.add(template.label)
                    best = max(best, min(1.0, s))
        spots = np.concatenate(places) if places else np.zeros(0, np.int64)
        first, last = (int(spots.min()), int(spots.max())) if len(spots) else (None, None)
        return len(words), len(spots), first, last, ",".join(sorted(base)), ",".join(sorted(base | labels)), best


def _holds(words: list[bytes], phrase: list[bytes]) -> bool:
    n = len(phrase)
    return any(words[i:i + n] == phrase for i in range(len(words) - n + 1))


def build_index(docs: DataFrame, templates: Sequence[Template] = BASE + TEMPLATES) -> PositionalIndex:
    vocabulary = sorted({w.decode() for t in templates for w in license_words(t.phrase)})
    counts, n = document_frequencies(docs, vocabulary)
    return PositionalIndex(tuple(templates), {w.encode(): math.log((n + 1) / (counts.get(w, 0) + 1)) + 1e-6 for w in vocabulary})


_SCAN = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()), T.StructField("score", T.DoubleType()),
])


def scan_licenses(docs: DataFrame, templates: Sequence[Template] = BASE + TEMPLATES) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``n_base`` counts all places of base phrases, of which ``first_word`` and
    ``last_word`` are the smallest and the largest, null without one. Labels
    are distinct, sorted and joined by commas, empty without one. The score is
    the largest share of a template's weight that was found. A null text is an
    empty one. Repeated rows are scanned each; other columns are ignored; an
    empty table gives an empty result.
    """
    index = build_index(docs, templates)

    @F.pandas_udf(_SCAN)
    def scanned(texts: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame([index.scan(t) for t in texts], columns=_SCAN.names)
        return out.astype({"first_word": "Int64", "last_word": "Int64"})

    return docs.select("doc_id", scanned("text").alias("s")).select("doc_id", "s.*")

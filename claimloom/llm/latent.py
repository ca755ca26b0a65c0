"""Benchmark decontamination by latent semantic retrieval.

Passages of the corpus and of the benchmark are rows of one TF-IDF matrix over
the benchmark's words (no other word adds to a product with an item). A
distributed randomised SVD gives its leading right singular vectors: every
task sketches its passages with a random matrix and multiplies back, the
sketches are summed, and the small factor is decomposed. Items are folded
through the latent factors, and passages whose cosine reaches ``COSINE`` are
candidates. A candidate is a leak if a compact stretch of the document holds
most of the item's words in order (longest common subsequence), or fewer of
them and the item's answer: that catches paraphrases.

Words are told apart without case and surrounding punctuation. The benchmark
is worked on in blocks of items, so what a task holds is bounded by
``BLOCK_PASSAGES`` and the block's vocabulary.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import bounded_batches, discard, small_or_shuffled, text_or_empty, written, written_counting
from claimloom.session import scratch_dir

#: Words of a half passage; passages are two of them and overlap by one.
HALF = 32
#: Half passages whose products are in memory at a time: at most 32 terms of 1 KB each in every one.
HALVES_AT_ONCE = 1_024
#: Terms in over this share of passages have no weight, but for the rarest ``KEPT`` terms of each item.
COMMON_SHARE, KEPT = 0.005, 8
#: Singular vectors kept, and further columns of the sketch.
RANK, OVERSAMPLE = 256, 16
#: Passages of items in a block.
BLOCK_PASSAGES = 256
#: Least cosine of a candidate.
COSINE = 0.25
#: Share of an item's words that a leak holds in order; a smaller one with the answer.
LCS, LCS_WITH_ANSWER, ANSWER = 0.8, 0.6, 0.9
#: A stretch may be so many times as long as its item.
LOOSE = 1.5
#: Shorter items have too few words to tell a leak from chance by a share of them: they leak word for word only.
LEAST_WORDS = 8
#: Short items in a block, and words on either side of one that its answer is looked for in.
BLOCK_PHRASES, AROUND = 4_096, 64

_SIGNS = "".join(chr(b) for b in range(33, 127) if not chr(b).isalnum())
_SENTENCE = re.compile(r"(?<=[.?!])\s+|\n+")


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one after another, and where each text begins."""
    cut = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    return pc.ascii_trim(cut.flatten(), characters=_SIGNS), cut.offsets.to_numpy().astype(np.int64)


def _word_list(text: str | None) -> list[str]:
    return [w for w in _words(pa.array([text or ""], pa.large_string()))[0].to_pylist() if w]


@dataclass(frozen=True)
class Item:
    item_id: object
    words: tuple[int, ...]
    answer: tuple[int, ...]


@dataclass
class Vocabulary:
    """The words of the items, numbered from 1; 0 is any other word."""

    words: list[str]
    _set: pa.Array | None = field(default=None, repr=False)

    def __getstate__(self):
        return {"words": self.words, "_set": None}

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if self._set is None:
            self._set = pa.array(self.words, pa.large_string())
        words, begins = _words(texts)
        found = pc.index_in(words, value_set=self._set)
        return pc.fill_null(pc.add(found, 1), 0).to_numpy(zero_copy_only=False).astype(np.int64), begins


def _halves(begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Numbers the half passages of several texts, with a spare one after each text: of every word, of every text's first, how many."""
    sizes = np.diff(begins)
    count = -(-sizes // HALF) + 1
    first = np.concatenate(([0], np.cumsum(count)))
    text = np.repeat(np.arange(len(sizes)), sizes)
    return first[text] + (np.arange(begins[-1]) - begins[text]) // HALF, first[:-1], int(first[-1])


def _terms_once(ids: np.ndarray, part: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Each term of a part once, in order of part."""
    known = ids > 0
    keys = np.unique(part[known] * size + ids[known] - 1)
    return keys % size, keys // size


def _summed(rows: np.ndarray, part: np.ndarray, parts: int) -> np.ndarray:
    """Sums of rows by their part; parts come in order."""
    out = np.zeros((parts, rows.shape[1]), dtype=np.float32)
    if len(part):
        begins = np.flatnonzero(np.diff(part, prepend=-1))
        out[part[begins]] = np.add.reduceat(rows, begins, axis=0)
    return out


@dataclass
class Retriever:
    """A block of items and what finds them: for each term its part in the cosine with every item passage."""

    vocabulary: Vocabulary
    items: list[Item]
    #: Of every passage the number of its item.
    owner: np.ndarray
    idf: np.ndarray
    #: Terms by passages of items: the folded items, weighted by the term's IDF.
    parts: np.ndarray

    def leaks(self, texts: pa.Array) -> list[list[tuple]]:
        """For each text its leaks ``(item, cosine, lcs, answer, first word)``, the best place of each item."""
        ids, begins = self.vocabulary.ids(texts)
        out: list[list[tuple]] = [[] for _ in range(len(begins) - 1)]
        half, first, n = _halves(begins)
        term, part = _terms_once(ids, half, len(self.idf))
        weighty = self.idf[term] > 0
        term, part = term[weighty], part[weighty]
        if not len(term):
            return out
        best: dict[tuple[int, int], tuple] = {}
        for low_half, scores in self._scores(term, part, n):
            self._judge(scores, low_half, first, begins, ids, best)
        for (t, _), leak in sorted(best.items()):
            out[t].append(leak)
        return out

    def _scores(self, term: np.ndarray, part: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
        """Cosines of passages, two halves each, with every item passage, so many at a time: the first one's number and their rows."""
        for low in range(0, n, HALVES_AT_ONCE):
            high = min(n, low + HALVES_AT_ONCE)
            # One half more, which the last passage ends with.
            here = slice(*np.searchsorted(part, [low, high + 1]))
            terms, halves, size = term[here], part[here] - low, min(n, high + 1) - low
            if not len(terms):
                continue
            scores = _summed(self.parts[terms], halves, size)
            energy = np.bincount(halves, self.idf[terms] ** 2, size)
            scores[:-1] += scores[1:]
            energy[:-1] += energy[1:]
            scores /= np.sqrt(np.maximum(energy, 1e-12))[:, None]
            yield low, scores[:high - low]

    def _judge(self, scores: np.ndarray, low_half: int, first: np.ndarray, begins: np.ndarray, ids: np.ndarray, best: dict) -> None:
        """Put the best place of each text and item among these candidates into ``best``."""
        at, passage = np.nonzero(scores >= COSINE)
        text = np.searchsorted(first, at + low_half, side="right") - 1
        for t, row, p in zip(text.tolist(), at.tolist(), passage.tolist(), strict=True):
            key, h = (t, int(self.owner[p])), row + low_half
            if key in best and best[key][2] == 1.0:
                continue
            item = self.items[key[1]]
            low = max(0, (h - int(first[t])) * HALF - len(item.words))
            high = min(int(begins[t + 1] - begins[t]), (h - int(first[t]) + 2) * HALF + len(item.words))
            found = judged(item, ids[begins[t] + low: begins[t] + high].tolist())
            if found and (key not in best or found[0] > best[key][2]):
                best[key] = (key[1], float(scores[row, p]), found[0], found[1], low + found[2])


def lcs_length(a: tuple[int, ...] | list[int], b: tuple[int, ...] | list[int]) -> int:
    """Longest common subsequence, all cells of a row at once as bits; 0 matches nothing."""
    places: dict[int, int] = {}
    for i, w in enumerate(a):
        if w:
            places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        if m := places.get(w, 0):
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


def judged(item: Item, words: list[int]) -> tuple[float, bool, int] | None:
    """``(lcs share, answer found, first word)`` of the best compact stretch of ``words`` if it leaks the item."""
    n = len(item.words)
    if lcs_length(item.words, words) < LCS_WITH_ANSWER * n:
        return None
    size, step = int(LOOSE * n) + 4, max(1, n // 8)
    stretches = range(0, max(1, len(words) - size + step), step)
    share, start = max((lcs_length(item.words, words[s:s + size]) / n, -s) for s in stretches)
    near = words[max(0, -start - n): -start + size + n]
    answer = bool(item.answer) and lcs_length(item.answer, near) >= ANSWER * len(item.answer)
    return (share, answer, -start) if share >= LCS or (share >= LCS_WITH_ANSWER and answer) else None


@dataclass
class Phrases:
    """A block of short items; they are found word for word."""

    vocabulary: Vocabulary
    items: list[Item]

    def leaks(self, texts: pa.Array) -> list[list[tuple]]:
        """As those of ``Retriever``, the first place of each item; without a cosine."""
        ids, begins = self.vocabulary.ids(texts)
        out: list[list[tuple]] = [[] for _ in range(len(begins) - 1)]
        # Signs that stand alone are no words.
        at = np.flatnonzero(ids != self.vocabulary.words.index("") + 1)
        ids, text = ids[at], np.searchsorted(begins, at, side="right") - 1
        known = np.flatnonzero(ids)
        known = known[np.argsort(ids[known], kind="stable")]
        heads = np.searchsorted(ids[known], np.arange(len(self.vocabulary.words) + 2))
        for number, item in enumerate(self.items):
            words, n = np.array(item.words), len(item.words)
            rarest = int(np.argmin(heads[words + 1] - heads[words]))
            starts = known[heads[words[rarest]]:heads[words[rarest] + 1]] - rarest
            starts = starts[(starts >= 0) & (starts + n <= len(ids))]
            for k in range(n):
                starts = starts[ids[starts + k] == words[k]]
            starts = starts[text[starts] == text[starts + n - 1]]
            done = set()
            for s in starts.tolist():
                t = int(text[s])
                if t in done:
                    continue
                low, high = np.searchsorted(text, t), np.searchsorted(text, t, side="right")
                near = ids[max(low, s - AROUND - len(item.answer)): min(high, s + n + AROUND + len(item.answer))].tolist()
                answer = bool(item.answer) and lcs_length(item.answer, near) >= ANSWER * len(item.answer)
                if answer or not item.answer:
                    done.add(t)
                    out[t].append((number, None, 1.0, answer, int(at[s] - begins[t])))
        return out


def _item_words(text: str | None, answer: str | None) -> tuple[list[str], list[str]]:
    """An item's words, and its answer's: the given one, or its last sentence if it has several."""
    words = _word_list(text)
    if answer is None:
        sentences = [s for s in (_word_list(s) for s in _SENTENCE.split(text or "")) if s]
        return words, sentences[-1] if len(sentences) > 1 else []
    return words, _word_list(answer)


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple]]:
    """``(item_id, words, answer)`` in blocks of up to ``BLOCK_PASSAGES`` passages, streamed from the table; short items in blocks of their own."""
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    block, passages, short = [], 0, []
    for row in benchmark.select("item_id", "text", answer.alias("answer")).toLocalIterator():
        words, of_answer = _item_words(row["text"], row["answer"])
        if len(words) < LEAST_WORDS:
            if words:
                short.append((row["item_id"], words, of_answer))
            if len(short) == BLOCK_PHRASES:
                yield short
                short = []
            continue
        n = -(-len(words) // (2 * HALF))
        if block and passages + n > BLOCK_PASSAGES:
            yield block
            block, passages = [], 0
        block.append((row["item_id"], words, of_answer))
        passages += n
    for rest in (block, short):
        if rest:
            yield rest


def _document_ids(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The ids of every text's words, as bytes."""
    kind = "<u2" if len(vocabulary.words) < 65_535 else "<u4"

    def encoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, begins = vocabulary.ids(batch.column(0))
            raw, width = ids.astype(kind).tobytes(), int(kind[-1])
            cells = [raw[a * width: b * width] for a, b in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.binary())], names=["ids"])

    return written(docs.select(text_or_empty().alias("text")).mapInArrow(encoded, "ids binary"), "term-ids")


def _read(cells: pd.Series, size: int) -> tuple[np.ndarray, np.ndarray]:
    kind = "<u2" if size < 65_535 else "<u4"
    lengths = np.array([len(c) for c in cells], dtype=np.int64) // int(kind[-1])
    return np.frombuffer(b"".join(cells), dtype=kind).astype(np.int64), np.concatenate(([0], np.cumsum(lengths)))


def _passages(ids: np.ndarray, begins: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Terms of passages that don't overlap: term, passage, number of passages."""
    half, first, n = _halves(begins)
    text = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    return *_terms_once(ids, first[text] + (half - first[text]) // 2, size), n


def _passage_counts(ids: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """In how many passages each term stands, and how many passages there are."""
    def counted(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(size, np.int64), 0
        for frame in frames:
            words, begins = _read(frame["ids"], size)
            term, _, _ = _passages(words, begins, size)
            total += np.bincount(term, minlength=size)
            n += int((-(-np.diff(begins) // (2 * HALF))).sum())
        yield pd.DataFrame({"term": np.append(np.flatnonzero(total), -1), "n": np.append(total[total > 0], n)})

    rows = ids.mapInPandas(counted, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    found = dict(zip(rows["term"].tolist(), rows["n"].tolist(), strict=True))
    passages = found.pop(-1, 0)
    counts = np.zeros(size, np.int64)
    counts[list(found)] = list(found.values())
    return counts, passages


def _sketch(ids: DataFrame, size: int, idf: np.ndarray, random: np.ndarray) -> np.ndarray:
    """The sum over all passages of ``a' (a @ random)``, a passage's weighted row being ``a``."""
    weighted = (idf[:, None] * random).astype(np.float32)
    columns = [f"c{k}" for k in range(random.shape[1])]

    def sketched(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, len(columns)))
        for frame in frames:
            words, begins = _read(frame["ids"], size)
            term, part, n = _passages(words, begins, size)
            weighty = idf[term] > 0
            term, part = term[weighty], part[weighty]
            if not len(term):
                continue
            for low in range(0, n, HALVES_AT_ONCE):
                here = slice(*np.searchsorted(part, [low, low + HALVES_AT_ONCE]))
                terms, parts = term[here], part[here] - low
                if not len(terms):
                    continue
                product = _summed(weighted[terms], parts, min(n - low, HALVES_AT_ONCE))
                order = np.argsort(terms, kind="stable")
                heads = np.flatnonzero(np.diff(terms[order], prepend=-1))
                total[terms[order][heads]] += np.add.reduceat(product[parts[order]], heads, axis=0)
        met = np.flatnonzero(np.any(total != 0, axis=1))
        out = pd.DataFrame(total[met].astype(np.float32), columns=columns)
        out.insert(0, "term", met)
        yield out

    schema = "term long, " + ", ".join(f"{c} float" for c in columns)
    rows = ids.mapInPandas(sketched, schema).groupBy("term").agg(*[F.sum(c).alias(c) for c in columns]).toPandas()
    out = np.zeros((size, len(columns)))
    out[rows["term"].to_numpy()] = rows[columns].to_numpy(dtype=float)
    return out * idf[:, None]


def singular_vectors(gram_random: np.ndarray, random: np.ndarray, rank: int) -> np.ndarray:
    """The leading right singular vectors of ``A`` from ``(A'A) @ random``, as columns (a Nyström approximation of ``A'A``)."""
    shift = 1e-6 * max(np.linalg.norm(gram_random), 1e-12)
    moved = gram_random + shift * random
    core = random.T @ moved
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    sound = values > 1e-12 * max(values.max(), 1e-300)
    root = vectors[:, sound] / np.sqrt(values[sound])
    left, sizes, _ = np.linalg.svd(moved @ root, full_matrices=False)
    return left[:, (sizes ** 2 > 2 * shift)][:, :rank]


def fit(docs: DataFrame, benchmark: DataFrame, seed: int = 11) -> Iterator[Retriever | Phrases]:
    """A retriever for each block of items, made when it is asked for. Counts and the SVD go over all rows and whole texts of ``docs(text)``.

    Items without a word are left out; those under ``LEAST_WORDS`` words are
    looked for as they stand. Repeated items stay and are each reported. An empty benchmark gives none.
    """
    bounded_batches(docs.sparkSession)
    for block in _blocks(benchmark):
        short = len(block[0][1]) < LEAST_WORDS
        vocabulary = Vocabulary(sorted({w for _, words, answer in block for w in words + answer} | ({""} if short else set())))
        number = {w: k + 1 for k, w in enumerate(vocabulary.words)}
        items = [Item(i, tuple(number[w] for w in words), tuple(number[w] for w in answer)) for i, words, answer in block]
        if short:
            yield Phrases(vocabulary, items)
            continue
        size = len(vocabulary.words)
        ids = _document_ids(docs, vocabulary)
        counts, passages = _passage_counts(ids, size)
        idf = np.log((passages + 1) / (counts + 1)) + 1e-3
        kept = counts <= COMMON_SHARE * passages
        for item in items:
            terms = np.unique(np.array(item.words)) - 1
            kept[terms[np.argsort(counts[terms], kind="stable")[:KEPT]]] = True
        idf = np.where(kept, idf, 0.0)
        # Rows of the items' passages, each term once in a half as in the documents.
        owner = np.concatenate([np.full(-(-len(i.words) // (2 * HALF)), k) for k, i in enumerate(items)])
        rows = np.zeros((len(owner), size))
        for p, k in enumerate(owner):
            piece = p - np.searchsorted(owner, k)
            words = items[k].words[piece * 2 * HALF: (piece + 1) * 2 * HALF]
            for h in range(0, len(words), HALF):
                rows[p, np.unique(np.array(words[h:h + HALF])) - 1] += 1
        rows *= idf
        random = np.random.default_rng(seed).normal(size=(size, min(size, RANK + OVERSAMPLE)))
        # The items weigh as much as the corpus, so the leading directions tell them apart.
        balance = max(1, passages) / len(rows)
        gram = _sketch(ids, size, idf, random) + balance * (rows.T @ (rows @ random))
        basis = singular_vectors(gram, random, RANK)
        folded = (rows @ basis) @ basis.T
        length = np.sqrt((rows ** 2).sum(axis=1))
        discard(ids)
        parts = (idf[:, None] * (folded / np.maximum(length, 1e-12)[:, None]).T).astype(np.float32)
        yield Retriever(vocabulary, items, owner, idf, parts)


_LEAK = "array<struct<item: int, cosine: double, lcs: double, answer: boolean, first_word: long>>"


def _leaks(text: Column, retriever: Retriever | Phrases) -> Column:
    @F.pandas_udf(_LEAK)
    def found(texts: pd.Series) -> pd.Series:
        rows = retriever.leaks(pa.array(texts, pa.large_string(), from_pandas=True))
        return pd.Series([[dict(zip(("item", "cosine", "lcs", "answer", "first_word"), leak, strict=True)) for leak in row] for row in rows], dtype=object)

    return found(text)


def _each_block(docs: DataFrame, benchmark: DataFrame, rows: Callable[[Retriever | Phrases], DataFrame], name: str) -> DataFrame | None:
    """The rows that every block gives, written before the next block is fitted, so one retriever is alive; nothing without a block."""
    path, schema, blocks = scratch_dir(docs.sparkSession, f"llm-{name}"), None, fit(docs, benchmark)
    while (retriever := next(blocks, None)) is not None:
        found = rows(retriever)
        found.write.mode("append").parquet(path)
        schema = found.schema
        del retriever, found
    return None if schema is None else docs.sparkSession.read.schema(schema).parquet(path)


def benchmark_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, cosine, lcs, answer, first_word``: the items that a document leaks, and where the best stretch begins.

    Documents without a leak have no row, as have null and empty texts. An item
    under ``LEAST_WORDS`` words has no cosine: it leaks if it stands in a text
    word for word, with its answer nearby if one is given.
    Repeated documents have rows each. ``benchmark`` has ``item_id, text`` and
    may have ``answer``. Columns beside those are ignored.
    """
    kind = benchmark.schema["item_id"].dataType

    def rows(retriever: Retriever | Phrases) -> DataFrame:
        names = F.array(*[F.lit(i.item_id).cast(kind) for i in retriever.items])
        hits = docs.select("doc_id", F.explode(_leaks(F.col("text"), retriever)).alias("l"))
        return hits.select("doc_id", F.get(names, F.col("l.item")).alias("item_id"), "l.cosine", "l.lcs", "l.answer", "l.first_word")

    found = _each_block(docs, benchmark, rows, "leaks")
    if found is None:
        found = docs.join(benchmark.select("item_id"), F.lit(False)).select(
            "doc_id", "item_id", F.lit(0.0).alias("cosine"), F.lit(0.0).alias("lcs"), F.lit(False).alias("answer"), F.lit(0).cast("long").alias("first_word"))
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that leak no item, all their columns as they are; null and empty texts stay."""
    digest = F.unhex(F.sha2(text_or_empty().cast("binary"), 256)).alias("digest")

    def leaking(retriever: Retriever | Phrases) -> DataFrame:
        return docs.where(F.size(_leaks(F.col("text"), retriever)) > 0).select(digest).distinct()

    found = _each_block(docs, benchmark, leaking, "leaking")
    if found is None:
        return docs
    found, seen = written_counting(found.distinct(), "leaking-texts", n=F.count(F.lit(1)))
    told = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), digest)
    return told.join(small_or_shuffled(found, seen["n"]), "digest", "left_anti").select("row.*")

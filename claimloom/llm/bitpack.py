"""Token ids in fixed-width bit packing.

The file format: a Parquet folder of blocks. A block holds up to
``BLOCK_IDS`` consecutive ids of one shard, each in the fewest bits that the
vocabulary needs, the lowest bit first, in ``payload``; ``first_id`` says how
many ids of the shard lie before it, ``n_ids`` how many it holds, and ``docs``
which documents begin in it and where. A shard is a range of documents in
ascending id order; ``shards`` beside the blocks holds one row for each, with
its number of ids, so a reader knows how many ids lie before any block. A
block is unpacked on its own by array operations; a range of ids is read from
the blocks whose offsets meet it, which Parquet's statistics find.

Spark writes and commits the blocks, so a task of a lost executor runs again
without leaving anything behind.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm.common import bounded_batches, text_or_empty, written

BLOCK_IDS = 1 << 16
#: Distinct pieces of text that a worker remembers with their ids (about 200 bytes each), twice: the newest and those before.
REMEMBERED = 500_000
#: Characters of a text that are cut into pieces at a time.
STRETCH = 1 << 20

_BLOCK = "shard int, block long, first_id long, n_ids int, payload binary, docs array<struct<doc_id: long, at: int, n: long>>"
#: White space that a pre-tokenizer of byte-level BPE may join to the white space before a word.
_SPACE = " \t\n\r\x0b\x0c"
_PIECE = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
_SPACES = re.compile(r"[ \n][ \n]")
_OTHER_SPACE = re.compile(r"[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Letters, and marks that are neither letters, numbers nor white space, to every version of Unicode's tables.
_LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha())
_MARKS = re.escape("".join(c for c in map(chr, (*range(0x250), *range(0x2010, 0x205F))) if unicodedata.category(c)[0] in "PS"))
#: What else a word may hold; and how the pre-tokenizer cuts words without that, each after a null byte and its space or line break.
_UNCERTAIN = re.compile(f"[^\n{_LETTERS}0-9{_MARKS}]")
_UNIT = re.compile(rf"\0\n|(?:\0 )?[{_LETTERS}]+|(?:\0 )?[0-9]+|'(?:[stmd]|re|ve|ll)|(?:\0 )?[{_MARKS}]+")
_ODD_SPACE = re.compile(rf"[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000][{_SPACE}]")


def bits_for(vocabulary: int) -> int:
    """Bits of the largest id."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` in ``bits`` bits each, lowest bit first, filled up to whole bytes."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    each = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    return np.packbits(np.unpackbits(each, axis=1, bitorder="little")[:, :bits].ravel(), bitorder="little").tobytes()


def unpack(payload: bytes, bits: int, n: int, start: int = 0) -> np.ndarray:
    """``n`` ids from the ``start``-th on."""
    if bits in (8, 16, 32):
        return np.frombuffer(payload, f"<u{bits // 8}", n, start * bits // 8).astype("<u4")
    first, last = start * bits // 8, -(-(start + n) * bits // 8)
    flat = np.unpackbits(np.frombuffer(payload, np.uint8, last - first, first), bitorder="little")[start * bits - first * 8:][: n * bits]
    wide = np.zeros((n, 32), dtype=np.uint8)
    wide[:, :bits] = flat.reshape(n, bits)
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


class _Units:
    """Ids of words, many in one run of the model of byte-level BPE, which spells a byte as a character.

    Between words, and between the units into which the pre-tokenizer cuts a
    word, stands a byte that no UTF-8 text has and no merge of the model takes
    in, so nothing is merged over it.
    """

    def __init__(self, tokenizer, word: int, unit: int):
        from tokenizers import Tokenizer

        self.word, self.unit = (tokenizer.token_to_id(chr(byte)) for byte in (word, unit))
        spelled = {byte: byte for byte in (*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100))}
        spelled |= {byte: 0x100 + k for k, byte in enumerate(byte for byte in range(0x100) if byte not in spelled)}
        spelled |= {0: word, 1: unit}
        self.spelled = np.array([spelled[byte] for byte in range(0x100)], dtype="<u2")
        self.encode = Tokenizer(tokenizer.model).encode_batch_fast

    @classmethod
    def of(cls, tokenizer) -> _Units | None:
        """None if the model has no two such bytes, or treats the beginning or end of a word in its own way."""
        model = json.loads(tokenizer.to_str())["model"]
        if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
            return None
        merged = set("".join(map("".join, model["merges"])))
        free = [byte for byte in (0xC0, 0xC1, *range(0xF5, 0x100)) if chr(byte) in model["vocab"] and chr(byte) not in merged]
        return cls(tokenizer, *free[:2]) if len(free) > 1 else None

    def __call__(self, words: list[str]) -> Iterator[bytes]:
        """The ids of each word; none is empty or holds what is ``_UNCERTAIN``."""
        for at in range(0, len(words), 256):
            joined = "".join([f"\0{w}" if w[0] == "\n" else f"\0 {w}" for w in words[at: at + 256]])
            cut = "\1".join(_UNIT.findall(joined)).replace("\1\0", "\0") + "\0"
            spelled = self.spelled[np.frombuffer(cut.encode(), np.uint8)].tobytes().decode("utf-16-le")
            ids = np.array(self.encode([spelled], add_special_tokens=False)[0].ids, dtype="<u4")
            ids = ids[ids != self.unit]
            ends, raw = (4 * np.flatnonzero(ids == self.word)).tolist(), ids.tobytes()
            for begin, end in zip(ends, ends[1:]):
                yield raw[begin + 4: end]


class _Words:
    """Ids of words that follow a space or begin a line, as bytes; worked out when first asked for."""

    def __init__(self, tokenizer):
        self.encode, self.units = tokenizer.encode_batch_fast, _Units.of(tokenizer)
        self.newest: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @staticmethod
    def _fill(words: list[str], found: list[bytes | None], work_out: Callable[[list[str]], Iterable[bytes]]) -> dict[str, bytes]:
        """Puts ids where ``found`` has None; returns the words it lacked with them."""
        unmet = [k for k, ids in enumerate(found) if ids is None]
        new = [words[k] for k in unmet]
        made = list(work_out(new)) if new else []
        for k, ids in zip(unmet, made, strict=True):
            found[k] = ids
        return dict(zip(new, made, strict=True))

    def _encoded(self, words: list[str]) -> Iterator[bytes]:
        encoded = self.encode([w if w.startswith("\n") else f" {w}" for w in words], add_special_tokens=False)
        return (array("I", e.ids).tobytes() for e in encoded)

    def _worked_out(self, words: list[str]) -> list[bytes]:
        found: list[bytes | None] = [None] * len(words)
        certain = [k for k, w in enumerate(words) if w and not _UNCERTAIN.search(w)] if self.units else []
        if certain:
            for k, ids in zip(certain, self.units([words[k] for k in certain]), strict=True):
                found[k] = ids
        self._fill(words, found, self._encoded)
        return found

    def _recalled(self, words: list[str]) -> list[bytes]:
        """Words that come again return from the older half."""
        found = list(map(self.older.get, words))
        self._fill(words, found, self._worked_out)
        return found

    def __call__(self, words: list[str]) -> list[bytes]:
        """For each of the distinct ``words``, its ids."""
        found = list(map(self.newest.get, words))
        new = self._fill(words, found, self._recalled)
        if len(self.newest) + len(new) > REMEMBERED:
            self.older, self.newest = self.newest, {}
        self.newest.update(new)
        return found


class Encoder:
    """Encodes texts with a file of the ``tokenizers`` library, ids equal to its own.

    The pre-tokenizer of byte-level BPE never joins what stands before white
    space with that white space, so a text's ids are those of its pieces of
    white space and word, and a piece that was met before needs no second run.
    Texts of single spaces and line breaks are cut at those, many texts at
    once; others by a pattern. A text that holds an added token, or other
    white space before ASCII white space, and any text for another kind of
    tokenizer, is encoded as a whole.
    """

    def __init__(self, path: str):
        # Threads of the library would only wait for one another beside other tasks.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        cuts = self.tokenizer.pre_tokenizer
        self.by_piece = self.tokenizer.normalizer is None and isinstance(cuts, pre_tokenizers.ByteLevel) and cuts.use_regex and not cuts.add_prefix_space
        self.words = _Words(self.tokenizer) if self.by_piece else None
        self.line = len(self._whole("\n"))
        self.known: dict[str, bytes] = {}

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def __call__(self, text: str) -> np.ndarray:
        return next(self.each([text]))

    def each(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text in turn; works on texts of ``STRETCH`` characters together, or one longer text."""
        held, size = [], 0
        for text in texts:
            if held and size + len(text) > STRETCH:
                yield from self._held(held)
                held, size = [], 0
            held.append(text)
            size += len(text)
        yield from self._held(held)

    def _held(self, texts: list[str]) -> Iterator[np.ndarray]:
        spaced = [self._single_spaced(t) for t in texts]
        together = self._together([t for t, s in zip(texts, spaced, strict=True) if s])
        for text, s in zip(texts, spaced, strict=True):
            yield next(together) if s else self._alone(text)

    def _single_spaced(self, text: str) -> bool:
        return (self.by_piece and len(text) <= STRETCH and not any(t in f"\n{text}" for t in self.added)
                and not _SPACES.search(text) and not _OTHER_SPACE.search(text))

    def _together(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Each text as if a line break stood before it, without the ids of that."""
        if not texts:
            return
        joined = "\n".join(texts).replace("\n", " \n")
        words = pc.split_pattern(pa.array([f"\n{joined}"], pa.large_string()), " ").values.dictionary_encode()
        found, at = self.words(words.dictionary.to_numpy(zero_copy_only=False).tolist()), words.indices.to_numpy()
        n = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first, n = (np.cumsum(n) - n)[at], n[at]
        ends = np.cumsum(n)
        ids = np.frombuffer(b"".join(found), "<u4")[np.arange(ends[-1]) + np.repeat(first - ends + n, n)]
        begin, k = 0, -1
        for text in texts:
            k += text.count(" ") + text.count("\n") + 1
            yield ids[begin + self.line: ends[k]]
            begin = ends[k]

    def _alone(self, text: str) -> np.ndarray:
        if not self.by_piece or any(t in text for t in self.added) or _ODD_SPACE.search(text):
            return self._whole(text)
        found = []
        for at in range(0, len(text), STRETCH):
            found += self._pieces(text, at)
        return np.frombuffer(b"".join(found), dtype="<u4")

    def _pieces(self, text: str, at: int) -> list[bytes]:
        known = self.known
        pieces = _PIECE.findall(text, self._cut(text, at), self._cut(text, at + STRETCH))
        if new := list(set(pieces).difference(known)):
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = list(set(pieces))
            for piece, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False), strict=True):
                known[piece] = array("I", e.ids).tobytes()
        return [known[p] for p in pieces]

    @staticmethod
    def _cut(text: str, at: int) -> int:
        """The first place from ``at`` on where white space follows a word: what stands before it is whole pieces."""
        if at <= 0 or at >= len(text):
            return max(0, min(at, len(text)))
        m = re.compile(f"(?<=[^{_SPACE}])[{_SPACE}]").search(text, at)
        return m.start() if m else len(text)


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One for each worker, so what it remembers outlives a task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _blocks(frames: Iterable[pd.DataFrame], path: str, bits: int, end_id: int, block_ids: int) -> Iterator[pd.DataFrame]:
    """The blocks of one shard; holds one block and the texts of one stretch at a time."""
    from pyspark import TaskContext

    shard, encode = TaskContext.get().partitionId(), _encoder(path)
    held, n_held, first, block, docs = [], 0, 0, 0, []

    def emit(n: int) -> pd.DataFrame:
        nonlocal held, n_held, first, block, docs
        ids = np.concatenate(held) if held else np.zeros(0, "<u4")
        out = pd.DataFrame([(shard, block, first, n, pack(ids[:n], bits), docs)], columns=["shard", "block", "first_id", "n_ids", "payload", "docs"])
        held, n_held, first, block, docs = [ids[n:]], n_held - n, first + n, block + 1, []
        return out

    for frame in frames:
        for doc_id, ids in zip(frame["doc_id"], encode.each(frame["text"]), strict=True):
            ids = np.append(ids, np.uint32(end_id)).astype("<u4")
            docs.append({"doc_id": None if doc_id is None else int(doc_id), "at": n_held, "n": len(ids)})
            held.append(ids)
            n_held += len(ids)
            while n_held >= block_ids:
                yield emit(block_ids)
    if n_held:
        yield emit(n_held)


def write_packed(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, block_ids: int = BLOCK_IDS) -> None:
    """Encode ``docs(doc_id, text)`` into packed blocks below ``path``, in ascending id order.

    A null text is an empty one: its ids are the end id alone. A null id comes
    first; rows that repeat an id follow one another in the order of the input.
    Other columns are ignored. An empty table gives files without blocks.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    bounded_batches(spark)
    bits = bits_for(max(Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True), end_id + 1))
    ordered = (docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"), F.monotonically_increasing_id().alias("row"))
               .repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row")
               .select(F.col("doc_id").cast("string"), "text"))  # pandas would make fractions of ids beside a null
    blocks = ordered.mapInPandas(lambda frames: _blocks(frames, tokenizer, bits, end_id, block_ids), _BLOCK)
    blocks.withColumn("bits", F.lit(bits)).write.option("compression", "snappy").parquet(f"{path}/blocks")
    # One row for each shard, with the ids of the shards before it.
    shards = spark.read.parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    shards.withColumn("base", F.sum("n_ids").over(Window.orderBy("shard")) - F.col("n_ids")).coalesce(1).write.parquet(f"{path}/shards")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``start``, the ids of all shards and blocks before them."""
    shards = spark.read.parquet(f"{path}/shards").select("shard", "base")
    blocks = spark.read.parquet(f"{path}/blocks")
    # As many shards as the writer had tasks.
    return blocks.join(F.broadcast(shards), "shard").withColumn("start", F.col("base") + F.col("first_id"))


def read_ids(spark: SparkSession, path: str, start: int, stop: int) -> np.ndarray:
    """The ids from ``start`` up to ``stop``, from the blocks that hold them."""
    met = read_blocks(spark, path).where((F.col("start") < stop) & (F.col("start") + F.col("n_ids") > start)).select("start", "n_ids", "bits", "payload")
    parts = [np.zeros(0, "<u4")]
    for row in sorted(met.collect(), key=lambda r: r["start"]):
        low, high = max(0, start - row["start"]), min(row["n_ids"], stop - row["start"])
        parts.append(unpack(row["payload"], row["bits"], high - low, low))
    return np.concatenate(parts)


def _gf2_times(matrix: list[int], vector: int) -> int:
    total, k = 0, 0
    while vector:
        if vector & 1:
            total ^= matrix[k]
        vector >>= 1
        k += 1
    return total


@cache
def _past_zeros(k: int) -> list[int]:
    """Moves a crc32 past ``2**k`` zero bytes; for -3, past one zero bit."""
    if k == -3:
        return [0xEDB88320] + [1 << bit for bit in range(31)]
    half = _past_zeros(k - 1)
    return [_gf2_times(half, v) for v in half]


def joined_crc32(a: int, b: int, bytes_of_b: int) -> int:
    """The crc32 of two stretches of bytes from theirs: ``a`` is moved past the zeros of ``b``, bit by bit of its length."""
    for k in range(bytes_of_b.bit_length()):
        if bytes_of_b >> k & 1:
            a = _gf2_times(_past_zeros(k), a)
    return a ^ b


def _stretches(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each block the stretches of documents in it, with their crc32; what lies before its first document goes on from an earlier block."""
    for frame in frames:
        out = []
        for r in frame.itertuples(index=False):
            raw = unpack(r.payload, r.bits, r.n_ids).tobytes()
            first = min([r.n_ids, *(d["at"] for d in r.docs)])
            if first:
                out.append((r.shard, r.block, None, None, None, first, zlib.crc32(raw[: 4 * first])))
            for d in r.docs:
                n = min(d["n"], r.n_ids - d["at"])
                out.append((r.shard, r.block, d["doc_id"], r.start + d["at"], d["n"], n, zlib.crc32(raw[4 * d["at"]: 4 * (d["at"] + n)])))
        names = ["shard", "block", "doc_id", "start", "n_tokens", "n", "crc"]
        yield pd.DataFrame({name: pd.array([row[k] for row in out], dtype="Int64") for k, name in enumerate(names)})


@F.pandas_udf(T.LongType())
def _joined(parts: pd.Series) -> pd.Series:
    def one(stretches) -> int:
        crc = 0
        for k, s in enumerate(stretches):
            crc = int(s["crc"]) if not k else joined_crc32(crc, int(s["crc"]), 4 * int(s["n"]))
        return crc

    return parts.map(one)


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Read the files back: ``doc_id, start, n_tokens, ids_crc32`` for every document.

    A document whose ids lie in one block is done there; the stretches of one
    that goes over several blocks are gathered by the block in which it begins.
    """
    bounded_batches(spark)
    blocks = read_blocks(spark, path)
    found = written(blocks.select("shard", "block", "start", "n_ids", "bits", "payload", "docs").mapInPandas(
        _stretches, "shard int, block long, doc_id long, start long, n_tokens long, n long, crc long"), "stretches")
    whole = found.where("n = n_tokens").select("doc_id", "start", "n_tokens", F.col("crc").alias("ids_crc32"))
    parts = found.where("n_tokens is null or n < n_tokens")
    # Of the blocks in which a document begins and is not ended, the last one up to this block is where it began.
    began = Window.partitionBy("shard").orderBy("block", F.col("start").isNotNull())
    head = F.last(F.when(F.col("start").isNotNull(), F.struct("doc_id", "start", "n_tokens")), ignorenulls=True).over(began)
    split = (parts.withColumn("head", head).groupBy("shard", F.col("head.start").alias("start"))
             .agg(F.first("head.doc_id").alias("doc_id"), F.first("head.n_tokens").alias("n_tokens"),
                  F.sort_array(F.collect_list(F.struct("block", "n", "crc"))).alias("parts"))
             .select("doc_id", "start", "n_tokens", _joined("parts").alias("ids_crc32")))
    return whole.unionByName(split)

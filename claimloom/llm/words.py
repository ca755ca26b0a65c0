"""Words and shingles of whole texts inside a task, in pieces of bounded size."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import xxhash

#: Bytes of a text that are split into words at a time.
PIECE = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def word_pieces(text: str | None, piece: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text, A-Z in lower case, as lists that follow one another; ``bytes.split`` cuts at the same six characters."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    start = 0
    while start < len(data):
        cut = _SPACE.search(data, start + piece) if len(data) - start > piece else None
        end = cut.start() if cut else len(data)
        if words := data[start:end].split():
            yield words
        start = end + 1


def shingle_hashes(text: str | None, k: int, seed: int = 42) -> Iterator[np.ndarray]:
    """XXH64 of the text's ``k``-word shingles, repeats included; of the whole sequence if it has fewer words."""
    carried: list[bytes] = []
    found = False
    for words in word_pieces(text):
        words = carried + words
        if len(words) >= k:
            found = True
            yield _hashed(words, k, seed)
            words = words[len(words) - k + 1:] if k > 1 else []
        carried = words
    if not found and carried:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(carried), seed)], dtype="<u8")


def _hashed(words: list[bytes], k: int, seed: int) -> np.ndarray:
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(lengths)
    starts = (ends - lengths)[: len(words) - k + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], seed) for a, b in zip(starts, (ends[k - 1:] - 1).tolist(), strict=True)], dtype="<u8")

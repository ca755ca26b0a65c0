"""Fill-in-middle documents by in-place block rotation.

A text is cut into units, a word with the white space before it, or trailing
white space. Two of the cuts between units split it into prefix, middle and
suffix. Sentinels are inserted at the cuts in a bytearray, which then holds
``<P>`` prefix ``<M>`` middle ``<S>`` suffix; neighbouring blocks change places
by a rotation made of three reversals, so the wanted order comes about inside
that one buffer. Restoring finds the sentinels again, rotates back and takes
them out: a text that holds one of them itself stays plain, so that is exact.

Everything runs on UTF-8 bytes in the scan: the white space that counts is
ASCII, so no unit begins inside a character. No row leaves its task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.llm.common import bounded_batches, text_or_empty

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Of 100 texts so many are transformed, and of 100 of those so many suffix first.
FIM_PERCENT, SPM_PERCENT = 50, 80
SEED = 42


def draws(doc_id: object, seed: int = SEED) -> list[int]:
    """Four 32-bit numbers of a document, from the SHA-256 of ``seed:doc_id``; a null id is written as nothing."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[k:k + 4], "big") for k in range(0, 16, 4)]


def unit_ends(text: bytes) -> np.ndarray:
    """Where the units of a text end, in bytes."""
    data = np.frombuffer(text, np.uint8)
    word = ~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D)))
    ends = np.flatnonzero(word[:-1] & ~word[1:]) + 1 if len(data) else np.zeros(0, np.int64)
    return np.append(ends, len(data)) if len(data) else ends


def code_points(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def _reverse(buffer: bytearray, start: int, end: int) -> None:
    part = buffer[start:end]
    part.reverse()
    buffer[start:end] = part


def exchange(buffer: bytearray, start: int, middle: int, end: int) -> None:
    """Let the blocks ``start..middle`` and ``middle..end`` change places: each is reversed, then both together."""
    _reverse(buffer, start, middle)
    _reverse(buffer, middle, end)
    _reverse(buffer, start, end)


def transform(text: bytes, doc_id: object, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT,
              seed: int = SEED) -> tuple[int, str, bytes, int | None, int | None]:
    """``(units, form, output, prefix characters, middle characters)`` of one text; the last two are None for a plain one."""
    ends = unit_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= fim_percent:
        return n, "plain", text, None, None
    first, second = (int(ends[k - 1]) if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    data = np.frombuffer(text, np.uint8)
    chars = code_points(data[:first]), code_points(data[first:second])
    buffer = bytearray(text)
    # The later cut first, so that the earlier one stays where it is.
    buffer[second:second] = SUFFIX
    buffer[first:first] = MIDDLE
    buffer[0:0] = PREFIX
    middle, suffix = len(PREFIX) + first, len(PREFIX) + len(MIDDLE) + second
    form = "spm" if h4 % 100 < spm_percent else "psm"
    exchange(buffer, 0 if form == "spm" else middle, suffix, len(buffer))
    return n, form, bytes(buffer), *chars


def restore(output: bytes, form: str) -> bytes:
    """The text that ``transform`` made ``output`` of."""
    if form == "plain":
        return output
    buffer = bytearray(output)
    if form == "spm":
        exchange(buffer, 0, buffer.index(PREFIX), len(buffer))
    elif form == "psm":
        exchange(buffer, buffer.index(SUFFIX), buffer.index(MIDDLE), len(buffer))
    else:
        raise ValueError(f"no such form: {form}")
    for sentinel in (SUFFIX, MIDDLE, PREFIX):
        at = buffer.index(sentinel)
        del buffer[at:at + len(sentinel)]
    return bytes(buffer)


def fill_in_middle(docs: DataFrame, text: str = "text", key: str = "doc_id", fim_percent: int = FIM_PERCENT,
                   spm_percent: int = SPM_PERCENT, seed: int = SEED) -> DataFrame:
    """``docs`` with ``n, form, output, prefix_chars, middle_chars``: each whole text, transformed or plain.

    The cuts and the form of a row follow from its key alone. A null text is an
    empty one, and empty texts are plain; so are texts that hold a sentinel. A
    null key is drawn for like any other. Repeated rows are transformed alike.
    Columns of ``docs`` with one of the added names are replaced, all others
    kept; an empty table stays empty with the columns added.
    """
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("n long, form string, output binary, prefix_chars long, middle_chars long")
    def made(texts: pd.Series, keys: pd.Series) -> pd.DataFrame:
        rows = [transform(t, k, fim_percent, spm_percent, seed) for t, k in zip(texts, keys, strict=True)]
        out = pd.DataFrame(rows, columns=["n", "form", "output", "prefix_chars", "middle_chars"])
        return out.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    added = ("n", "form", "output", "prefix_chars", "middle_chars")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in added]
    rows = docs.select(F.struct(*kept).alias("row"), made(text_or_empty(f"`{text}`").cast("binary"), F.col(f"`{key}`").cast("string")).alias("fim"))
    return rows.select("row.*", "fim.n", "fim.form", F.col("fim.output").cast("string").alias("output"), "fim.prefix_chars", "fim.middle_chars")


def restored(output: Column, form: Column) -> Column:
    """The original texts of columns that ``fill_in_middle`` made."""
    @F.pandas_udf(T.BinaryType())
    def back(outputs: pd.Series, forms: pd.Series) -> pd.Series:
        return pd.Series([restore(o, f) for o, f in zip(outputs, forms, strict=True)], dtype=object)

    return back(output.cast("binary"), form).cast("string")


def fim_digests(docs: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``doc_id, n, form, prefix_chars, middle_chars`` and the digests of output and restored text."""
    made = fill_in_middle(docs.select("doc_id", "text"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))

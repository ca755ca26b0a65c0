"""Free-text rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.functions import as_column

# The code points Unicode-aware whitespace covers. Java's \s is
# ASCII only and (?U)\s misses U+001C..U+001F, so they are spelled out.
WS_CHARS = "".join(map(chr, (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)))
WS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# The same class without the plain space. The range in front settles letters,
# digits and punctuation with one comparison, before the class is looked through.
_WS_NOT_SPACE = "[[^ -\\x{84}]&&" + WS.replace(r"\x1c-\x20", r"\x1c-\x1f") + "]"

# Tokens a default CSV read takes for missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

MIN_ARTICLE_CHARS = 200


def strip(c: Column | str) -> Column:
    """Remove leading and trailing Unicode whitespace."""
    return F.btrim(as_column(c), F.lit(WS_CHARS))


def clean_text(c: Column | str) -> Column:
    """One space per whitespace run, none at the ends, null when nothing is left.

    Two narrow passes, other whitespace to spaces and then runs of spaces to
    one, rewrite only what differs and cost a third of a single general one.
    """
    spaced = F.regexp_replace(as_column(c), _WS_NOT_SPACE, " ")
    return F.nullif(F.trim(F.regexp_replace(spaced, "  +", " ")), F.lit(""))


def has_text(c: Column | str) -> Column:
    """Whether ``clean_text`` leaves something; looks at the ends of the text only."""
    return strip(c) != ""


def na_to_null(c: Column | str) -> Column:
    c = as_column(c)
    return F.when(~c.isin(*NA_TOKENS), c)


def na_tokens_to_null(df: DataFrame) -> DataFrame:
    """Missing-value tokens become null in every string column."""
    return df.select([
        na_to_null(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def text_length(c: Column | str) -> Column:
    return F.char_length(F.coalesce(as_column(c), F.lit(""))).cast("long")


def min_length(c: Column | str, chars: int = MIN_ARTICLE_CHARS) -> Column:
    """Text shorter than ``chars`` is not usable article text."""
    c = as_column(c)
    return F.when(F.char_length(c) >= chars, c)

"""Cleaning, labelling and de-duplication of canonical rows.

Step order carries meaning: rows without a claim go first, then later copies of
a key, then rows without a label. A first copy with an ambiguous rating hence
removes a later, labelled copy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from claimloom.functions.dates import normalize_datetime
from claimloom.functions.ratings import label_from_rating
from claimloom.functions.text import clean_text, has_text
from claimloom.functions.urls import is_image_url, normalize_url
from claimloom.operators.adapters import DATASET, ORDER
from claimloom.operators.dedup import keep_first

_TEXTS = ("article_title", "article_text", "claimant", "publisher_name")
_DATES = ("claim_date", "published_at")


def clean_keys(df: DataFrame) -> DataFrame:
    """Clean what decides a row's fate: claim, address, label."""
    rules = {"claim_text": clean_text("claim_text")}
    if "article_url" in df.columns:
        rules["article_url"] = normalize_url("article_url")
    if "label" not in df.columns:
        rules["label"] = label_from_rating("textual_rating_raw")
    return df.withColumns(rules)


def clean_payload(df: DataFrame, pivot_year: int | None = None) -> DataFrame:
    """Clean the remaining columns; runs on surviving rows only."""
    rules = {c: clean_text(c) for c in _TEXTS if c in df.columns}
    rules |= {c: normalize_datetime(c, pivot_year) for c in _DATES if c in df.columns}
    if "image_url" in df.columns:
        rules["image_url"] = normalize_url("image_url")
    df = df.withColumns(rules)
    return df.withColumn("has_valid_image", is_image_url("image_url")) if "image_url" in df.columns else df


def drop_blank_claims(df: DataFrame) -> DataFrame:
    """The rows ``drop_missing_text`` drops, found before cleaning.

    A filter on the cleaned text would move below the cleaning and run it again.
    """
    return df.filter(has_text("claim_text"))


def drop_missing_text(df: DataFrame) -> DataFrame:
    """Rows with a claim, its text cleaned already or not: blank text is no claim."""
    return drop_blank_claims(df)


def dedup_key(df: DataFrame) -> Column:
    """Address, or claim text without one; both share one key space."""
    return F.coalesce("article_url", "claim_text") if "article_url" in df.columns else F.col("claim_text")


def _within(df: DataFrame) -> list[str]:
    # Each input is its own run: copies are only looked for inside it.
    return [DATASET] if DATASET in df.columns else []


def dedup_keep_first(df: DataFrame, order: Sequence[str] = (ORDER,), fan_in: int = 0) -> DataFrame:
    return keep_first(df, [*_within(df), dedup_key(df)], order, fan_in)


def drop_unlabeled(df: DataFrame) -> DataFrame:
    return df.filter(F.col("label").isNotNull())


class DropTally:
    """Rows read, dropped per reason and kept, counted inside a curation's own plan while it runs.

    Pass one to the plan, run one action on it, then ask for ``counts``: no
    second pass, and no changed input between rows and counts.
    """

    def __init__(self):
        self._raw, self._first = Observation(), Observation()

    def at_raw(self, df: DataFrame) -> DataFrame:
        return df.observe(self._raw, F.count(F.lit(1)).alias("n"), F.count_if(has_text("claim_text")).alias("with_claim"))

    def at_first_copies(self, df: DataFrame) -> DataFrame:
        return df.observe(self._first, F.count(F.lit(1)).alias("n"), F.count("label").alias("labeled"))

    def counts(self) -> dict[str, int]:
        """Waits for the first action on the plan."""
        raw, first = self._raw.get, self._first.get
        return {
            "rows_read": raw["n"],
            "rows_dropped_missing_text": raw["n"] - raw["with_claim"],
            "rows_dropped_duplicate": raw["with_claim"] - first["n"],
            "rows_dropped_label": first["n"] - first["labeled"],
            "rows_exported": first["labeled"],
        }


def survivors(df: DataFrame, order: Sequence[str] = (ORDER,), fan_in: int = 0, tally: DropTally | None = None) -> DataFrame:
    """Of non-blank rows with cleaned keys, those no further step drops.

    An unlabelled row can only keep later copies out, so it is shuffled without
    its texts.
    """
    fate = {DATASET, *order, "claim_text", "article_url", "label"}
    slim = {c: F.when(F.col("label").isNotNull(), F.col(c)) for c in df.columns if c not in fate}
    first = dedup_keep_first(df.withColumns(slim), order, fan_in)
    return drop_unlabeled(tally.at_first_copies(first) if tally else first)


def clean_claims(df: DataFrame, order: Sequence[str] = (ORDER,), pivot_year: int | None = None) -> DataFrame:
    """All cleaning steps on one input."""
    return clean_payload(survivors(clean_keys(drop_blank_claims(df)), order), pivot_year)


def drop_counts(df: DataFrame, order: Sequence[str] = (ORDER,), cleaned: bool = False) -> DataFrame:
    """Rows read, dropped per reason and kept, per input, in one pass.

    ``df`` is adapted, or has its keys ``cleaned`` already. Counts per key are combined before the shuffle, so neither a hot key nor the
    article texts travel.
    """
    within = _within(df)
    keyed = df if cleaned else clean_keys(df)
    position = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    per_key = (
        keyed.withColumn("_key", F.when(F.col("claim_text").isNotNull(), dedup_key(keyed)))
        .groupBy(*within, "_key")
        .agg(
            F.count("*").alias("n"),
            F.min_by(F.col("label").isNotNull(), position).alias("first_labeled"),
        )
    )
    has_key = F.col("_key").isNotNull()

    def total(rows: Column) -> Column:
        return F.coalesce(F.sum(rows), F.lit(0)).cast("long")

    return per_key.groupBy(*within).agg(
        total(F.col("n")).alias("rows_read"),
        total(F.when(~has_key, F.col("n"))).alias("rows_dropped_missing_text"),
        total(F.when(has_key, F.col("n") - 1)).alias("rows_dropped_duplicate"),
        total(F.when(has_key & ~F.col("first_labeled"), F.lit(1))).alias("rows_dropped_label"),
        total(F.when(has_key & F.col("first_labeled"), F.lit(1))).alias("rows_exported"),
    )

"""Verdict wording to a binary label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimloom.functions import as_column
from claimloom.functions.text import strip

# Wording per verdict class. Classes are tried in this order, since
# "unverified" holds "verified" and "inexact" holds "exact".
AMBIGUOUS = (
    "half true", "half false", "mixture", "mixed", "unproven", "unverified",
    "opinion", "satire", "outdated", "missing context", "out of context",
    "needs context", "unclear", "research in progress", "altered context",
    "mi-vrai", "mi-faux", "à vérifier", "sans fondement suffisant",
)
FAKE = (
    "false", "fake", "pants on fire", "misleading", "incorrect", "not true",
    "no evidence", "no such report", "distort", "manipulated", "hoax", "scam",
    "alter", "miscaption",
    "faux", "trompeur", "mensonge", "inexact", "erroné", "erronee", "falso",
)
TRUE = ("true", "correct", "accurate", "vrai", "exact", "verified", "confirmed")


def label_from_rating(c: Column | str) -> Column:
    """fake, true, or null where the wording is ambiguous or says nothing known."""
    rating = F.lower(strip(c))
    return (
        F.when(rating.rlike("|".join(AMBIGUOUS)), F.lit(None).cast("string"))
        .when(rating.rlike("|".join(FAKE)), F.lit("fake"))
        .when(rating.rlike("|".join(TRUE)), F.lit("true"))
    )

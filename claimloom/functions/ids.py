"""Content-based row identity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimloom.functions import as_column

# Text separator and number of hex digits kept.
UNIT_SEPARATOR = "\x1f"
ID_DIGITS = 16


def record_id(source: Column | str, url: Column | str, *texts: Column | str) -> Column:
    """Leading SHA-1 digits of source and address, or of source and texts without an address.

    Nothing positional goes in, so reordering or re-running an input keeps every id.
    """
    return F.substring(_digest(source, url, *texts), 1, ID_DIGITS)


def _digest(source: Column | str, url: Column | str, *texts: Column | str) -> Column:
    url = F.nullif(as_column(url), F.lit(""))
    content = F.concat_ws(UNIT_SEPARATOR, *[F.coalesce(as_column(t), F.lit("")) for t in texts])
    basis = F.concat(as_column(source), F.lit(":"), F.coalesce(url, content))
    return F.sha1(F.encode(basis, "UTF-8"))


def id_rest(source: Column | str, url: Column | str, *texts: Column | str) -> Column:
    """The digits that ``record_id`` leaves out: rows of one id that differ in them have two different bases."""
    return F.substring(_digest(source, url, *texts), ID_DIGITS + 1, 40 - ID_DIGITS)

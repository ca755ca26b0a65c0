"""Tolerant date reading.

Each known shape is rewritten to an ISO timestamp string, which one ``try_cast``
reads. Spark's cast parses without raising, so a dirty column costs no
exception per row, as trying a list of formats would.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimloom.functions import as_column, let
from claimloom.functions.text import strip

# Fixed value: output form of every date.
ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss'Z'"
# The representable range of a nanosecond timestamp; outside is null.
EARLIEST, LATEST = "1677-09-21 00:12:43.145225", "2262-04-11 23:47:16.854775"

_MONTH = (
    r"(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|"
    r"sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)\.?"
)
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_WEEKDAY = r"(?i)\A(?:mon|tues?|wed(?:nes)?|thu(?:rs?)?|fri|sat(?:ur)?|sun)(?:day)?\.?,?\s+"
_CLOCK = r"(\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d{1,9})?)?)"
_ZONE = r"(z|utc|gmt|[+-]\d{2}:?\d{2}|[+-]\d{2}|[ecmp][sd]t)"
_TIME = rf"(?:,?[ T]+(?:at +)?{_CLOCK}\s*([ap]m)?\s*{_ZONE}?)?\z"
_DAY = r"(\d{1,2})(?:st|nd|rd|th)?"
_YEAR = r"(\d{4}|\d{2})"

_ISO = r"\A\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}:\d{2}(?:\.\d{1,9})?(?:Z|[+-]\d{2}:\d{2})?)?\z"

# Shape -> the same value as year|month|day|clock|am-pm|zone.
_SHAPES = (
    (rf"(?i)\A(\d{{4}})-(\d{{1,2}})(?:-(\d{{1,2}}))?{_TIME}", "$1|$2|$3|$4|$5|$6"),
    (rf"(?i)\A{_MONTH}[ -]+{_DAY},?[ -]+{_YEAR}{_TIME}", "$3|$1|$2|$4|$5|$6"),
    (rf"(?i)\A{_DAY}[ /-]+{_MONTH},?[ /-]+{_YEAR}{_TIME}", "$3|$2|$1|$4|$5|$6"),
    (rf"(?i)\A(\d{{4}})[ -]+{_MONTH}[ -]+{_DAY}{_TIME}", "$1|$2|$3|$4|$5|$6"),
    (rf"(?i)\A{_MONTH}\s+{_DAY}\s+{_CLOCK}\s+(?:{_ZONE}\s+)?(\d{{4}})\z", "$5|$1|$2|$3||$4"),
    (rf"(?i)\A{_MONTH},?[ -]+(\d{{4}})\z", "$2|$1||||"),
    (rf"(?i)\A(\d{{4}})[/.](\d{{1,2}})[/.](\d{{1,2}}){_TIME}", "$1|$2|$3|$4|$5|$6"),
    # Numeric day and month: month first, unless that number cannot be a month.
    (rf"(?i)\A(0?[1-9]|1[0-2])[/.-](\d{{1,2}})[/.-]{_YEAR}{_TIME}", "$3|$1|$2|$4|$5|$6"),
    (rf"(?i)\A(\d{{1,2}})[/.-](0?[1-9]|1[0-2])[/.-]{_YEAR}{_TIME}", "$3|$2|$1|$4|$5|$6"),
    (r"\A(\d{4})(\d{2})(\d{2})\z", "$1|$2|$3|||"),
    (rf"(?i)\A(\d{{4}})(\d{{2}})(\d{{2}})T?(\d{{2}})(\d{{2}})(\d{{2}}){_ZONE}?\z", "$1|$2|$3|$4:$5:$6||$7"),
    (rf"(?i)\A(\d{{4}})-(\d{{1,2}})-(\d{{1,2}})[T ]+(\d{{1,2}})\s*([ap]m)?\s*{_ZONE}?\z", "$1|$2|$3|$4:00|$5|$6"),
    (r"\A(\d{4})\z", "$1|||||"),
)


def _two(c: Column) -> Column:
    return F.lpad(c, 2, "0")


def _fields(text: Column) -> Column:
    """The value as year|month|day|clock|am-pm|zone; null in no known shape."""
    fields = F.lit(None).cast("string")
    for pattern, order in reversed(_SHAPES):
        fields = F.when(text.rlike(pattern), F.regexp_replace(text, pattern, order)).otherwise(fields)
    return fields


def _iso_text(part: Column, pivot: int) -> Column:
    """ISO timestamp text of split year|month|day|clock|am-pm|zone."""
    month_word = F.lower(F.substring(part[1], 1, 3))
    month = F.when(part[1].rlike(r"^\d+$"), _two(part[1])).when(
        part[1] != "", _two(((F.instr(F.lit(_MONTHS), month_word) + 2) / 3).cast("int").cast("string"))
    ).otherwise(F.lit("01"))
    day = F.when(part[2] == "", F.lit("01")).otherwise(_two(part[2]))

    short = part[0].try_cast("int") + F.lit(2000)
    century = F.when(short >= pivot + 50, short - 100).otherwise(short)
    year = F.when(F.char_length(part[0]) == 2, century.cast("string")).otherwise(part[0])

    clock = F.translate(F.when(part[3] == "", F.lit("00:00")).otherwise(part[3]), ",", ".")
    hour = F.substring_index(clock, ":", 1).cast("int")
    half = F.lower(part[4])
    hour = F.when(half == "pm", hour % 12 + 12).when(half == "am", hour % 12).otherwise(hour)
    rest = F.regexp_replace(clock, r"^\d+", "")
    seconds = F.when(rest.rlike(r"^:\d{2}$"), F.lit(":00")).otherwise(F.lit(""))
    zone = F.when(part[5].rlike(r"^[+-]\d{4}$"), F.concat(F.substring(part[5], 1, 3), F.lit(":"), F.substring(part[5], 4, 2)))
    zone = zone.when(part[5].rlike(r"^[+-]\d{2}$"), F.concat(part[5], F.lit(":00")))
    zone = zone.when(part[5].rlike(r"^[+-]"), part[5]).otherwise(F.lit("Z"))
    return F.concat(year, F.lit("-"), month, F.lit("-"), day, F.lit("T"), _two(hour.cast("string")), rest, seconds, zone)


def parse_datetime(c: Column | str, pivot_year: int | None = None) -> Column:
    """Timestamp of a date written in any known shape; no zone means UTC; else null.

    A two-digit year is read into the 50 years either side of ``pivot_year``
    (this year by default). Words for a moving date ("now", "today"), bare clock
    times and six bare digits name no date and are null.
    """
    pivot = pivot_year or datetime.now(timezone.utc).year
    earliest, latest = F.lit(EARLIEST).cast("timestamp"), F.lit(LATEST).cast("timestamp")

    def rewritten(text: Column) -> Column:
        fields = let(F.regexp_replace(text, _WEEKDAY, ""), _fields)
        return let(F.split(fields, r"\|"), lambda part: _iso_text(part, pivot))

    # Already ISO, by far the most frequent shape, needs no rewriting.
    iso = let(strip(c), lambda text: F.when(text.rlike(_ISO), text).otherwise(rewritten(text)))
    return let(
        iso.try_cast("timestamp"), lambda stamp: F.when(stamp.between(earliest, latest), stamp)
    )


def iso_utc(stamp: Column | str) -> Column:
    return F.date_format(as_column(stamp), ISO_UTC)


def normalize_datetime(c: Column | str, pivot_year: int | None = None) -> Column:
    """``parse_datetime`` as an ISO 8601 UTC string, which sorts like the date."""
    return iso_utc(parse_datetime(c, pivot_year))

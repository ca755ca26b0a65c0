"""Scalar rules: tables of cases, and Python's own parsers where they define the rule."""

import hashlib
import re
import warnings
from pathlib import PurePosixPath
from urllib.parse import urljoin, urlparse

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimloom.functions.dates import normalize_datetime
from claimloom.functions.ids import record_id
from claimloom.functions.numbers import exact_mean, round_half_even
from claimloom.functions.ratings import AMBIGUOUS, FAKE, TRUE, label_from_rating
from claimloom.functions.text import NA_TOKENS, WS_CHARS, clean_text, min_length, na_to_null, strip, text_length
from claimloom.functions.urls import (
    IMAGE_EXTENSIONS, image_file_name, last_url_in_text, normalize_url, prefix_url_scheme, resolve_url,
    validate_image_url,
)


def each(spark, values, rule):
    """Rule applied to every value, in order."""
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r["out"] for r in df.select("i", rule(F.col("v")).alias("out")).orderBy("i").collect()]


def test_whitespace_set_is_pythons():
    assert set(WS_CHARS) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


CLEAN = [
    None, "", "\u00a0", "a  b", "\t a\n\nb \x1f", "\u200b", "x\u2003y", "  ", "😀  😀", "a b", "\u3000a\u0085b\u2028",
    "a\x1cb", " \n \t",
]


def test_clean_text(spark):
    want = [None if v is None else (re.sub(r"\s+", " ", v).strip() or None) for v in CLEAN]
    assert each(spark, CLEAN, clean_text) == want


def test_strip(spark):
    assert each(spark, CLEAN, strip) == [None if v is None else v.strip() for v in CLEAN]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(WS_CHARS + "ab\u200bé"), st.characters(codec="utf-8", exclude_characters="\0"))), min_size=20, max_size=60))
def test_clean_text_agrees_and_is_idempotent(spark, values):
    once = each(spark, values, clean_text)
    assert once == [re.sub(r"\s+", " ", v).strip() or None for v in values]
    assert each(spark, values, lambda c: clean_text(clean_text(c))) == once


def test_na_tokens(spark, tmp_path):
    values = [*NA_TOKENS, "none", " NA", "x"]
    path = tmp_path / "na.csv"
    path.write_text("v,w\n" + "".join(f'"{v}",1\n' for v in values))
    want = [None if pd.isna(v) else v for v in pd.read_csv(path)["v"]]
    assert each(spark, values, na_to_null) == want


def test_lengths(spark):
    assert each(spark, [None, "", "é😀", "abc"], text_length) == [0, 0, 2, 3]
    assert [v is None for v in each(spark, ["a" * 199, "a" * 200, None], min_length)] == [True, False, True]


URLS = [
    None, "", "  ", "www.x.org/a", " https://x.org ", "http://", "http:///x", "file:///a.png", "mailto:x", "http://a b/c.png",
    "https://é_x.org/A.JPG?x=1", "a.b/a.png#f", "a.b/a.jpg;v=1", "foo://x/a.jpg;v=1", "a.b/x;p/a.gif", "http://a[b/c",
    "http://a]b/c", "http://[::1]/a.png", "\t\n", "http://\n/x", "a.b/c.jpg/", "x.jpg", "https://x.jpg", "a.b/c.jp\ng",
    "a.b/c;x.jpg", "a.b/c.jpg;x/d", "HTTP://a.b/C.PNG;y", "a.b/.svg", "a.b/c.jpg?d=e.gif#g", "//x/y.gif", "a.b/c.webp?x;y",
    "ftp://a/b.bmp;c;d", "foo://x/a;b/c.jpeg",
]


def reference_url(value):
    value = (value or "").strip()
    if not value:
        return None
    if not re.match(r"^[a-zA-Z][a-zA-Z0-9+.\-]*://", value):
        value = f"https://{value}"
    try:
        parts = urlparse(value)
    except ValueError:
        return None
    return value if parts.scheme and parts.netloc else None


def test_normalize_url(spark):
    assert each(spark, URLS, normalize_url) == [reference_url(u) for u in URLS]


def test_prefix_url_scheme(spark):
    assert each(spark, [None, " ", "a.b", "http://", "x+y.z://q"], prefix_url_scheme) == [
        None, None, "https://a.b", "http://", "x+y.z://q"
    ]


def test_validate_image_url(spark):
    endings = tuple(f".{e}" for e in IMAGE_EXTENSIONS)
    normal = [reference_url(u) for u in URLS]
    assert each(spark, URLS, validate_image_url) == [bool(u) and urlparse(u).path.lower().endswith(endings) for u in normal]


@pytest.mark.parametrize("text, want", [
    (None, None), ("no link", None), ("see http://a.b", "http://a.b"), ("http://a https://b/c?d=e#f\nend", "https://b/c?d=e#f"),
    ("ftp://x", None), ("https://x\u00a0y", "https://x"),
])
def test_last_url_in_text(spark, text, want):
    assert each(spark, [text], last_url_in_text) == [want]


def test_resolve_url(spark):
    base = "http://a.b/c/d/e.html?q=1#f"
    links = [
        "x.png", "../x.png", "../../x.png", "../../../x.png", "./x.png", "/x/../y.png", "//cdn.z/x.png", "https://q/r.png",
        "?z=1", "#g", "x/./y/../z.png?a=../b", "..", ".", "../", "a/..", "data:abc",
    ]
    assert each(spark, links, lambda c: resolve_url(F.lit(base), c)) == [urljoin(base, link) for link in links]
    bare = ["x.png", "/x.png", "?q", "../y"]
    assert each(spark, bare, lambda c: resolve_url(F.lit("http://a.b"), c)) == [urljoin("http://a.b", link) for link in bare]


def test_image_file_name(spark):
    images = ["http://a/b.png?x=1", "http://a/b", "http://a/.png", "http://a/b.", "http://a/b.tar.gz", "http://a.b/",
              "http://a/b.c/d", "x..png", "http://a/b.jpg/"]
    want = ["7" + (PurePosixPath(i.split("?")[0]).suffix or ".jpg") for i in images]
    assert each(spark, images, lambda c: image_file_name(F.lit("at://d/post/7"), c)) == want


@pytest.mark.parametrize("patterns, want", [(AMBIGUOUS, None), (FAKE, "fake"), (TRUE, "true")])
def test_each_rating_pattern(spark, patterns, want):
    assert set(each(spark, [f" It is {p.upper()}! " for p in patterns], label_from_rating)) == {want}


RATINGS = {
    "Half True": None, "Half-true": "true", "Barely True": "true", "Untrue": "true", "Mostly False": "fake",
    "Altered": "fake", "Altered context": None, "unverified": None, "incorrect": "fake", "Inexact": "fake",
    "Not true": "fake", "À VÉRIFIER": None, "Erroné": "fake", "N/A": None, "": None, "  ": None, "Three Pinocchios": None,
}


def test_rating_quirks(spark):
    assert each(spark, list(RATINGS), label_from_rating) == list(RATINGS.values())
    assert each(spark, [None], label_from_rating) == [None]


DATES = [
    "December 31, 2017 ", "19-Feb-18", "Sept 5, 2017", "Thu, 05 Sep 2024 10:11:12 +0200", "Thu, 05 Sep 2024 10:11:12 GMT",
    "2024-01-02T03:04:05Z", "2024-01-02T03:04:05.123456+05:30", "2024-01-02", "2024-01", "2024", "20240105", "13/04/2017",
    "04/13/2017", "4/5/17", "garbage", "31 Dec 2017", "Dec 31 2017", "December 2017", "2024-01-02 03:04",
    "2024-01-02 3:04:05 PM", "2024/1/2", "1600-01-01", "2300-01-01", "2024-13-01", "2024-02-30", "Feb 30, 2020",
    "Monday, March 3rd, 2014 5:06 pm", "12:30 am", "31.12.2017", "01.02.2017", "12-31-2017", "https://a.b/c",
    "2024-01-02T24:00:00", "2024-01-02T03:04:05 +0100", "2024-01-02T03:04:05-0130", "Mar. 5, 2014", "", "None", "0",
    "2017-12-31 23:59:60", "Sun, 1 Jan 2023 00:00:00 -0800", "2024-01-02 12:15 AM", "1677-09-21", "1677-09-22", "2262-04-11",
]


def test_normalize_datetime(spark):
    values = [d for d in DATES if d != "12:30 am"]
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        parsed = [pd.to_datetime(pd.Series([v]), errors="coerce", utc=True, format="mixed")[0] for v in values]
    want = [None if pd.isna(p) else p.strftime("%Y-%m-%dT%H:%M:%SZ") for p in parsed]
    assert each(spark, values, normalize_datetime) == want
    assert each(spark, ["12:30 am", None], normalize_datetime) == [None, None]


def test_two_digit_years_follow_the_pivot(spark):
    values = ["19-Feb-73", "19-Feb-74", "19-Feb-24"]
    assert [d[:4] for d in each(spark, values, lambda c: normalize_datetime(c, 2024))] == ["2073", "1974", "2024"]


def test_record_id(spark):
    df = spark.createDataFrame(
        [("s", "u", "t", "x"), ("s", None, "t", None), ("s", "", "é", "x"), ("s", None, None, None)],
        "s string, u string, t string, x string",
    )
    got = [r[0] for r in df.select(record_id("s", "u", "t", "x")).collect()]
    basis = ["s:u", "s:t\x1f", "s:é\x1fx", "s:\x1f"]
    assert got == [hashlib.sha1(b.encode()).hexdigest()[:16] for b in basis]


def test_rounding_and_means(spark):
    df = spark.createDataFrame([(0.125,), (62.125,), (1.005,), (None,)], "x double")
    assert [r[0] for r in df.select(round_half_even("x", 2)).collect()] == [0.12, 62.12, 1.0, None]
    assert df.filter("x is null").select(exact_mean("x")).first()[0] is None
    assert spark.createDataFrame([(0.1,), (0.2,), (0.3,)], "x double").select(exact_mean("x")).first()[0] == 0.6 / 3

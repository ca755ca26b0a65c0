"""Every query against its SQL twin, on whole tables of the smallest data set."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from claimloom.plans.fixtures import TABLES, view
from claimloom.plans.queries import QUERIES as OWN
from claimloom.session import shared_dir

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
# The operators for training data have tests of their own.
ORACLES = {name: sql for name, sql in contract.oracle_sql().items() if name in OWN}
QUERIES = {name: query for name, query in contract.queries().items() if name in OWN}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in values)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLES[name])
    expected_columns = [c[0] for c in expected.description]
    assert sorted(frame.columns) == sorted(expected_columns)
    want = rows(expected_columns, expected.fetchall())
    got = rows(frame.columns, [tuple(r) for r in frame.collect()])
    assert len(got) == len(want)
    different = [(g, w) for g, w in zip(got, want) if g != w]
    assert not different, different[0]
    assert got, "an empty result checks nothing"


def test_every_query_has_a_twin_or_is_known_not_to():
    assert set(QUERIES) == set(ORACLES)


def test_links_reach_every_page(spark):
    """No cap on the pages that claims point at, at any scale."""
    for sf_dir in (SF_DIR, "/root/testdata/sf0.01"):
        linked = view(spark, sf_dir, "claim_links").select("article_url").distinct()
        pages = view(spark, sf_dir, "pages").select("url").distinct()
        assert pages.join(linked, pages["url"] == linked["article_url"], "left_anti").count() == 0


def test_scratch_needs_its_setting(spark):
    class Unset:
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Unset)


def test_entry_is_the_flagship(spark):
    frame = contract.entry(spark)
    assert frame.count() > 0 and frame.columns[0] == "record_id" and len(frame.columns) == 18

"""Large files with line breaks inside fields, and feeds, read in blocks by many tasks: the same rows as from one task."""

import csv
import io
import random

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimloom.schema import RAW_ARTICLES
from claimloom.sources.readers import parse_post_feed, read_raw_csv
from claimloom.sources.records import _lines, csv_records

FIELD = st.lists(st.sampled_from(["a", "b c", '"', '""', "\n", "\r\n", ",", "é🙂", "\n\n", '",\n"', "x" * 90, "\t"]), max_size=6).map("".join)


@pytest.fixture
def blocks_of(spark):
    """Sets how many bytes of a file one task reads."""
    def set_size(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield set_size
    for key in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{key}")


def one_task(spark, path):
    """The rows as Spark's own reader of such files gives them, a file a task."""
    return [tuple(r) for r in spark.read.options(header=True, multiLine=True, quote='"', escape='"', mode="FAILFAST").csv(path).coalesce(1).collect()]


def written(path, rows, ending="\n", quoting=csv.QUOTE_ALL):
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=ending, quoting=quoting)
    writer.writerow(["title", "text", "more\nwords"])
    writer.writerows(rows)
    path.write_bytes(out.getvalue().encode())
    return str(path)


def in_order(frame):
    return [tuple(r)[:-1] for r in frame.orderBy("input_order").collect()]


@given(rows=st.lists(st.tuples(FIELD, FIELD, FIELD), max_size=12), size=st.integers(1, 400), ending=st.sampled_from(["\n", "\r\n"]),
       quoting=st.sampled_from([csv.QUOTE_ALL, csv.QUOTE_MINIMAL]))
@settings(max_examples=8, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
def test_blocks_of_any_size_give_the_records_of_one_task(spark, tmp_path_factory, blocks_of, rows, size, ending, quoting):
    path = written(tmp_path_factory.mktemp("csv") / "a.csv", rows, ending, quoting)
    blocks_of(size)
    lines = [r["line"] for r in csv_records(spark, path).orderBy("record").collect()]
    # Records again, by the reader of the standard library.
    again = [next(csv.reader(io.StringIO(line, newline=""))) for line in lines]
    assert again == [["title", "text", "more\nwords"], *map(list, rows)]


def test_a_file_with_line_breaks_is_read_by_many_tasks(spark, tmp_path, blocks_of):
    rng = random.Random(2)
    bits = ["word", 'said ""yes""', '"', "line\nbreak", "crlf\r\nbreak", ", ", "été 🙂 "]
    rows = [["".join(rng.choice(bits) for _ in range(rng.randrange(1, 30))) for _ in range(3)] for _ in range(1500)]
    rows[700][1] = "a very long field\n" * 3000
    path = written(tmp_path / "big.csv", rows)
    want = one_task(spark, path)
    blocks_of(8_000)
    got = read_raw_csv(spark, path, RAW_ARTICLES)
    assert in_order(got) == want
    size = (tmp_path / "big.csv").stat().st_size
    assert _lines(spark, path).rdd.getNumPartitions() >= size // 8_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "FileScan csv" not in plan


def test_whole_records_stay_in_the_task_of_their_block(spark, tmp_path, blocks_of):
    path = written(tmp_path / "flat.csv", [[f"title {k}", "text, " * 20, ""] for k in range(1000)])
    blocks_of(8_000)
    records = csv_records(spark, path)
    assert records.count() == 1001
    spread = {r["p"]: r["n"] for r in records.where("record > 1").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()}
    assert len(spread) >= (tmp_path / "flat.csv").stat().st_size // 8_000 and max(spread.values()) < 120


def test_several_files_blank_lines_and_a_byte_order_mark(spark, tmp_path, blocks_of):
    (tmp_path / "a.csv").write_bytes('﻿title,text\r\n"a\n1","x"\r\n\r\nb,"y ""q"""\r\n'.encode())
    (tmp_path / "b.csv").write_bytes(b'\ntitle,text\n\nc,\n"d","\n\n"\n\n')
    (tmp_path / "c.csv").write_bytes(b"title,text\n")
    for size in (3, 10, 1_000_000):
        blocks_of(size)
        assert in_order(read_raw_csv(spark, str(tmp_path), RAW_ARTICLES)) == [("a\n1", "x"), ("b", 'y "q"'), ("c", None), ("d", "\n\n")]


def test_a_stray_quote_is_refused_and_shifts_nothing(spark, tmp_path):
    (tmp_path / "a.csv").write_text('title,text\n5" disk,x\nb,y\nc,z\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_raw_csv(spark, str(tmp_path / "a.csv"), RAW_ARTICLES).collect()


def feed_file(path, items):
    body = "".join(
        f"<item a='1'>\n<link>https://a.b/{i}</link><description><![CDATA[{text}]]></description>"
        f"<pubDate>2024-01-02T03:04:05Z</pubDate><guid isPermaLink='false'>g{i}</guid></item>\n" for i, text in enumerate(items))
    path.write_text(f"<?xml version='1.0'?><rss><channel><title>items &amp; more</title><items/>{body}</channel></rss>", encoding="utf-8")
    return str(path)


def test_a_feed_is_read_by_many_tasks(spark, tmp_path, blocks_of):
    items = [f"post {i} été 🙂\nsee https://x.y/{i} <b>" * (1 + i % 3) for i in range(400)]
    path = feed_file(tmp_path / "feed.xml", items)
    whole = [tuple(r)[1:] for r in parse_post_feed(spark, path).orderBy("input_order").collect()]
    spark_own = spark.read.format("xml").option("rowTag", "item").schema("link string, description string, guid string").load(path).collect()
    assert [r["guid"] for r in spark_own] == [f"g{i}" for i in range(400)]
    assert [(r[0], r[3]) for r in whole] == [(r["link"], r["guid"]) for r in spark_own]
    assert [r[1] for r in whole] == [r["description"].strip() for r in spark_own]
    for size in (500, 4_000):
        blocks_of(size)
        frame = parse_post_feed(spark, path)
        assert [tuple(r)[1:] for r in frame.orderBy("input_order").collect()] == whole
        assert frame.select(F.spark_partition_id().alias("p")).distinct().count() > 10


def test_cut_feeds(spark, tmp_path):
    path = tmp_path / "feed.xml"
    path.write_text("<rss><channel><item><link>l1</link></item><item><link>l2</link><gui")
    # A malformed item is a row of nulls, as everywhere.
    assert [(r["post_url"], r["guid"]) for r in parse_post_feed(spark, str(path)).collect()] == [("l1", None), (None, None)]
    path.write_text("<rss><channel></channel></rss>")
    assert parse_post_feed(spark, str(path)).count() == 0
    path.write_text("<rss><channel><item><description><![CDATA[ends with </item> ]]></description></item></channel></rss>")
    with pytest.raises(Exception, match="CDATA"):
        parse_post_feed(spark, str(path)).collect()

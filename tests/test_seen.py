"""The store of seen keys: what a poll reads, repeated polls, merges."""

import random

from pyspark.sql import functions as F

from claimloom.operators.incremental import new_posts
from claimloom.streaming.posts import start_post_append
from claimloom.streaming.seen import SeenKeys

from test_load_and_streams import POST, poll, read_polls


def guids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "guid string")


def test_a_poll_reads_the_buckets_it_meets(spark, tmp_path):
    seen = SeenKeys(spark, f"{tmp_path}/seen", buckets=64)
    assert seen.among(guids(spark, ["a", None])).count() == 0
    for n in range(3):
        seen.remember(guids(spark, [f"{n}-{k}" for k in range(400)] + [None, f"{n}-0"]), n)
    every = seen._read(range(64))
    assert every.count() == 1200 and every.select("bucket").distinct().count() == 64
    asked = guids(spark, ["0-1", "2-7", "new", None])
    met = seen.among(asked)
    assert len(met.inputFiles()) <= 3 * len(every.inputFiles()) // 64 + 3
    assert {r["guid"] for r in asked.join(met, "guid", "left_semi").collect()} == {"0-1", "2-7"}
    # A poll that runs again sees neither its own first try nor later ones, and replaces it.
    assert asked.join(seen.among(asked, before=2), "guid", "left_semi").count() == 1
    seen.remember(guids(spark, [f"2-{k}" for k in range(400)]), 2)
    assert seen._read(range(64)).count() == 1200


def test_merges_keep_every_key_and_few_files(spark, tmp_path):
    seen = SeenKeys(spark, f"{tmp_path}/seen", buckets=2, fan=3)
    known = set()
    for n in range(20):
        keys = {f"{n}-{k}" for k in range(6)} | {"always"}
        seen.remember(guids(spark, keys), n)
        seen.tidy([0, 1], before=n + 1)
        known |= keys
    rows = [r["guid"] for r in seen._read([0, 1]).collect()]
    assert set(rows) == known
    assert all(len(polls) < 3 for polls in seen.files([0, 1]).values()) and max(level for _, level in seen.files([0, 1])) == 2
    # A merge leaves the polls from ``before`` on alone, so that they can run again.
    for n in range(20, 24):
        seen.remember(guids(spark, [f"{n}-{k}" for k in range(6)]), n)
    seen.tidy([0, 1], before=21)
    assert all({21, 22, 23} <= polls for (_, level), polls in seen.files([0, 1]).items() if level == 0)
    assert {r["guid"] for r in seen._read([0, 1]).where("poll < 21").collect()} == known | {f"20-{k}" for k in range(6)}


def test_polls_equal_the_batch_contract_at_random(spark, tmp_path):
    rng, folder, out = random.Random(4), str(tmp_path / "polls"), str(tmp_path / "out")
    stored = None
    for n in range(4):
        rows = [(f"t{n}-{k}", "2024-01-01", rng.choice([None, f"g{rng.randrange(40)}", f"g{rng.randrange(40)}"])) for k in range(15)]
        poll(spark, folder, n, rows)
        start_post_append(read_polls(spark, folder), out, str(tmp_path / "checkpoint"), buckets=4).awaitTermination()
        feed = spark.createDataFrame([(t, None, g) for t, _, g in rows], POST)
        fresh = new_posts(feed, stored, ["post_text"]) if stored is not None else feed
        stored = fresh if stored is None else stored.unionByName(fresh)
        stored = spark.createDataFrame([tuple(r) for r in stored.collect()], POST)
    got = sorted(r["post_text"] for r in spark.read.parquet(out).collect())
    assert got == sorted(r["post_text"] for r in stored.collect()) and 20 < len(got) < 60


def test_posts_stored_without_a_store_are_known(spark, tmp_path):
    folder, out = str(tmp_path / "polls"), str(tmp_path / "out")
    spark.createDataFrame([("a", None, "1"), ("b", None, None)], POST).write.parquet(f"{out}/poll=-5")
    poll(spark, folder, 0, [("a", "2024-01-01", "1"), ("c", "2024-01-02", "2")])
    start_post_append(read_polls(spark, folder), out, str(tmp_path / "checkpoint"), buckets=4).awaitTermination()
    assert sorted(r["post_text"] for r in spark.read.parquet(out).where(F.col("poll") >= 0).collect()) == ["c"]

"""Star tables over repeated loads, incremental feeds, and streams over several polls."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from claimloom.operators.incremental import append_new_posts, new_posts
from claimloom.operators.upsert import load_summary, sink_values, upsert_publisher_dim, upsert_source_dim
from claimloom.plans.curate import curate_claims, run_source
from claimloom.plans import load as load_plan
from claimloom.plans.load import compact, last_commit, load_star, read_star, stage_load, vacuum
from claimloom.plans.log import _write, commit, read_log
from claimloom.schema import CANONICAL, CLAIM_RECORD
from claimloom.session import folders
from claimloom.sources.readers import read_run_metrics
from claimloom.streaming.curate import start_curation
from claimloom.streaming.posts import start_post_append, start_post_dedup, stream_checkpoint

from test_curate import STAMP, claim, reviews

POST = "post_text string, pub_date timestamp, guid string"


def batch(spark, path, rows):
    claims = curate_claims({"google_factcheck": reviews(spark, rows)}, STAMP, keep_order=True)
    claims.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def star_rows(spark, root):
    return sorted(map(repr, read_star(spark, root)["claim_record"].collect()))


def test_load_is_idempotent_and_replaces_changed_rows(spark, tmp_path):
    root = str(tmp_path / "star")
    assert last_commit(spark, root) is None and read_star(spark, root)["claim_record"].count() == 0
    rows = [claim(f"c{i}", url=f"a.b/{i}", review_publisher_name=f"p{i % 2}", review_publisher_site=None if i < 2 else "s") for i in range(40)]
    first = batch(spark, f"{tmp_path}/b1", rows)
    summary = load_star(spark, root, first, loaded_at=STAMP)
    assert tuple(summary) == (1, 2, 40)
    stored = star_rows(spark, root)
    assert len(stored) == 40 and read_star(spark, root)["claim_record"].columns == CLAIM_RECORD.fieldNames()
    load_star(spark, root, first, loaded_at="2025-01-01T00:00:00Z")
    assert star_rows(spark, root) == stored
    tables = read_star(spark, root)
    assert [tuple(r) for r in tables["source"].collect()] == [("google_factcheck", STAMP)]
    assert {r["name"]: r["site"] for r in tables["publisher"].collect()} == {"p0": None, "p1": None}

    second = batch(spark, f"{tmp_path}/b2", [claim("changed", "True", "a.b/3"), claim("new", "False", "a.b/99")])
    assert tuple(load_star(spark, root, second, loaded_at=STAMP)) == (1, 0, 2)
    claims = read_star(spark, root)["claim_record"]
    assert claims.count() == 41
    assert {r["claim_text"]: r["label"] for r in claims.collect()}["changed"] == "true"
    commit = last_commit(spark, root)
    written = spark.read.parquet(f"{root}/claim_record/load={commit['load']}")
    assert commit["version"] == 3 and written.count() == 2, "a load writes its own rows, whatever the store holds"

    stored, dims = star_rows(spark, root), sorted(map(repr, read_star(spark, root)["publisher"].collect()))
    for _ in range(2):
        compact(spark, root, STAMP)
        assert star_rows(spark, root) == stored and sorted(map(repr, read_star(spark, root)["publisher"].collect())) == dims
    load_star(spark, root, batch(spark, f"{tmp_path}/b3", [claim("again", "False", "a.b/3")]), loaded_at=STAMP)
    texts = {r["claim_text"] for r in read_star(spark, root)["claim_record"].collect()}
    assert "again" in texts and "changed" not in texts and len(texts) == 41
    compact(spark, root, STAMP)
    assert {r["claim_text"] for r in read_star(spark, root)["claim_record"].collect()} == texts


def test_loads_at_the_same_time_all_arrive(spark, tmp_path):
    root = str(tmp_path / "star")
    batches = [batch(spark, f"{tmp_path}/b{k}", [claim(f"{k}-{i}", url=f"a.b/{k}/{i}", review_publisher_name="P") for i in range(30)]) for k in range(4)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda b: load_star(spark, root, b, loaded_at=STAMP), batches))
    tables = read_star(spark, root)
    assert tables["claim_record"].count() == tables["claim_record"].select("record_id").distinct().count() == 120
    assert tables["publisher"].count() == 1 and tables["source"].count() == 1


def test_levels_are_merged_and_rows_rewritten_once_per_level(spark, tmp_path):
    root, fan, loads = str(tmp_path / "star"), 3, 14
    expected = {}
    for n in range(loads):
        rows = [claim(f"{n}-{k}", "True" if n % 2 else "False", f"a.b/{(n * 3 + k) % 25}", review_publisher_name=f"p{n % 4}") for k in range(4)]
        load_star(spark, root, batch(spark, f"{tmp_path}/b{n}", rows), loaded_at=STAMP, fan=fan)
        expected.update({(n * 3 + k) % 25: f"{n}-{k}" for k in range(4)})
    assert sorted(r["claim_text"] for r in read_star(spark, root)["claim_record"].collect()) == sorted(expected.values())
    live = read_log(spark, root).live
    assert [r["level"] for r in live] == [2, 1, 0, 0], "fewer runs of a level than are merged"
    written = spark.read.parquet(f"{root}/claim_record").count()
    assert written <= loads * 4 * 3, "once by its load, once per level"
    publishers = [tuple(r) for r in read_star(spark, root)["publisher"].collect()]
    assert sorted(publishers) == [(f"p{k}", None) for k in range(4)]

    # What is replaced stays for readers that have it, until it is removed.
    held = read_star(spark, root)["claim_record"]
    stored = sorted(map(repr, held.collect()))
    assert vacuum(spark, root, older_than=3600) == []
    compact(spark, root, STAMP)
    assert sorted(map(repr, held.collect())) == stored == star_rows(spark, root)
    staged = stage_load(spark, root, batch(spark, f"{tmp_path}/dead", [claim("dead", url="a.b/1")]))  # dies before its commit
    removed = vacuum(spark, root, older_than=0)
    assert f"claim_record/load={staged.load}" in removed and len(removed) > loads
    assert star_rows(spark, root) == stored and set(folders(spark, f"{root}/claim_record")) == {f"load={read_log(spark, root).live[0]['load']}"}


def test_two_claims_under_one_id_are_refused_at_the_merge(spark, tmp_path):
    root = str(tmp_path / "star")
    same = F.lit("0" * 16)
    one = batch(spark, f"{tmp_path}/b1", [claim("a", url="a.b/1")]).withColumn("record_id", same)
    again = batch(spark, f"{tmp_path}/b2", [claim("a, told anew", url="a.b/1")]).withColumn("record_id", same)
    other = batch(spark, f"{tmp_path}/b3", [claim("c", url="a.b/2")]).withColumn("record_id", same)
    for rows in (one, again):
        load_star(spark, root, rows, loaded_at=STAMP, fan=2)
    assert [r["level"] for r in read_log(spark, root).live] == [1], "a claim that changed is no clash"
    load_star(spark, root, other, loaded_at=STAMP, fan=0)
    with pytest.raises(ValueError, match="a.b/[12].*a.b/[12]"):
        compact(spark, root, STAMP)
    assert len(read_log(spark, root).live) == 2


def test_the_log_is_read_from_few_files(spark, tmp_path):
    root, every = str(tmp_path / "star"), 5
    names = [f"run{n:03}" for n in range(32)]
    for n, name in enumerate(names):
        replaces = names[n - 3:n] if n % 8 == 7 else None
        commit(spark, root, name, STAMP, level=1 if replaces else 0, replaces=replaces, stream=None if replaces else "s", batch=None if replaces else n, every=every)
    state = read_log(spark, root)
    gone = {name for n in range(7, 32, 8) for name in names[n - 3:n]}
    assert [r["load"] for r in state.live] == [n for n in names if n not in gone]
    assert state.last["version"] == 32 and state.batches == {"s": 30}
    files = spark.read.option("recursiveFileLookup", True).text([f"{root}/_commits/epoch={e}" for e in (state.epoch - 1, state.epoch)]).inputFiles()
    assert state.epoch >= 4 and len(files) <= 2 * (every + 2)
    assert len(state.dead) <= len(names), "what no epoch names any more is forgotten"


def test_a_commit_into_a_closed_epoch_is_seen(spark, tmp_path):
    root = str(tmp_path / "star")
    for n in range(4):
        commit(spark, root, f"run{n}", STAMP, every=2)
    epoch = read_log(spark, root).epoch
    assert epoch == 1
    # Written when the next epoch was open already: readers and the next checkpoint see it.
    _write(spark, root, 0, "late", [("load", 2, 2, "late", STAMP, 0, [], None, None)])
    assert "late" in {r["load"] for r in read_log(spark, root).live}
    for n in range(4, 9):
        commit(spark, root, f"run{n}", STAMP, every=2)
    assert read_log(spark, root).epoch > epoch + 1 and {r["load"] for r in read_log(spark, root).live} == {"late", *(f"run{n}" for n in range(9))}


def test_a_batch_that_died_before_its_commit_is_one_delta(spark, tmp_path, monkeypatch):
    folder, root, checkpoint = str(tmp_path / "raw"), str(tmp_path / "star"), str(tmp_path / "checkpoint")
    reviews(spark, [claim("a", url="a.b/1"), claim("b", url="a.b/2")]).coalesce(1).write.parquet(folder)
    raw = spark.readStream.schema(spark.read.parquet(folder).schema).parquet(folder)
    real = load_plan.commit_load

    def dies(after):
        def commit_load(*args, **kwargs):
            if after:
                real(*args, **kwargs)
            raise RuntimeError("killed")

        monkeypatch.setattr(load_plan, "commit_load", commit_load)
        with pytest.raises(Exception, match="killed"):
            start_curation(raw, "google_factcheck", root, checkpoint, STAMP).awaitTermination()
        monkeypatch.setattr(load_plan, "commit_load", real)

    dies(after=False)
    assert read_log(spark, root).live == [] and len(folders(spark, f"{root}/claim_record")) == 1
    dies(after=True)  # committed, but the stream doesn't know
    assert len(read_log(spark, root).live) == 1
    start_curation(raw, "google_factcheck", root, checkpoint, STAMP).awaitTermination()
    assert len(read_log(spark, root).live) == 1 and len(folders(spark, f"{root}/claim_record")) == 2
    assert sorted(r["claim_text"] for r in read_star(spark, root)["claim_record"].collect()) == ["a", "b"]


def test_whole_chain_is_one_recorded_run(spark, tmp_path):
    rows = [claim("a", url="a.b/1", review_publisher_name="P"), claim("a", url="a.b/1"), claim("b", "Half True"), claim("c", "True")]
    root, out, history = f"{tmp_path}/star", f"{tmp_path}/out", f"{tmp_path}/runs"
    for _ in range(2):
        summary = run_source("google_factcheck", reviews(spark, rows), out, root, history, "raw.csv", STAMP)
    assert tuple(summary) == (1, 1, 2)
    assert read_star(spark, root)["claim_record"].count() == 2 and spark.read.parquet(out).columns == CANONICAL.fieldNames()
    runs = read_run_metrics(spark, history).collect()
    assert len(runs) == 2
    assert (runs[0]["rows_read"], runs[0]["rows_exported"], runs[0]["rows_loaded"], runs[0]["pct_valid"]) == (4, 2, 2, 50.0)
    assert set(runs[0]["step_durations"]) == {"clean", "export", "load"}


def test_a_refused_load_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "star")
    good = batch(spark, f"{tmp_path}/b1", [claim("a", url="a.b/1")])
    load_star(spark, root, good, loaded_at=STAMP)
    bad = good.withColumn("label", F.lit("other"))
    with pytest.raises(ValueError, match="label in domain"):
        load_star(spark, root, bad, loaded_at=STAMP)
    assert last_commit(spark, root)["version"] == 1 and read_star(spark, root)["claim_record"].first()["label"] == "fake"


def test_last_copy_in_a_batch_wins(spark, tmp_path):
    root = str(tmp_path / "star")
    one = batch(spark, f"{tmp_path}/b1", [claim("first", url="a.b/1")])
    twice = one.unionByName(one.withColumns({"claim_text": F.lit("last"), "input_order": F.lit(7).cast("long")}))
    load_star(spark, root, twice, loaded_at=STAMP)
    assert [r["claim_text"] for r in read_star(spark, root)["claim_record"].collect()] == ["last"]


def test_dimensions_keep_what_they_have(spark):
    rows = spark.createDataFrame(
        [("s1", "p", None, 0), ("s1", "p", "late", 1), ("s2", "q", "q.org", 2), (None, None, "x", 3), ("s2", "old", "new", 4)],
        "source string, publisher_name string, publisher_site string, input_order long",
    )
    dim = spark.createDataFrame([("s2", "before")], "name string, first_loaded_at string")
    assert {tuple(r) for r in upsert_source_dim(dim, rows, STAMP).collect()} == {("s1", STAMP), ("s2", "before")}
    publishers = spark.createDataFrame([("old", None)], "name string, site string")
    assert {tuple(r) for r in upsert_publisher_dim(publishers, rows).collect()} == {("old", None), ("p", None), ("q", "q.org")}
    assert tuple(load_summary(rows.withColumn("record_id", F.lit("x"))).first()) == (2, 3, 5)


def test_sink_values(spark):
    df = spark.createDataFrame([(True, float("nan"), "x")], "has_valid_image boolean, article_text_length double, label string")
    for field in CLAIM_RECORD.fields:
        if field.name not in df.columns:
            df = df.withColumn(field.name, F.lit(None).cast(field.dataType))
    df = df.withColumn("published_at", F.lit("2024-01-02 03:04:05").cast("timestamp"))
    row = sink_values(df).first()
    assert (row["has_valid_image"], row["article_text_length"], row["published_at"]) == (1, None, "2024-01-02T03:04:05+00:00")


def posts(spark, *rows):
    return spark.createDataFrame([(t, None, g) for t, g in rows], POST)


def test_new_posts(spark):
    stored = posts(spark, ("a", "1"), ("b", None))
    feed = posts(spark, ("a", "1"), ("c", "2"), ("c again", "2"), ("d", None), ("e", None), ("a2", "1"))
    got = sorted(r["post_text"] for r in new_posts(feed, stored, ["post_text"]).collect())
    assert got == ["c", "c again", "d", "e"]
    assert append_new_posts(stored, feed.withColumn("extra", F.lit(1))).count() == 6
    assert new_posts(feed.filter("1 = 0"), stored).count() == 0
    assert new_posts(feed, stored.filter("1 = 0")).count() == 6


def poll(spark, folder, n, rows):
    data = spark.createDataFrame(rows, "post_text string, pub_date string, guid string")
    data.select("post_text", F.col("pub_date").cast("timestamp").alias("pub_date"), "guid").coalesce(1).write.mode("append").parquet(folder)


def read_polls(spark, folder):
    return spark.readStream.schema(POST).parquet(folder)


POLLS = [
    [("a", "2024-01-01", "1"), ("b", "2024-01-02", "2"), ("n", "2024-01-02", None)],
    [("b", "2024-01-02", "2"), ("c", "2024-01-03", "3"), ("n", "2024-01-02", None)],
    [("c", "2024-01-03", "3"), ("b", "2024-01-02", "2"), ("d", "2024-01-04", "4"), ("d", "2024-01-04", "4")],
]


@pytest.mark.parametrize("forget_after", [None, "3650 days", "1 day"])
def test_stream_dedup_over_polls(spark, tmp_path, forget_after):
    folder, out, checkpoint = str(tmp_path / "polls"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for n, rows in enumerate(POLLS):
        poll(spark, folder, n, rows)
        start_post_dedup(read_polls(spark, folder), out, checkpoint, forget_after=forget_after).awaitTermination()
    got = sorted(r["post_text"] for r in spark.read.schema(POST).parquet(out).collect())
    assert got == ["a", "b", "c", "d", "n", "n"]


def test_old_posts_that_come_late_are_not_lost(spark, tmp_path):
    folder, out, checkpoint = str(tmp_path / "polls"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for n, rows in enumerate([[("new", "2024-06-01", "9")], [("old", "2020-01-01", "1"), ("new", "2024-06-01", "9")]]):
        poll(spark, folder, n, rows)
        start_post_dedup(read_polls(spark, folder), out, checkpoint).awaitTermination()
    assert sorted(r["post_text"] for r in spark.read.schema(POST).parquet(out).collect()) == ["new", "old"]


def test_stream_append_equals_the_batch_contract(spark, tmp_path):
    folder, out, checkpoint = str(tmp_path / "polls"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    expected = None
    for n, rows in enumerate(POLLS):
        poll(spark, folder, n, rows)
        start_post_append(read_polls(spark, folder), out, checkpoint).awaitTermination()
        feed = posts(spark, *[(t, g) for t, _, g in rows])
        expected = append_new_posts(expected, feed) if expected is not None else feed
    got = sorted(r["post_text"] for r in spark.read.parquet(out).collect())
    assert got == sorted(r["post_text"] for r in expected.collect()) == ["a", "b", "c", "d", "d", "n", "n"]


def test_stream_curation_upserts_each_batch(spark, tmp_path):
    folder, root = str(tmp_path / "raw"), str(tmp_path / "star")
    checkpoint = str(tmp_path / "checkpoint")
    for rows in ([claim("a", url="a.b/1"), claim("b", url="a.b/2")], [claim("a2", "True", "a.b/1"), claim("c", url="a.b/3")]):
        reviews(spark, rows).coalesce(1).write.mode("append").parquet(folder)
        schema = spark.read.parquet(folder).schema
        raw = spark.readStream.schema(schema).parquet(folder)
        start_curation(raw, "google_factcheck", root, checkpoint, STAMP).awaitTermination()
    claims = {r["claim_text"]: r["label"] for r in read_star(spark, root)["claim_record"].collect()}
    assert claims == {"a2": "true", "b": "fake", "c": "fake"}


def test_stream_checkpoints_live_in_the_shared_folder(spark):
    assert stream_checkpoint(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))

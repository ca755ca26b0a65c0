"""Adapters, cleaning order, identity, validation and sinks on small hand-written inputs."""

import json
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimloom.operators.adapters import ADAPTERS, adapt, adapt_labeled_articles, adapt_news_links, offending_labels
from claimloom.operators.cleaning import clean_claims, clean_keys, dedup_keep_first, drop_counts, drop_missing_text
from claimloom.operators.dedup import distinct_reviews, keep_first, keep_last
from claimloom.operators.enrich import enrich_claims
from claimloom.operators.quality import (
    canonical_roles, constraint_violations, require_load_columns, require_no_violations, schema_issues,
)
from claimloom.operators.sampling import sample_per_file
from claimloom.plans.curate import curate_claims, phase_snapshot, run_curation
from claimloom.schema import CANONICAL, RAW_ARTICLES, RAW_REVIEWS, REQUIRED, fields_with_role, project
from claimloom.sources.readers import (
    labeled_file_union, parse_post_feed, read_claim_payloads, read_raw_csv, read_raw_parquet, read_run_metrics,
)
from claimloom.sources.sinks import export_dataset, run_manifest

STAMP = "2024-06-01T00:00:00Z"
NAMES = RAW_REVIEWS.fieldNames()


def reviews(spark, rows):
    """Raw reviews from dicts; the position is the input order."""
    data = [tuple(r.get(n) for n in NAMES) + (i,) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, ", ".join(f"{n} string" for n in NAMES) + ", input_order long")


def claim(text, rating="False", url=None, **more):
    return {"claim_text": text, "textual_rating": rating, "review_url": url, **more}


def kept(df):
    return [r["input_order"] for r in df.orderBy("input_order").collect()]


def test_a_first_ambiguous_copy_removes_a_later_labelled_one(spark):
    df = adapt(reviews(spark, [claim("a", "Half True", "u.v/1"), claim("b", "False", "u.v/1"), claim("c", "True", "u.v/2")]), "google_factcheck")
    assert kept(clean_claims(df)) == [2]


def test_keys_without_address_and_shared_key_space(spark):
    rows = [claim("same"), claim(" same "), claim("x", url="https://a.b"), claim("https://a.b"), claim(" "), claim(None)]
    df = adapt(reviews(spark, rows), "google_factcheck")
    assert kept(clean_claims(df)) == [0, 2]
    counts = drop_counts(df).first().asDict()
    assert counts == {
        "rows_read": 6, "rows_dropped_missing_text": 2, "rows_dropped_duplicate": 2, "rows_dropped_label": 0, "rows_exported": 2,
    }


def test_counts_of_an_empty_input_are_zero(spark):
    df = adapt(reviews(spark, [claim("a")]).filter("input_order < 0"), "google_factcheck")
    assert set(drop_counts(df).first().asDict().values()) == {0}


rating = st.sampled_from(["False", "True", "Half True", "Unproven", None, "zzz"])
row = st.builds(claim, st.sampled_from(["a", "b", " a", "", None, "http://a.b"]), rating, st.sampled_from([None, "", "a.b", "http://a.b", "http://", "c.d"]))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=25))
def test_read_equals_exported_plus_drops_and_a_plain_loop(spark, rows):
    df = adapt(reviews(spark, rows), "google_factcheck")
    keyed = {r["input_order"]: r for r in clean_keys(df).collect()}
    seen, expect = set(), []
    for i in sorted(keyed):
        r = keyed[i]
        key = r["article_url"] or r["claim_text"]
        if r["claim_text"] is None or key in seen:
            continue
        seen.add(key)
        if r["label"]:
            expect.append(i)
    assert kept(clean_claims(df)) == expect
    c = drop_counts(df).first()
    assert c["rows_read"] == len(rows) and c["rows_exported"] == len(expect)
    assert c["rows_read"] == c["rows_exported"] + sum(c[n] for n in c.asDict() if n.startswith("rows_dropped"))


def test_curating_curated_rows_changes_nothing(spark):
    rows = [claim(f"  claim {i % 7}", url=None if i % 2 else f"a.b/{i % 9}", article_text=f" t\n{i}") for i in range(30)]
    once = clean_claims(adapt(reviews(spark, rows), "google_factcheck"))
    twice = clean_claims(once)
    assert sorted(map(repr, once.collect())) == sorted(map(repr, twice.select(*once.columns).collect()))


def test_ids_do_not_depend_on_row_order(spark):
    rows = [claim(f"c{i}", url=None if i % 2 else f"a.b/{i}", article_text=str(i)) for i in range(20)]
    ids = [
        {r["record_id"] for r in curate_claims({"google_factcheck": reviews(spark, data)}, STAMP).collect()}
        for data in (rows, rows[::-1])
    ]
    assert ids[0] == ids[1] and len(ids[0]) == 20


@pytest.mark.parametrize("fan_in", [0, 4])
def test_keep_first_and_last_with_a_hot_key(spark, fan_in):
    df = spark.range(1000).select(F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 9 == 0, None).otherwise("cold").alias("k"), "id")
    assert {r["k"]: r["id"] for r in keep_first(df, ["k"], ["id"], fan_in).collect()} == {"hot": 1, None: 0, "cold": 3}
    assert {r["k"]: r["id"] for r in keep_last(df, ["k"], ["id"], fan_in).collect()} == {"hot": 998, None: 999, "cold": 996}


def test_dedup_is_limited_before_the_shuffle(spark):
    df = clean_keys(adapt(reviews(spark, [claim("a")]), "google_factcheck"))
    plan = dedup_keep_first(df)._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_distinct_reviews_treats_nulls_as_one(spark):
    df = reviews(spark, [claim("a", url="u"), claim("b"), claim("c"), claim("d", url="u")])
    assert kept(distinct_reviews(df)) == [0, 1]


def test_adapters_name_missing_columns(spark):
    with pytest.raises(ValueError, match="claim_text"):
        adapt(spark.range(1), "google_factcheck")
    with pytest.raises(ValueError, match="available"):
        adapt(spark.range(1), "nope")
    with pytest.raises(ValueError, match="label must be"):
        adapt_news_links(spark.range(1), "maybe")
    with pytest.raises(ValueError, match="guid"):
        adapt(spark.range(1), "bluesky_afp")
    with pytest.raises(ValueError, match="news_url"):
        adapt(spark.range(1), "fakenewsnet_politifact_true")
    assert len(ADAPTERS) == 8


def test_optional_raw_columns_become_null(spark):
    posts = spark.createDataFrame([("text", "g")], "post_text string, guid string")
    row = project(adapt(posts, "bluesky_afp")).first()
    assert row["article_url"] is None and row["label"] is None and row["publisher_name"] == "AFP Factuel"


def test_a_null_label_column_is_not_mapped_again(spark):
    posts = spark.createDataFrame([("False", "g", 0)], "post_text string, guid string, input_order long")
    df = adapt(posts, "bluesky_afp").withColumn("textual_rating_raw", F.lit("False"))
    assert clean_claims(df).count() == 0


def test_unexpected_label_fails_the_job_that_reads_it(spark):
    df = spark.createDataFrame([("t", "x", "true"), ("t", "x", "maybe"), ("t", "x", None)], "title string, text string, label string")
    assert [tuple(r) for r in offending_labels(df).collect()] == [("maybe", 1)]
    with pytest.raises(Exception, match="unexpected label value maybe"):
        adapt_labeled_articles(df).collect()


def test_contract_metadata():
    assert REQUIRED == ("record_id", "source", "claim_text", "label", "ingested_at")
    assert fields_with_role("nlp_text") == ["claim_text", "article_title", "article_text"]
    assert len(CANONICAL) == 18 and CANONICAL.fieldNames()[7] == "article_text_length"


def test_project_keeps_order_and_metadata(spark):
    df = project(spark.createDataFrame([("x",)], "label string"))
    assert df.columns == CANONICAL.fieldNames() and df.schema["label"].metadata["role"] == "classification_target"
    assert canonical_roles(df)["record_id"] == "identifier"


def curated(spark):
    rows = [claim(f"c{i}", "True" if i % 4 == 0 else "False", f"a.b/{i}", review_publisher_name=f"p{i % 3}") for i in range(12)]
    return curate_claims({"google_factcheck": reviews(spark, rows)}, STAMP)


def test_schema_issues(spark):
    good = curated(spark)
    assert schema_issues(good).count() == 0
    assert schema_issues(good.drop("claimant")).count() == 0
    bad = good.drop("source").withColumns({
        "claim_text": F.when(F.col("claim_text") != "c1", F.col("claim_text")),
        "label": F.when(F.col("claim_text").isin("c2", "c3"), "zz").otherwise(F.col("label")),
    })
    got = {(r["issue"], r["column_name"], r["value"], r["n_rows"]) for r in schema_issues(bad).collect()}
    assert got == {("missing_column", "source", None, None), ("null_values", "claim_text", None, 1), ("unexpected_label", "label", "zz", 2)}


def test_load_checks(spark):
    claims = curated(spark)
    require_load_columns(claims)
    with pytest.raises(ValueError, match="label"):
        require_load_columns(claims.drop("label"))
    sources = spark.createDataFrame([("google_factcheck",)], "name string")
    publishers = spark.createDataFrame([("p0",), ("p1",), ("p2",)], "name string")
    assert constraint_violations(claims, sources, publishers).count() == 0
    broken = claims.withColumn("label", F.when(F.col("claim_text") == "c5", "other").otherwise(F.col("label")))
    found = constraint_violations(broken, sources, publishers.filter("name != 'p1'")).collect()
    names = {r["claim_text"]: r["violations"] for r in found}
    assert names["c5"] == ["label in domain"] and names["c4"] == ["publisher_name references dimension"] and len(names) == 5
    with pytest.raises(ValueError, match="load refused"):
        require_no_violations(broken, sources, publishers)
    assert constraint_violations(claims.withColumn("publisher_name", F.lit(None).cast("string")), sources, publishers).count() == 0


def test_export_writes_manifest_and_issues(spark, tmp_path):
    out = str(tmp_path / "claims")
    written = export_dataset(curated(spark), out, "google_factcheck", "raw.csv", generated_at=STAMP)
    assert written.count() == 12 and written.columns == CANONICAL.fieldNames()
    manifest = spark.read.json(f"{out}.manifest").first().asDict(recursive=True)
    assert manifest["row_count"] == 12 and manifest["label_distribution"] == {"fake": 9, "true": 3}
    assert manifest["schema_issues"] == [] and manifest["generated_at"] == STAMP
    again = export_dataset(curated(spark).limit(3), out, "google_factcheck", "raw.csv")
    assert again.count() == 3


def test_issues_do_not_stop_the_export(spark, tmp_path):
    bad = curated(spark).withColumn("label", F.when(F.col("claim_text") == "c0", "odd").when(F.col("claim_text") != "c1", F.col("label")))
    out = str(tmp_path / "bad")
    export_dataset(bad, out, "s", "in")
    manifest = spark.read.json(f"{out}.manifest").first()
    assert len(manifest["schema_issues"]) == 2 and manifest["label_distribution"]["odd"] == 1
    assert manifest["schema_issues"][1] == "Column 'label' has unexpected value: 'odd'"
    assert spark.read.json(f"{out}.issues").count() == 2


def test_csv_export_round_trips(spark, tmp_path):
    rows = [claim('say "no"\nline two, with comma', url="a.b/1", article_text="  x "), claim("plain", "True", "a.b/2")]
    claims = curate_claims({"google_factcheck": reviews(spark, rows)}, STAMP).withColumn("article_title", F.lit('q"\n,'))
    written = export_dataset(claims, str(tmp_path / "csv"), "s", "in", fmt="csv")
    assert sorted(map(repr, written.select("record_id", "claim_text", "label", "article_title").collect())) == sorted(
        map(repr, claims.select("record_id", "claim_text", "label", "article_title").collect()))


def test_run_manifest_of_a_frame_without_label(spark):
    row = run_manifest(curated(spark).drop("label"), "s", "i", "o", STAMP).first()
    assert row["label_distribution"] == {} and row["schema_issues"] == ["Missing required column: label"]


def test_raw_csv_strings_quotes_and_missing_tokens(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('title,text,subject,date\n"a ""q"", b","line\nbreak",NA,None\n1984,true,,"N/A"\n', encoding="utf-8")
    rows = read_raw_csv(spark, str(path), RAW_ARTICLES).orderBy("input_order").collect()
    assert [tuple(r)[:4] for r in rows] == [('a "q", b', "line\nbreak", None, None), ("1984", "true", None, None)]


def test_raw_parquet_keeps_file_and_row_order(spark, tmp_path):
    rows = [claim("a", "Half True", "u.v/1"), claim("b", "False", "u.v/1"), claim("N/A"), claim("c", "True", "u.v/2")]
    path = str(tmp_path / "raw")
    reviews(spark, rows).select(*NAMES).coalesce(1).write.parquet(path)
    raw = read_raw_parquet(spark, path, RAW_REVIEWS)
    assert [r["claim_text"] for r in raw.orderBy("input_order").collect()] == ["a", "b", None, "c"]
    assert [r["claim_text"] for r in curate_claims({"google_factcheck": raw}, STAMP).collect()] == ["c"]
    assert drop_counts(adapt(raw, "google_factcheck")).first()["rows_dropped_label"] == 1


def test_label_files_keep_order_and_text_labels(spark, tmp_path):
    for name in ("Fake", "True"):
        (tmp_path / f"{name}.csv").write_text("title,text,subject,date\n" + "".join(f"{name}{i},x,s,\n" for i in range(5)))
    files = [(str(tmp_path / "Fake.csv"), "fake"), (str(tmp_path / "True.csv"), "true")]
    df = labeled_file_union(spark, files)
    assert df.schema["label"].dataType.simpleString() == "string"
    assert [r["title"] for r in df.orderBy("input_order").collect()] == [f"{n}{i}" for n in ("Fake", "True") for i in range(5)]
    sampled = labeled_file_union(spark, files, max_rows_per_file=3)
    assert {r["label"]: r["count"] for r in sampled.groupBy("label").count().collect()} == {"fake": 3, "true": 3}
    assert kept_titles(sampled) == kept_titles(labeled_file_union(spark, files, max_rows_per_file=3))
    curated_rows = curate_claims({"isot": df}, STAMP)
    assert {r["label"] for r in curated_rows.collect()} == {"fake", "true"}


def kept_titles(df):
    return sorted(r["title"] for r in df.collect())


def test_sample_only_shrinks_larger_files(spark):
    df = spark.range(30).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") < 25, "a").otherwise("b").alias("file"))
    got = sample_per_file(df, ["a", "b"], 10, "id").groupBy("file").count().collect()
    assert {r["file"]: r["count"] for r in got} == {"a": 10, "b": 5}
    assert sample_per_file(df, ["a", "b"], None, "id").count() == 30


def test_claim_payloads(spark, tmp_path):
    def review(url, rating="False"):
        return {"publisher": {"name": "P", "site": "p.org"}, "url": url, "title": "T", "reviewDate": "2024-01-02T00:00:00Z", "textualRating": rating, "languageCode": "en"}

    pages = [
        {"claims": [{"text": "a", "claimReview": [review("u1"), review("u2")]}, {"text": "none"}, {"text": "b", "claimReview": [review("u1", "True")]}], "nextPageToken": "x"},
        {"claims": [{"text": "c", "claimant": "C", "claimReview": [{"url": "u3"}]}]},
        {},
    ]
    for i, page in enumerate(pages):
        (tmp_path / f"page{i}.json").write_text(json.dumps(page, indent=1))
    rows = read_claim_payloads(spark, str(tmp_path)).orderBy("review_url").collect()
    assert [(r["claim_text"], r["review_url"], r["textual_rating"]) for r in rows] == [("a", "u1", "False"), ("a", "u2", "False"), ("c", "u3", None)]
    assert rows[2]["review_publisher_name"] is None and rows[2]["claimant"] == "C"


def test_feed_with_and_without_guid_attributes(spark, tmp_path):
    (tmp_path / "feed.xml").write_text(
        "<?xml version='1.0'?><rss><channel><title>c</title>"
        "<item><link>l1</link><description> See https://a.b/1 and https://a.b/2\n </description>"
        "<pubDate>05 Sep 2024 10:11 +0200</pubDate><guid isPermaLink='false'>at://d/app.bsky.feed.post/3</guid></item>"
        "<item><link>l2</link><pubDate>soon</pubDate></item></channel></rss>", encoding="utf-8")
    rows = {r["post_url"]: r for r in parse_post_feed(spark, str(tmp_path / "feed.xml")).collect()}
    first, second = rows["l1"], rows["l2"]
    assert first["post_text"] == "See https://a.b/1 and https://a.b/2" and first["article_url"] == "https://a.b/2"
    assert first["guid"] == "at://d/app.bsky.feed.post/3" and str(first["pub_date"]) == "2024-09-05 08:11:00"
    assert second["post_text"] == "" and second["guid"] is None and second["pub_date"] is None and second["article_url"] is None


def test_run_is_recorded(spark, tmp_path):
    raw = reviews(spark, [claim("a"), claim("a"), claim(None), claim("b", "Half True"), claim("c", "True")])
    history = str(tmp_path / "runs")
    assert read_run_metrics(spark, history).count() == 0
    for _ in range(2):
        written, phases = run_curation("google_factcheck", raw, str(tmp_path / "out"), history, "raw.csv", STAMP)
    assert written.count() == 2 and phases.first()["counts"]["rows_exported"] == 2
    runs = read_run_metrics(spark, history)
    assert runs.count() == 2 and runs.schema["run_timestamp"].dataType.simpleString() == "timestamp"
    record = runs.first()
    assert (record["rows_read"], record["rows_exported"], record["pct_valid"]) == (5, 2, 40.0)
    assert set(record["step_durations"]) == {"export", "clean"} and record["peak_memory_mb"] is None
    assert os.path.isdir(f"{tmp_path}/out.manifest")


def test_enrich_without_optional_columns(spark):
    df = spark.createDataFrame([("s", "t")], "source string, claim_text string")
    row = enrich_claims(df, STAMP).first()
    assert row["article_text_length"] == 0 and row["ingested_at"] == STAMP and len(row["record_id"]) == 16


def test_raw_columns_go_by_name(spark, tmp_path):
    def csv(name, text):
        (tmp_path / name).write_text(text, encoding="utf-8")
        return str(tmp_path / name)

    moved = csv("moved.csv", 'label,subject,title,text,date\ntrue,s,"t\n1",x,d\n')
    other = csv("other.csv", "title,text,more\nt2,NA,y\n")
    rows = read_raw_csv(spark, moved, RAW_ARTICLES).drop("input_order")
    assert rows.columns == [*RAW_ARTICLES.fieldNames(), "label"] and tuple(rows.first()) == ("t\n1", "x", "s", "d", "true")
    both = read_raw_csv(spark, [moved, other], RAW_ARTICLES)
    assert {(r["title"], r["text"], r["label"], r["more"]) for r in both.collect()} == {("t\n1", "x", "true", None), ("t2", None, None, "y")}
    lacking = csv("lacking.csv", "claimant,claim_text\nBob,The sky is green\n")
    found = read_raw_csv(spark, lacking, RAW_REVIEWS)
    assert found.first()["claim_text"] == "The sky is green"
    with pytest.raises(ValueError, match="textual_rating"):
        adapt(found, "google_factcheck")
    whole = csv("whole.csv", "title,text\nt,x\nu,y\n")
    assert read_raw_csv(spark, whole, RAW_ARTICLES, multi_line=False).count() == 2


@pytest.mark.parametrize("text", ["title,text\nt,x,SURPLUS\n", "title,text\nt\n"])
def test_ragged_rows_are_refused(spark, tmp_path, text):
    (tmp_path / "ragged.csv").write_text(text)
    with pytest.raises(Exception, match="(?i)malformed"):
        read_raw_csv(spark, str(tmp_path / "ragged.csv"), RAW_ARTICLES).select("title").collect()


def test_files_with_different_headers_below_one_path_are_refused(spark, tmp_path):
    (tmp_path / "1.csv").write_text("title,text\na,b\n")
    (tmp_path / "2.csv").write_text("text,title\nb,a\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_csv(spark, str(tmp_path), RAW_ARTICLES).collect()


def test_raw_parquet_goes_by_name(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([("x", 5)], "text string, title long").write.parquet(path)
    raw = read_raw_parquet(spark, path, RAW_ARTICLES)
    assert raw.columns == ["title", "text", "input_order"] and raw.first()["title"] == "5"
    with pytest.raises(ValueError, match="label"):
        adapt(raw, "isot")


def test_a_bad_label_on_a_blank_row_is_refused(spark):
    raw = spark.createDataFrame([(" ", "b", "fakeish", 0)], "title string, text string, label string, input_order long")
    with pytest.raises(Exception, match="unexpected label value fakeish"):
        curate_claims({"isot": raw}, STAMP).collect()


def test_samples_draw_rows_without_title_in_proportion(spark, tmp_path):
    (tmp_path / "a.csv").write_text("title,text,subject,date\n" + "".join(f"t{i},x,s,d\n" for i in range(300)) + "NA,x,s,d\n" * 300)
    titles = [r["title"] for r in labeled_file_union(spark, [(str(tmp_path / "a.csv"), "fake")], max_rows_per_file=100).collect()]
    assert 30 <= sum(t is None for t in titles) <= 70
    df = spark.range(40).select(F.when(F.col("id") > 19, F.col("id").cast("string")).alias("id"), F.when(F.col("id") >= 0, "f").alias("file"))
    plan = sample_per_file(df, ["f"], 5, "id")
    assert plan.count() == 5 and "WindowGroupLimit" in plan._jdf.queryExecution().executedPlan().toString()


def test_a_feed_goes_through_the_chain(spark, tmp_path):
    (tmp_path / "feed.xml").write_text(
        "<rss><channel>" + "".join(f"<item><link>l{i}</link><description>post {i % 2}</description><guid>g{i}</guid></item>" for i in range(3)) + "</channel></rss>")
    feed = parse_post_feed(spark, str(tmp_path / "feed.xml"))
    assert curate_claims({"bluesky_afp": feed}, STAMP).count() == 0
    counts = drop_counts(adapt(feed, "bluesky_afp")).first()
    assert (counts["rows_read"], counts["rows_dropped_duplicate"], counts["rows_dropped_label"]) == (3, 1, 2)


def test_a_run_reads_its_input_once(spark, tmp_path):
    path = str(tmp_path / "raw")
    reviews(spark, [claim("a"), claim("a"), claim(" "), claim("b", "Half True")]).coalesce(1).write.parquet(path)
    reads = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        reads.add(1)
        return text

    raw = spark.read.parquet(path).withColumn("language_code", counted.asNondeterministic()("claim_text"))
    extract = phase_snapshot(spark, "google_factcheck", STAMP, 1, {"extract": 2.5}, {})
    history = str(tmp_path / "runs")
    _, phases = run_curation("google_factcheck", raw, str(tmp_path / "out"), history, "in", STAMP, extract=extract)
    assert reads.value == 4
    record = read_run_metrics(spark, history).first()
    assert (record["rows_read"], record["rows_dropped_missing_text"], record["rows_dropped_duplicate"], record["rows_dropped_label"], record["rows_exported"]) == (4, 1, 1, 1, 1)
    assert set(record["step_durations"]) == {"extract", "clean", "export"} and record["duration_seconds"] >= 2.5


def test_claims_are_cleaned_once_in_the_plan(spark):
    df = adapt(reviews(spark, [claim("a")]), "google_factcheck")
    plan = clean_keys(drop_missing_text(df))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(claim_text") <= 2 * plan.count("Project"), plan


def test_link_files_with_a_label_column_are_one_collection(spark):
    rows = [("u.v/1", "a", "fake", "fakenewsnet_x_fake", 0), ("u.v/1", "a", "true", "fakenewsnet_x_true", 1), ("u.v/1", "a", "true", "fakenewsnet_x_true", 2)]
    raw = spark.createDataFrame(rows, "news_url string, title string, label string, dataset string, input_order long")
    got = curate_claims({"fakenewsnet": raw}, STAMP, keep_order=True).collect()
    assert {(r["dataset"], r["label"], r["input_order"]) for r in got} == {("fakenewsnet_x_fake", "fake", 0), ("fakenewsnet_x_true", "true", 1)}

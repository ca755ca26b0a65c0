"""Page text and preview image on hand-written pages; joins with hot addresses."""

import re

import pytest
from pyspark.sql import functions as F

from claimloom.functions.html import article_text, preview_image, unescape
from claimloom.functions.html_tree import article_text_nested
from claimloom.operators.joins import skew_join
from claimloom.operators.pages import attach_page_text, dead_links, drop_dead_links, page_content, prune_source_dead_rows
from claimloom.sources.page_store import _name, add_pages, store_pages, stored_pages

LONG = "word " * 60


@pytest.mark.parametrize("page, want", [
    (None, None),
    ("no paragraph", ""),
    ("<p>a<p>b", "a\nb"),
    ("<article><p>a<p>c</p>d</article><p>e</p>", "a\nc"),
    ("<p>x</p><main><p>m&nbsp;</p></main>", "m"),
    ('<div role="main"><div><p>x</p></div><p>y</p></div><p>z</p>', "x\ny"),
    ("<section id=1 role=main><p>q</p></section><p>r</p>", "q"),
    ("<article><article><p>i</p></article><p>o</p></article><article><p>no</p></article>", "i\no"),
    ("<article></article><main><p>k</p></main>", ""),
    ("<p>a<script>x</p></script>b</p>", "a b"),
    ("<p>a<style>p{}</style> <noscript><p>n</p></noscript>b</p>", "a b"),
    ("<p>a<!-- </p> -->b</p>", "a b"),
    ("<p>n <b>o</b><i> p</i></p>", "n o p"),
    ("<p>1</p><p></p><p> </p><p>2</p>", "1\n2"),
    ("<pre>no</pre><P CLASS=x>yes</P><param name=p>", "yes"),
    ("<p>one\n\n\ntwo</p>", "one\ntwo"),
    ("<article><p>cut", "cut"),
])
def test_article_text(spark, page, want):
    df = spark.createDataFrame([(page,)], "h string")
    assert df.select(article_text("h")).first()[0] == want


@pytest.mark.parametrize("page, want", [
    (None, None),
    ("<p>a<p>b</p>c</p>d", "a b c\nb"),
    ("<article><p>a<b>x<p>b</p><p>c</p>z</article><p>out</p>", "a x b c z\nb\nc"),
    ("<div><p>a</div>no<p>b", "a\nb"),
    ("<p>a</b>x</p></p>y", "a x"),
    ("<p>a<br>b<img src=x>c</p>", "a b c"),
    ("<p>a<script>x</p></script>b<noscript><p>n</p></noscript></p>", "a b"),
    ("<p>q &amp;lt; caf&eacute; &#233;&#x20AC; &foo; r</p>", "q &lt; café é€ &foo r"),
    ("<p>a<!-- </p> -->b</p>", "a b"),
    ("<main><p>m</p></main><p>x</p><article></article>", ""),
    ("<noscript><article><p>n</p></article></noscript><main><p>m</p></main><p>x</p>", "m"),
    ('<div role="main"><div><p>x</p></div><p>y</p></div><p>z</p>', "x\ny"),
    ("<p/>a<p>b</p>", "b"),
    ("no paragraph", ""),
])
def test_nested_article_text(spark, page, want):
    df = spark.createDataFrame([(page,)], "h string")
    assert df.select(article_text_nested("h")).first()[0] == want


def test_both_readings_agree_where_all_paragraphs_are_closed(spark):
    pages = ["<article><p>a</p> <p>b <i>c</i></p></article><p>d</p>", "<p>a&nbsp;b</p><!-- x --><p> </p><p>c</p>"]
    df = spark.createDataFrame([(p,) for p in pages], "h string")
    assert all(r[0] == r[1] for r in df.select(article_text("h"), article_text_nested("h")).collect())


@pytest.mark.parametrize("text, want", [
    ("plain", "plain"), ("a &amp;lt; b", "a &lt; b"), ("&lt;b&gt;", "<b>"), ("&#233;&#x20AC;&#146;&eacute;", "é€’é"),
    ("&foo;&copy 2 &#99999999;", "&foo© 2 �"), ("a & b && c&", "a & b && c&"), ("&hellip;&rsquo;&NotEqualTilde;", "…’≂̸"),
    ("&#0;x&#xD800;", "\x00x�"), (None, None),
])
def test_unescape(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(unescape("t")).first()[0] == want


@pytest.mark.parametrize("head, want", [
    ('<meta property="og:image" content="/i.png?a=1&amp;b=2">', "https://s.t/i.png?a=1&b=2"),
    ("<meta content='x.jpg' name=twitter:image>", "https://s.t/d/x.jpg"),
    ('<meta property="og:image" content=""><meta name="og:image" content="n"><meta name="twitter:image:src" content="t">',
     "https://s.t/d/t"),
    ('<meta name="og:image" content="n.png"><meta property="og:image" content="p.png">', "https://s.t/d/p.png"),
    ('<meta name="twitter:image" content="t.png"><meta name="og:image" content="o.png">', "https://s.t/d/o.png"),
    ('<!-- <meta property="og:image" content="p.png"> -->', None),
    ('<meta property="og:image">', None),
    ('<meta data-property="og:image" content="no">', None),
    ('<meta property="og:image" content="a>b.png" />', "https://s.t/d/a>b.png"),
    ("<noscript><meta property=og:image content=//c.d/i.gif></noscript>", "https://c.d/i.gif"),
    ("<meta property='og:image' content='unclosed", None),
    (None, None),
])
def test_preview_image(spark, head, want):
    df = spark.createDataFrame([(head,)], "h string")
    assert df.select(preview_image("h", F.lit("https://s.t/d/e"))).first()[0] == want


def pages(spark):
    body = f'<meta property="og:image" content="/i.png"><p>{LONG}</p>'
    rows = [(i, f"u{s}", s, body) for i, s in enumerate([200, 403, 404, 410, 500])]
    rows += [(5, "uNone", None, body), (6, "u200", 200, "<p>later copy</p>"), (7, "short", 200, "<p>short</p>")]
    return spark.createDataFrame(rows, "input_order long, url string, http_status int, html string")


def test_content_only_of_answered_pages(spark):
    got = {r["input_order"]: r for r in page_content(pages(spark)).collect()}
    assert got[0]["article_text"] == LONG.strip() and got[0]["image_url"] == "/i.png"
    assert all(got[i]["article_text"] is None for i in (1, 2, 3, 4, 5, 7))
    assert got[1]["http_status"] == 403


def test_dead_links(spark):
    assert {r["url"] for r in dead_links(pages(spark)).collect()} == {"u404", "u410", "uNone"}
    assert drop_dead_links(pages(spark)).count() == 5


def test_prune_keeps_unchecked_rows(spark):
    source = spark.createDataFrame(
        [(f"{i}", f"u{i}", "t", "", "extra") for i in range(4)], "id string, news_url string, title string, tweet_ids string, x string"
    )
    checked = spark.createDataFrame([("0", 404), ("1", 403), ("2", None)], "id string, http_status int")
    left = prune_source_dead_rows(source, checked)
    assert sorted(r["id"] for r in left.collect()) == ["1", "3"]
    assert left.columns == ["id", "news_url", "title", "tweet_ids"]


def test_attach_gives_each_claim_its_page(spark):
    urls = ["u200"] * 60 + [None] * 30 + ["u404", "nowhere"] * 5
    claims = spark.createDataFrame(list(enumerate(urls)), "input_order long, article_url string")
    got = attach_page_text(claims, pages(spark))
    assert got.columns == ["input_order", "article_url", "http_status", "article_text", "image_url"]
    rows = {r["input_order"]: r for r in got.collect()}
    assert len(rows) == len(urls) == got.count()
    for i, url in enumerate(urls):
        assert rows[i]["article_url"] == url
        assert rows[i]["http_status"] == {"u200": 200, "u404": 404}.get(url)
        assert (rows[i]["article_text"] is not None) == (url == "u200")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_skew_join_equals_a_plain_join(spark, how):
    left = spark.range(400).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None)
                                   .otherwise(F.concat(F.lit("k"), F.col("id") % 11)).alias("k"))
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k3", 3), ("unused", 4)], "k string, v int")
    plain = left.join(right, "k", how).select(*sorted(left.join(right, "k", how).columns))
    spread = skew_join(left, right, "k", ["id"], how)
    spread = spread.select(*sorted(spread.columns))
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, spread.collect()))


@pytest.mark.parametrize("how", ["left", "inner", "left_anti"])
def test_a_hot_key_is_split_by_adaptive_execution(spark, how, tmp_path):
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in low}
    try:
        for k, v in low.items():
            spark.conf.set(k, v)
        rows = spark.range(0, 400_000, 1, 16).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
        rows.write.parquet(f"{tmp_path}/rows")
        left = spark.read.parquet(f"{tmp_path}/rows")
        right = left.select("k").distinct().withColumn("v", F.lit(1))
        counted = skew_join(left, right, "k", ["id"], how).agg(F.count("*").alias("n"), F.max("id"))
        assert counted.collect()[0]["n"] == (0 if how == "left_anti" else 400_000)
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_building_a_lookup_runs_no_job(spark):
    claims = spark.createDataFrame([(0, "u200")], "input_order long, article_url string")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "plans only")
    try:
        attach_page_text(claims, pages(spark))
        skew_join(claims, claims.select("article_url"), "article_url", ["input_order"])
        assert not tracker.getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_only_linked_pages_are_parsed(spark):
    claims = spark.createDataFrame([(0, "u200")], "input_order long, article_url string")
    plan = attach_page_text(claims, pages(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan


def moved_columns(frame):
    """The columns of every exchange of a plan."""
    plan = frame._jdf.queryExecution().explainString(frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return re.findall(r"\) (?:Broadcast)?Exchange\nInput \[\d+\]: \[([^\]]*)\]", plan)


def test_stored_pages_stay_where_they_are(spark, tmp_path):
    path = str(tmp_path / "pages")
    every = pages(spark)
    store_pages(every.filter("url LIKE '%1'"), path)
    add_pages(every.filter("NOT url LIKE '%1' OR url IS NULL"), path)
    assert sorted(map(repr, stored_pages(spark, path).collect())) == sorted(map(repr, every.collect()))
    spark.sql(f"DROP TABLE {_name(path)}")  # as for another session, which has to register them
    claims = spark.createDataFrame([(k, u) for k, u in enumerate([r["url"] for r in every.collect()] * 2 + [None, "gone"])], "input_order long, article_url string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = attach_page_text(claims, stored_pages(spark, path))
        assert any("html" in c for c in moved_columns(attach_page_text(claims, every)))
        assert moved_columns(stored) and not any("html" in c for c in moved_columns(stored))
        assert sorted(map(repr, stored.collect())) == sorted(map(repr, attach_page_text(claims, every).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

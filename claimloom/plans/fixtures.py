"""Claim-shaped views over the given tables.

The tables hold documents, pages and events, not claims. Each view derives raw
rows of one input shape from them, in SQL both Spark and the checking engine
read, so that both sides start from the same rows. Whole tables go in; the
arithmetic on ids only assigns spellings, addresses and ratings to rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from claimloom.functions.urls import PUBLISHER_SITES

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Run time and two-digit-year pivot every query uses.
AS_OF = "2024-06-01T00:00:00Z"
PIVOT_YEAR = 2024

_MONTH = "split_part('January,February,March,April,May,June,July,August,September,October,November,December', ',', CAST(1 + {id} % 12 AS INT))"
_DAY = "concat(1 + {id} % 28, '')"


def _date(id_: str, shift: int = 0) -> str:
    """A date written in a shape that depends on the row."""
    i = f"({id_} + {shift})"
    month, day = _MONTH.format(id=i), _DAY.format(id=i)
    mm, dd = f"lpad(concat(1 + {i} % 12, ''), 2, '0')", f"lpad({day}, 2, '0')"
    year = f"concat(2016 + {i} % 9, '')"
    return f"""CASE {i} % 10
      WHEN 0 THEN concat({year}, '-', {mm}, '-', {dd}, 'T', lpad(concat({i} % 24, ''), 2, '0'), ':15:30Z')
      WHEN 1 THEN concat({year}, '-', {mm}, '-', {dd})
      WHEN 2 THEN concat({month}, ' ', {day}, ', ', {year}, ' ')
      WHEN 3 THEN concat({day}, '-', substr({month}, 1, 3), '-', substr({year}, 3, 2))
      WHEN 4 THEN concat('Thu, ', {dd}, ' ', substr({month}, 1, 3), ' ', {year}, ' 10:11:12 +0200')
      WHEN 5 THEN concat('Sept ', {day}, ', ', {year})
      WHEN 6 THEN concat({dd}, '/', {mm}, '/', {year})
      WHEN 7 THEN concat({year}, {mm}, {dd})
      WHEN 8 THEN 'date unknown'
      ELSE NULL END"""


def _rating(id_: str) -> str:
    return f"""CASE {id_} % 10
      WHEN 0 THEN 'False' WHEN 1 THEN 'Mostly True' WHEN 2 THEN 'Half True' WHEN 3 THEN 'Pants on Fire'
      WHEN 4 THEN ' VRAI ' WHEN 5 THEN 'Faux' WHEN 6 THEN 'Unverified' WHEN 7 THEN 'inexact'
      WHEN 8 THEN 'N/A' ELSE NULL END"""


# The known publishers and four others.
_SITES = ",".join([*PUBLISHER_SITES, "example.org", "example.net", "blog.example.com", "news.example.com"])


def _reviews(rating_shift: int) -> str:
    return f"""
    SELECT doc_id AS input_order,
      CASE WHEN doc_id % 11 = 0 THEN concat(' ', chr(9))
           WHEN doc_id % 7 = 0 THEN concat(chr(160), first_line, '  ')
           ELSE first_line END AS claim_text,
      CASE doc_id % 6 WHEN 0 THEN 'None' WHEN 1 THEN '' ELSE concat('  Speaker ', doc_id % 13) END AS claimant,
      {_date('doc_id')} AS claim_date,
      source AS review_publisher_name,
      split_part('{_SITES}', ',', CAST(1 + doc_id % 20 AS INT)) AS review_publisher_site,
      CASE WHEN doc_id % 5 = 0 THEN NULL
           WHEN doc_id % 5 = 1 THEN concat(' www.', source, '.example.com/', doc_id)
           WHEN doc_id % 25 = 3 THEN 'http://'
           ELSE concat('https://factcheck.example.org/', CAST(floor(doc_id / 2) AS BIGINT)) END AS review_url,
      concat('Review:  ', first_line) AS review_title,
      {_date('doc_id', 3)} AS review_date,
      {_rating(f'(doc_id + {rating_shift})')} AS textual_rating,
      lang AS language_code,
      text AS article_text
    FROM (SELECT *, split_part(text, chr(10), 1) AS first_line FROM {{documents}})"""


VIEWS = {
    # Fact-check reviews, and the same reviews extracted again with other verdicts.
    "raw_reviews": _reviews(0),
    "raw_reviews_again": _reviews(3),
    "raw_articles": f"""
    SELECT d.doc_id AS input_order, split_part(d.text, chr(10), 1) AS title, d.text AS text, d.lang AS subject,
      {_date('d.doc_id', 2)} AS date,
      CASE l.quality WHEN 1 THEN 'true' ELSE 'fake' END AS label
    FROM {{documents}} d JOIN {{labels}} l ON l.doc_id = d.doc_id""",
    # Stored answers: dead, refused, failed and lost fetches among them.
    "fetched_pages": """
    SELECT page_id AS input_order, url,
      CASE page_id % 10 WHEN 0 THEN 404 WHEN 1 THEN 410 WHEN 2 THEN 403 WHEN 3 THEN 500 WHEN 4 THEN NULL
        ELSE 200 END AS http_status,
      replace(html, '<head>', concat('<head>', CASE page_id % 7
        WHEN 0 THEN '<meta property="og:image" content="/img/lead.png?w=1&amp;h=2">'
        WHEN 1 THEN '<meta name="twitter:image" content="img/lead.JPG">'
        WHEN 2 THEN '<meta property="og:image" content=""><meta name="twitter:image:src" content="//cdn.example.com/i.gif">'
        WHEN 3 THEN concat('<meta content="https://cdn.example.com/', page_id, '.webp" property="og:image">')
        ELSE '' END)) AS html
    FROM {pages}""",
    "raw_links": """
    SELECT page_id AS input_order, concat('link', page_id) AS id,
      CASE WHEN page_id % 4 = 0 THEN replace(replace(url, 'https://', ''), 'http://', '') ELSE url END AS news_url,
      regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
      concat(page_id * 7, chr(9), page_id * 11) AS tweet_ids,
      CASE page_id % 4 WHEN 0 THEN 'gossipcop_fake' WHEN 1 THEN 'gossipcop_true'
        WHEN 2 THEN 'politifact_fake' ELSE 'politifact_true' END AS file
    FROM {pages}""",
    "raw_posts": """
    SELECT event_id AS input_order,
      concat('https://social.example.com/post/', event_id) AS post_url,
      CASE event_id % 4
        WHEN 0 THEN concat('No link here, only #', event_type)
        WHEN 1 THEN concat('Read https://news.example.com/', event_type, '/', event_id % 100)
        WHEN 2 THEN concat('See http://a.example.com/x?u=', user_id, ' and https://news.example.com/', user_id, chr(10), 'now')
        ELSE concat('  Fact: https://www.example.org/f/', user_id, '#', event_id % 9, ' ') END AS post_text,
      CAST(ts AS STRING) AS pub_date,
      CASE WHEN event_id % 50 = 0 THEN NULL
        ELSE concat('at://did/app.bsky.feed.post/', event_id) END AS guid,
      CASE event_id % 4 WHEN 0 THEN NULL
        WHEN 1 THEN concat('https://news.example.com/', event_type, '/', event_id % 100)
        WHEN 2 THEN concat('https://news.example.com/', user_id)
        ELSE concat('https://www.example.org/f/', user_id, '#', event_id % 9) END AS article_url,
      CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN concat('https://cdn.example.com/', user_id, '.PNG?s=', event_id)
        WHEN 2 THEN 'img.example.com/photo' WHEN 3 THEN concat('https://cdn.example.com/a.jpg;v=', user_id)
        WHEN 4 THEN 'file:///local.png' ELSE 'https://cdn.example.com/a.b/c.webp#x' END AS image_url
    FROM {events}""",
    # What a first poll stored; the second poll shows the whole feed again.
    "stored_posts": """
    SELECT * FROM {raw_posts} WHERE pub_date < '2024-01-19'""",
    # Claims that point at pages, several at the same one; addresses without a page and none at all.
    "claim_links": """
    SELECT d.doc_id AS input_order, d.text AS claim_text,
      CASE WHEN d.doc_id % 9 = 0 THEN NULL
        WHEN p.url IS NULL THEN concat('https://gone.example.com/', d.doc_id) ELSE p.url END AS article_url
    FROM (SELECT doc_id, text, doc_id % (SELECT greatest(count(*), 1) FROM {pages}) AS page_no FROM {documents}) d
    LEFT JOIN {pages} p ON p.page_id = d.page_no""",
    # One run per event type and day, with three phases.
    "phases": """
    SELECT event_type AS source,
      concat(CAST(CAST(ts AS DATE) AS STRING), 'T06:00:00Z') AS run_timestamp,
      CAST(1 + event_id % 3 AS INT) AS phase_no,
      CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS elapsed_seconds,
      CAST(count(*) AS BIGINT) AS n,
      CAST(sum(CASE WHEN user_id % 7 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_text,
      CAST(sum(CASE WHEN user_id % 7 = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_copy,
      CAST(sum(CASE WHEN user_id % 7 = 2 THEN 1 ELSE 0 END) AS BIGINT) AS n_label,
      CAST(max(value) AS DOUBLE) AS memory
    FROM {events}
    GROUP BY event_type, CAST(ts AS DATE), event_id % 3""",
    "runs": """
    SELECT source, run_timestamp,
      round(sum(elapsed_seconds), 4) AS duration_seconds,
      CAST(sum(n) AS BIGINT) AS rows_read,
      CAST(sum(n - n_text - n_copy - n_label) AS BIGINT) AS rows_exported,
      CAST(sum(n - n_text - n_copy - n_label) AS BIGINT) AS rows_loaded,
      round(CAST(100 * sum(n - n_text - n_copy - n_label) AS DOUBLE) / CAST(sum(n) AS DOUBLE), 2) AS pct_valid,
      CAST(sum(n_text) AS BIGINT) AS rows_dropped_missing_text,
      CAST(sum(n_copy) AS BIGINT) AS rows_dropped_duplicate,
      CAST(sum(n_label) AS BIGINT) AS rows_dropped_label,
      CASE WHEN max(memory) < 60 THEN NULL ELSE 4 * max(memory) END AS peak_memory_mb,
      max(CASE WHEN phase_no = 1 THEN elapsed_seconds END) AS step_extract,
      max(CASE WHEN phase_no = 2 THEN elapsed_seconds END) AS step_clean,
      max(CASE WHEN phase_no = 3 THEN elapsed_seconds END) AS step_load
    FROM {phases} GROUP BY source, run_timestamp""",
}


# Only these names stand for tables; other braces belong to regular expressions.
_NAMED = re.compile(r"\{(" + "|".join([*TABLES, *VIEWS]) + r")\}")


def _references(sql: str) -> list[str]:
    return list(dict.fromkeys(_NAMED.findall(sql)))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table or one of the views above."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = VIEWS[name]
    return spark.sql(sql, **{ref: view(spark, sf_dir, ref) for ref in _references(sql)})


def with_views(sql: str) -> str:
    """A query over views and tables, named in braces, as one SQL text with its views in front."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for ref in _references(text):
            if ref in VIEWS and ref not in ordered:
                visit(VIEWS[ref])
                ordered.append(ref)

    visit(sql)
    ctes = [f"{name} AS ({_NAMED.sub(r'\1', VIEWS[name])})" for name in ordered]
    body = _NAMED.sub(r"\1", sql)
    if not ctes:
        return body
    joined = ",\n".join(ctes)
    return f"WITH {joined},\n{body.lstrip()[5:]}" if body.lstrip().upper().startswith("WITH ") else f"WITH {joined}\n{body}"

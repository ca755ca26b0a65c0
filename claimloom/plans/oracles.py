"""The same results in plain SQL, written for DuckDB, to check the queries against.

Only the derived input views are shared with the Spark side; every rule is
stated again here, in SQL.
"""

from __future__ import annotations

from claimloom.plans.fixtures import AS_OF, with_views

# Whitespace, missing-value tokens and verdict wordings.
WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://"
NA = (
    "'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
    "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'"
)
AMBIGUOUS = (
    "half true|half false|mixture|mixed|unproven|unverified|opinion|satire|outdated|missing context|out of context|"
    "needs context|unclear|research in progress|altered context|mi-vrai|mi-faux|à vérifier|sans fondement suffisant"
)
FAKE = (
    "false|fake|pants on fire|misleading|incorrect|not true|no evidence|no such report|distort|manipulated|hoax|scam|"
    "alter|miscaption|faux|trompeur|mensonge|inexact|erroné|erronee|falso"
)
TRUE = "true|correct|accurate|vrai|exact|verified|confirmed"


def strip(x):
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def clean(x):
    return f"nullif(trim(regexp_replace({x}, '{WS}+', ' ', 'g')), '')"


def na(x):
    return f"CASE WHEN {x} NOT IN ({NA}) THEN {x} END"


def prefixed(x):
    bare = f"nullif({strip(x)}, '')"
    return f"CASE WHEN regexp_matches({bare}, '{SCHEME}') THEN {bare} ELSE 'https://' || {bare} END"


def url(x):
    return f"CASE WHEN regexp_matches({prefixed(x)}, '{SCHEME}[^/?#]') THEN {prefixed(x)} END"


def is_image(x):
    path = f"regexp_replace(regexp_extract({url(x)}, '{SCHEME}[^/?#]*([^?#]*)', 1), ';[^/]*$', '')"
    return f"coalesce(regexp_matches(lower({path}), '\\.(jpg|jpeg|png|gif|webp|bmp|svg)$'), false)"


def label(x):
    return (
        f"CASE WHEN regexp_matches(lower({x}), '{AMBIGUOUS}') THEN NULL "
        f"WHEN regexp_matches(lower({x}), '{FAKE}') THEN 'fake' "
        f"WHEN regexp_matches(lower({x}), '{TRUE}') THEN 'true' END"
    )


def stamp(x):
    """Timestamp of a date in one of the shapes the views write."""
    text = f"replace(regexp_replace({strip(x)}, '^[A-Z][a-z]{{2}}, ', ''), 'Sept ', 'Sep ')"
    zoned = f"regexp_matches({text}, '[+-][0-9]{{4}}$')"
    minutes = f"(CAST(substr({text}, -5, 3) AS INT) * 60 + CAST(substr({text}, -2) AS INT))"
    return (
        f"CASE WHEN regexp_matches({text}, '^[0-9]{{4}}-') THEN try_cast({text} AS TIMESTAMP) "
        f"WHEN {zoned} THEN try_strptime(substr({text}, 1, length({text}) - 6), '%d %b %Y %H:%M:%S') - to_minutes({minutes}) "
        f"ELSE try_strptime({text}, ['%B %d, %Y', '%b %d, %Y', '%d-%b-%y', '%m/%d/%Y', '%d/%m/%Y', '%Y%m%d']) END"
    )


def iso(x):
    return f"strftime({x}, '%Y-%m-%dT%H:%M:%SZ')"


def record_id(source, link, text, body):
    return (
        f"substr(sha1({source} || ':' || coalesce(nullif({link}, ''), "
        f"coalesce({text}, '') || chr(31) || coalesce({body}, ''))), 1, 16)"
    )


def unescape(x):
    for name, char in (("quot", '"'), ("lt", "<"), ("gt", ">"), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        x = f"replace({x}, '&{name};', '{char}')"
    return x


def rounded(x, digits):
    """Nearest with ties to even, on the scaled value."""
    return f"round_even(({x}) * 1e{digits}, 0) / 1e{digits}"


def total(x):
    """Sum of a recorded figure (at most four decimals), the same in any row order."""
    return f"CAST(sum(CAST({x} AS DECIMAL(28, 4))) AS DOUBLE)"


def mean(x):
    return f"{total(x)} / count({x})"


KILL = (
    r"(?is)<script.*?</script\s*>|<style.*?</style\s*>|<noscript.*?</noscript\s*>|<!--.*?-->"
)


def article(html):
    visible = f"regexp_replace({html}, '{KILL}', '<>', 'g')"
    scope = rf"regexp_extract({visible}, '(?is)<article(?:\s[^>]*)?>(.*?)</article\s*>', 1)"
    part = rf"string_split_regex(regexp_replace(p, '(?is)</p\s*>.*', ''), '(?s)<[^>]*>')"
    line = f"array_to_string(list_filter(list_transform({part}, lambda s: {strip(unescape('s'))}), lambda s: s <> ''), ' ')"
    lines = rf"list_transform(string_split_regex({scope}, '(?i)<p(?:\s[^>]*)?>')[2:], lambda p: {line})"
    return strip(rf"regexp_replace(array_to_string({lines}, chr(10)), '\n{{2,}}', chr(10), 'g')")


def nested_article(html):
    """As ``article``, but a paragraph without end tag holds the rest of the article."""
    visible = f"regexp_replace({html}, '{KILL}', '<>', 'g')"
    scope = rf"regexp_extract({visible}, '(?is)<article(?:\s[^>]*)?>(.*?)</article\s*>', 1)"
    pieces = rf"string_split_regex({scope}, '(?i)<p(?:\s[^>]*)?>')[2:]"
    held = (
        r"CASE WHEN regexp_matches(pieces[i], '(?i)</p\s*>') THEN regexp_replace(pieces[i], '(?is)</p\s*>.*', '') "
        "ELSE array_to_string(pieces[i:], '<>') END"
    )
    parts = f"list_transform(string_split_regex({held}, '(?s)<[^>]*>'), lambda s: {strip(unescape('s'))})"
    line = f"array_to_string(list_filter({parts}, lambda s: s <> ''), ' ')"
    lines = f"list_transform(range(1, len(pieces) + 1), lambda i: {line})"
    return pieces, strip(rf"regexp_replace(array_to_string({lines}, chr(10)), '\n{{2,}}', chr(10), 'g')")


def image(html, base):
    def meta(pattern):
        return f"nullif(regexp_extract({html}, '{pattern}', 1), '')"

    link = unescape(
        "coalesce("
        + ", ".join([
            meta('<meta property="og:image" content="([^"]*)"'),
            meta('<meta content="([^"]*)" property="og:image"'),
            meta('<meta name="twitter:image" content="([^"]*)"'),
            meta('<meta name="twitter:image:src" content="([^"]*)"'),
        ])
        + ")"
    )
    root = f"regexp_extract({base}, '^([a-z]+://[^/?#]+)', 1)"
    folder = f"coalesce(nullif(regexp_extract({base}, '^[a-z]+://[^/?#]+(/[^?#]*/|/)', 1), ''), '/')"
    return (
        f"CASE WHEN {link} LIKE 'http%' THEN {link} "
        f"WHEN {link} LIKE '//%' THEN regexp_extract({base}, '^([a-z]+:)', 1) || {link} "
        f"WHEN {link} LIKE '/%' THEN {root} || {link} ELSE {root} || {folder} || {link} END"
    )


def gated(text):
    return f"CASE WHEN length({text}) >= 200 THEN {text} END"


REVIEW_COLUMNS = (
    "claim_text", "claimant", "claim_date", "review_publisher_name", "review_publisher_site", "review_url",
    "review_title", "review_date", "textual_rating", "language_code", "article_text",
)


def reviews(view="raw_reviews"):
    return f"SELECT input_order, {', '.join(f'{na(c)} AS {c}' for c in REVIEW_COLUMNS)} FROM {{{view}}}"


CANONICAL = (
    "source", "claim_text", "claimant", "claim_date", "article_title", "article_text", "article_url", "image_url",
    "publisher_name", "publisher_site", "published_at", "textual_rating_raw", "language_code",
)


def adapted_reviews(view="raw_reviews"):
    return (
        "SELECT input_order, 'google_factcheck' AS source, claim_text, claimant, claim_date, review_title AS article_title, "
        "article_text, review_url AS article_url, CAST(NULL AS VARCHAR) AS image_url, "
        "review_publisher_name AS publisher_name, review_publisher_site AS publisher_site, review_date AS published_at, "
        f"textual_rating AS textual_rating_raw, language_code FROM ({reviews(view)})"
    )


NULL = "CAST(NULL AS VARCHAR)"
ADAPTED_POSTS = (
    f"SELECT input_order, 'bluesky_afp' AS source, post_text AS claim_text, {NULL} AS claimant, pub_date AS claim_date, "
    f"{NULL} AS article_title, {NULL} AS article_text, article_url, image_url, 'AFP Factuel' AS publisher_name, "
    f"'factuel.afp.com' AS publisher_site, pub_date AS published_at, {NULL} AS textual_rating_raw, {NULL} AS label, "
    "'fr' AS language_code FROM {raw_posts}"
)


def adapted_links(label_sql):
    return (
        f"SELECT input_order, 'fakenewsnet' AS source, title AS claim_text, {NULL} AS claimant, {NULL} AS claim_date, "
        f"title AS article_title, {NULL} AS article_text, news_url AS article_url, {NULL} AS image_url, "
        f"{NULL} AS publisher_name, {NULL} AS publisher_site, {NULL} AS published_at, {label_sql} AS textual_rating_raw, "
        f"{label_sql} AS label, 'en' AS language_code"
    )


ADAPTED_ARTICLES = (
    f"SELECT input_order, 'isot' AS source, title AS claim_text, {NULL} AS claimant, date AS claim_date, "
    f"title AS article_title, text AS article_text, {NULL} AS article_url, {NULL} AS image_url, {NULL} AS publisher_name, "
    f"{NULL} AS publisher_site, date AS published_at, label AS textual_rating_raw, label, 'en' AS language_code "
    "FROM {raw_articles}"
)


def keyed(rows, has_label=False):
    """Adapted rows with claim, address and label cleaned."""
    cleaned = f"{clean('claim_text')} AS claim_text, {url('article_url')} AS article_url"
    if has_label:
        return f"SELECT * REPLACE ({cleaned}) FROM ({rows})"
    return f"SELECT * REPLACE ({cleaned}), {label('textual_rating_raw')} AS label FROM ({rows})"


def first_copies(rows, within=""):
    return (
        f"SELECT * FROM ({rows}) WHERE claim_text IS NOT NULL QUALIFY row_number() OVER "
        f"(PARTITION BY {within}coalesce(article_url, claim_text) ORDER BY input_order) = 1"
    )


def finished(rows):
    """Labelled first copies with all columns cleaned."""
    return (
        f"SELECT * REPLACE ({clean('article_title')} AS article_title, {clean('article_text')} AS article_text, "
        f"{clean('claimant')} AS claimant, {clean('publisher_name')} AS publisher_name, "
        f"{iso(stamp('claim_date'))} AS claim_date, {iso(stamp('published_at'))} AS published_at, "
        f"{url('image_url')} AS image_url), {is_image('image_url')} AS has_valid_image FROM ({rows}) WHERE label IS NOT NULL"
    )


def enriched(rows):
    ids = record_id("source", "article_url", "claim_text", "article_text")
    return (
        f"SELECT *, {ids} AS record_id, CAST(length(coalesce(article_text, '')) AS BIGINT) AS article_text_length, "
        f"'{AS_OF}' AS ingested_at FROM ({rows})"
    )


def curated_reviews(view="raw_reviews"):
    return enriched(finished(first_copies(keyed(adapted_reviews(view)))))


KEYED_ALL = " UNION ALL BY NAME ".join([
    f"SELECT 'google_factcheck' AS dataset, * FROM ({keyed(adapted_reviews())})",
    f"SELECT 'bluesky_afp' AS dataset, * FROM ({keyed(ADAPTED_POSTS, True)})",
    f"SELECT 'isot' AS dataset, * FROM ({keyed(ADAPTED_ARTICLES, True)})",
    "SELECT * FROM ("
    + keyed(
        f"{adapted_links('split_part(file, chr(95), 2)')}, 'fakenewsnet_' || file AS dataset FROM {{raw_links}}", True
    )
    + ")",
])
CURATED = enriched(finished(first_copies(KEYED_ALL, "dataset, ")))
CANONICAL_ORDER = (
    "record_id, source, claim_text, claimant, claim_date, article_title, article_text, article_text_length, article_url, "
    "image_url, has_valid_image, publisher_name, publisher_site, published_at, textual_rating_raw, label, language_code, "
    "ingested_at"
)
STORED_COLUMNS = (
    "record_id, source, publisher_name, claim_text, claimant, claim_date, article_title, article_text, "
    "article_text_length, article_url, image_url, CAST(has_valid_image AS INT) AS has_valid_image, published_at, "
    "textual_rating_raw, label, language_code, ingested_at"
)

RUN_COLUMNS = (
    "source, run_timestamp, duration_seconds, rows_read, rows_exported, rows_loaded, pct_valid, "
    "rows_dropped_missing_text, rows_dropped_duplicate, rows_dropped_label, peak_memory_mb"
)
LATEST = (
    "SELECT * FROM {runs} QUALIFY row_number() OVER (PARTITION BY source ORDER BY run_timestamp DESC, "
    "duration_seconds DESC, rows_read DESC) = 1"
)
HEALTH = (
    "CASE WHEN pct_valid IS NULL THEN 'no_data' WHEN pct_valid >= 80 THEN 'good' WHEN pct_valid >= 50 THEN 'watch' "
    "ELSE 'problem' END"
)
PAGE_CONTENT = (
    f"SELECT input_order, url, http_status, CASE WHEN http_status = 200 THEN {gated('body')} END AS article_text, "
    f"CASE WHEN http_status = 200 THEN image END AS image_url FROM "
    f"(SELECT *, {article('html')} AS body, {image('html', 'url')} AS image FROM {{fetched_pages}})"
)

KPI_SUMMARY = f"""
        SELECT source, count(*) AS runs, {rounded(mean('pct_valid'), 2)} AS mean_pct_valid,
          {rounded(mean('duration_seconds'), 2)} AS mean_duration_seconds,
          {rounded(mean('peak_memory_mb'), 2)} AS mean_peak_memory_mb FROM {{runs}} GROUP BY source"""

PAGES_OF_CLAIMS = f"""
        SELECT c.input_order, c.claim_text, c.article_url, p.http_status, p.article_text, p.image_url
        FROM {{claim_links}} c LEFT JOIN (
          SELECT * FROM ({PAGE_CONTENT}) QUALIFY row_number() OVER (PARTITION BY url ORDER BY input_order) = 1
        ) p ON p.url = c.article_url"""

ALIVE = "http_status IS NOT NULL AND http_status NOT IN (404, 410)"

SQL = {
    # sources and readers
    "read_raw_csv": f"SELECT {', '.join(REVIEW_COLUMNS)} FROM ({reviews()})",
    "na_tokens_to_null": reviews(),
    "labeled_file_union": "SELECT title, text, subject, date, label FROM {raw_articles}",
    "sample_per_file": """
        SELECT file, id, news_url FROM {raw_links}
        QUALIFY row_number() OVER (PARTITION BY file ORDER BY md5(id || ':42'), id) <= 20""",
    "flatten_claim_reviews": """
        SELECT claim_text, claimant, claim_date, review_publisher_name, review_publisher_site, review_url,
          review_title, review_date, textual_rating, language_code
        FROM (
          SELECT *, 1 AS review_no FROM {raw_reviews} WHERE input_order % 3 <> 0
          UNION ALL BY NAME
          SELECT * REPLACE ('xx' AS language_code, review_url || '/xx' AS review_url), 2 AS review_no
          FROM {raw_reviews} WHERE input_order % 3 = 2)
        QUALIFY row_number() OVER (PARTITION BY review_url ORDER BY input_order, review_no) = 1""",
    "parse_post_feed": f"""
        SELECT post_url, post_text, {iso('CAST(pub_date AS TIMESTAMP)')} AS pub_date, guid,
          nullif(regexp_extract(post_text, '(?s)^.*(https?://[^ \\n]+)', 1), '') AS article_url
        FROM (SELECT * REPLACE ({strip('post_text')} AS post_text) FROM {{raw_posts}})""",
    "last_url_in_text": r"""
        SELECT input_order, regexp_extract_all(post_text, 'https?://[^ \n]+')[-1] AS last_url FROM {raw_posts}""",
    "read_run_metrics": f"SELECT {RUN_COLUMNS}, step_extract, step_clean, step_load FROM {{runs}}",
    "publisher_site_filter": f"""
        SELECT input_order, review_publisher_site FROM ({reviews()})
        WHERE review_publisher_site IN ('politifact.com', 'snopes.com', 'factcheck.org', 'fullfact.org',
          'leadstories.com', 'factcheck.afp.com', 'reuters.com', 'apnews.com', 'africacheck.org', 'boomlive.in',
          'altnews.in', 'correctiv.org', 'maldita.es', 'newtral.es', 'rappler.com', 'verafiles.org')""",
    "max_age_filter": f"""
        SELECT input_order, review_date FROM ({reviews()})
        WHERE {stamp('review_date')} >= TIMESTAMP '2024-06-01 00:00:00' - INTERVAL 180 DAYS""",
    # pages
    "extract_article_text": f"SELECT page_id, {article('html')} AS article_text FROM {{pages}}",
    "extract_article_text_nested": f"""
        SELECT page_id, {nested_article('html')[1]} AS article_text
        FROM (SELECT page_id, {nested_article('html')[0]} AS pieces FROM {{pages}})""",
    "min_text_length_gate": f"SELECT conv_id, turn, {gated('text')} AS text FROM {{conversations}}",
    "extract_preview_image": f"SELECT input_order, {image('html', 'url')} AS image_url FROM {{fetched_pages}}",
    "non_ok_page_nulls": PAGE_CONTENT,
    "drop_dead_links": f"SELECT input_order, url, http_status FROM {{fetched_pages}} WHERE {ALIVE}",
    "prune_source_dead_rows": f"""
        SELECT id, news_url, title, tweet_ids FROM {{raw_links}} WHERE id NOT IN
          (SELECT 'link' || input_order FROM {{fetched_pages}} WHERE NOT ({ALIVE}) OR http_status IS NULL)""",
    "attach_page_text": PAGES_OF_CLAIMS,
    "attach_page_text_stored": PAGES_OF_CLAIMS,
    "image_file_name": r"""
        SELECT input_order, regexp_extract(guid, '([^/]*)$', 1) ||
          coalesce(nullif(regexp_extract(split_part(image_url, '?', 1), '[^/](\.[^./]+)$', 1), ''), '.jpg') AS file_name
        FROM (SELECT input_order, guid, image_url FROM {raw_posts})
        WHERE guid IS NOT NULL AND image_url IS NOT NULL
        UNION ALL
        SELECT input_order, CASE WHEN guid IS NOT NULL THEN regexp_extract(guid, '([^/]*)$', 1) || '.jpg' END
        FROM {raw_posts} WHERE guid IS NULL OR image_url IS NULL""",
    # adapters
    "adapt_factcheck_api": adapted_reviews(),
    "adapt_post_feed": ADAPTED_POSTS,
    "adapt_news_links": adapted_links("'fake'") + " FROM {raw_links}",
    "adapt_labeled_articles": ADAPTED_ARTICLES,
    "adapter_registry": """
        SELECT 'google_factcheck' AS dataset, 'google_factcheck' AS source, count(*) AS n FROM {raw_reviews}
        UNION ALL SELECT 'bluesky_afp', 'bluesky_afp', count(*) FROM {raw_posts}
        UNION ALL SELECT 'isot', 'isot', count(*) FROM {raw_articles}
        UNION ALL SELECT 'fakenewsnet_' || file, 'fakenewsnet', count(*) FROM {raw_links} GROUP BY file""",
    "label_domain_check": f"""
        SELECT textual_rating AS label, count(*) AS n FROM ({reviews()})
        WHERE textual_rating NOT IN ('fake', 'true') GROUP BY textual_rating""",
    "project_canonical": f"""
        SELECT {NULL} AS record_id, CAST(NULL AS BIGINT) AS article_text_length, CAST(NULL AS BOOLEAN) AS has_valid_image,
          {NULL} AS ingested_at, * EXCLUDE (input_order) FROM ({ADAPTED_ARTICLES})""",
    # cleaning
    "clean_text": f"""
        SELECT input_order, {clean('claim_text')} AS claim_text, {clean('claimant')} AS claimant,
          {clean('review_title')} AS article_title, {clean('article_text')} AS article_text FROM {{raw_reviews}}""",
    "normalize_url": f"SELECT input_order, {url('review_url')} AS article_url FROM {{raw_reviews}}",
    "prefix_url_scheme": f"SELECT id, {prefixed('news_url')} AS news_url FROM {{raw_links}}",
    "validate_image_url": f"SELECT input_order, {is_image('image_url')} AS has_valid_image FROM {{raw_posts}}",
    "label_from_rating": f"""
        SELECT input_order, textual_rating, {label('textual_rating')} AS label FROM {{raw_reviews}}""",
    "normalize_datetime": f"""
        SELECT input_order, {iso(stamp('claim_date'))} AS claim_date, {iso(stamp('review_date'))} AS published_at
        FROM {{raw_reviews}}""",
    "drop_missing_text": f"""
        SELECT input_order, claim_text FROM ({keyed(adapted_reviews())}) WHERE claim_text IS NOT NULL""",
    "dedup_keep_first": f"""
        SELECT input_order, article_url, claim_text, article_text FROM ({first_copies(keyed(adapted_reviews()))})""",
    "drop_unlabeled": f"SELECT input_order, label FROM ({keyed(adapted_reviews())}) WHERE label IS NOT NULL",
    "drop_counts": f"""
        WITH ranked AS (
          SELECT dataset, claim_text, label, row_number() OVER (
            PARTITION BY dataset, claim_text IS NULL, coalesce(article_url, claim_text) ORDER BY input_order) AS copy
          FROM ({KEYED_ALL}))
        SELECT dataset, count(*) AS rows_read,
          count(*) FILTER (claim_text IS NULL) AS rows_dropped_missing_text,
          count(*) FILTER (claim_text IS NOT NULL AND copy > 1) AS rows_dropped_duplicate,
          count(*) FILTER (claim_text IS NOT NULL AND copy = 1 AND label IS NULL) AS rows_dropped_label,
          count(*) FILTER (claim_text IS NOT NULL AND copy = 1 AND label IS NOT NULL) AS rows_exported
        FROM ranked GROUP BY dataset""",
    "clean_claims": finished(first_copies(keyed(adapted_reviews()))),
    "distinct_reviews": f"""
        SELECT input_order, review_url FROM ({reviews()})
        QUALIFY row_number() OVER (PARTITION BY review_url ORDER BY input_order) = 1""",
    # enrichment
    "record_id": f"""
        SELECT input_order, {record_id("source", url("article_url"), clean("claim_text"), clean("article_text"))} AS record_id
        FROM ({adapted_reviews()})""",
    "id_clashes": f"""
        WITH told AS (
          SELECT substr(record_id, 1, 2) AS record_id,
            substr(sha1(source || ':' || coalesce(nullif(article_url, ''), coalesce(claim_text, '') || chr(31) || coalesce(article_text, ''))), 17, 24) AS rest,
            source || ':' || coalesce(nullif(article_url, ''), claim_text) AS named
          FROM ({curated_reviews()})),
        bases AS (SELECT record_id, rest, min(named) AS named FROM told GROUP BY record_id, rest)
        SELECT record_id, count(*) AS claims, arg_min(named, rest) AS one, arg_max(named, rest) AS other
        FROM bases GROUP BY record_id HAVING count(*) > 1""",
    "text_length": "SELECT doc_id, CAST(length(coalesce(text, '')) AS BIGINT) AS article_text_length FROM {documents}",
    "stamp_ingested_at": f"SELECT doc_id, '{AS_OF}' AS ingested_at FROM {{documents}}",
    "enrich_claims": f"SELECT input_order, record_id, article_text_length, ingested_at FROM ({curated_reviews()})",
    "curate_claims": f"SELECT {CANONICAL_ORDER} FROM ({CURATED})",
    # validation and sinks
    "schema_issues": f"""
        WITH rows_ AS (SELECT * REPLACE (textual_rating_raw AS label) FROM ({keyed(adapted_reviews())})),
        nulls AS (
          SELECT 'source' AS column_name, count(*) FILTER (source IS NULL) AS n_rows FROM rows_
          UNION ALL SELECT 'claim_text', count(*) FILTER (claim_text IS NULL) FROM rows_
          UNION ALL SELECT 'label', count(*) FILTER (label IS NULL) FROM rows_)
        SELECT 'missing_column' AS issue, c AS column_name, {NULL} AS value, CAST(NULL AS BIGINT) AS n_rows,
          'Missing required column: ' || c AS message FROM (VALUES ('record_id'), ('ingested_at')) v(c)
        UNION ALL SELECT 'null_values', column_name, NULL, n_rows,
          'Column ''' || column_name || ''' is required but has ' || n_rows || ' missing value(s)' FROM nulls WHERE n_rows > 0
        UNION ALL SELECT 'unexpected_label', 'label', label, count(*),
          'Column ''label'' has unexpected value: ''' || label || '''' FROM rows_
        WHERE label NOT IN ('fake', 'true') GROUP BY label""",
    "constraint_violations": f"""
        WITH rows_ AS ({keyed(adapted_reviews())})
        SELECT input_order, 'claim_text not null' AS violation FROM rows_ WHERE claim_text IS NULL
        UNION ALL SELECT input_order, 'label not null' FROM rows_ WHERE label IS NULL
        UNION ALL SELECT input_order, 'publisher_name references dimension' FROM rows_ WHERE publisher_name = 'src7'""",
    "export_dataset": f"SELECT {CANONICAL_ORDER} FROM ({CURATED})",
    "run_manifest": f"""
        SELECT 'all' AS source, 'in' AS input_path, 'out' AS output_path, count(*) AS row_count, '{AS_OF}' AS generated_at,
          count(*) FILTER (label = 'fake') AS n_fake, count(*) FILTER (label = 'true') AS n_true,
          CAST(0 AS BIGINT) AS n_issues FROM ({CURATED})""",
    "upsert_source_dim": f"""
        SELECT DISTINCT source AS name,
          CASE WHEN source = 'isot' THEN '2024-01-01T00:00:00Z' ELSE '{AS_OF}' END AS first_loaded_at FROM ({CURATED})""",
    "upsert_publisher_dim": f"""
        SELECT publisher_name || '/' || language_code AS name,
          CASE WHEN language_code <> 'en' THEN publisher_site END AS site FROM ({adapted_reviews()})
        QUALIFY row_number() OVER (PARTITION BY publisher_name, language_code ORDER BY input_order) = 1""",
    "upsert_claims": f"""
        WITH a AS ({curated_reviews()}), b AS ({curated_reviews('raw_reviews_again')})
        SELECT {STORED_COLUMNS} FROM a WHERE record_id NOT IN (SELECT record_id FROM b)
        UNION ALL SELECT {STORED_COLUMNS} FROM b""",
    "load_summary": f"""
        SELECT count(DISTINCT source) AS sources, count(DISTINCT publisher_name) AS publishers,
          count(*) AS claim_records FROM ({CURATED})""",
    "append_run_record": f"""
        SELECT {RUN_COLUMNS}, step_extract, step_clean, step_load FROM {{runs}}
        UNION ALL
        SELECT * REPLACE (source || '_again' AS source)
        FROM (SELECT {RUN_COLUMNS}, step_extract, step_clean, step_load FROM {{runs}})""",
    "value_to_sink": f"""
        SELECT * REPLACE (nullif(article_text_length, 0) AS article_text_length,
          strftime(CAST(published_at AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S+00:00') AS published_at)
        FROM (SELECT {STORED_COLUMNS} FROM ({CURATED}))""",
    # incremental and streaming
    "incremental_new_posts": """
        SELECT * FROM {raw_posts} WHERE guid IS NULL OR guid NOT IN (SELECT guid FROM {stored_posts} WHERE guid IS NOT NULL)""",
    "append_new_posts": """
        SELECT * REPLACE (CAST(NULL AS VARCHAR) AS image_url) FROM {stored_posts}
        UNION ALL
        SELECT * FROM {raw_posts}
        WHERE guid IS NULL OR guid NOT IN (SELECT guid FROM {stored_posts} WHERE guid IS NOT NULL)""",
    "stream_dedup_posts": f"""
        WITH both_polls AS (SELECT * FROM {{stored_posts}} UNION ALL SELECT * FROM {{raw_posts}}),
        once AS (
          SELECT DISTINCT input_order, guid, post_text, pub_date FROM both_polls WHERE guid IS NOT NULL
          UNION ALL SELECT input_order, guid, post_text, pub_date FROM both_polls WHERE guid IS NULL)
        SELECT * REPLACE ({iso('CAST(pub_date AS TIMESTAMP)')} AS pub_date) FROM once""",
    "stream_append_posts": """
        SELECT input_order, guid, post_text, pub_date FROM {stored_posts}
        UNION ALL
        SELECT input_order, guid, post_text, pub_date FROM {raw_posts}
        WHERE guid IS NULL OR guid NOT IN (SELECT guid FROM {stored_posts} WHERE guid IS NOT NULL)""",
    "stream_curate": f"SELECT {STORED_COLUMNS} FROM ({curated_reviews()})",
    # run metrics
    "merge_phase_metrics": f"""
        WITH phase AS (
          SELECT *, n - n_text - n_copy - n_label AS kept,
            row_number() OVER (PARTITION BY source, run_timestamp ORDER BY phase_no DESC) AS from_last FROM {{phases}})
        SELECT source, run_timestamp, {total('elapsed_seconds')} AS duration_seconds,
          CAST(sum(n) AS BIGINT) AS rows_read, CAST(sum(kept) AS BIGINT) AS rows_exported,
          CAST(sum(kept) AS BIGINT) AS rows_loaded,
          {rounded('CAST(100 * sum(kept) AS DOUBLE) / CAST(sum(n) AS DOUBLE)', 2)} AS pct_valid,
          CAST(sum(n_text) AS BIGINT) AS rows_dropped_missing_text,
          CAST(sum(n_copy) AS BIGINT) AS rows_dropped_duplicate,
          CAST(sum(n_label) AS BIGINT) AS rows_dropped_label,
          nullif(max(memory), 0) AS peak_memory_mb,
          max(elapsed_seconds) FILTER (phase_no = 1) AS step_extract,
          max(elapsed_seconds) FILTER (phase_no = 2) AS step_clean,
          max(elapsed_seconds) FILTER (phase_no = 3) AS step_load,
          max(elapsed_seconds) FILTER (from_last = 1) AS step_export
        FROM phase GROUP BY source, run_timestamp""",
    "step_timings": f"""
        WITH ranked AS (
          SELECT claim_text, label, row_number() OVER (
            PARTITION BY claim_text IS NULL, coalesce(article_url, claim_text) ORDER BY input_order) AS copy
          FROM ({keyed(adapted_reviews())}))
        SELECT 'google_factcheck' AS source, '{AS_OF}' AS run_timestamp, count(*) AS rows_read,
          count(*) FILTER (claim_text IS NOT NULL AND copy = 1 AND label IS NOT NULL) AS rows_exported,
          {rounded('CAST(100 * count(*) FILTER (claim_text IS NOT NULL AND copy = 1 AND label IS NOT NULL) AS DOUBLE) / CAST(count(*) AS DOUBLE)', 2)} AS pct_valid,
          count(*) FILTER (claim_text IS NULL) AS rows_dropped_missing_text,
          count(*) FILTER (claim_text IS NOT NULL AND copy > 1) AS rows_dropped_duplicate,
          count(*) FILTER (claim_text IS NOT NULL AND copy = 1 AND label IS NULL) AS rows_dropped_label,
          'clean,export' AS steps
        FROM ranked""",
    "latest_run_per_source": f"SELECT {RUN_COLUMNS} FROM ({LATEST})",
    "overview_kpis": f"""
        SELECT {rounded(mean('pct_valid'), 2)} AS mean_pct_valid, {rounded(mean('duration_seconds'), 2)} AS mean_duration_seconds,
          {rounded(mean('peak_memory_mb'), 2)} AS mean_peak_memory_mb,
          (SELECT count(*) FROM {{runs}}) AS runs FROM ({LATEST})""",
    "health_badge": f"SELECT source, run_timestamp, {HEALTH} AS health FROM {{runs}}",
    "drop_reasons_long": f"""
        SELECT source, cause, rows FROM (SELECT source, rows_dropped_missing_text, rows_dropped_duplicate,
          rows_dropped_label FROM ({LATEST}))
        UNPIVOT (rows FOR cause IN (rows_dropped_missing_text, rows_dropped_duplicate, rows_dropped_label))""",
    "slowest_sources": f"SELECT source, duration_seconds FROM ({LATEST}) ORDER BY duration_seconds, source",
    "costliest_sources": f"SELECT source, peak_memory_mb FROM ({LATEST}) ORDER BY peak_memory_mb NULLS LAST, source",
    "step_durations_wide": f"""
        SELECT source, step_extract AS extract, CAST(NULL AS DOUBLE) AS read, CAST(NULL AS DOUBLE) AS adapt,
          step_clean AS clean, CAST(NULL AS DOUBLE) AS enrich, CAST(NULL AS DOUBLE) AS export, step_load AS load
        FROM ({LATEST})""",
    "precision_trend": """
        SELECT source, run_timestamp, pct_valid FROM {runs}
        QUALIFY count(*) OVER (PARTITION BY source) > 1 ORDER BY source, run_timestamp""",
    "kpi_summary": KPI_SUMMARY,
    "kpi_summary_incremental": KPI_SUMMARY,
    "duration_alert": """
        WITH timed AS (SELECT source, run_timestamp, duration_seconds, CAST(left(run_timestamp, 10) AS DATE) AS day FROM {runs}),
        limits AS (
          SELECT d.source, d.day, quantile_disc(o.duration_seconds, 0.75) AS usual
          FROM (SELECT DISTINCT source, day FROM timed) d JOIN timed o ON o.source = d.source AND o.day < d.day
          WHERE o.duration_seconds IS NOT NULL GROUP BY d.source, d.day)
        SELECT t.source, t.run_timestamp, t.duration_seconds, l.usual,
          CASE WHEN l.usual IS NULL OR t.duration_seconds IS NULL THEN 'no_data'
            WHEN t.duration_seconds > l.usual THEN 'slow' ELSE 'good' END AS alert
        FROM timed t LEFT JOIN limits l ON l.source = t.source AND l.day = t.day""",
    "run_history": f"""
        SELECT {RUN_COLUMNS} FROM {{runs}} WHERE source IN ('click', 'view', 'error') ORDER BY run_timestamp DESC, source""",
    "runs_overview": "SELECT count(*) AS runs, count(DISTINCT source) AS sources FROM {runs}",
    "speed_alert": f"""
        WITH history AS (
          SELECT source, run_timestamp, duration_seconds,
            CAST(sum(CAST(duration_seconds AS DECIMAL(28, 4))) OVER earlier AS DOUBLE) / count(*) OVER earlier AS m
          FROM {{runs}} WINDOW earlier AS (
            PARTITION BY source ORDER BY run_timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
        SELECT source, run_timestamp, duration_seconds, {rounded('m', 4)} AS mean_before,
          CASE WHEN m IS NULL THEN 'no_data' WHEN duration_seconds > 5 * m THEN 'critical'
            WHEN duration_seconds >= 2 * m THEN 'watch' ELSE 'good' END AS alert FROM history""",
    "cost_alert": """
        SELECT source, run_timestamp, peak_memory_mb,
          CASE WHEN peak_memory_mb IS NULL THEN 'no_data' WHEN peak_memory_mb > 1024 THEN 'critical'
            WHEN peak_memory_mb >= 500 THEN 'watch' ELSE 'good' END AS alert FROM {runs}""",
    "precision_alert": f"""
        SELECT source, pct_valid, {HEALTH} AS alert FROM ({LATEST}) WHERE pct_valid < 80""",
    "weekly_drop_comparison": """
        WITH weekly AS (
          SELECT source, CAST(date_trunc('week', CAST(run_timestamp AS TIMESTAMP)) AS DATE) AS week,
            CAST(sum(rows_dropped_missing_text) AS BIGINT) AS a, CAST(sum(rows_dropped_duplicate) AS BIGINT) AS b,
            CAST(sum(rows_dropped_label) AS BIGINT) AS c FROM {runs} GROUP BY ALL)
        SELECT w.source, CAST(w.week AS VARCHAR) AS week, w.a AS rows_dropped_missing_text,
          w.b AS rows_dropped_duplicate, w.c AS rows_dropped_label, p.a AS rows_dropped_missing_text_week_before,
          p.b AS rows_dropped_duplicate_week_before, p.c AS rows_dropped_label_week_before
        FROM weekly w LEFT JOIN weekly p ON p.source = w.source AND p.week = w.week - INTERVAL 7 DAYS""",
    "label_imbalance": f"""
        WITH counted AS (
          SELECT source, label, count(c.source_) AS n FROM
            (SELECT DISTINCT source FROM ({CURATED})) s CROSS JOIN (VALUES ('fake'), ('true')) l(label)
            LEFT JOIN (SELECT source AS source_, label AS label_ FROM ({CURATED})) c ON source_ = source AND label_ = label
          GROUP BY source, label)
        SELECT source, label, n, {rounded('n / sum(n) OVER (PARTITION BY source)', 4)} AS share,
          min(n) OVER (PARTITION BY source) / sum(n) OVER (PARTITION BY source) < 0.05 AS extreme FROM counted""",
    # exploration
    "status_histogram": "SELECT http_status, count(*) AS n FROM {fetched_pages} GROUP BY http_status",
    "class_balance": f"SELECT label, count(*) AS n FROM ({CURATED}) GROUP BY label",
    "top_unmapped_ratings": f"""
        SELECT rating, count(*) AS n FROM (
          SELECT textual_rating AS rating FROM ({reviews()}) UNION ALL SELECT claimant FROM ({reviews()}))
        WHERE rating IS NOT NULL AND {label('rating')} IS NULL
        GROUP BY rating ORDER BY n DESC, rating LIMIT 15""",
    "file_summary": f"""
        WITH content AS (
          SELECT * REPLACE (regexp_replace(url, '^http:', 'https:') AS url) FROM ({PAGE_CONTENT}))
        SELECT file, split_part(file, '_', 2) AS label, count(*) AS rows_kept,
          count(article_text) AS rows_with_article_text
        FROM {{raw_links}} JOIN content ON url = regexp_replace({url('news_url')}, '^http:', 'https:')
        WHERE {ALIVE} GROUP BY file""",
    "text_coverage": f"""
        SELECT count(*) AS rows, count(*) FILTER (http_status = 200) AS fetched_ok, count(article_text) AS with_text,
          count(image_url) AS with_image, {rounded('count(article_text) / count(*)', 4)} AS text_share FROM ({PAGE_CONTENT})""",
    "preview_rows": f"""
        SELECT input_order, url, article_text FROM ({PAGE_CONTENT}) WHERE article_text IS NOT NULL
        ORDER BY input_order LIMIT 5""",
}


ORACLES = {name: with_views(sql) for name, sql in SQL.items()}

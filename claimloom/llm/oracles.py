"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from claimloom.llm.maglev import table_size
from claimloom.llm.queries import SHARDS

_HASH = "('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT"

MIX = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, {_HASH} AS h
  FROM documents),
sums AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, 2.0::DOUBLE * source_size AS stop,
         (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER (
            ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sums),
targets AS (
  SELECT source, source_size,
         least(stop, coalesce((SELECT arg_min(level, stop / weight) FROM levels WHERE level <= stop / weight) * weight, stop)) AS target
  FROM levels),
open AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS rounds FROM targets),
ranked AS (
  SELECT s.doc_id, s.size, o.source_size, o.target, o.rounds, o.target - o.rounds * o.source_size AS budget,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h) AS running,
         sum(s.size) OVER (PARTITION BY s.source, s.h) AS unit
  FROM sized s JOIN open o ON s.source IS NOT DISTINCT FROM o.source)
SELECT doc_id, size, source_size, target,
       (size * (rounds + CASE WHEN budget > 0 AND (running <= budget
          OR (running - unit <= budget AND 2 * (budget - (running - unit)) >= unit)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ranked
"""

_SLOTS = table_size(SHARDS)

SHARD = f"""
WITH RECURSIVE names AS (
  SELECT k, 'shard-' || k AS name FROM range({SHARDS}) t(k)),
walks AS (
  SELECT k, ('0x' || substr(md5(name || ':start'), 1, 15))::BIGINT % {_SLOTS} AS first_slot,
         ('0x' || substr(md5(name || ':step'), 1, 15))::BIGINT % {_SLOTS - 1} + 1 AS step FROM names),
orders AS (
  SELECT list(walk ORDER BY k) AS walks FROM (
    SELECT k, list_transform(range({_SLOTS}), lambda i: ((first_slot + i * step) % {_SLOTS})::INTEGER) AS walk FROM walks)),
turns AS (
  SELECT 0 AS turn, list_transform(range({_SLOTS}), lambda i: true) AS free, -1 AS slot, -1 AS shard
  UNION ALL
  SELECT turn + 1, list_transform(free, lambda f, i: f AND i <> claimed + 1), claimed, (turn % {SHARDS})::INTEGER
  FROM (SELECT t.turn, t.free, walk[list_position(list_select(t.free, list_transform(walk, lambda s: s + 1)), true)] AS claimed
        FROM (SELECT turns.turn, turns.free, orders.walks[turns.turn % {SHARDS} + 1] AS walk FROM turns, orders
              WHERE turns.turn < {_SLOTS}) t)),
slots AS (SELECT slot, shard FROM turns WHERE shard >= 0)
SELECT doc_id, slot, shard
FROM (SELECT doc_id, ({_HASH} % {_SLOTS})::INTEGER AS slot FROM documents) JOIN slots USING (slot)
"""

EXACT_DEDUP = r"""
WITH plain AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER best AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       row_number() OVER best = 1 AS kept,
       sha256(body) AS text_sha256
FROM plain
WINDOW best AS (PARTITION BY body ORDER BY chars DESC, doc_id NULLS LAST)
"""

FILL_IN_MIDDLE = r"""
WITH plain AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
         sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS drawn
  FROM documents),
numbers AS (
  SELECT *, len(units) AS n, list_transform([1, 9, 17, 25], lambda k: ('0x' || substr(drawn, k, 8))::BIGINT) AS h FROM plain),
cuts AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 50 THEN 'plain'
              WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers),
parts AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:], '') AS suffix FROM cuts)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

ORACLES = {
    "op3_mix_sources": MIX,
    "op9_shard": SHARD,
    "op10_exact_dedup": EXACT_DEDUP,
    "op13_fill_in_middle": FILL_IN_MIDDLE,
}

"""Mixing sources to target weights."""

from patio.llm.common import table
from patio.llm.mixing import BLOCK, CAP, MAX_SHARDS, SEED, SHARD_WORDS, WEIGHTS, plan_mix, sized_rows


def op2_mix_sources(spark, sf_dir):
    sized = sized_rows(table(spark, sf_dir, "documents"))
    return plan_mix(sized).select("doc_id", "size", "source_size", "target", "taken")


_W = f"[{', '.join(f'{float(w)}::DOUBLE' for w in WEIGHTS)}]"
# every quotient of every source is ranked here, where the operator ranks only the open seats
OP2_SQL = rf"""
WITH sized AS (
  SELECT row_number() OVER () AS row, doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ordered AS (SELECT *, row_number() OVER (ORDER BY source COLLATE C NULLS LAST) AS src FROM totals),
rated AS (
  SELECT *, {_W}[(src - 1) % {len(WEIGHTS)} + 1] AS weight, ({CAP} * source_size)::DOUBLE AS most FROM ordered),
steps AS (
  SELECT *, row_number() OVER r AS pos,
    (SELECT sum(source_size) FROM rated)::DOUBLE - coalesce(sum(most) OVER b, 0) AS rest,
    (SELECT sum(weight) FROM rated) - coalesce(sum(weight) OVER b, 0) AS shares
  FROM rated WINDOW r AS (ORDER BY most / weight, src),
    b AS (ORDER BY most / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
opened AS (SELECT * FROM steps WHERE rest <= most / weight * shares ORDER BY pos LIMIT 1),
sources AS (
  SELECT s.source, s.src, s.source_size,
    CASE WHEN s.pos < coalesce((SELECT pos FROM opened), 1 << 30) THEN s.most
         ELSE (SELECT rest FROM opened) * s.weight / (SELECT shares FROM opened) END AS target,
    greatest(CAST(ceil(s.source_size / greatest({SHARD_WORDS}, ceil((SELECT sum(source_size) FROM totals) / {MAX_SHARDS}))) AS BIGINT), 1) AS n_shards
  FROM steps s),
quotients AS (
  SELECT src, target / (2 * j + 1) AS q FROM (
    SELECT src, target, unnest(range(CAST(target // {BLOCK} + 40 AS BIGINT))) AS j FROM sources WHERE target > 0)),
seats AS (
  SELECT src, count(*) AS n FROM (SELECT *, row_number() OVER (ORDER BY q DESC, src) AS r FROM quotients)
  WHERE r <= (SELECT round_even(sum(source_size) / {BLOCK}, 0) FROM totals) GROUP BY src),
drawn AS (
  SELECT z.*, s.src, s.source_size, s.target, md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS ticket, n_shards
  FROM sized z JOIN sources s ON z.source IS NOT DISTINCT FROM s.source),
sharded AS (SELECT *, ('0x' || ticket[1:8])::BIGINT % n_shards AS shard FROM drawn),
shards AS (SELECT src, shard, CAST(sum(size) AS BIGINT) AS words FROM sharded GROUP BY ALL HAVING sum(size) > 0),
shard_quotients AS (
  SELECT src, shard, words / (2 * j + 1) AS q FROM (
    SELECT src, shard, words, unnest(range(CAST(3 * words // {BLOCK} + 40 AS BIGINT))) AS j FROM shards)),
shard_seats AS (
  SELECT src, shard, count(*) AS won FROM (
    SELECT *, row_number() OVER (PARTITION BY src ORDER BY q DESC, shard) AS r FROM shard_quotients)
  JOIN seats USING (src) WHERE r <= n GROUP BY src, shard),
needs AS (
  SELECT src, shard, words, least(won * {BLOCK}, {CAP} * words) AS need FROM shards JOIN shard_seats USING (src, shard)),
blocks AS (
  SELECT src, shard, words, need // words AS passes, need % words AS extra, b, least({BLOCK}, words - b * {BLOCK}) AS len,
    md5('{SEED}:' || src || ':' || shard || ':' || b) AS turn
  FROM (SELECT *, unnest(range((words - 1) // {BLOCK} + 1)) AS b FROM needs)),
takes AS (
  SELECT src, shard, b, passes, least(greatest(extra - coalesce(sum(len) OVER (
    PARTITION BY src, shard ORDER BY turn, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0), len) AS take FROM blocks),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY src, shard ORDER BY ticket, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM sharded),
spans AS (
  SELECT row, src, shard, pos, size, unnest(range(CAST(pos // {BLOCK} AS BIGINT), CAST((pos + size - 1) // {BLOCK} + 1 AS BIGINT))) AS b
  FROM placed WHERE size > 0),
shares_of AS (
  SELECT row, max(passes) AS passes,
    sum(greatest(least(pos + size - b * {BLOCK}, take) - greatest(pos - b * {BLOCK}, 0), 0)) AS extra
  FROM spans JOIN takes USING (src, shard, b) GROUP BY row)
SELECT doc_id, size, source_size, target, CAST(coalesce(passes * size + extra, 0) AS BIGINT) AS taken
FROM sharded LEFT JOIN shares_of USING (row)
"""

QUERIES = {"op2_mix_sources": op2_mix_sources}
ORACLES = {"op2_mix_sources": OP2_SQL}

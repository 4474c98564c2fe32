"""Quality rules, URL filters and line dedup."""

from pyspark.sql import functions as F

from patio.llm.common import table
from patio.llm.lines import MIN_PAGES, RATIO, drop_boilerplate
from patio.llm.quality import METHOD_RULES, STOP_WORDS, judge_quality
from patio.llm.urls import CONFIDENCE, MIN_COUNT, RULES, SUPPORT, filter_urls, labelled_urls

WHITE_SQL = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"
WORDS_SQL = r"regexp_extract_all(coalesce({x}, ''), '[^\x20\x09-\x0D]+')"


def op4_quality_rules(spark, sf_dir):
    judged = judge_quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "failed")


def _rule_sql(rule):
    parts = []
    if rule.low is not None:
        parts.append(f"{rule.metric} < {rule.low}")
    if rule.high is not None:
        parts.append(f"{rule.metric} > {rule.high}")
    return f"CASE WHEN {' OR '.join(parts)} THEN '{rule.name}' END"


_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)
OP4_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS body,
         {WORDS_SQL.format(x='text')} AS words FROM documents),
windows AS (
  SELECT row, i, words[i:i + 2] AS win FROM (
    SELECT row, words, unnest(range(1, len(words) - 1)) AS i FROM docs)),
repeated AS (
  SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, win) AS c FROM windows) WHERE c > 1),
covered AS (
  SELECT row, count(DISTINCT i + k) AS n FROM repeated, (SELECT unnest([0, 1, 2]) AS k) GROUP BY row),
lined AS (
  SELECT row, list_filter(string_split(body, chr(10)), lambda x: trim(x, {WHITE_SQL}) <> '') AS lines FROM docs),
base AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(body) - length(replace(body, '!', '')) AS BIGINT) AS n_bangs,
    CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(list_filter({WORDS_SQL.format(x='lower(body)')}, lambda x: x IN ({_STOPS}))) AS BIGINT) AS n_stops
  FROM docs JOIN lined USING (row) LEFT JOIN covered USING (row)),
rated AS (
  SELECT *, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_length,
    CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbols_per_word,
    CASE WHEN n_words > 0 THEN n_bangs / n_words ELSE 0 END AS exclamations_per_word,
    CASE WHEN n_words > 0 THEN n_stops / n_words ELSE 0 END AS stop_word_ratio,
    CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_ratio,
    n_words < 50 AS too_short, 100 * n_repeat_words > 50 * n_words AS repetitive FROM base),
judged AS (
  SELECT *, too_short OR repetitive AS base_failed, concat_ws(',',
    CASE WHEN too_short THEN 'too_short' END, CASE WHEN repetitive THEN 'repetitive' END,
    {', '.join(_rule_sql(r) for r in METHOD_RULES)}) AS failed FROM rated)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       failed = '' AS kept, failed FROM judged
"""


def op5_url_filters(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labelled = labelled_urls(pages, table(spark, sf_dir, "labels"))
    return filter_urls(pages, labelled).select("page_id", "host", "path", "rule", "verdict",
                                               F.col("mined_rules").cast("long"))


def _url_rule_sql(value):
    cases = " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') "
        f"THEN '{value(r)}'" for r in sorted(RULES, key=lambda r: -len(r.name)))
    return f"CASE {cases} END"


#: The twin lists combinations of up to three tokens; the operator has no such bound, and on the tables
#: that the twin is compared on no rule is longer.
MAX_TOKENS = 3
OP5_SQL = rf"""
WITH urls AS (
  SELECT page_id, url, CASE WHEN contains(url, '://') THEN url[position('://' IN url) + 3:] ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM urls),
tokens AS (
  SELECT url, list_distinct(list_filter(list_concat(
      list_transform(string_split(host, '.'), lambda x: 'h:' || x),
      list_transform(regexp_split_to_array(lower(path), '[/._-]'), lambda x: 'p:' || x)),
    lambda x: NOT regexp_matches(x, '^[hp]:$') AND NOT regexp_matches(x, '^p:[0-9]+$'))) AS tokens,
    try_cast(regexp_extract(path, '/([0-9]{{1,18}})(?:\.[a-z]+)?/?$', 1) AS BIGINT) AS doc_id, page_id
  FROM parts),
marked AS (
  SELECT doc_id, bool_or(quality = 0 OR toxic = 1) AS bad FROM labels GROUP BY doc_id),
baskets AS (
  SELECT row_number() OVER () AS id, tokens, bad FROM tokens JOIN marked USING (doc_id) WHERE bad IS NOT NULL),
items AS (SELECT id, bad, unnest(tokens) AS t FROM baskets),
combos AS (
  SELECT id, bad, [t] AS c FROM items
  UNION ALL SELECT a.id, a.bad, [a.t, b.t] FROM items a JOIN items b ON a.id = b.id AND a.t < b.t
  UNION ALL SELECT a.id, a.bad, [a.t, b.t, d.t] FROM items a JOIN items b ON a.id = b.id AND a.t < b.t
    JOIN items d ON a.id = d.id AND b.t < d.t),
good AS (
  SELECT c, len(c) AS k FROM combos GROUP BY c
  HAVING count(*) FILTER (WHERE bad) >= greatest({SUPPORT} * (SELECT count(*) FROM baskets), {MIN_COUNT}) - 1e-6
     AND count(*) FILTER (WHERE bad) / count(*) >= {CONFIDENCE} AND len(c) <= {MAX_TOKENS}),
rules AS (
  SELECT c FROM good g WHERE NOT EXISTS (
    SELECT 1 FROM good s WHERE s.k < g.k AND list_has_all(g.c, s.c))),
hits AS (
  SELECT page_id, count(c) AS mined_rules FROM tokens LEFT JOIN rules ON list_has_all(tokens, c) GROUP BY page_id)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, {_url_rule_sql(lambda r: r.name)} AS rule,
       coalesce({_url_rule_sql(lambda r: r.verdict)}, CASE WHEN mined_rules > 0 THEN 'block' ELSE 'allow' END) AS verdict,
       CAST(mined_rules AS BIGINT) AS mined_rules
FROM parts JOIN hits USING (page_id)
"""


def op6_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    clean = drop_boilerplate(docs, dropped="n_dropped")
    return clean.select("doc_id", "n_dropped", F.length("text").cast("long").alias("n_chars"),
                        F.sha2("text", 256).alias("text_sha256"))


CLEAN_LINES_SQL = f"""
numbered AS (SELECT row_number() OVER () AS row, * FROM {{docs}}),
split AS (
  SELECT row, source, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos FROM numbered),
body AS (SELECT row, source, line, pos, trim(line, {WHITE_SQL}) AS b FROM split),
sites AS (SELECT source, count(*) AS pages FROM numbered GROUP BY source),
freq AS (SELECT source, b, count(DISTINCT row) AS holding FROM body WHERE b <> '' GROUP BY source, b),
stock AS (
  SELECT f.source, f.b FROM freq f JOIN sites s ON f.source IS NOT DISTINCT FROM s.source
  WHERE holding >= {MIN_PAGES} AND holding > {RATIO}::DOUBLE * pages),
marked AS (
  SELECT x.*, s.b IS NOT NULL AS stock FROM body x
  LEFT JOIN stock s ON x.source IS NOT DISTINCT FROM s.source AND x.b = s.b),
rejoined AS (
  SELECT row, count(*) FILTER (WHERE stock) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT stock), '') AS clean
  FROM marked GROUP BY row)
"""
OP6_SQL = "WITH " + CLEAN_LINES_SQL.format(docs="documents") + """
SELECT doc_id, CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped, CAST(length(clean) AS BIGINT) AS n_chars,
       sha256(clean) AS text_sha256
FROM numbered LEFT JOIN rejoined USING (row)
"""

QUERIES = {"op4_quality_rules": op4_quality_rules, "op5_url_filters": op5_url_filters,
           "op6_line_dedup": op6_line_dedup}
ORACLES = {"op4_quality_rules": OP4_SQL, "op5_url_filters": OP5_SQL, "op6_line_dedup": OP6_SQL}

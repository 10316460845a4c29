"""One query per operator over the shared tables, and SQL giving the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import bytecnn, collocations, decontam, filter_audit, impact_index, mixing, neighbours, scratch, setjoin, sharding, substrings, token_prefix, url_rules, warc
from meterlake.llm.shipping import ship

VOCABULARY = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents")).drop("text_key", "source")


def op2_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    rules = spark.createDataFrame(url_rules.RULES, "action string, rule_host string, rule_path string")
    return url_rules.judge(pages, rules, url_rules.declared_links(pages)).drop("component")


def op3_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def op4_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(table(spark, sf_dir, "pages"), scratch.new_path(spark, "warc"))
    back = warc.resolve_revisits(warc.read_records(index, with_payload=False))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_jaccard_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.components(table(spark, sf_dir, "documents"))


def op6_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = bytecnn.fit(docs, table(spark, sf_dir, "labels"))
    scored = bytecnn.score(docs.select("doc_id", "text"), net)
    return scored.select("doc_id", bytecnn.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    store = scratch.write(token_prefix.prefix_table(docs, vocabulary_path()), "token-prefixes")
    return token_prefix.read_counts(store, 1024)


def op8_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_curve_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = sharding.shards(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("similarity", 1 - F.col("distance") / F.col("item_words"))


def op11_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impact_index.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_source_mix, op2_url_verdicts, op3_repeated_passages, op4_warc_round_trip, op5_jaccard_classes,
        op6_quality_scores, op7_token_counts, op8_nearest_vectors, op9_curve_shards, op10_benchmark_leaks, op11_top_products, op12_filter_audit,
        op13_phrase_collocations,
    )
}

SQL_MIX = r"""
WITH d AS (
  SELECT doc_id, source, md5('mix-1:' || CAST(doc_id AS VARCHAR)) AS k,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM d GROUP BY source),
c AS (SELECT *, source_size * 2 AS cap, sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE AS total FROM s),
l AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / sum(w) OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
  FROM c),
f AS (SELECT *, level >= cap::DOUBLE / w AS is_full FROM l),
t AS (
  SELECT source, source_size, CASE WHEN is_full THEN cap::DOUBLE
    ELSE least(cap::DOUBLE, max(level) FILTER (WHERE NOT is_full) OVER () * w) END AS target FROM f),
p AS (
  SELECT doc_id, size, source_size, target,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
    CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (epochs * size + greatest(0, least(size, floor(target)::BIGINT - epochs * source_size - before)))::BIGINT AS taken
FROM p
"""

def _sql_tidy(path: str) -> str:
    own = f"regexp_extract({path}, '(?s)^([^?#]*)', 1)"
    left = f"""list_reduce(list_prepend([]::VARCHAR[], list_transform(string_split({own}, '/')[2:], lambda s: [s])),
      lambda a, x: CASE x[1] WHEN '.' THEN a WHEN '..' THEN a[1:len(a) - 1] ELSE list_concat(a, x) END)"""
    end = f"CASE WHEN string_split({own}, '/')[-1] IN ('.', '..') AND len({left}) > 0 THEN '/' ELSE '' END"
    return f"'/' || array_to_string({left}, '/') || {end} || regexp_extract({path}, '(?s)^[^?#]*(.*)$', 1)"


def _sql_resolved(link: str, base: str) -> str:
    origin = f"regexp_extract({base}, '(?s)^([^:/?#]+://[^/?#]*)', 1)"
    path = f"regexp_extract({base}, '(?s)^[^:/?#]+://[^/?#]*([^?#]*)', 1)"
    folder = f"coalesce(nullif(regexp_extract({path}, '(?s)^(.*/)', 1), ''), '/')"
    return f"""CASE WHEN regexp_matches({link}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN CASE WHEN contains({link}, '://') THEN {link} END
      WHEN {origin} = '' OR {base} IS NULL OR {link} = '' OR starts_with({link}, '#') THEN NULL
      WHEN starts_with({link}, '//') THEN regexp_extract({base}, '(?s)^([^:/?#]+:)', 1) || {link}
      WHEN starts_with({link}, '/') THEN {origin} || {_sql_tidy(link)}
      WHEN starts_with({link}, '?') THEN {origin} || {path} || {link}
      ELSE {origin} || {_sql_tidy(f"({folder} || {link})")} END"""


SQL_URLS = r"""
WITH RECURSIVE r(action, rh, rp) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
tags AS (
  SELECT url, replace(regexp_extract(html, '(?is)<base\b[^>]*\bhref=["'']?([^"''\s>]+)', 1), '&amp;', '&') AS tag, unnest(
    regexp_extract_all(html, '(?is)<link\b[^>]*\brel=["'']?canonical\b[^>]*\bhref=["'']?([^"''\s>]+)', 1)
    || regexp_extract_all(html, '(?is)<link\b[^>]*\bhref=["'']?([^"''\s>]+)["'']?[^>]*\brel=["'']?canonical\b', 1)
    || regexp_extract_all(html, '(?is)<meta\b[^>]*\bhttp-equiv=["'']?refresh\b[^>]*\burl=["'']?([^"''\s>]+)', 1)
    || regexp_extract_all(html, '(?is)<meta\b[^>]*\burl=["'']?([^"''\s>]+)["'']?[^>]*\bhttp-equiv=["'']?refresh\b', 1)) AS raw
  FROM pages WHERE url IS NOT NULL),
bases AS (SELECT url, replace(raw, '&amp;', '&') AS link, CASE WHEN tag = '' THEN url ELSE coalesce(<tag>, url) END AS base FROM tags),
links AS (SELECT DISTINCT url AS a, <link> AS b FROM bases),
e AS (SELECT a, b FROM links WHERE contains(b, '://') AND a IS NOT NULL
  UNION SELECT b, a FROM links WHERE contains(b, '://') AND a IS NOT NULL),
reach(a, b) AS (SELECT a, a FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
u AS (SELECT url FROM pages WHERE url IS NOT NULL UNION SELECT a FROM e),
h AS (
  SELECT url, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM u),
m AS (
  SELECT url, rh || rp AS rule, action, row_number() OVER (
    PARTITION BY url ORDER BY length(rh) + length(rp) DESC, length(rh) DESC, action = 'allow' DESC) AS n
  FROM h JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)),
w AS (SELECT url, rule, action FROM m WHERE n = 1),
spread AS (
  SELECT reach.a AS url, bool_or(action = 'block') AND NOT bool_or(action = 'allow') AS by_alias
  FROM reach JOIN w ON reach.b = w.url GROUP BY reach.a)
SELECT p.page_id, coalesce(h.host, '') AS host, coalesce(h.path, '') AS path, w.rule,
  coalesce(w.action, CASE WHEN by_alias THEN 'block' END, 'allow') AS verdict
FROM pages p LEFT JOIN h ON p.url = h.url LEFT JOIN w ON p.url = w.url LEFT JOIN spread s ON p.url = s.url
""".replace("<tag>", _sql_resolved("tag", "url")).replace("<link>", _sql_resolved("link", "base"))

SQL_PRODUCTS = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.w, c.w)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

SQL_AUDIT = r"""
WITH l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
  FROM documents),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 10 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(d.doc_id > least, false)::INT AS mask
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
c AS (SELECT part, mask, good, toxic, count(*) AS n FROM m GROUP BY ALL),
f(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (
  SELECT filter_order, step, 1 << (ascii(filter_order[step]) - 65) AS own,
    coalesce(list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(filter_order[i]) - 65))), 0)::INT AS earlier
  FROM o, (SELECT unnest([1, 2, 3, 4, 5])::INT AS step)),
r AS (SELECT *, mask & own > 0 AS fails, mask & earlier > 0 AS gone FROM c, s)
SELECT part, filter_order, step,
  coalesce(sum(n) FILTER (WHERE NOT fails AND NOT gone), 0)::BIGINT AS kept,
  coalesce(sum(n) FILTER (WHERE fails AND NOT gone), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (WHERE fails AND gone), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (WHERE mask = own), 0)::BIGINT AS unique_fails,
  coalesce(sum(n) FILTER (WHERE fails AND NOT gone AND good = 1), 0)::BIGINT AS good_lost,
  coalesce(sum(n) FILTER (WHERE fails AND NOT gone AND toxic = 1), 0)::BIGINT AS toxic_lost,
  coalesce(sum(n * 120 // greatest(1, bit_count(mask))) FILTER (WHERE fails), 0)::BIGINT AS shapley
FROM r GROUP BY part, filter_order, step
"""

SQL_PHRASES = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
i AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
g AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM i, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE i + m - 1 <= len(w)),
f AS (SELECT lang, m, phrase, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
h AS (SELECT * FROM f WHERE a >= 100),
longer AS (
  SELECT lang, m, a, unnest(list_distinct(flatten([[array_to_string(s[x:y], ' ') FOR y IN range(x + 1, m + 1) IF y - x + 1 < m] FOR x IN range(1, m)]))) AS phrase
  FROM (SELECT *, string_split(phrase, ' ') AS s FROM h WHERE m > 2)),
covered AS (SELECT DISTINCT h.lang, h.phrase FROM h JOIN longer q ON h.lang = q.lang AND h.phrase = q.phrase WHERE 100 * q.a >= 100 * h.a),
c AS (
  SELECT lang, m, phrase, a, string_split(phrase, ' ') AS s, unnest(range(1, m)) AS k
  FROM h WHERE m > 1 AND NOT EXISTS (SELECT 1 FROM covered v WHERE v.lang = h.lang AND v.phrase = h.phrase)),
x AS (
  SELECT c.lang, c.phrase, c.a, c.k, l.a AS l, r.a AS r, n.n,
    (1000 * c.a::HUGEINT * n.n::HUGEINT // (l.a::HUGEINT * r.a::HUGEINT))::BIGINT AS score
  FROM c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(s[1:k], ' ') AND l.m = k
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(s[k + 1:], ' ') AND r.m = c.m - k
  JOIN n ON n.lang = c.lang),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM x)
SELECT * FROM (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM b WHERE place = 1)
WHERE rank <= 2000
"""

SQL: dict[str, str] = {"op1_source_mix": SQL_MIX, "op2_url_verdicts": SQL_URLS, "op11_top_products": SQL_PRODUCTS,
    "op12_filter_audit": SQL_AUDIT, "op13_phrase_collocations": SQL_PHRASES}

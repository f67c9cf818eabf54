"""One query for each operator, over the whole tables it is meant for, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txguard.llm import (
    bpe, decontaminate, divergence, embedding_dedup, html_text, jaccard_forest, language, license_scan, periodic_runs, quality, toxicity,
    url_filter, warc)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
         r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op4_decontaminate", f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS w FROM documents),
b AS (SELECT item_id, {WORDS} AS w FROM benchmark),
bw AS (SELECT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS gram
  FROM b, LATERAL unnest(range(1, len(w) - least(len(w), 13) + 2)) t(i) WHERE len(w) > 0),
dw AS (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM d, (SELECT DISTINCT n FROM bw) s, LATERAL unnest(range(1, len(w) - n + 2)) t(i)),
hit AS (SELECT DISTINCT rid, i, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.gram = bw.gram),
covered AS (SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT rid, i, n FROM hit), LATERAL unnest(range(i, i + n)) u(p) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN items USING (rid)""")
def op4(spark, folder):
    return decontaminate.scan(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("text_key")


@query("op8_url_filter")
def op8(spark, folder):
    return url_filter.judge(table(spark, folder, "pages"))


@query("op9_license_scan")
def op9(spark, folder):
    return license_scan.scan(table(spark, folder, "documents"))


def _components_sql(links: str, nodes: str, name: str) -> str:
    """Shared tail: number of links, smallest reachable id."""
    return f"""
reach AS (SELECT a AS x, a AS y FROM ({nodes}) UNION SELECT reach.x, l.b FROM reach JOIN {links} l ON l.a = reach.y),
least AS (SELECT x, min(y) AS component FROM reach GROUP BY x),
n AS (SELECT a, count(*) AS n FROM {links} GROUP BY a)"""


BASE32 = ("array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + "
          "((CAST('0x' || substr(sha1({0}), 1 + 5 * (i // 4), 5) AS INT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31), 1)), '')")


@query("op1_embedding_dedup", f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) > 0),
links AS (SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q
  ON p.vec_id <> q.vec_id AND list_cosine_similarity(p.e, q.e) >= 0.9),{_components_sql('links', 'SELECT vec_id AS a FROM embeddings', 'vec_id')}
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component AS component_id, vec_id = component AS kept
FROM embeddings JOIN least ON x = vec_id LEFT JOIN n ON n.a = vec_id""")
def op1(spark, folder):
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


@query("op2_quality")
def op2(spark, folder):
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op3_jaccard_join", f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS g
  FROM d, LATERAL unnest(range(1, len(w) - least(len(w), 5) + 2)) t(i) WHERE len(w) > 0),
size AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
pairs AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS common FROM s p JOIN s q ON p.g = q.g GROUP BY ALL),
alike AS (SELECT a, b, common, x.size AS m, y.size AS k FROM pairs JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE a <> b AND common >= 0.8 * (x.size + y.size - common)),
links AS (SELECT a, b FROM alike),
copies AS (SELECT a, min(b) AS copy FROM alike WHERE common = m AND common = k GROUP BY a),{_components_sql('links', 'SELECT doc_id AS a FROM documents', 'doc_id')}
SELECT doc_id, least(doc_id, coalesce(copy, doc_id)) AS copy_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links,
  component AS class_id, doc_id = component AS kept
FROM documents JOIN least ON x = doc_id LEFT JOIN n ON n.a = doc_id LEFT JOIN copies ON copies.a = doc_id""")
def op3(spark, folder):
    return jaccard_forest.near_duplicates(table(spark, folder, "documents")).drop("text_key")


@query("op5_language")
def op5(spark, folder):
    return language.identify(table(spark, folder, "documents"))


@query("op6_warc", f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
r AS (SELECT page_id, payload, max(page_id) OVER (PARTITION BY payload) AS largest FROM p)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, {BASE32.format('payload')} AS payload_digest,
  CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> largest THEN largest END AS refers_to FROM r""")
def op6(spark, folder):
    return warc.round_trip(table(spark, folder, "pages"))


@query("op7_html_text")
def op7(spark, folder):
    return html_text.extract(table(spark, folder, "pages"))


@query("op10_bpe")
def op10(spark, folder):
    import public_tokenizers

    return bpe.digests(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op13_source_audit", r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
e AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM e GROUP BY lang, term HAVING count(DISTINCT rid) >= 30),
c AS (SELECT lang, source, term, count(*) AS n FROM e SEMI JOIN kept USING (lang, term) GROUP BY ALL),
ls AS (SELECT lang, count(term) AS v, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang FROM d) LEFT JOIN kept USING (lang) GROUP BY lang),
gs AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT gs.lang, gs.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000 * (coalesce(c.n, 0) + 5)::HUGEINT) // (gs.total + 5 * ls.v) AS p,
    1 + (1000000000 * (k.n + 5)::HUGEINT) // (ls.total + 5 * ls.v) AS q
  FROM gs JOIN ls USING (lang) JOIN kept k USING (lang) LEFT JOIN c ON c.lang = gs.lang AND c.source = gs.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value
  FROM gs a JOIN gs b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source AS s, y.source AS t, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term
    AND x.source <> y.source GROUP BY ALL) x ON x.lang = a.lang AND x.s = a.source AND x.t = b.source),
every AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
WHERE part = 'pair' OR rank <= 50""")
def op13(spark, folder):
    return divergence.audit(table(spark, folder, "documents"))


@query("op11_toxicity")
def op11(spark, folder):
    return toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; a text whose id has a checksum that ends in 0 repeats, from some word on, the words that follow there.

    Rows without an id and texts without words stay as they are.
    """
    split = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    # Only the tenth of the texts that changes is split here.
    rows = rows.withColumn("w", F.when(F.col("h") % 10 == 0, split)).selectExpr("*", "h div 10 AS g", "size(w) AS n")
    rows = rows.selectExpr("*", "CASE WHEN n > 0 THEN g % n END AS a", "CASE WHEN n > 0 THEN 1 + (n - g % n) div (3 + g % 8) END AS p")
    again = "array_join(transform(sequence(0, n - 1), i -> get(w, CAST(IF(i >= a, a + (i - a) % p, i) AS INT))), ' ')"
    return rows.selectExpr("doc_id", f"CASE WHEN n > 0 THEN {again} ELSE text END AS text")


@query("op12_periodic_runs", r"""
WITH RECURSIVE raw AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w,
  CAST(doc_id AS VARCHAR) AS s FROM documents),
h AS (SELECT rid, doc_id, w, xor(4294967295, list_reduce(flatten(list_transform(range(1, len(s) + 1), lambda i:
    [CAST(unicode(substr(s, i, 1)) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])),
    lambda c, x: xor(xor(c, x) >> 1, CASE WHEN xor(c, x) & 1 = 1 THEN 3988292384 ELSE 0 END), 4294967295)) AS h FROM raw),
g AS (SELECT rid, doc_id, w, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN h // 10 END AS g FROM h),
a AS (SELECT *, g % n AS a, 1 + (n - g % n) // (3 + g % 8) AS p FROM g),
d AS (SELECT rid, doc_id, n, CASE WHEN g IS NULL THEN w ELSE list_transform(range(n), lambda i:
  w[1 + (CASE WHEN i >= a THEN a + (i - a) % p ELSE i END)]) END AS w FROM a),
e AS (SELECT rid, n, unnest(range(n)) AS i, unnest(w) AS t FROM d),
pairs AS (SELECT x.rid, x.i, y.i - x.i AS q FROM e x JOIN e y ON x.rid = y.rid AND x.t = y.t AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
islands AS (SELECT rid, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM pairs) GROUP BY rid, q, island),
runs AS (SELECT rid, start, length, min(q) AS period FROM islands WHERE length >= greatest(24, 3 * q) GROUP BY rid, start, length),
best AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY (CAST(length AS HUGEINT) * 1000000000000) // period DESC, start, period) AS nth FROM runs),
digest AS (SELECT rid, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS s FROM runs GROUP BY rid),
dropped AS (SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT e.rid, string_agg(t, ' ' ORDER BY e.i) AS s FROM e ANTI JOIN dropped ON e.rid = dropped.rid AND e.i = dropped.i GROUP BY e.rid)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length,
  CAST(period AS BIGINT) AS period, CAST(1000 * length // period AS BIGINT) AS exponent_milli,
  sha256(coalesce(digest.s, '')) AS runs_sha256, sha256(coalesce(kept.s, '')) AS collapsed_sha256
FROM d LEFT JOIN digest USING (rid) LEFT JOIN (SELECT * FROM best WHERE nth = 1) b USING (rid) LEFT JOIN kept USING (rid)""")
def op12(spark, folder):
    found = periodic_runs.find(with_planted_periods(table(spark, folder, "documents")), keep=["doc_id"])
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "strongest.start", "strongest.length", "strongest.period",
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))

"""The registered queries of the training-data operators, with production parameters, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import best_fit, decontaminate, html_extract, license_scan, line_dedup, ngram_join, quality_rules, sharding, token_counts, url_filters
from weftline.llm.common import table


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filters.url_filters(pages, url_filters.sample_list(pages))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.benchmark_decontamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.html_extraction(table(spark, sf_dir, "pages"))


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.best_fit_packing(table(spark, sf_dir, "documents"))


#: Arrivals that the sharding query makes of the documents, as a feed would bring them.
ARRIVALS = 21


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as it reads from the compacted store."""
    docs = table(spark, sf_dir, "documents")
    arrival = F.coalesce(F.pmod("doc_id", F.lit(ARRIVALS)), F.lit(0))
    back = sharding.sharded(docs.withColumn("arrival", arrival), F.col("arrival")).read()
    return back.select("doc_id", "arrival", "lang", "source", F.octet_length("text").cast("long").alias("n_bytes"), F.md5("text").alias("text_md5"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_jaccard_join(table(spark, sf_dir, "documents")).drop("node")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_filters,
        op2_quality_rules,
        op3_benchmark_decontamination,
        op4_html_extraction,
        op5_license_scans,
        op6_best_fit_packing,
        op7_sharding,
        op8_line_dedup,
        op9_ngram_jaccard_join,
        op10_token_counts,
    )
}

_HOST = r"coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')"
_PATH = r"coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '')"

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS3 = rf"coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"
_WORDS9 = rf"coalesce(regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+'), [])"

ORACLE_SQL: dict[str, str] = {
    "op3_benchmark_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS3} AS w FROM documents),
i AS (SELECT row_number() OVER () AS i, item_id, w FROM (SELECT DISTINCT item_id, text, {_WORDS3} AS w FROM benchmark)),
s AS (SELECT i, item_id, s, w[s + 1 : s + 13] AS win FROM (SELECT *, unnest(range(0, greatest(len(w) - 13, 0) + 1)) AS s FROM i WHERE len(w) > 0)),
lens AS (SELECT DISTINCT len(win) AS l FROM s),
dw AS (SELECT r, pos, l, array_to_string(w[pos : pos + l - 1], ' ') AS k FROM (SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS pos FROM d, lens WHERE len(w) >= l)),
m AS (SELECT DISTINCT r, pos, l, item_id FROM dw JOIN (SELECT DISTINCT item_id, len(win) AS l, array_to_string(win, ' ') AS k FROM s) USING (l, k)),
hit AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(pos, pos + l)) AS p FROM m) GROUP BY r),
ids AS (SELECT r, list_sort(list(DISTINCT CAST(item_id AS VARCHAR)) FILTER (item_id IS NOT NULL)) AS ids FROM m GROUP BY r),
p AS (SELECT r, t, pos FROM (SELECT r, unnest(w) AS t, generate_subscripts(w, 1) AS pos FROM d)),
sw AS (SELECT i, s, t, k, coalesce(n, 0) AS n FROM (SELECT i, s, unnest(win) AS t, generate_subscripts(win, 1) AS k FROM s) LEFT JOIN (SELECT t, count(*) AS n FROM p GROUP BY t) USING (t)),
rare AS (SELECT i, s, arg_min(t, (n, k)) AS t, count(DISTINCT t) AS need FROM sw GROUP BY i, s HAVING min(n) > 0),
c AS (SELECT i, s, need, r, pos AS c FROM rare JOIN p USING (t)),
near AS (SELECT r, count(DISTINCT i) AS n FROM (
  SELECT c.r, c.i FROM c JOIN (SELECT DISTINCT i, s, t FROM sw) q ON q.i = c.i AND q.s = c.s JOIN p ON p.r = c.r AND p.t = q.t AND abs(p.pos - c.c) <= {decontaminate.REACH}
  GROUP BY c.r, c.i, c.s, c.c, c.need HAVING count(DISTINCT q.t) = c.need) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(len(ids), 0) AS n_items, sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
  coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated, coalesce(near.n, 0) AS n_near
FROM d LEFT JOIN hit USING (r) LEFT JOIN ids USING (r) LEFT JOIN near USING (r)""",
    "op9_ngram_jaccard_join": f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS9} AS w FROM documents),
g AS (SELECT DISTINCT r, array_to_string(w[k : k + 3], ' ') AS g FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM g GROUP BY r),
e AS (SELECT a.r AS a, b.r AS b FROM g a JOIN g b ON a.g = b.g AND a.r < b.r JOIN n x ON x.r = a.r JOIN n y ON y.r = b.r GROUP BY a.r, b.r, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, coalesce(min(o.doc_id), d.doc_id) AS component_id FROM d LEFT JOIN n USING (r) JOIN reach ON reach.a = d.r JOIN d o ON o.r = reach.b GROUP BY d.r, d.doc_id""",
    "op1_url_filters": f"""
WITH p AS (SELECT page_id, {_HOST} AS host, {_PATH} AS path FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/7') THEN 'example.com/en/7'
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/de/8') THEN 'example.net/de/8'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/en/') THEN 'com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/de/') THEN 'net/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/es/') THEN 'org/es/' END AS rule,
    starts_with(md5(host || path), '0') AS listed
  FROM p)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('com/en/', 'example.net/de/8', 'org/es/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed
FROM r""",
    "op7_sharding": f"""
SELECT doc_id, coalesce(doc_id % {ARRIVALS}, 0) AS arrival, lang, source, strlen(text) AS n_bytes, md5(text) AS text_md5
FROM documents""",
}

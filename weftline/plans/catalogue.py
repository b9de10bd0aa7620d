"""The registered queries of the document-relation operators over the shared tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import text as X
from weftline.functions.fixed import POINT_LETTERS
from weftline.operators import graph, lookup, metrics, relations, sampling, spans

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Event types stand for relations in the queries over events.
GROUPS = (("purchase",), ("signup",), ("click", "view"))

# Clauses and text


def _clauses(spark: SparkSession, d: str) -> DataFrame:
    lines = read(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return lines.select("doc_id", "pos", F.trim("line").alias("clause")).where("clause <> ''")


_CLAUSES = r"""clauses AS (
  SELECT doc_id, pos, trim(line) AS clause FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents)
  WHERE trim(line) <> '')"""


@query(f"WITH {_CLAUSES} SELECT doc_id, CAST(pos AS INTEGER) AS pos, clause FROM clauses")
def clause_split(spark: SparkSession, d: str) -> DataFrame:
    return _clauses(spark, d)


@query(r"""
SELECT doc_id, list_aggregate(list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(regexp_replace(x, '[ \t]+', ' ', 'g'), ' ')), lambda x: x <> ''), 'string_agg', chr(10)) AS tidy
FROM (SELECT doc_id, regexp_replace(regexp_replace(text, '["“”](?:.|\n)*?["“”]', '', 'g'), '[''‘’](?:.|\n)*?[''‘’]', '', 'g') AS t FROM documents)
WHERE trim(replace(replace(t, chr(10), ''), chr(9), '')) <> ''""")
def text_clean_lines(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", X.drop_quoted(F.col("text")).alias("tidy")).where("tidy <> ''")


@query(r"""
SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '[ \n\t\r]+', ' ', 'g')) AS plain FROM pages""")
def html_strip(spark: SparkSession, d: str) -> DataFrame:
    bare = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " "), r"(?s)<[^>]*>", " ")
    return read(spark, d, "pages").select("page_id", F.trim(F.regexp_replace(bare, r"[ \n\t\r]+", " ")).alias("plain"))


@query(r"""
SELECT p_partkey, upper(regexp_replace(regexp_replace(translate(trim(p_brand || ' / ' || p_type), 'đĐ', 'dD'), '\s*([/-])\s*', '\1', 'g'), '\s+', '', 'g')) AS number FROM part""")
def number_fold(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "part").select("p_partkey", X.number_key(F.concat_ws(" / ", "p_brand", "p_type")).alias("number"))


@query(r"""
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS n, m AS mention FROM (
  SELECT doc_id, unnest(l) AS m, generate_subscripts(l, 1) AS i FROM (SELECT doc_id, regexp_extract_all(text, '[A-Za-z]+[0-9]+\.example\.com|[0-9]+/[0-9]+|version [0-9]') AS l FROM documents))""")
def mention_extract(spark: SparkSession, d: str) -> DataFrame:
    found = F.regexp_extract_all("text", F.lit(r"[A-Za-z]+[0-9]+\.example\.com|[0-9]+/[0-9]+|version [0-9]"), F.lit(0))
    return read(spark, d, "documents").select("doc_id", F.posexplode(found).alias("n", "mention"))


CUES = {"license": "[Ll]icen[sc]e", "rights": "rights reserved", "work": "This work", "the": "\\bthe\\b"}


@query("WITH " + ", ".join(f"c{k} AS (SELECT '{n}' AS cue, lang, length(regexp_extract_all(text, '{p}')) AS n FROM documents)" for k, (n, p) in enumerate(CUES.items())) + """
SELECT cue, lang, CAST(sum(n) AS BIGINT) AS n, CAST(count(*) FILTER (n > 0) AS BIGINT) AS docs FROM (""" + " UNION ALL ".join(f"SELECT * FROM c{k}" for k in range(len(CUES))) + ") GROUP BY cue, lang")
def cue_count(spark: SparkSession, d: str) -> DataFrame:
    each = F.array(*[F.struct(F.lit(n).alias("cue"), F.regexp_count("text", F.lit(p)).alias("n")) for n, p in CUES.items()])
    rows = read(spark, d, "documents").select("lang", F.explode(each).alias("c"))
    return rows.groupBy(F.col("c.cue").alias("cue"), "lang").agg(F.sum("c.n").alias("n"), F.count_if(F.col("c.n") > 0).alias("docs"))


@query()
def cue_overlap_fold(spark: SparkSession, d: str) -> DataFrame:
    """Longest-first removal of overlapping matches of several patterns."""
    text = read(spark, d, "documents").select("doc_id", F.split("text", " ").alias("w"))
    at = lambda words: F.transform(
        F.filter(F.sequence(F.lit(0), F.greatest(F.size("w") - words, F.lit(0))), lambda i: F.lower(F.coalesce(F.get("w", i), F.lit(""))).isin("the", "of", "and", "la", "de")),
        lambda i: F.struct(i.alias("start"), (i + words).alias("stop"), F.lit(words).alias("size")),
    )
    kept = spans.drop_overlaps(F.concat(at(1), at(2), at(3)))
    return text.select("doc_id", F.explode(kept).alias("s")).groupBy("doc_id").agg(F.count("*").alias("n"), F.sum("s.size").alias("words"))


@query(f"""WITH {_CLAUSES},
m AS (SELECT doc_id, pos, clause, strpos(clause, 'the ') AS i FROM clauses)
SELECT doc_id, CAST(pos AS INTEGER) AS pos, CAST(i AS INTEGER) AS "at", CASE WHEN regexp_matches(substr(clause, i + 4, 60), '[,.] *(and|of) ') THEN 'continued' WHEN regexp_matches(substr(clause, i + 4, 60), '[0-9]') THEN 'numbered' END AS reason
FROM m WHERE i > 0""")
def lookahead_guard(spark: SparkSession, d: str) -> DataFrame:
    """What follows a cue within 60 characters rejects it, with the first reason that holds."""
    found = _clauses(spark, d).withColumn("at", F.instr("clause", "the ")).where("at > 0")
    after = F.substring("clause", F.col("at") + 4, F.lit(60))
    return found.select("doc_id", "pos", "at", F.when(after.rlike("[,.] *(and|of) "), "continued").when(after.rlike("[0-9]"), "numbered").alias("reason"))


_NEAR = """e AS (SELECT *, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS s FROM events),
p AS (SELECT c.user_id, c.event_id AS cue, c.s AS cs, r.event_id AS ref, r.s AS rs, CASE WHEN r.s <= c.s THEN c.s - r.s END AS back, CASE WHEN r.s >= c.s THEN r.s - c.s END AS ahead
  FROM e c JOIN e r ON c.user_id = r.user_id AND c.event_type = 'purchase' AND r.event_type = 'error'),
q AS (SELECT *, min(back) OVER (PARTITION BY user_id, cue) AS mb, min(ahead) OVER (PARTITION BY user_id, cue) AS ma FROM p),
t AS (SELECT *, CASE WHEN mb IS NOT NULL AND (ma IS NULL OR mb <= ma) THEN 'back' WHEN ma IS NOT NULL THEN 'ahead' END AS side FROM q)"""


def _events(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").withColumn("s", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000))


@query(f"""WITH {_NEAR}, u AS (SELECT user_id, cue, ref, side, CASE WHEN side = 'back' THEN back ELSE ahead END AS distance, rs FROM t WHERE CASE WHEN side = 'back' THEN back ELSE ahead END IS NOT NULL)
SELECT user_id, cue, ref, side, distance, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id, cue ORDER BY distance, ref) AS rank FROM u) WHERE rank <= 2""")
def nearest_mention(spark: SparkSession, d: str) -> DataFrame:
    """The two nearest errors on the nearer side of each purchase of a user; ties go to the side before."""
    e = _events(spark, d)
    cue = e.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("cue"), F.col("s").alias("cs"))
    ref = e.where("event_type = 'error'").select("user_id", F.col("event_id").alias("ref"), F.col("s").alias("rs"))
    return spans.nearest_refs(cue, ref, ["user_id"], "cue", "cs", "ref", "rs", 2).select("user_id", "cue", "ref", "side", "distance", "rank")


@query("""WITH c AS (SELECT user_id, event_id AS cue, ts AS at, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS fence FROM events WHERE event_type = 'signup')
SELECT c.user_id, cue, e.event_id AS ref FROM c JOIN events e ON e.user_id = c.user_id AND e.event_type = 'click' AND e.ts > c.at AND (c.fence IS NULL OR e.ts < c.fence)""")
def fence_range_join(spark: SparkSession, d: str) -> DataFrame:
    """Clicks between a user's sign-up and the next one."""
    e = read(spark, d, "events")
    cues = e.where("event_type = 'signup'").select("user_id", F.col("event_id").alias("cue"), F.col("ts").alias("cue_at"))
    refs = e.where("event_type = 'click'").select("user_id", F.col("event_id").alias("ref"), F.col("ts").alias("ref_at"))
    return spans.forward_targets(cues, refs, ["user_id"], "cue_at", "ref_at", "cue").select("user_id", "cue", "ref")


@query("""WITH g AS (SELECT user_id, event_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events),
i AS (SELECT *, sum(CASE WHEN b IS NULL THEN 0 WHEN epoch_us(ts) - epoch_us(b) > 7200000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM g)
SELECT user_id, CAST(island AS BIGINT) AS island, count(*) AS n, min(event_id) AS first_event FROM i GROUP BY user_id, island""")
def cluster_islands(spark: SparkSession, d: str) -> DataFrame:
    """Runs of a user's events with gaps of two hours at most."""
    gap = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("_before").cast("timestamp")) > 7_200_000_000
    runs = spans.islands(read(spark, d, "events"), ["user_id"], ["ts", "event_id"], gap)
    return runs.groupBy("user_id", "island").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))


@query("""SELECT conv_id, turn, role, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn, role ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS asked_at FROM conversations""")
def conversation_context(spark: SparkSession, d: str) -> DataFrame:
    """The nearest earlier turn of the user, for each turn."""
    turns = read(spark, d, "conversations").withColumn("_asked", F.when(F.col("role") == "user", F.col("turn")))
    return spans.nearest_before(turns, ["conv_id"], ["turn", "role"], "_asked", "asked_at").select("conv_id", "turn", "role", "asked_at")


# Keys and hierarchy


def _keyed(spark: SparkSession, d: str) -> DataFrame:
    """Line items with a clause key: order as article, line as clause, and a point for every third part."""
    point = F.get(F.array(*map(F.lit, POINT_LETTERS.split())), F.pmod("l_partkey", F.lit(23)).cast("int"))
    key = X.compose_key(F.when(F.col("l_partkey") % 3 == 0, point), F.col("l_linenumber").cast("string"), F.pmod("l_orderkey", F.lit(50)).cast("string"))
    return read(spark, d, "lineitem").select(F.floor(F.col("l_orderkey") / 50).alias("doc"), key.alias("key"), "l_orderkey", "l_linenumber", "l_partkey")


_LETTERS = "string_split('" + POINT_LETTERS + "', ' ')"
_KEYED = f"""keyed AS (SELECT CAST(floor(l_orderkey / 50) AS BIGINT) AS doc, CASE WHEN l_partkey % 3 = 0 THEN 'diem_' || {_LETTERS}[l_partkey % 23 + 1] || '_' ELSE '' END
  || 'khoan_' || l_linenumber || '_dieu_' || (l_orderkey % 50) AS key FROM lineitem)"""


@query(f"""WITH {_KEYED}
SELECT DISTINCT key, CASE WHEN key LIKE 'diem%' THEN regexp_replace(key, '^diem_[^_]+_', '') ELSE regexp_replace(key, '^khoan_[^_]+_', '') END AS graph_parent,
  CASE WHEN key LIKE 'diem%' THEN regexp_replace(key, '^diem_[^_]+_', '') ELSE regexp_replace(key, '^khoan_[^_]+_', '') END AS extract_parent,
  CASE WHEN key LIKE 'diem%' THEN 'Điểm ' || split_part(key, '_', 2) || ' Khoản ' || split_part(key, '_', 4) || ' Điều ' || split_part(key, '_', 6) ELSE 'Khoản ' || split_part(key, '_', 2) || ' Điều ' || split_part(key, '_', 4) END AS label FROM keyed""")
def parent_key_parse(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("key")
    return _keyed(spark, d).select("key", X.graph_parent_key(key).alias("graph_parent"), X.extract_parent_candidate(key).alias("extract_parent"), X.readable_key(key).alias("label")).distinct()


@query(f"""WITH {_KEYED}, k AS (SELECT DISTINCT doc, key FROM keyed)
SELECT doc, CAST(count(*) AS BIGINT) AS edges, CAST(count(DISTINCT head) AS BIGINT) AS heads FROM (
  SELECT doc, CASE WHEN key LIKE 'diem%' THEN regexp_replace(key, '^diem_[^_]+_', '') ELSE regexp_replace(key, '^khoan_[^_]+_', '') END || '#' || doc AS head, key || '#' || doc AS tail FROM k) GROUP BY doc""")
def clause_containment(spark: SparkSession, d: str) -> DataFrame:
    edges = graph.containment(_keyed(spark, d), "doc", "key")
    return edges.groupBy(graph.doc_of(F.col("tail")).cast("long").alias("doc")).agg(F.count("*").alias("edges"), F.count_distinct("head").alias("heads"))


@query(f"""WITH {_KEYED}, k AS (SELECT DISTINCT doc, key FROM keyed),
a AS (SELECT doc, key, CASE WHEN key LIKE 'diem%' THEN [regexp_replace(key, '^diem_[^_]+_', ''), regexp_replace(regexp_replace(key, '^diem_[^_]+_', ''), '^khoan_[^_]+_', '')] ELSE [regexp_replace(key, '^khoan_[^_]+_', '')] END AS up FROM k)
SELECT CAST(doc AS VARCHAR) AS doc, CAST(depth AS INTEGER) AS depth, count(*) AS n FROM (SELECT doc, unnest(generate_series(1, len(up) + 1)) AS depth FROM a) GROUP BY doc, depth""")
def inserted_ancestors(spark: SparkSession, d: str) -> DataFrame:
    edges = graph.inserted_edges(_keyed(spark, d).select("doc", "key").distinct(), "doc", "key")
    return edges.groupBy(graph.doc_of(F.col("tail")).alias("doc"), "depth").agg(F.count("*").alias("n"))


_TREE = """edges AS (
  SELECT 'r#' || n_regionkey AS head, 'n#' || n_nationkey AS tail FROM nation UNION ALL
  SELECT 'n#' || c_nationkey, 'c#' || c_custkey FROM customer UNION ALL
  SELECT 'c#' || o_custkey, 'o#' || o_orderkey FROM orders)"""


def _tree(spark: SparkSession, d: str) -> DataFrame:
    made = None
    for name, top, head, low, tail in (("nation", "r", "n_regionkey", "n", "n_nationkey"), ("customer", "n", "c_nationkey", "c", "c_custkey"), ("orders", "c", "o_custkey", "o", "o_orderkey")):
        part = read(spark, d, name).select(F.concat(F.lit(f"{top}#"), head).alias("head"), F.concat(F.lit(f"{low}#"), tail).alias("tail"))
        made = part if made is None else made.unionByName(part)
    return made


@query(f"WITH {_TREE} SELECT head, tail FROM edges")
def containment_edges(spark: SparkSession, d: str) -> DataFrame:
    return _tree(spark, d)


@query(f"""WITH RECURSIVE {_TREE}, w(start, node, hops) AS (
  SELECT 'r#' || r_regionkey, 'r#' || r_regionkey, 0 FROM region UNION ALL SELECT start, tail, hops + 1 FROM w JOIN edges ON head = node WHERE hops < 3)
SELECT start, CAST(hops AS INTEGER) AS hops, count(DISTINCT node) AS nodes FROM w GROUP BY start, hops""")
def descendant_closure(spark: SparkSession, d: str) -> DataFrame:
    starts = read(spark, d, "region").select(F.concat(F.lit("r#"), "r_regionkey").alias("node"))
    return graph.closure(_tree(spark, d), starts, 3).groupBy("start", "hops").agg(F.count("*").alias("nodes"))


# Relations between orders, parts and suppliers

RELATION_OF = {"A": "bai_bo", "N": "dan_chieu", "R": "sua_doi"}
INFER = {"bai_bo": "sua_doi_bo_sung", "sua_doi": "sua_doi_bo_sung"}


def _clause_relations(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("source"), F.pmod("l_partkey", F.lit(100)).alias("target"), relations.mapped(F.col("l_returnflag"), RELATION_OF).alias("relation"), F.col("l_linenumber").cast("string").alias("key")
    )


_CLAUSE_RELATIONS = """r AS (SELECT l_suppkey AS source, l_partkey % 100 AS target, CASE l_returnflag WHEN 'A' THEN 'bai_bo' WHEN 'N' THEN 'dan_chieu' WHEN 'R' THEN 'sua_doi' END AS relation, CAST(l_linenumber AS VARCHAR) AS key FROM lineitem),
i AS (SELECT source, target, CASE WHEN relation IN ('bai_bo', 'sua_doi') THEN 'sua_doi_bo_sung' ELSE relation END AS inferred, relation, CAST(count(DISTINCT key) AS BIGINT) AS n, string_agg(DISTINCT key, ',' ORDER BY key) AS keys FROM r GROUP BY ALL)"""


@query(f"WITH {_CLAUSE_RELATIONS} SELECT source, target, inferred, relation, n, keys FROM i")
def inferred_rollup(spark: SparkSession, d: str) -> DataFrame:
    return relations.inferred(_clause_relations(spark, d), INFER, "source", "target", "relation", "key")


@query(f"WITH {_CLAUSE_RELATIONS} SELECT source, target, inferred, string_agg(DISTINCT relation, ',' ORDER BY relation) AS relations, CAST(sum(n) AS BIGINT) AS n FROM i GROUP BY source, target, inferred")
def inferred_merge(spark: SparkSession, d: str) -> DataFrame:
    return relations.merged_inferred(inferred_rollup(spark, d), "source", "target", "relation")


@query("""WITH r AS (SELECT *, CASE WHEN event_type = 'purchase' THEN 0 WHEN event_type = 'signup' THEN 1 WHEN event_type IN ('click', 'view') THEN 2 END AS k FROM events)
SELECT event_id, user_id, event_type FROM (SELECT *, min(k) OVER (PARTITION BY user_id, date_trunc('hour', ts)) AS m FROM r) WHERE k IS NULL OR k = m""")
def conflict_priority(spark: SparkSession, d: str) -> DataFrame:
    hourly = read(spark, d, "events").withColumn("hour", F.date_trunc("hour", "ts"))
    return relations.strongest_group(hourly, ["user_id", "hour"], "event_type", GROUPS).select("event_id", "user_id", "event_type")


@query("""SELECT l_orderkey, l_suppkey, l_partkey, l_linenumber, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY CASE l_returnflag WHEN 'R' THEN 80 WHEN 'A' THEN 90 ELSE 20 END DESC, l_linenumber, l_partkey, l_extendedprice) AS n FROM lineitem) WHERE n = 1""")
def best_relation(spark: SparkSession, d: str) -> DataFrame:
    priority = F.coalesce(relations.mapped(F.col("l_returnflag"), {"R": 80, "A": 90}), F.lit(20))
    best = relations.best_relation(read(spark, d, "lineitem"), ["l_orderkey", "l_suppkey"], priority, [F.col("l_linenumber"), F.col("l_partkey"), F.col("l_extendedprice")])
    return best.select("l_orderkey", "l_suppkey", "l_partkey", "l_linenumber", "l_quantity")


@query("""SELECT l_suppkey, l_partkey, min(l_orderkey) AS first_order, count(*) AS n, round(sum(l_quantity), 2) AS quantity, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags FROM lineitem GROUP BY l_suppkey, l_partkey""")
def edge_dedup_merge(spark: SparkSession, d: str) -> DataFrame:
    return relations.merged_edges(
        read(spark, d, "lineitem"),
        ["l_suppkey", "l_partkey"],
        {"first_order": ("l_orderkey", "l_orderkey")},
        n=F.count("*"),
        quantity=F.round(F.sum("l_quantity"), 2),
        flags=F.array_join(F.array_sort(F.collect_set("l_returnflag")), ","),
    )


@query("""SELECT l_suppkey, l_partkey, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n = 1""")
def edge_first_wins(spark: SparkSession, d: str) -> DataFrame:
    return relations.first_edges(read(spark, d, "lineitem"), ["l_suppkey", "l_partkey"], ["l_orderkey", "l_linenumber"]).select("l_suppkey", "l_partkey", "l_orderkey", "l_linenumber")


LIST_KEYS = {"click": ("dan_chieu", False), "purchase": ("thay_the", True), "error": ("bai_bo", True), "signup": ("huong_dan", False)}


def _curated(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").withColumn("other", F.pmod("event_id", F.lit(97)))
    return relations.directed(e, LIST_KEYS, "event_type", "user_id", "other")


_CURATED = """cur AS (SELECT event_id, CASE event_type WHEN 'click' THEN 'dan_chieu' WHEN 'purchase' THEN 'thay_the' WHEN 'error' THEN 'bai_bo' WHEN 'signup' THEN 'huong_dan' END AS rel_type,
  CASE WHEN event_type IN ('purchase', 'error') THEN event_id % 97 ELSE user_id END AS head, CASE WHEN event_type IN ('purchase', 'error') THEN user_id ELSE event_id % 97 END AS tail
  FROM events WHERE event_type <> 'view')"""


@query(f"WITH {_CURATED} SELECT event_id, head, rel_type, tail FROM cur")
def direction_flip(spark: SparkSession, d: str) -> DataFrame:
    return _curated(spark, d).select("event_id", "head", "rel_type", "tail")


@query("""SELECT DISTINCT e.user_id, e.event_type FROM events e WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = e.user_id AND o.o_orderstatus = 'P')""")
def source_precedence(spark: SparkSession, d: str) -> DataFrame:
    """Curated pairs that no derived one covers."""
    derived = read(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("user_id"))
    return relations.without(derived, read(spark, d, "events"), ["user_id"]).select("user_id", "event_type").distinct()


@query(f"""WITH {_CURATED}, s AS (SELECT o_custkey % 150 AS head, o_orderkey % 97 AS tail, CASE o_orderstatus WHEN 'F' THEN 'dan_chieu' WHEN 'O' THEN 'huong_dan' ELSE 'bai_bo' END AS rel_type FROM orders)
SELECT event_id, head, rel_type, tail FROM cur c WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.head = c.head AND s.tail = c.tail AND s.rel_type <> c.rel_type)""")
def stored_conflict(spark: SparkSession, d: str) -> DataFrame:
    """Curated edges whose ends have no stored edge of another relation."""
    rel = F.when(F.col("o_orderstatus") == "F", "dan_chieu").when(F.col("o_orderstatus") == "O", "huong_dan").otherwise("bai_bo")
    held = read(spark, d, "orders").select(F.pmod("o_custkey", F.lit(150)).alias("head"), F.pmod("o_orderkey", F.lit(97)).alias("tail"), rel.alias("rel_type"))
    return relations.without_other_group(held, _curated(spark, d), ["head", "tail"], "rel_type").select("event_id", "head", "rel_type", "tail")


# Resolution


@query("""WITH u AS (SELECT p_name, p_brand, min(p_partkey) AS p_partkey FROM part GROUP BY p_name, p_brand HAVING count(DISTINCT p_partkey) = 1)
SELECT l_orderkey, l_linenumber, l_partkey, u.p_partkey AS resolved FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey LEFT JOIN u ON u.p_name = p.p_name AND u.p_brand = p.p_brand""")
def exact_number_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Line items' parts looked up by name and brand; ambiguous ones resolve to nothing."""
    part = read(spark, d, "part")
    refs = read(spark, d, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", "l_partkey", "p_name", "p_brand")
    table = part.select("p_name", "p_brand", F.col("p_partkey").alias("resolved"))
    return lookup.resolved(refs, table, ["p_name", "p_brand"], "resolved").select("l_orderkey", "l_linenumber", "l_partkey", "resolved")


@query("""WITH a AS (SELECT p_name, p_brand, p_size, min(p_partkey) AS t FROM part GROUP BY ALL HAVING count(DISTINCT p_partkey) = 1), b AS (SELECT p_name, p_brand, min(p_partkey) AS t FROM part GROUP BY ALL HAVING count(DISTINCT p_partkey) = 1)
SELECT p.p_partkey, coalesce(b.t, a.t) AS target FROM part p LEFT JOIN b USING (p_name, p_brand) LEFT JOIN a USING (p_name, p_brand, p_size)""")
def priority_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The first of two tables that gives one target."""
    part = read(spark, d, "part")
    table = part.select("p_name", "p_brand", "p_size", F.col("p_partkey").alias("target"))
    return lookup.resolved_in_order(part, [(table, ["p_name", "p_brand"]), (table, ["p_name", "p_brand", "p_size"])], "target").select("p_partkey", "target")


@query("""WITH t AS (SELECT DISTINCT p_name, p_type, p_brand, p_name || ' ' || p_type || ' ' || p_brand AS title FROM part),
k AS (SELECT title, list_distinct(list_filter(regexp_split_to_array(lower(title), '[^a-z0-9]+'), lambda x: x <> '')) AS s FROM t),
j AS (SELECT a.title, b.title AS other FROM k a JOIN k b ON a.title <> b.title AND len(list_intersect(a.s, b.s)) * 1.0 / len(list_distinct(a.s || b.s)) >= 0.6)
SELECT title, min(other) AS found FROM j GROUP BY title HAVING count(*) = 1""")
def title_fuzzy_unique(spark: SparkSession, d: str) -> DataFrame:
    """Titles that have just one other title with a token Jaccard of 0.6 or more."""
    titles = read(spark, d, "part").select(F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("title")).distinct()
    a = titles.withColumn("toks", X.tokens(F.col("title")))
    b = a.select(F.col("title").alias("found"), F.col("toks").alias("found_toks"))
    return lookup.fuzzy_unique(a, b, "toks", "found_toks", "title", "found", 0.6, proper=True)


@query("""WITH v AS (SELECT o_custkey, year(o_orderdate) AS y, max(o_orderkey) AS ok FROM orders GROUP BY ALL), r AS (SELECT o_orderkey, o_custkey, year(o_orderdate) - 1 AS y FROM orders)
SELECT r.o_orderkey, CAST(r.y AS INTEGER) AS ref_year, CAST(max(v.y) AS INTEGER) AS year, arg_max(v.ok, v.y) AS value FROM r LEFT JOIN v ON v.o_custkey = r.o_custkey AND v.y <= r.y GROUP BY r.o_orderkey, r.y""")
def asof_year(spark: SparkSession, d: str) -> DataFrame:
    """For each order the customer's last order of the year before, or the latest earlier year."""
    o = read(spark, d, "orders")
    versions = o.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(F.max("o_orderkey").alias("value"))
    refs = o.select("o_orderkey", "o_custkey", (F.year("o_orderdate") - 1).alias("ref_year"))
    return lookup.as_of(refs, versions, ["o_custkey"], "ref_year", "year", "value").select("o_orderkey", "ref_year", "year", "value")


@query("""WITH i AS (SELECT DISTINCT p_type, p_brand AS id FROM part) SELECT a.p_type, a.id AS bare, min(b.id) AS variant FROM i a JOIN i b ON a.p_type = b.p_type AND starts_with(b.id, a.id) AND a.id <> b.id GROUP BY ALL HAVING count(*) = 1""")
def variant_prefix_unique(spark: SparkSession, d: str) -> DataFrame:
    """The only longer brand of the same type that starts with a brand."""
    ids = read(spark, d, "part").select("p_type", F.col("p_brand").alias("variant")).distinct()
    refs = ids.select("p_type", F.col("variant").alias("bare"))
    return lookup.prefix_unique(refs, ids, ["p_type"], "bare", "variant", proper=True).where("variant IS NOT NULL")


# Graph maintenance


@query("""SELECT o_orderkey, o_custkey, CASE WHEN c.c_custkey IS NULL THEN 'missing_source' WHEN p.p_partkey IS NULL THEN 'missing_target' WHEN p_brand <> 'Brand#' || (o_orderkey % 25) THEN 'unexpected_number' END AS reason
FROM orders LEFT JOIN customer c ON c.c_custkey = o_custkey AND c_acctbal > 0 LEFT JOIN part p ON p.p_partkey = o_orderkey % 3000""")
def endpoint_partition(spark: SparkSession, d: str) -> DataFrame:
    """Edges that may be written (no reason) and those that may not, with the first reason."""
    edges = read(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), F.pmod("o_orderkey", F.lit(3000)).alias("p_partkey"))
    heads, tails = read(spark, d, "customer").where("c_acctbal > 0").select("c_custkey"), read(spark, d, "part").select("p_partkey", "p_brand")
    odd = F.col("p_brand") != F.concat(F.lit("Brand#"), F.pmod("o_orderkey", F.lit(25)))
    return graph.checked_edges(edges, heads, tails, "c_custkey", "p_partkey", [(odd, "unexpected_number")]).select("o_orderkey", F.col("c_custkey").alias("o_custkey"), "reason")


@query("""SELECT coalesce(o.k, c.c_custkey) AS k, coalesce(o.name, c_name) AS name, coalesce(o.seg, c_mktsegment) AS seg FROM (SELECT o_custkey AS k, NULL::VARCHAR AS name, max(CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END) AS seg FROM orders GROUP BY o_custkey) o FULL JOIN customer c ON c.c_custkey = o.k""")
def skeleton_heal(spark: SparkSession, d: str) -> DataFrame:
    """Bare nodes filled from their source, missing ones added."""
    nodes = read(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.lit(None).cast("string").alias("name"), F.max(F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority"))).alias("seg"))
    source = read(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("seg"))
    return graph.healed(nodes, source, "k", ["name", "seg"])


@query("""SELECT p_partkey FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 45) AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = p_partkey AND o_orderstatus = 'F')""")
def orphan_nodes(spark: SparkSession, d: str) -> DataFrame:
    edges = read(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("head"), F.col("l_partkey").alias("tail"))
    more = read(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("head"), F.lit(None).cast("long").alias("tail"))
    heads = more.select("head", "tail").unionByName(edges.select(F.lit(None).cast("long").alias("head"), "tail"))
    return graph.orphans(read(spark, d, "part").select("p_partkey"), "p_partkey", heads, ["head", "tail"])


@query("""WITH e AS (SELECT DISTINCT o_orderkey AS k, o_orderkey % 7 + 1 AS n FROM orders), a AS (SELECT DISTINCT l_orderkey AS k, CAST(l_linenumber AS BIGINT) AS n FROM lineitem)
SELECT state, count(*) AS n FROM (SELECT CASE WHEN a.k IS NULL THEN 'missing' WHEN e.k IS NULL THEN 'extra' ELSE 'matched' END AS state FROM e FULL JOIN a ON e.k = a.k AND e.n = a.n) GROUP BY state""")
def reconcile_edges(spark: SparkSession, d: str) -> DataFrame:
    expected = read(spark, d, "orders").select(F.col("o_orderkey").alias("k"), (F.pmod("o_orderkey", F.lit(7)) + 1).alias("n"))
    actual = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").cast("long").alias("n"))
    return graph.reconciled(expected, actual, ["k", "n"]).groupBy("state").agg(F.count("*").alias("n"))


_HEAD_KEYS = {"dan_chieu": "van_ban_dan_chieu", "huong_dan": "van_ban_duoc_huong_dan", "thay_the": "van_ban_bi_thay_the", "bai_bo": "van_ban_bi_bai_bo"}
_TAIL_KEYS = {"huong_dan": "van_ban_huong_dan", "thay_the": "van_ban_thay_the", "bai_bo": "van_ban_bai_bo"}


@query(f"""WITH {_CURATED}, x AS (
  SELECT head AS node, CASE rel_type WHEN 'dan_chieu' THEN 'van_ban_dan_chieu' WHEN 'huong_dan' THEN 'van_ban_duoc_huong_dan' WHEN 'thay_the' THEN 'van_ban_bi_thay_the' ELSE 'van_ban_bi_bai_bo' END AS key, tail AS other FROM cur WHERE head <> tail
  UNION SELECT tail, CASE rel_type WHEN 'huong_dan' THEN 'van_ban_huong_dan' WHEN 'thay_the' THEN 'van_ban_thay_the' ELSE 'van_ban_bai_bo' END, head FROM cur WHERE head <> tail AND rel_type <> 'dan_chieu')
SELECT node, key, string_agg(CAST(other AS VARCHAR), ',' ORDER BY other) AS ids FROM x GROUP BY node, key""")
def relation_export(spark: SparkSession, d: str) -> DataFrame:
    return graph.exported(_curated(spark, d), _HEAD_KEYS, _TAIL_KEYS)


@query("""SELECT user_id, event_id, event_type, round(value, 4) AS value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1""")
def latest_node(spark: SparkSession, d: str) -> DataFrame:
    nodes = read(spark, d, "events").select("user_id", F.struct("ts", "event_id").alias("at"), "event_type", F.round("value", 4).alias("value"))
    return graph.latest_nodes(nodes, "user_id", "at").select("user_id", "at.event_id", "event_type", "value")


@query("""WITH RECURSIVE e AS (SELECT 'r#' || n_regionkey AS head, 'n#' || n_nationkey AS tail, 'bao_gom' AS rel_type FROM nation UNION ALL SELECT 'n#' || c_nationkey, 'c#' || c_custkey, 'bao_gom' FROM customer UNION ALL SELECT 'c#' || o_custkey, 'o#' || o_orderkey, 'dan_chieu' FROM orders),
w(node, hops) AS (SELECT 'r#0', 0 UNION SELECT tail, hops + 1 FROM w JOIN e ON head = node AND rel_type = 'bao_gom' WHERE hops < 4)
SELECT rel_type, count(*) AS n FROM e WHERE rel_type = 'bao_gom' OR head NOT IN (SELECT node FROM w) GROUP BY rel_type""")
def reset_host(spark: SparkSession, d: str) -> DataFrame:
    """What is left when one region's outgoing relations are reset."""
    tree = _tree(spark, d).withColumn("rel_type", F.when(F.col("head").startswith("c#"), "dan_chieu").otherwise("bao_gom"))
    hosts = read(spark, d, "region").where("r_regionkey = 0").select(F.concat(F.lit("r#"), "r_regionkey").alias("node"))
    return graph.reset(tree, hosts, ("bao_gom",)).groupBy("rel_type").agg(F.count("*").alias("n"))


# Metrics


def _judged(spark: SparkSession, d: str) -> DataFrame:
    """Labels with two systems' verdicts and a score, from plain properties of the documents."""
    docs = read(spark, d, "documents").select("doc_id", "lang", "source", "n_chars", F.regexp_count("text", F.lit("[*$%&#|!]")).alias("marks"))
    judged = read(spark, d, "labels").join(docs, "doc_id")
    return judged.select("doc_id", "lang", "source", (F.col("quality") == 1).alias("gold"), (F.col("marks") * 20 < F.col("n_chars")).alias("a"), (F.col("n_chars") > 400).alias("b"), F.floor(1000.0 * F.col("marks") / F.greatest("n_chars", F.lit(1))).alias("score"))


_JUDGED = """j AS (SELECT doc_id, lang, source, quality = 1 AS gold, marks * 20 < n_chars AS a, n_chars > 400 AS b, CAST(floor(1000.0 * marks / greatest(n_chars, 1)) AS BIGINT) AS score
  FROM labels JOIN (SELECT doc_id, lang, source, n_chars, len(regexp_extract_all(text, '[*$%&#|!]')) AS marks FROM documents) USING (doc_id))"""


@query(f"""WITH {_JUDGED}, s AS (SELECT lang, source, sum(CASE WHEN gold AND a THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN NOT gold AND a THEN 1 ELSE 0 END) AS fp, sum(CASE WHEN gold AND NOT a THEN 1 ELSE 0 END) AS fn FROM j GROUP BY GROUPING SETS ((), (lang), (source)))
SELECT lang, source, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END, 6) AS precision, round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END, 6) AS recall, round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END, 6) AS f1 FROM s""")
def prf_by_group(spark: SparkSession, d: str) -> DataFrame:
    return metrics.scores(_judged(spark, d), F.col("gold"), F.col("a"), [[], ["lang"], ["source"]])


@query(f"""WITH {_JUDGED}, s AS (SELECT lang, CAST(count(*) FILTER (gold) AS DOUBLE) AS k, CAST(count(*) AS DOUBLE) AS n FROM j GROUP BY lang), z AS (SELECT 1.959963984540054 AS z)
SELECT lang, round(k / n, 4) AS point, round(greatest(0.0, ((k / n + z * z / (2 * n)) - z * sqrt((k / n * (1 - k / n) + z * z / (4 * n)) / n)) / (1 + z * z / n)), 4) AS low, round(least(1.0, ((k / n + z * z / (2 * n)) + z * sqrt((k / n * (1 - k / n) + z * z / (4 * n)) / n)) / (1 + z * z / n)), 4) AS high FROM s, z""")
def wilson_ci(spark: SparkSession, d: str) -> DataFrame:
    got = _judged(spark, d).groupBy("lang").agg(F.count_if("gold").alias("k"), F.count("*").alias("n"))
    return got.select("lang", *[F.round(c, 4).alias(n) for c, n in zip(metrics.wilson(F.col("k"), F.col("n")), ("point", "low", "high"), strict=True)])


@query(f"""WITH {_JUDGED}, s AS (SELECT lang, count(*) FILTER ((a = gold) AND (b <> gold)) AS only_a, count(*) FILTER ((a <> gold) AND (b = gold)) AS only_b FROM j GROUP BY lang)
SELECT lang, only_a, only_b, round(CASE WHEN only_a + only_b > 0 THEN (abs(only_a - only_b) - 1) * (abs(only_a - only_b) - 1) / (only_a + only_b) ELSE 0.0 END, 4) AS chi2 FROM s""")
def mcnemar_chi2(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.col("a") == F.col("gold"), F.col("b") == F.col("gold")
    got = _judged(spark, d).groupBy("lang").agg(F.count_if(a & ~b).alias("only_a"), F.count_if(~a & b).alias("only_b"))
    return got.withColumn("chi2", F.round(metrics.mcnemar_chi2(F.col("only_a"), F.col("only_b")), 4))


@query()
def mcnemar_p(spark: SparkSession, d: str) -> DataFrame:
    got = mcnemar_chi2(spark, d)
    return got.withColumn("p", F.round(metrics.chi2_p_value(F.col("chi2")), 6))


@query(f"""WITH {_JUDGED}, e AS (SELECT *, CASE WHEN a AND NOT gold THEN 'fp' WHEN gold AND NOT a THEN 'fn' END AS kind FROM j)
SELECT lang, kind, doc_id, n FROM (SELECT lang, kind, doc_id, count(*) OVER (PARTITION BY lang, kind) AS n, row_number() OVER (PARTITION BY lang, kind ORDER BY doc_id) AS r FROM e WHERE kind IS NOT NULL) WHERE r <= 5""")
def error_samples(spark: SparkSession, d: str) -> DataFrame:
    """Errors by kind, with five examples of each: the report's stated size."""
    kind = F.when(F.col("a") & ~F.col("gold"), "fp").when(F.col("gold") & ~F.col("a"), "fn")
    errors = _judged(spark, d).withColumn("kind", kind).where("kind IS NOT NULL")
    counts = errors.groupBy("lang", "kind").agg(F.count("*").alias("n"))
    return sampling.capped(errors, ["lang", "kind"], ["doc_id"], 5).join(counts, ["lang", "kind"]).select("lang", "kind", "doc_id", "n")


@query(f"""WITH {_JUDGED} SELECT lang, CASE WHEN a = gold AND b = gold THEN 'kept' WHEN a = gold THEN 'broken' WHEN b = gold THEN 'fixed' ELSE 'wrong' END AS change, count(*) AS n FROM j GROUP BY ALL""")
def system_transitions(spark: SparkSession, d: str) -> DataFrame:
    change = metrics.transitions(None, F.col("a") == F.col("gold"), F.col("b") == F.col("gold"))
    return _judged(spark, d).groupBy("lang", change.alias("change")).agg(F.count("*").alias("n"))


@query(f"""WITH {_JUDGED}, g AS (SELECT lang, -score AS score, count(*) AS n, count(*) FILTER (gold) AS k FROM j GROUP BY lang, score), c AS (SELECT lang, score, sum(n) OVER w AS n, sum(k) OVER w AS k FROM g WINDOW w AS (PARTITION BY lang ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
l AS (SELECT lang, score, CAST(n AS BIGINT) AS n, CAST(k AS BIGINT) AS k, greatest(0.0, ((k / n + 3.841458820694124 / (2.0 * n)) - 1.959963984540054 * sqrt((k / n * (1 - k / n) + 3.841458820694124 / (4.0 * n)) / n)) / (1 + 3.841458820694124 / n)) AS low FROM c)
SELECT lang, arg_max(score, n) AS threshold, max(n) AS "count", arg_max(k, n) AS n_good FROM l WHERE n >= 5 AND low >= 0.8 GROUP BY lang""")
def threshold_pick(spark: SparkSession, d: str) -> DataFrame:
    scored = _judged(spark, d).withColumn("score", -F.col("score"))
    return metrics.thresholds(scored, ["lang"], "score", F.col("gold"), 0.8, 5).select("lang", "threshold", "count", "n_good")


@query(f"""WITH {_JUDGED} SELECT lang, doc_id, score, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, doc_id) AS r FROM j WHERE NOT gold) WHERE r <= 10""")
def hard_negatives(spark: SparkSession, d: str) -> DataFrame:
    """The ten hardest negatives of each language: the report's stated size."""
    from weftline.operators.spans import nearest_k

    hardness = _judged(spark, d).where("NOT gold").withColumn("ease", -F.col("score"))
    return nearest_k(hardness, ["lang"], "ease", "doc_id", 10).select("lang", "doc_id", "score", "rank")


@query("""WITH r AS (SELECT l_returnflag AS flag, l_extendedprice AS v, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) - 1 AS i, count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem),
q AS (SELECT flag, max(n) AS n, max(CASE WHEN i = n // 4 THEN v END) AS q1, max(CASE WHEN i = 3 * n // 4 THEN v END) AS q3 FROM r GROUP BY flag)
SELECT r.flag, count(*) AS kept, max(q.n) AS n, round(avg(v), 3) AS mean, round(stddev_pop(v), 3) AS stdev, min(v) AS least, max(v) AS most FROM r JOIN q USING (flag) WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY r.flag""")
def iqr_trim_stats(spark: SparkSession, d: str) -> DataFrame:
    values = read(spark, d, "lineitem").select(F.col("l_returnflag").alias("flag"), F.col("l_extendedprice").alias("v"))
    got = metrics.trimmed_stats(values, ["flag"], "v")
    return got.select("flag", "kept", "n", F.round("mean", 3).alias("mean"), F.round("stdev", 3).alias("stdev"), "least", "most")


@query("""SELECT role, count(*) AS calls, CAST(sum(length(text)) AS BIGINT) AS chars, CAST(ceil(sum(length(text)) / 3.5) AS BIGINT) AS tokens, round(count(*) * 9.3 / 32 / 3600, 6) AS hours FROM conversations GROUP BY role""")
def cost_projection(spark: SparkSession, d: str) -> DataFrame:
    got = read(spark, d, "conversations").groupBy("role").agg(F.count("*").alias("calls"), F.sum(F.length("text")).alias("chars"))
    return got.withColumns({"tokens": F.ceil(F.col("chars") / F.lit(3.5)), "hours": F.round(F.col("calls") * F.lit(9.3) / 32 / 3600, 6)})


# Sampling and corpus


@query("""SELECT doc_id, CASE WHEN b < 4080218930 THEN 'train' ELSE 'validation' END AS split FROM (SELECT doc_id, CAST('0x' || substr(sha1(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) AS b FROM documents)""")
def stable_split(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", sampling.stable_split(F.col("doc_id").cast("string"), 0.05).alias("split"))


@query("""SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY sha1(text) ORDER BY doc_id) AS n FROM documents) WHERE n = 1""")
def exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return sampling.first_of_text(read(spark, d, "documents"), F.col("text"), ["doc_id"]).select("doc_id", "source")


@query(f"""WITH {_CLAUSES}, b AS (SELECT lower(regexp_replace(trim(text), '[^A-Za-z0-9]+', ' ', 'g')) AS t FROM benchmark)
SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM clauses JOIN b ON lower(regexp_replace(clause, '[^A-Za-z0-9]+', ' ', 'g')) = b.t)""")
def golden_exclusion(spark: SparkSession, d: str) -> DataFrame:
    """Documents without a clause that equals a held-out item, both normalised."""
    norm = lambda c: F.lower(F.regexp_replace(F.trim(c), "[^A-Za-z0-9]+", " "))
    held = read(spark, d, "benchmark").select(norm(F.col("text")).alias("t"))
    hit = _clauses(spark, d).select("doc_id", norm(F.col("clause")).alias("t")).join(held, "t", "left_semi")
    return relations.without(hit, read(spark, d, "documents"), ["doc_id"]).select("doc_id")


@query("""WITH r AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM documents)
SELECT source, doc_id FROM r WHERE n <= 7 OR i IN (SELECT CAST(round_even(k * (n - 1) / 6.0, 0) AS BIGINT) FROM generate_series(0, 6) g(k))""")
def evenly_spaced(spark: SparkSession, d: str) -> DataFrame:
    """Seven documents of each source at even distances: a sampling operator."""
    return sampling.evenly_spaced(read(spark, d, "documents").select("source", "doc_id"), ["source"], ["doc_id"], 7)


@query("""WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang), e AS (SELECT lang, n, n * 137.0 / sum(n) OVER () AS x FROM c), r AS (SELECT *, floor(x) AS base, row_number() OVER (ORDER BY round(x - floor(x), 9) DESC, lang) AS rank FROM e)
SELECT lang, n, CAST(base + CASE WHEN rank <= 137 - (SELECT sum(base) FROM r) THEN 1 ELSE 0 END AS BIGINT) AS quota FROM r""")
def strata_allocation(spark: SparkSession, d: str) -> DataFrame:
    cells = read(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("n"))
    return sampling.allocated(cells, F.col("n"), 137, ["lang"]).select("lang", "n", "quota")


@query("""SELECT doc_id, lang, source, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS INTEGER) AS turn FROM documents""")
def round_robin(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents").select("doc_id", "lang", "source")
    return sampling.round_robin(docs, ["lang", "source"], ["doc_id"]).select("doc_id", "lang", "source", F.col("turn").cast("int").alias("turn"))


@query("""SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY sha1('42|' || doc_id), doc_id) AS n FROM documents) WHERE n <= 12""")
def seeded_sample(spark: SparkSession, d: str) -> DataFrame:
    """Twelve documents of each source by a seeded hash: a sampling operator."""
    return sampling.sample_by_cell(read(spark, d, "documents"), ["source"], F.lit(12), 42, "doc_id").select("doc_id", "source")


@query("""SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS n FROM documents) WHERE n <= 40""")
def type_cap(spark: SparkSession, d: str) -> DataFrame:
    """Forty documents of a type at most: the export's stated cap."""
    return sampling.capped(read(spark, d, "documents"), ["lang"], [F.col("n_chars").desc(), "doc_id"], 40).select("doc_id", "lang")


@query("""SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels""")
def id_increment(spark: SparkSession, d: str) -> DataFrame:
    return sampling.new_ids(read(spark, d, "documents"), read(spark, d, "labels"), "doc_id")


@query("""SELECT id, min(k) AS source FROM (SELECT doc_id AS id, 0 AS k FROM labels UNION ALL SELECT page_id, 1 FROM pages UNION ALL SELECT doc_id, 2 FROM documents) GROUP BY id""")
def id_union(spark: SparkSession, d: str) -> DataFrame:
    ids = [read(spark, d, n).select(F.col(c).alias("id")) for n, c in (("labels", "doc_id"), ("pages", "page_id"), ("documents", "doc_id"))]
    return sampling.ordered_union(ids, "id")


@query("""SELECT o_orderkey, CAST(ntile(16) OVER (ORDER BY o_orderkey) AS INTEGER) AS chunk FROM orders""")
def chunk_ntile(spark: SparkSession, d: str) -> DataFrame:
    return sampling.chunks(read(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], 16)


@query("""SELECT category, lang, count(*) AS n FROM (SELECT lang, CASE WHEN regexp_matches(text, '(?i)licen[sc]e') THEN CASE WHEN regexp_matches(text, '[0-9]+[.][0-9]') THEN 'law_code' ELSE 'law_title' END WHEN regexp_matches(text, '[0-9]{4}') THEN 'other_date' WHEN length(text) > 3000 THEN 'other_title' ELSE 'vague' END AS category FROM documents) GROUP BY ALL""")
def failed_categories(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    kind = F.when(t.rlike("(?i)licen[sc]e"), F.when(t.rlike("[0-9]+[.][0-9]"), "law_code").otherwise("law_title")).when(t.rlike("[0-9]{4}"), "other_date").when(F.length(t) > 3000, "other_title").otherwise("vague")
    return read(spark, d, "documents").groupBy(kind.alias("category"), "lang").agg(F.count("*").alias("n"))


@query("""SELECT doc_id, substr(sha1(CAST(doc_id AS VARCHAR) || chr(31) || coalesce(source, '') || chr(31) || coalesce(lang, '')), 1, 20) AS id FROM documents""")
def stable_ids(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", X.stable_id(F.col("doc_id"), F.col("source"), F.col("lang")).alias("id"))


# The flagship


_FLAGSHIP = f"""WITH {_CLAUSES},
m AS (SELECT doc_id, pos, CASE WHEN clause LIKE '%icense%' THEN 'can_cu' WHEN clause LIKE '%rights reserved%' THEN 'bai_bo' ELSE 'dan_chieu' END AS relation, md5(clause) AS k FROM clauses),
u AS (SELECT k, min(doc_id) AS target FROM (SELECT DISTINCT md5(clause) AS k, doc_id FROM clauses) GROUP BY k),
e AS (SELECT DISTINCT m.doc_id AS source, u.target, m.relation FROM m JOIN u USING (k) WHERE m.doc_id <> u.target),
p AS (SELECT *, CASE relation WHEN 'bai_bo' THEN 0 WHEN 'can_cu' THEN 1 WHEN 'dan_chieu' THEN 2 END AS r FROM e)
SELECT relation, count(*) AS edges, count(DISTINCT source) AS sources, count(DISTINCT target) AS targets FROM (SELECT *, min(r) OVER (PARTITION BY source, target) AS best FROM p) WHERE r = best GROUP BY relation"""


@query(_FLAGSHIP)
def relations_by_type(spark: SparkSession, d: str) -> DataFrame:
    """Clauses cite the first document that has them; the strongest relation of each pair stays; counts by type."""
    clauses = _clauses(spark, d).withColumn("k", F.md5("clause"))
    kind = F.when(F.col("clause").contains("icense"), "can_cu").when(F.col("clause").contains("rights reserved"), "bai_bo").otherwise("dan_chieu")
    first = clauses.groupBy("k").agg(F.min("doc_id").alias("target"), F.max("doc_id").alias("_last")).where("target <> _last").select("k", "target")
    cited = clauses.select(F.col("doc_id").alias("source"), kind.alias("relation"), "k").join(first, "k").where("source <> target")
    edges = cited.select("source", "target", "relation").distinct()
    best = relations.strongest_group(edges, ["source", "target"], "relation", (("bai_bo",), ("can_cu",), ("dan_chieu",)))
    return best.groupBy("relation").agg(F.count("*").alias("edges"), F.count_distinct("source").alias("sources"), F.count_distinct("target").alias("targets"))


FLAGSHIP = relations_by_type


# Clauses in the language of the rules, made of line items, through the whole extraction


def _legal_clauses(spark: SparkSession, d: str) -> DataFrame:
    item = F.concat(F.col("l_linenumber").cast("string"))
    article, number = F.pmod("l_orderkey", F.lit(50)) + 1, F.pmod("l_partkey", F.lit(9000)) + 10
    say = lambda *parts: F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])
    text = (
        F.when(F.col("l_returnflag") == "A", say("Bãi bỏ khoản ", item, " Điều ", article, " Nghị định số ", number, "/2019/NĐ-CP."))
        .when(F.col("l_returnflag") == "N", say("Thực hiện theo quy định tại khoản ", item, " và ", F.col("l_linenumber") + 1, " Điều ", article, " Thông tư số ", number, "/2019/TT-BTC; bổ sung hồ sơ."))
        .otherwise(say("Sửa đổi, bổ sung điểm a khoản ", item, " Điều ", article, " Nghị định số ", number, "/2019/NĐ-CP (đã được sửa đổi theo Nghị định số 5/2020/NĐ-CP) như sau:"))
    )
    key = F.concat(F.lit("dieu_"), F.col("l_linenumber").cast("string"))
    return read(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), key.alias("com_key"), text.alias("text"))


_LEGAL = """s AS (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_orderkey % 50 + 1 AS article, l_partkey % 9000 + 10 AS num, l_linenumber AS line FROM lineitem),
x AS (
  SELECT l_orderkey, 'bai_bo' AS relation, 'khoan_' || line || '_dieu_' || article AS key, num || '/2019/NĐ-CP' AS number FROM s WHERE l_returnflag = 'A' UNION ALL
  SELECT l_orderkey, 'dan_chieu', 'khoan_' || unnest([line, line + 1]) || '_dieu_' || article, num || '/2019/TT-BTC' FROM s WHERE l_returnflag = 'N' UNION ALL
  SELECT l_orderkey, 'sua_doi_bo_sung', 'diem_a_khoan_' || line || '_dieu_' || article, num || '/2019/NĐ-CP' FROM s WHERE l_returnflag = 'R')"""


@query(f"WITH {_LEGAL} SELECT relation, key, count(*) AS n, count(DISTINCT number) AS numbers, count(DISTINCT l_orderkey) AS docs FROM x GROUP BY relation, key")
def legal_relations(spark: SparkSession, d: str) -> DataFrame:
    """Cues, mentions, lists, masks, distractors, rank policy and conflicts, counted by target clause."""
    from weftline.operators import extract

    clauses = _legal_clauses(spark, d)
    sources = clauses.select("doc_id").distinct().withColumn("source_number", F.lit("20/2021/NĐ-CP"))
    found = extract.allowed(extract.matched(extract.cleaned(clauses).withColumn("parent_text", F.lit(None).cast("string"))), sources)
    return found.groupBy("relation", "key").agg(F.count("*").alias("n"), F.count_distinct("number").alias("numbers"), F.count_distinct("doc_id").alias("docs"))


_RANKS = """CASE WHEN n LIKE '%/QH14' THEN 130 WHEN n LIKE '%NĐ-CP' THEN 100 WHEN n LIKE '%QĐ-TTg' THEN 90 WHEN n LIKE '%TT-BTC' THEN 80 WHEN n LIKE '%NQ-HĐND' THEN 60 ELSE 50 END"""


def _numbers(spark: SparkSession, d: str) -> DataFrame:
    ends = F.array(*map(F.lit, ("QH14", "NĐ-CP", "QĐ-TTg", "TT-BTC", "NQ-HĐND", "QĐ-UBND")))
    number = lambda k: F.concat((k % 900 + 1).cast("string"), F.lit("/2020/"), F.get(ends, (k % 6).cast("int")))
    o = read(spark, d, "orders")
    return o.select("o_orderkey", number(F.col("o_orderkey")).alias("a"), number(F.floor(F.col("o_custkey") / 3)).alias("b"))


_NUMBERS = """e AS (SELECT ['QH14', 'NĐ-CP', 'QĐ-TTg', 'TT-BTC', 'NQ-HĐND', 'QĐ-UBND'] AS l), k AS (SELECT o_orderkey, o_orderkey AS i, CAST(floor(o_custkey / 3) AS BIGINT) AS j FROM orders),
n AS (SELECT o_orderkey, (i % 900 + 1) || '/2020/' || l[i % 6 + 1] AS a, (j % 900 + 1) || '/2020/' || l[j % 6 + 1] AS b FROM k, e)"""


@query(f"""WITH {_NUMBERS}, r AS (SELECT o_orderkey, a, b, {_RANKS.replace('n LIKE', 'a LIKE')} AS ra, {_RANKS.replace('n LIKE', 'b LIKE')} AS rb FROM n)
SELECT o_orderkey, a, b, CAST(ra AS INTEGER) AS rank_a, CAST(rb AS INTEGER) AS rank_b, CASE WHEN ra > rb THEN 'source_higher' WHEN ra < rb THEN 'source_lower'
  WHEN a LIKE '%QĐ%' AND b LIKE '%NQ%' THEN 'source_lower' WHEN a LIKE '%NQ%' AND b LIKE '%QĐ%' THEN 'source_higher' END AS way FROM r""")
def authority_compare(spark: SparkSession, d: str) -> DataFrame:
    """Ranks of the issuing bodies of two numbers, and which is higher."""
    from weftline.functions import authority as A

    n = _numbers(spark, d)
    info = A.described(n.select(F.col("a").alias("number")).unionByName(n.select(F.col("b").alias("number"))))
    n = A.with_info(A.with_info(n, info, "a", None, "_a"), info, "b", None, "_b")
    return n.select("o_orderkey", "a", "b", F.col("_a_rank").alias("rank_a"), F.col("_b_rank").alias("rank_b"), A.way("_a", "_b").alias("way"))


@query("""WITH s AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'ngày 5/3/2020' WHEN 1 THEN 'ngày 15-12-2019' WHEN 2 THEN 'ngày 7 tháng 9 năm 2018' WHEN 3 THEN 'tháng 4 năm 2017' WHEN 4 THEN 'năm 2016' ELSE 'Luật Hàng không 1991' END AS t,
  CASE o_orderkey % 6 WHEN 0 THEN ['05', '03', '2020'] WHEN 1 THEN ['15', '12', '2019'] WHEN 2 THEN ['07', '09', '2018'] WHEN 3 THEN [NULL, '04', '2017'] WHEN 4 THEN [NULL, NULL, '2016'] ELSE [NULL, NULL, '1991'] END AS x FROM orders)
SELECT o_orderkey, x[1] AS day, x[2] AS month, CAST(x[3] AS INTEGER) AS year FROM s""")
def issue_dates(spark: SparkSession, d: str) -> DataFrame:
    said = F.array(*map(F.lit, ("ngày 5/3/2020", "ngày 15-12-2019", "ngày 7 tháng 9 năm 2018", "tháng 4 năm 2017", "năm 2016", "Luật Hàng không 1991")))
    o = read(spark, d, "orders").select("o_orderkey", F.get(said, F.pmod("o_orderkey", F.lit(6)).cast("int")).alias("t"))
    date = X.issue_date(F.col("t"))
    return o.select("o_orderkey", date["day"].alias("day"), date["month"].alias("month"), date["year"].alias("year"))

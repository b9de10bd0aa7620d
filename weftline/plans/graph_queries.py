"""Registered queries of scans, graph writing, routing and number rules over the shared tables, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import text as X
from weftline.functions.fixed import CURATED_KEYS
from weftline.operators import graph, lookup, metrics, relations, sampling, scan, writer
from weftline.plans.catalogue import query, read

# Scans


@query("""SELECT o_orderkey FROM orders o WHERE o_orderstatus = 'O' AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l_returnflag = 'R')""")
def pending_documents(spark: SparkSession, d: str) -> DataFrame:
    """Open orders that are not done, which those with a returned line are."""
    done = read(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return scan.pending(read(spark, d, "orders"), F.col("o_orderstatus") == "O", done, "o_orderkey").select("o_orderkey")


@query("""SELECT doc_id FROM documents WHERE doc_id < 700 ORDER BY doc_id DESC LIMIT 100""")
def keyset_page(spark: SparkSession, d: str) -> DataFrame:
    """A page of a hundred falling ids below 700: the page size is the feature."""
    return scan.page_before(read(spark, d, "documents"), "doc_id", 700, 100).select("doc_id")


@query("""SELECT doc_id, lang FROM documents WHERE doc_id BETWEEN 40 AND 160""")
def id_range_listing(spark: SparkSession, d: str) -> DataFrame:
    return scan.id_range(read(spark, d, "documents"), "doc_id", 40, 160, ["lang"])


@query("""SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 20""")
def find_documents(spark: SparkSession, d: str) -> DataFrame:
    """Condition, projection, order, skip and limit of a scan."""
    return scan.find(read(spark, d, "orders"), F.col("o_orderstatus") == "F", ["o_orderkey", "o_totalprice"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 20, 50)


# Nodes and edges to write


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_orderstatus").alias("status"))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS node, 'VAN_BAN' AS node_class, NULL AS level, NULL AS path, o_orderstatus AS status FROM orders UNION ALL
SELECT 'khoan_' || l_linenumber || '_dieu_' || l_suppkey || '#' || l_orderkey, 'DIEU_KHOAN', 'khoan', 'Khoản ' || l_linenumber, o_orderstatus FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag <> 'N'""")
def prepared_nodes(spark: SparkSession, d: str) -> DataFrame:
    """A node for each order and each of its lines; lines that stand for the whole document give none."""
    line = F.col("l_linenumber").cast("string")
    clauses = read(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"),
        F.concat(F.lit("khoan_"), line, F.lit("_dieu_"), F.col("l_suppkey").cast("string")).alias("com_key"),
        F.when(F.col("l_returnflag") == "N", "vanban").otherwise("khoan").alias("com_type"),
        F.concat(F.lit("Khoản "), line).alias("com_path"),
    )
    return writer.prepared_nodes(_docs(spark, d), clauses, ["status"])


def _clause_targets(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Targets, inserted and existing clauses of customers: by their numbers, so that SQL can say which anchor counts."""
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    doc, clause, article = F.col("k").cast("string").alias("doc"), F.pmod("k", F.lit(4)) + 1, F.pmod("k", F.lit(7)) + 1
    key = lambda point: F.concat(F.lit(point), F.lit("khoan_"), clause.cast("string"), F.lit("_dieu_"), article.cast("string")).alias("key")
    targets = c.select(doc, key("diem_a_"))
    inserted = c.where("k % 3 = 0").select(doc, F.concat(F.lit("dieu_"), article.cast("string")).alias("key")).unionByName(c.where("k % 11 = 0").select(doc, key("diem_a_")))
    existing = c.where("k % 2 = 0").select(doc, key("")).unionByName(c.where("k % 5 = 0").select(doc, F.concat(F.lit("dieu_"), article.cast("string")).alias("key")))
    return targets, inserted, existing


_TARGETS = """t AS (SELECT c_custkey AS k, 'dieu_' || (c_custkey % 7 + 1) AS a, 'khoan_' || (c_custkey % 4 + 1) || '_dieu_' || (c_custkey % 7 + 1) AS c, 'diem_a_khoan_' || (c_custkey % 4 + 1) || '_dieu_' || (c_custkey % 7 + 1) AS p FROM customer),
n AS (SELECT *, CASE WHEN k % 11 = 0 THEN 0 WHEN k % 3 = 0 THEN 2 WHEN k % 2 = 0 THEN 1 WHEN k % 5 = 0 THEN 2 END AS hops FROM t)"""


@query(f"""WITH {_TARGETS} SELECT CAST(k AS VARCHAR) AS doc, p AS key, CASE hops WHEN 0 THEN p WHEN 1 THEN c ELSE a END AS anchor, hops FROM n WHERE hops IS NOT NULL""")
def synthetic_anchors(spark: SparkSession, d: str) -> DataFrame:
    """The nearest inserted, else existing, clause at or above a target."""
    return writer.anchors(*_clause_targets(spark, d))


@query(f"""WITH {_TARGETS} SELECT c || '#' || k AS head, p || '#' || k AS tail, k % 2 <> 0 AS head_new FROM n WHERE hops >= 1
UNION ALL SELECT a || '#' || k, c || '#' || k, k % 5 <> 0 FROM n WHERE hops = 2""")
def synthetic_containment(spark: SparkSession, d: str) -> DataFrame:
    """Edges from a target up to its anchor, and which heads are new."""
    return writer.synthetic_edges(*_clause_targets(spark, d))


@query("""SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS doc, 'dieu_' || l_linenumber AS key FROM lineitem WHERE l_returnflag IN ('A', 'R')""")
def inserted_keys(spark: SparkSession, d: str) -> DataFrame:
    """The clauses that edges of two relations have at their tail."""
    tail = F.when(F.col("l_linenumber") > 0, F.concat(F.lit("dieu_"), F.col("l_linenumber").cast("string"), F.lit("#"), F.col("l_orderkey").cast("string")))
    edges = read(spark, d, "lineitem").select(F.col("l_returnflag").alias("rel_type"), F.col("l_partkey").cast("string").alias("head"), tail.alias("tail"))
    return writer.clause_keys(edges, ["A", "R"])


def _graph(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Edges from orders' customers to parts, the nodes that are there, and those that a source could add."""
    edges = read(spark, d, "orders").select("o_orderkey", F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("head"), F.concat(F.lit("p"), F.pmod("o_orderkey", F.lit(3000)).cast("string")).alias("tail"))
    customers = read(spark, d, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("node"), F.col("c_acctbal").alias("x"))
    parts = read(spark, d, "part").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("node"), F.col("p_size").cast("double").alias("x"))
    nodes = customers.where("x > 1000").unionByName(parts.where("x > 10")).select("node")
    return edges, nodes, customers.unionByName(parts.where("x > 5")).select("node")


_ENDS = """e AS (SELECT o_orderkey, c_custkey IS NOT NULL AS hs, coalesce(c_acctbal > 1000, false) AS hn, coalesce(p_size > 5, false) AS ts, coalesce(p_size > 10, false) AS tn
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN part ON p_partkey = o_orderkey % 3000),
r AS (SELECT *, CASE WHEN NOT hn THEN 'missing_source' WHEN NOT tn THEN 'missing_target' END AS strict, CASE WHEN NOT hs THEN 'missing_source' WHEN NOT ts THEN 'missing_target' END AS heal FROM e)"""


@query(f"""WITH {_ENDS} SELECT 'legacy' AS mode, 'written' AS status, NULL AS reason, false AS healed, count(*) AS n FROM r
UNION ALL SELECT 'shadow-strict', 'written', strict, false, count(*) FROM r GROUP BY strict
UNION ALL SELECT 'strict-no-heal', CASE WHEN strict IS NULL THEN 'written' ELSE 'deferred' END, strict, false, count(*) FROM r GROUP BY strict
UNION ALL SELECT 'strict-auto-heal', CASE WHEN heal IS NULL THEN 'written' ELSE 'deferred' END, heal, heal IS NULL AND strict IS NOT NULL AS h, count(*) FROM r GROUP BY heal, h""")
def write_modes(spark: SparkSession, d: str) -> DataFrame:
    """What each mode of the writer does with edges whose ends are missing."""
    edges, nodes, source = _graph(spark, d)
    each = [writer.written(edges, nodes, m, source).withColumn("mode", F.lit(m)) for m in writer.MODES]
    every = each[0].unionByName(each[1]).unionByName(each[2]).unionByName(each[3])
    return every.groupBy("mode", "status", "reason", "healed").agg(F.count("*").alias("n"))


@query("""WITH e AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % 2500 END AS target_doc FROM orders)
SELECT o_orderkey, target_doc, mode, CASE WHEN target_doc IS NULL THEN 'missing_target' WHEN p_partkey IS NOT NULL THEN 'resolved' WHEN mode = 'strict' THEN 'missing_target' ELSE 'skeleton_target' END AS status,
  CASE WHEN p_partkey IS NOT NULL OR mode = 'permissive' THEN target_doc END AS resolved_doc
FROM e CROSS JOIN (VALUES ('strict'), ('permissive')) m(mode) LEFT JOIN part ON p_partkey = target_doc""")
def target_resolution(spark: SparkSession, d: str) -> DataFrame:
    events = read(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderkey") % 2500).alias("target_doc"))
    documents = read(spark, d, "part").select(F.col("p_partkey").alias("doc_id"))
    strict, permissive = (writer.resolved_targets(events, documents, m).withColumn("mode", F.lit(m)) for m in ("strict", "permissive"))
    return strict.unionByName(permissive).select("o_orderkey", "target_doc", "mode", "status", "resolved_doc")


@query("""SELECT node, max(node_class) AS node_class FROM (SELECT 'k' || c_custkey AS node, 'VAN_BAN' AS node_class FROM customer UNION ALL SELECT 'k' || l_partkey, 'DIEU_KHOAN' FROM lineitem WHERE l_returnflag = 'A' AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = l_partkey)) GROUP BY node""")
def upserted_targets(spark: SparkSession, d: str) -> DataFrame:
    """Nodes, and the clauses that edges insert; existing nodes stay as they are."""
    nodes = read(spark, d, "customer").select(F.concat(F.lit("k"), F.col("c_custkey").cast("string")).alias("node"), F.lit("VAN_BAN").alias("node_class"))
    edges = read(spark, d, "lineitem").select(F.col("l_returnflag").alias("rel_type"), F.concat(F.lit("k"), F.col("l_partkey").cast("string")).alias("tail"), F.lit("DIEU_KHOAN").alias("tail_class"))
    return writer.with_inserted_targets(nodes, edges, ["A"])


_EDGES = """x AS (SELECT 'khoan_' || l_linenumber || '#' || l_orderkey AS head, CAST(l_partkey AS VARCHAR) AS tail, l_orderkey, l_partkey,
  CASE l_returnflag WHEN 'A' THEN 'bao_gom' WHEN 'N' THEN 'dan_chieu' ELSE 'bai_bo' END AS rel_type, CASE WHEN l_linenumber % 2 = 0 THEN 'gian_tiep' END AS loai_quan_he FROM lineitem)"""


def _edges(spark: SparkSession, d: str) -> DataFrame:
    line, order = F.col("l_linenumber").cast("string"), F.col("l_orderkey").cast("string")
    rel = F.when(F.col("l_returnflag") == "A", "bao_gom").when(F.col("l_returnflag") == "N", "dan_chieu").otherwise("bai_bo")
    return read(spark, d, "lineitem").select(
        F.concat(F.lit("khoan_"), line, F.lit("#"), order).alias("head"), F.col("l_partkey").cast("string").alias("tail"), rel.alias("rel_type"), F.when(F.col("l_linenumber") % 2 == 0, "gian_tiep").alias("loai_quan_he")
    )


@query(f"""WITH {_EDGES}, g AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
SELECT 'status' AS kind, head, tail, rel_type FROM x WHERE NOT (rel_type <> 'bao_gom' AND loai_quan_he IS NULL AND l_orderkey IN (FROM g))
UNION ALL SELECT 'inferred', head, tail, rel_type FROM x WHERE NOT (rel_type <> 'bao_gom' AND loai_quan_he IS NOT NULL AND l_orderkey IN (FROM g))""")
def deleted_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges that are left when the status, or the inferred, edges of some documents go; containment stays."""
    docs = read(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("doc_id"))
    left = [writer.edges_without(_edges(spark, d), docs, k).withColumn("kind", F.lit(k)) for k in ("status", "inferred")]
    return left[0].unionByName(left[1]).select("kind", "head", "tail", "rel_type")


@query(f"""WITH {_EDGES}, g AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
SELECT 'edge' AS kind, head AS node, tail AS other FROM x WHERE l_orderkey NOT IN (FROM g) AND l_partkey NOT IN (FROM g) UNION ALL
SELECT 'node', head, NULL FROM x WHERE l_orderkey NOT IN (FROM g)""")
def deleted_documents(spark: SparkSession, d: str) -> DataFrame:
    """Nodes and edges that are left when documents go with their clauses and all edges at them."""
    docs = read(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("doc_id"))
    edges = _edges(spark, d)
    nodes, left = writer.without_documents(edges.select(F.col("head").alias("node")), edges, docs)
    none = F.lit(None).cast("string").alias("other")
    return left.select(F.lit("edge").alias("kind"), F.col("head").alias("node"), F.col("tail").alias("other")).unionByName(nodes.select(F.lit("node").alias("kind"), "node", none))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '{' || CASE WHEN o_custkey % 2 = 0 THEN '"danh_sach_id_lien_quan":"{\\"bai_bo\\":[' || o_custkey || ']}",' ELSE '' END || '"loai_quan_he":"gian_tiep","mo_ta":"' || o_orderpriority || '","nguon_cap_nhat":"cmcai"}'
  ELSE '{"nguon_cap_nhat":"cmcai"}' END AS props FROM orders""")
def edge_properties(spark: SparkSession, d: str) -> DataFrame:
    """The properties that an edge's kind allows, as JSON."""
    edges = read(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "gian_tiep").otherwise("truc_tiep").alias("loai_quan_he"),
        F.col("o_orderpriority").alias("mo_ta"),
        F.when(F.col("o_custkey") % 2 == 0, F.create_map(F.lit("bai_bo"), F.array("o_custkey"))).alias("danh_sach_id_lien_quan"),
        F.lit("x").alias("other"),
    )
    return writer.edge_properties(edges).select("o_orderkey", "props")


@query("""WITH v AS (SELECT c_custkey AS node, c_custkey + 100000 AS variant FROM customer WHERE c_acctbal < 0)
SELECT o_orderkey, coalesce(h.variant, o_custkey) AS head, coalesce(t.variant, o_orderkey % 1500) AS tail FROM orders LEFT JOIN v h ON h.node = o_custkey LEFT JOIN v t ON t.node = o_orderkey % 1500""")
def remapped_ends(spark: SparkSession, d: str) -> DataFrame:
    variants = read(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("node"), (F.col("c_custkey") + 100000).alias("variant"))
    edges = read(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("head"), (F.col("o_orderkey") % 1500).alias("tail"))
    return writer.remapped(edges, variants).select("o_orderkey", "head", "tail")


_KEYS = ", ".join(f"('{k}', '{r}', {'true' if f else 'false'}, {i})" for i, (k, (r, f)) in enumerate(CURATED_KEYS.items()))


@query(f"""WITH k(key, rel, flip, i) AS (VALUES {_KEYS}) SELECT o_orderkey, rel AS rel_type, CASE WHEN flip THEN o_custkey ELSE o_orderkey END AS head, CASE WHEN flip THEN o_orderkey ELSE o_custkey END AS tail FROM orders JOIN k ON i = o_orderkey % 27""")
def curated_edges(spark: SparkSession, d: str) -> DataFrame:
    """All curated list keys, with their directions; unknown keys give no edge."""
    names = F.array(*map(F.lit, CURATED_KEYS))
    rows = read(spark, d, "orders").select("o_orderkey", "o_custkey", F.get(names, (F.col("o_orderkey") % 27).cast("int")).alias("key"))
    return relations.directed(rows, CURATED_KEYS, "key", "o_orderkey", "o_custkey").select("o_orderkey", "rel_type", "head", "tail")


# Routing and coverage


_SCORED = """s AS (SELECT l_orderkey, l_linenumber, l_discount * 10 AS score, 0.7 + (l_linenumber % 3) / 10.0 AS accept, 0.2 + (l_linenumber % 2) / 10.0 AS reject, CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END AS label FROM lineitem)"""


def _scored(spark: SparkSession, d: str) -> DataFrame:
    line = F.col("l_linenumber")
    return read(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_discount") * 10).alias("score"), (F.lit(0.7) + (line % 3) / 10).alias("accept"), (F.lit(0.2) + (line % 2) / 10).alias("reject"), F.when(F.col("l_returnflag") == "N", 0).otherwise(1).alias("label")
    )


@query(f"""WITH {_SCORED}, r AS (SELECT *, CASE WHEN score >= accept THEN 'ACCEPT' WHEN score <= reject THEN 'REJECT' ELSE 'UNCERTAIN' END AS route FROM s)
SELECT route, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS coverage, CASE WHEN route <> 'UNCERTAIN' THEN round(count(*) FILTER (label = CASE route WHEN 'ACCEPT' THEN 1 ELSE 0 END) / count(*), 6) END AS decision_precision FROM r GROUP BY route""")
def routing_report(spark: SparkSession, d: str) -> DataFrame:
    return metrics.routing(_scored(spark, d), "score", "accept", "reject", "label")


@query(f"""WITH {_SCORED} SELECT l_orderkey, l_linenumber, round(least(abs(score - accept), abs(score - reject)), 9) AS distance FROM s WHERE score < accept AND score > reject""")
def abstention_queue(spark: SparkSession, d: str) -> DataFrame:
    return metrics.abstained(_scored(spark, d), "score", "accept", "reject").select("l_orderkey", "l_linenumber", "distance")


@query("""SELECT l_returnflag AS relation, count(*) AS total, count(o_orderkey) AS covered, round(count(o_orderkey) / count(*), 6) AS recall_ceiling FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus = l_linestatus GROUP BY ALL""")
def candidate_coverage(spark: SparkSession, d: str) -> DataFrame:
    gold = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("unit"), F.col("l_returnflag").alias("relation"), F.col("l_linestatus").alias("reference"))
    said = read(spark, d, "orders").select(F.col("o_orderkey").alias("unit"), F.explode(F.array(F.lit("A"), F.lit("N"), F.lit("R"))).alias("relation"), F.col("o_orderstatus").alias("reference"))
    return metrics.coverage(gold, said, ["unit"], "relation", "reference")


# Numbers, authorities, titles

_SAID = (
    ("15/2020/NĐ-CP", "UBND tỉnh A", "ngày 5/3/2020"), ("15/NĐ", "Ủy ban nhân dân Tỉnh A", "Luật Đất đai"), ("số 45/2019/QH14", "Bộ Tài chính", "năm 2019"), ("1171/KCB", "BỘ TÀI CHÍNH.", "30/4"),
    ("12/2015/TTLT-BTC-BCA", "HĐND huyện B", "theo 12/2015/TT-BTC"), ("12/2015/TTLT-BTC-BCA-BQP", "Hội đồng nhân dân", ""), ("7/2021/QĐ-UBND", "", "ngày 7 tháng 9 năm 2018"), ("abc", "Chính phủ", "30/4 và 5/QĐ-TTg"),
)
#: Whether each number is specific, whether the next one extends it, whether the next authority is the same, whether the reference may be kept.
_TELLS = ((True, False, True, True), (False, False, False, False), (True, False, True, True), (True, False, False, False), (True, True, True, True), (True, False, False, False), (True, False, False, False), (False, False, False, True))


@query("WITH t(k, a, b, c, e) AS (VALUES " + ", ".join(f"({k}, {', '.join(str(x).lower() for x in row)})" for k, row in enumerate(_TELLS)) + ") SELECT o_orderkey, a AS specific, b AS extends, c AS same, e AS cacheable FROM orders JOIN t ON k = o_orderkey % 8")
def number_rules(spark: SparkSession, d: str) -> DataFrame:
    """Whether a number is specific and extended by another, whether two authorities are the same, whether a reference may be cached."""
    rows = F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip(("number", "authority", "said"), row, strict=True)]) for row in _SAID])
    o = read(spark, d, "orders").withColumn("k", (F.col("o_orderkey") % 8).cast("int")).select("o_orderkey", F.get(rows, F.col("k")).alias("a"), F.get(rows, (F.col("k") + 1) % 8).alias("b"))
    source = F.when(F.col("a.number") == "7/2021/QĐ-UBND", F.col("a.number")).otherwise("1/2020/NĐ-CP")
    return o.select(
        "o_orderkey",
        X.is_specific_number(F.col("a.number")).alias("specific"),
        X.extends_number(F.col("b.number"), F.col("a.number")).alias("extends"),
        X.same_authority(F.col("a.authority"), F.col("b.authority")).alias("same"),
        X.cacheable(F.col("a.said"), F.col("a.authority"), source).alias("cacheable"),
    )


@query("""WITH i AS (SELECT DISTINCT l_suppkey AS doc, 'dieu_' || l_linenumber || CASE WHEN l_returnflag = 'R' THEN 'a' ELSE '' END AS id FROM lineitem)
SELECT a.doc, a.id AS bare, min(b.id) AS variant FROM i a JOIN i b ON a.doc = b.doc AND starts_with(b.id, a.id) AND a.id <> b.id GROUP BY ALL HAVING count(*) = 1""")
def clause_variants(spark: SparkSession, d: str) -> DataFrame:
    """The only longer clause key of the same document that starts with a key."""
    key = F.concat(F.lit("dieu_"), F.col("l_linenumber").cast("string"), F.when(F.col("l_returnflag") == "R", "a").otherwise(""))
    ids = read(spark, d, "lineitem").select(F.col("l_suppkey").alias("doc"), key.alias("variant")).distinct()
    return lookup.prefix_unique(ids.select("doc", F.col("variant").alias("bare")), ids, ["doc"], "bare", "variant", proper=True).where("variant IS NOT NULL")


_WORDS = "list_distinct(list_filter(regexp_split_to_array(lower({}), '[^a-z0-9]+'), lambda x: x <> ''))"


@query(f"""WITH t AS (SELECT doc_id, substr(text, 1, 90) AS title FROM documents WHERE lang = 'en'), k AS (SELECT DISTINCT title, {_WORDS.format('title')} AS s FROM t WHERE len({_WORDS.format('title')}) > 3),
j AS (SELECT a.title, b.title AS other FROM k a JOIN k b ON a.title <> b.title AND len(list_intersect(a.s, b.s)) * 1.0 / len(list_distinct(a.s || b.s)) >= 0.6)
SELECT title, min(other) AS found FROM j GROUP BY title HAVING count(*) = 1""")
def title_of_documents(spark: SparkSession, d: str) -> DataFrame:
    """First lines that have just one other with a token Jaccard of 0.6 or more."""
    titles = read(spark, d, "documents").where("lang = 'en'").select(F.substring("text", 1, 90).alias("title")).distinct()
    a = titles.withColumn("toks", X.tokens(F.col("title"))).where(F.size("toks") > 3)
    b = a.select(F.col("title").alias("found"), F.col("toks").alias("found_toks"))
    return lookup.fuzzy_unique(a, b, "toks", "found_toks", "title", "found", 0.6, proper=True)


@query("""SELECT CAST(n_nationkey AS INTEGER) AS n_nationkey, count(*) AS n FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL HAVING count(*) > 1""")
def repeated_ids(spark: SparkSession, d: str) -> DataFrame:
    """Ids that a key constraint would refuse."""
    return graph.repeated_ids(read(spark, d, "customer").select(F.col("c_nationkey").cast("int").alias("n_nationkey")), "n_nationkey")


@query("""SELECT split, source, count(*) AS n FROM (SELECT source, CASE WHEN ('0x' || substr(sha1(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT < 4080218930 THEN 'train' ELSE 'validation' END AS split FROM documents) GROUP BY ALL""")
def corpus_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Counts by split and source."""
    docs = read(spark, d, "documents").select("source", sampling.stable_split(F.col("doc_id").cast("string"), 0.05).alias("split"))
    return docs.groupBy("split", "source").agg(F.count("*").alias("n"))


# Targets of actions in templates of legal language: {n} is the document's number, {k} a clause's


#: text, relation, and the key and number of each target; * of the key is {k}.
TEMPLATES: tuple[tuple[str, str, tuple[tuple[str, str], ...]], ...] = (
    ("Bãi bỏ khoản {k} Điều 5 Nghị định số {n}/2019/NĐ-CP.", "bai_bo", (("khoan_*_dieu_5", "/2019/NĐ-CP"),)),
    ("Bãi bỏ các khoản {k} và 9 Điều 5 Thông tư số {n}/2019/TT-BTC; bổ sung hồ sơ.", "bai_bo", (("khoan_9_dieu_5", "/2019/TT-BTC"),)),
    ("Bổ sung điểm d vào sau điểm c khoản {k} Điều 34 của Nghị định số {n}/2023/NĐ-CP như sau:", "sua_doi_bo_sung", (("diem_d_khoan_*_dieu_34", "/2023/NĐ-CP"),)),
    ("Hủy bỏ các Quyết định trái với Nghị định số 35/2001/NĐ-CP:\n- Quyết định số {n}/2000/QĐ-UBND;\n- Quyết định số {k}/2001/QĐ-UBND.", "huy_bo", (("", "/2000/QĐ-UBND"),)),
    ("Thông tư này quy định chi tiết Nghị định số {n}/2025/NĐ-CP, bao gồm:\n1. Hồ sơ (khoản {k} Điều 10);\n2. Thời hạn (khoản 8 Điều 18).", "quy_dinh_chi_tiet", (("khoan_*_dieu_10", "/2025/NĐ-CP"), ("khoan_8_dieu_18", "/2025/NĐ-CP"))),
    ("Hợp đồng đã ký thì tiếp tục thực hiện theo Nghị định số {n}/2019/NĐ-CP.", "dan_chieu", (("", "/2019/NĐ-CP"),)),
    ("Nghị định số {n}/2010/NĐ-CP hết hiệu lực kể từ ngày Nghị định này có hiệu lực thi hành.", "thay_the", (("", "/2010/NĐ-CP"),)),
    ("Quyết định số {n}/2011/QĐ-TTg hết hiệu lực thi hành.", "bai_bo", (("", "/2011/QĐ-TTg"),)),
    ("Thay thế Phụ lục ban hành kèm theo Nghị định số {n}/2012/NĐ-CP.", "sua_doi_bo_sung", (("", "/2012/NĐ-CP"),)),
    ("Sửa đổi khoản {k} Điều 2 Nghị định số {n}/2010/NĐ-CP đã được sửa đổi tại Nghị định số 9/2012/NĐ-CP.", "sua_doi_bo_sung", (("khoan_*_dieu_2", "/2010/NĐ-CP"),)),
    ("Bãi bỏ Nghị quyết số {n}/2010/NQ-HĐND về việc kéo dài Nghị quyết số 4/2009/NQ-HĐND.", "bai_bo", (("", "/2010/NQ-HĐND"),)),
    ("Thay thế từ khoản 1 đến khoản 2 Điều {k} Nghị định số {n}/2012/NĐ-CP.", "thay_the", (("khoan_1_dieu_*", "/2012/NĐ-CP"), ("khoan_2_dieu_*", "/2012/NĐ-CP"))),
    ("Quy định chi tiết khoản {k} Điều 7 Nghị định số {n}/2022/NĐ-CP.", "quy_dinh_chi_tiet", (("khoan_*_dieu_7", "/2022/NĐ-CP"),)),
    ("Hướng dẫn thi hành Điều {k} Nghị định số {n}/2022/NĐ-CP.", "huong_dan", (("dieu_*", "/2022/NĐ-CP"),)),
    ("Đính chính khoản {k} Điều 4 Thông tư số {n}/2018/TT-BYT.", "dinh_chinh", (("khoan_*_dieu_4", "/2018/TT-BYT"),)),
    ("Ngưng hiệu lực Điều {k} Nghị định số {n}/2017/NĐ-CP.", "ngung_hieu_luc", (("dieu_*", "/2017/NĐ-CP"),)),
    ("Kéo dài thời hạn áp dụng Nghị quyết số {n}/2016/NQ-HĐND.", "keo_dai_hieu_luc", (("", "/2016/NQ-HĐND"),)),
    ("Thực hiện theo quy định tại điểm a khoản {k} Điều 12 Nghị định số {n}/2015/NĐ-CP.", "dan_chieu", (("diem_a_khoan_*_dieu_12", "/2015/NĐ-CP"),)),
    ("Đình chỉ thi hành Quyết định số {n}/2014/QĐ-UBND.", "dinh_chi", (("", "/2014/QĐ-UBND"),)),
    ("Người nộp bổ sung hồ sơ, kinh phí; hủy bỏ chứng chỉ {n}.", "", ()),
    ("Bổ sung dự án Luật Đất đai vào chương trình lập pháp năm {n}.", "", ()),
    ("Sửa đổi, bổ sung điểm a khoản {k} Điều 3 Nghị định số {n}/2020/NĐ-CP (đã được sửa đổi theo Nghị định số 5/2020/NĐ-CP) như sau:", "sua_doi_bo_sung", (("diem_a_khoan_*_dieu_3", "/2020/NĐ-CP"),)),
)


def _template_sql() -> str:
    rows = [(k, r, key, end) for k, (_, r, found) in enumerate(TEMPLATES) for key, end in found]
    more = [(1, "bai_bo", "khoan_*_dieu_5", "/2019/TT-BTC")]  # the list's other value
    values = ", ".join(f"({k}, '{r}', '{key}', '{end}')" for k, r, key, end in rows + more)
    return f"""WITH t(i, relation, key, ending) AS (VALUES {values}), o AS (SELECT o_orderkey, o_orderkey % {len(TEMPLATES)} AS i, o_custkey % 7 + 1 AS k, o_orderkey % 900 + 10 AS n FROM orders)
SELECT o_orderkey, relation, replace(key, '*', CAST(k AS VARCHAR)) AS key, n || ending AS number FROM o JOIN t USING (i)
UNION ALL SELECT o_orderkey, 'huy_bo', '', k || '/2001/QĐ-UBND' FROM o WHERE i = 3"""


@query(_template_sql())
def legal_targets(spark: SparkSession, d: str) -> DataFrame:
    """What the clause rules find in the templates, one for each order."""
    from weftline.operators import extract

    says = F.get(F.array(*[F.lit(t) for t, _, _ in TEMPLATES]), (F.col("o_orderkey") % len(TEMPLATES)).cast("int"))
    k, n = ((F.col("o_custkey") % 7) + 1).cast("string"), ((F.col("o_orderkey") % 900) + 10).cast("string")
    text = F.replace(F.replace(says, F.lit("{k}"), k), F.lit("{n}"), n)
    clauses = read(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), F.lit("dieu_1").alias("com_key"), text.alias("text"), F.lit(None).cast("string").alias("parent_text"))
    found = extract.decided(extract.matched(extract.cleaned(clauses)))
    own = F.coalesce("own", F.lit(False))
    return found.where(~own).select(F.col("doc_id").alias("o_orderkey"), "relation", "key", "number")

"""The property graph as DataFrames: nodes, containment, insertion, closures, checks before writing, maintenance, export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import graph_parent_key


def clause_id(key: Column, doc: Column) -> Column:
    return F.concat_ws("#", key, doc.cast("string"))


def doc_of(node: Column) -> Column:
    """The document id of a node id: what follows the last '#'."""
    return F.element_at(F.split(node, "#"), -1)


def containment(clauses: DataFrame, doc: str, key: str) -> DataFrame:
    """head, tail of bao_gom edges: clause under its parent clause, articles under the document."""
    parent = graph_parent_key(F.col(key))
    head = F.when(parent.isNull(), F.col(doc).cast("string")).otherwise(clause_id(parent, F.col(doc)))
    return clauses.select(head.alias("head"), clause_id(F.col(key), F.col(doc)).alias("tail")).distinct()


def ancestors(key: Column) -> Column:
    """Array of the keys above a clause key, the nearest first."""
    parts = F.split(key, "_")
    steps = F.sequence(F.lit(1), F.floor(F.size(parts) / 2).cast("int"))
    return F.filter(F.transform(steps, lambda i: F.array_join(F.slice(parts, 2 * i + 1, F.greatest(F.size(parts) - 2 * i, F.lit(0))), "_")), lambda x: x != "")


def inserted_edges(clauses: DataFrame, doc: str, key: str) -> DataFrame:
    """head, tail, depth of contains-after-insertion edges: each clause under every ancestor, and the document."""
    above = F.posexplode(F.array_append(F.transform(ancestors(F.col(key)), lambda a: clause_id(a, F.col(doc))), F.col(doc).cast("string"))).alias("d", "head")
    return clauses.select(doc, key, above).select("head", clause_id(F.col(key), F.col(doc)).alias("tail"), (F.col("d") + 1).alias("depth"))


def status_edges(resolved: DataFrame) -> DataFrame:
    """head, head_class, rel_type, tail, tail_class of resolved references (source_doc, source_key, relation, target_doc,
    target_key): a clause end where there is a key; a clause to a document also gives the document edge."""
    known = resolved.where("source_doc IS NOT NULL AND target_doc IS NOT NULL AND relation IS NOT NULL")

    def end(doc: str, key: str) -> list[Column]:
        has = F.coalesce(F.col(key), F.lit("")) != ""
        return [F.when(has, clause_id(F.col(key), F.col(doc))).otherwise(F.col(doc).cast("string")), F.when(has, "DIEU_KHOAN").otherwise("VAN_BAN")]

    (head, head_class), (tail, tail_class) = end("source_doc", "source_key"), end("target_doc", "target_key")
    own = known.select(head.alias("head"), head_class.alias("head_class"), F.col("relation").alias("rel_type"), tail.alias("tail"), tail_class.alias("tail_class"))
    whole = known.where("coalesce(source_key, '') <> '' AND coalesce(target_key, '') = ''").select(
        F.col("source_doc").cast("string").alias("head"), F.lit("VAN_BAN").alias("head_class"), F.col("relation").alias("rel_type"), F.col("target_doc").cast("string").alias("tail"), F.lit("VAN_BAN").alias("tail_class")
    )
    return own.unionByName(whole).distinct()


def closure(edges: DataFrame, starts: DataFrame, depth: int) -> DataFrame:
    """start, node, hops: nodes reached from start (column node) over head -> tail edges in at most depth steps, at the least number of
    them. Each step joins the new nodes only."""
    new = starts.select(F.col("node").alias("start"), "node", F.lit(0).alias("hops")).distinct()
    found = new
    for k in range(1, depth + 1):
        step = new.join(edges.select(F.col("head").alias("node"), F.col("tail").alias("_next")).distinct(), "node")
        new = step.select("start", F.col("_next").alias("node"), F.lit(k).alias("hops")).distinct().join(found.select("start", "node"), ["start", "node"], "left_anti")
        found = found.unionByName(new)
    return found


def orphans(nodes: DataFrame, node: str, edges: DataFrame, ends: list[str]) -> DataFrame:
    """Nodes that no edge has at either end."""
    for end in ends:
        nodes = nodes.join(edges.select(F.col(end).alias(node)).distinct(), node, "left_anti")
    return nodes


def checked_edges(edges: DataFrame, heads: DataFrame, tails: DataFrame, head: str, tail: str, expected: list[tuple[Column, str]]) -> DataFrame:
    """edges with reason, null if an edge may be written: missing_source, missing_target, then the first of expected (fails, reason)
    that holds. heads and tails have the node ids under the names head and tail, and what expected looks at."""
    h = heads.withColumn("_has_head", F.lit(True))
    t = tails.withColumn("_has_tail", F.lit(True))
    joined = edges.join(h, head, "left").join(t, tail, "left")
    reason = F.lit(None).cast("string")
    for fails, name in reversed(expected):
        reason = F.when(fails, name).otherwise(reason)
    reason = F.when(F.col("_has_tail").isNull(), "missing_target").otherwise(reason)
    reason = F.when(F.col("_has_head").isNull(), "missing_source").otherwise(reason)
    return joined.withColumn("reason", reason).drop("_has_head", "_has_tail")


def healed(nodes: DataFrame, source: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """nodes with null columns filled from source, and nodes of source added that are missing."""
    s = source.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    both = nodes.join(s, key, "full_outer")
    return both.select(key, *[F.coalesce(F.col(c), F.col(f"_{c}")).alias(c) for c in columns])


def reset(edges: DataFrame, hosts: DataFrame, contain: tuple[str, ...], depth: int = 4) -> DataFrame:
    """edges without those that hosts (node) or the clauses they contain have as head, but for relations in contain."""
    inside = closure(edges.where(F.col("rel_type").isin(*contain)), hosts, depth).select(F.col("node").alias("head")).distinct()
    kept = edges.where(F.col("rel_type").isin(*contain))
    return kept.unionByName(edges.where(~F.col("rel_type").isin(*contain)).join(inside, "head", "left_anti"))


def propagated(inserted: DataFrame, edges: DataFrame, created: DataFrame, depth: int = 3) -> DataFrame:
    """node, creator: descendants of inserted (node, creator) within depth steps that have no creator of their own (created: node)."""
    below = closure(edges, inserted.select("node").distinct(), depth).where("hops > 0")
    made = below.join(inserted.select(F.col("node").alias("start"), "creator"), "start").groupBy("node").agg(F.min(F.struct("hops", "creator"))["creator"].alias("creator"))
    return made.join(created.select("node").distinct(), "node", "left_anti")


def reconciled(expected: DataFrame, actual: DataFrame, key: list[str]) -> DataFrame:
    """key, state: missing (expected only), extra (actual only) or matched."""
    e, a = expected.select(*key).distinct().withColumn("_e", F.lit(1)), actual.select(*key).distinct().withColumn("_a", F.lit(1))
    state = F.when(F.col("_a").isNull(), "missing").when(F.col("_e").isNull(), "extra").otherwise("matched")
    return e.join(a, key, "full_outer").withColumn("state", state).drop("_e", "_a")


def exported(edges: DataFrame, as_head: dict[str, str], as_tail: dict[str, str]) -> DataFrame:
    """node, key, ids: the lists of each node under the names for either end, sorted and joined by a comma; self-loops are left
    out."""
    from weftline.operators.relations import mapped

    real = edges.where("head <> tail")
    out = real.select(F.col("head").alias("node"), mapped(F.col("rel_type"), as_head).alias("key"), F.col("tail").alias("other"))
    back = real.select(F.col("tail").alias("node"), mapped(F.col("rel_type"), as_tail).alias("key"), F.col("head").alias("other"))
    both = out.unionByName(back).where("key IS NOT NULL")
    return both.groupBy("node", "key").agg(F.array_join(F.transform(F.array_sort(F.collect_set("other")), lambda x: x.cast("string")), ",").alias("ids"))


def latest_nodes(nodes: DataFrame, key: str, at: str) -> DataFrame:
    """The last version of each node, whole: properties are replaced, not merged."""
    rest = [c for c in nodes.columns if c not in (key, at)]
    return nodes.groupBy(key).agg(F.max(F.struct(at, *rest)).alias("_v")).select(key, "_v.*")


def repeated_ids(nodes: DataFrame, key: str) -> DataFrame:
    """Ids that occur several times, and how often: empty if the key is unique."""
    return nodes.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def skeletons(nodes: DataFrame, key: str) -> DataFrame:
    """Nodes that have nothing but their id."""
    rest = [F.col(c).isNull() for c in nodes.columns if c != key]
    bare = rest[0]
    for c in rest[1:]:
        bare = bare & c
    return nodes.where(bare)

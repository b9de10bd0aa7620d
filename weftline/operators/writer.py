"""What a build writes to the graph: nodes, synthetic descendants, edges checked by a mode, and what it deletes; all as DataFrames.

A node is its id (node) and its class (VAN_BAN or DIEU_KHOAN); a clause's id is key#document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.fixed import CLAUSE_LEVELS, PRESERVED_RELATIONS
from weftline.operators.graph import ancestors, clause_id, doc_of

#: How edges with missing ends are treated: written all the same; written and noted; written after missing nodes are added; held back.
MODES = ("legacy", "shadow-strict", "strict-auto-heal", "strict-no-heal")
DIRECT_PROPERTIES = ("nguon_cap_nhat", "thoi_gian_cap_nhat")
INDIRECT_PROPERTIES = (*DIRECT_PROPERTIES, "danh_sach_id_lien_quan", "loai_quan_he", "mo_ta", "moi_quan_he_goc")


def prepared_nodes(docs: DataFrame, clauses: DataFrame, info: list[str]) -> DataFrame:
    """node, node_class, level, path and the info columns: one row for each document (doc_id) and each of its clauses (com_key, com_type, com_path)
    of a clause level. Documents without id give nothing; a clause without a key gives no row."""
    known = docs.where("doc_id IS NOT NULL")
    own = known.select(F.col("doc_id").cast("string").alias("node"), F.lit("VAN_BAN").alias("node_class"), F.lit(None).cast("string").alias("level"), F.lit(None).cast("string").alias("path"), *info)
    some = clauses.where(F.col("com_type").isin(*CLAUSE_LEVELS) & (F.coalesce("com_key", F.lit("")) != ""))
    parts = some.join(known.select("doc_id", *info), "doc_id").select(
        clause_id(F.col("com_key"), F.col("doc_id")).alias("node"), F.lit("DIEU_KHOAN").alias("node_class"), F.col("com_type").alias("level"), F.col("com_path").alias("path"), *info
    )
    return own.unionByName(parts)


def clause_keys(edges: DataFrame, relations: list[str], end: str = "tail") -> DataFrame:
    """doc, key of the clauses that edges of the relations have at an end: what was inserted, or what there is."""
    at = edges.where(F.col("rel_type").isin(*relations) & F.col(end).contains("#"))
    return at.select(doc_of(F.col(end)).alias("doc"), F.substring_index(end, "#", 1).alias("key")).distinct()


def anchors(targets: DataFrame, inserted: DataFrame, existing: DataFrame) -> DataFrame:
    """targets (doc, key) with anchor and hops: the nearest inserted key of the target's document at or above its key, else the nearest existing
    one, and the steps up to it. Targets without an anchor are left out."""
    own = targets.select("doc", "key").distinct()
    up = own.select("doc", F.col("key").alias("target"), F.posexplode(F.concat(F.array("key"), ancestors(F.col("key")))).alias("hops", "key"))
    known = inserted.select("doc", "key", F.lit(0).alias("kind")).unionByName(existing.select("doc", "key", F.lit(1).alias("kind"))).groupBy("doc", "key").agg(F.min("kind").alias("kind"))
    best = up.join(known, ["doc", "key"]).groupBy("doc", "target").agg(F.min(F.struct("kind", "hops", "key")).alias("b"))
    return best.select("doc", F.col("target").alias("key"), F.col("b.key").alias("anchor"), F.col("b.hops").alias("hops"))


def synthetic_edges(targets: DataFrame, inserted: DataFrame, existing: DataFrame) -> DataFrame:
    """head, tail, head_new: containment after insertion from each target (doc, key) up to its anchor; head_new says that the head is to be made, as it is
    not an existing clause."""
    found = anchors(targets, inserted, existing).where("hops > 0")
    path = F.concat(F.array("key"), ancestors(F.col("key")))
    steps = found.select("doc", "key", F.explode(F.transform(F.sequence(F.lit(1), F.col("hops")), lambda i: F.struct(F.get(path, i).alias("up"), F.get(path, i - 1).alias("down")))).alias("s"))
    edges = steps.select("doc", "s.up", "s.down").distinct()
    there = existing.select("doc", F.col("key").alias("up"), F.lit(True).alias("there")).distinct()
    return edges.join(there, ["doc", "up"], "left").select(clause_id(F.col("up"), F.col("doc")).alias("head"), clause_id(F.col("down"), F.col("doc")).alias("tail"), F.col("there").isNull().alias("head_new"))


def with_inserted_targets(nodes: DataFrame, edges: DataFrame, relations: list[str]) -> DataFrame:
    """nodes (node, node_class), and the clauses that edges of the relations insert (tail, tail_class); what is there already stays as it is."""
    made = edges.where(F.col("rel_type").isin(*relations) & (F.col("tail_class") == "DIEU_KHOAN") & F.col("tail").isNotNull())
    new = made.select(F.col("tail").alias("node"), F.col("tail_class").alias("node_class")).distinct().join(nodes.select("node").distinct(), "node", "left_anti")
    return nodes.unionByName(new, allowMissingColumns=True)


def remapped(edges: DataFrame, variants: DataFrame) -> DataFrame:
    """edges whose ends (head, tail) are put in place of the only variant that there is of them; variants has node and variant."""
    for end in ("head", "tail"):
        known = variants.select(F.col("node").alias(end), F.col("variant").alias("other"))
        edges = edges.join(known, end, "left").withColumn(end, F.coalesce("other", end)).drop("other")
    return edges


def written(edges: DataFrame, nodes: DataFrame, mode: str, source: DataFrame | None = None) -> DataFrame:
    """edges (head, tail) with status and reason in a mode. reason is missing_source or missing_target where an end is no node (node), else null; status
    is written, deferred, or in the shadow mode written with the reason noted. Healing adds the nodes of source that are missing first: written then
    with healed true. A null end is never there."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}")
    heals = mode == "strict-auto-heal" and source is not None
    known = nodes.select("node", F.lit(False).alias("added")).distinct()
    if heals:
        known = known.unionByName(source.select("node", F.lit(True).alias("added")).distinct()).groupBy("node").agg(F.min("added").alias("added"))
    out = edges
    for end in ("head", "tail"):
        out = out.join(known.select(F.col("node").alias(end), F.col("added").alias(f"{end}_added")), end, "left")
    reason = F.when(F.col("head_added").isNull(), "missing_source").when(F.col("tail_added").isNull(), "missing_target")
    status = F.lit("written") if mode in ("legacy", "shadow-strict") else F.when(reason.isNull(), "written").otherwise("deferred")
    noted = F.lit(None).cast("string") if mode == "legacy" else reason
    healed = F.coalesce(F.col("head_added") | F.col("tail_added"), F.lit(False)) & (status == "written")
    return out.withColumns({"status": status, "reason": noted, "healed": healed}).drop("head_added", "tail_added")


def resolved_targets(events: DataFrame, documents: DataFrame, mode: str = "strict") -> DataFrame:
    """events (target_doc) with resolved_doc and status: resolved; missing_target; or, permissive, skeleton_target, whose node an edge will make."""
    if mode not in ("strict", "permissive"):
        raise ValueError("mode must be strict or permissive")
    known = documents.select(F.col("doc_id").alias("target_doc"), F.lit(True).alias("there")).distinct()
    joined = events.join(known, "target_doc", "left")
    lost = F.lit("skeleton_target" if mode == "permissive" else "missing_target")
    status = F.when(F.col("target_doc").isNull(), "missing_target").when(F.col("there"), "resolved").otherwise(lost)
    return joined.withColumn("status", status).withColumn("resolved_doc", F.when(F.col("status") != "missing_target", F.col("target_doc"))).drop("there")


def edges_without(edges: DataFrame, docs: DataFrame, kind: str) -> DataFrame:
    """edges but for those that the documents of docs (doc_id) and their clauses have as head: kind 'status' direct ones, 'inferred' indirect
    ones (loai_quan_he gian_tiep). Containment always stays."""
    indirect = F.coalesce(F.col("loai_quan_he") == "gian_tiep", F.lit(False))
    chosen = (indirect if kind == "inferred" else ~indirect) & ~F.col("rel_type").isin(*PRESERVED_RELATIONS)
    doc = docs.select(F.col("doc_id").cast("string").alias("own")).distinct()
    gone = edges.withColumn("own", F.when(chosen, doc_of(F.col("head"))))
    return gone.join(doc, "own", "left_anti").select(*edges.columns)


def without_documents(nodes: DataFrame, edges: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """nodes and edges without the documents of docs (doc_id), their clauses and all edges at them."""
    doc = docs.select(F.col("doc_id").cast("string").alias("own")).distinct()
    left = nodes.withColumn("own", doc_of(F.col("node"))).join(doc, "own", "left_anti").select(*nodes.columns)
    for end in ("head", "tail"):
        edges = edges.withColumn("own", doc_of(F.col(end))).join(doc, "own", "left_anti").drop("own")
    return left, edges


def without_containment(edges: DataFrame) -> DataFrame:
    return edges.where(~F.col("rel_type").isin(*PRESERVED_RELATIONS))


def edge_properties(edges: DataFrame, source: str = "cmcai") -> DataFrame:
    """edges with props: JSON of the properties that their kind allows, direct or indirect, that are not null; maps are JSON texts in it, and the
    source is source where there is none."""

    def value(name: str) -> Column:
        if name not in edges.columns:
            return F.lit(source) if name == "nguon_cap_nhat" else F.lit(None).cast("string")
        kind = edges.schema[name].dataType.typeName()
        c = F.to_json(name) if kind in ("map", "struct", "array") else F.col(name).cast("string")
        return F.coalesce(c, F.lit(source)) if name == "nguon_cap_nhat" else c

    props = lambda names: F.to_json(F.struct(*[value(n).alias(n) for n in sorted(names)]))
    indirect = F.col("loai_quan_he") == "gian_tiep" if "loai_quan_he" in edges.columns else F.lit(False)
    return edges.withColumn("props", F.when(indirect, props(INDIRECT_PROPERTIES)).otherwise(props(DIRECT_PROPERTIES)))

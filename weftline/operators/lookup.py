"""Resolution of references: joins that give a target only where it is unambiguous."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.sources.scratch import stored


def unique_targets(table: DataFrame, key: list[str], target: str) -> DataFrame:
    """key and target for keys that have one target only."""
    return table.groupBy(*key).agg(F.min(target).alias(target), F.max(target).alias("_most")).where(F.col(target) == F.col("_most")).drop("_most")


def resolved(refs: DataFrame, table: DataFrame, key: list[str], target: str) -> DataFrame:
    """refs with target, null if the key has none or several. Equal references are looked up once."""
    asked = refs.select(*key).distinct().join(unique_targets(table, key, target), key)
    return refs.join(asked, key, "left")


def resolved_in_order(refs: DataFrame, tables: list[tuple[DataFrame, list[str]]], target: str) -> DataFrame:
    """refs with target from the first of tables whose key has just one."""
    out = refs
    for k, (table, key) in enumerate(tables):
        out = resolved(out, table.withColumnRenamed(target, f"_t{k}"), key, f"_t{k}")
    names = [f"_t{k}" for k in range(len(tables))]
    return out.withColumn(target, F.coalesce(*names)).drop(*names)


def as_of(refs: DataFrame, versions: DataFrame, key: list[str], ref_at: str, version_at: str, value: str) -> DataFrame:
    """refs with value of the latest version of the same key that is not later, and its version_at; null if none.

    Both are put in one sequence for each key, so no pair of a reference and an earlier version is made."""
    order = "_at"
    a = refs.withColumns({order: F.col(ref_at), "_ref": F.lit(1)}).withColumn("_row", F.struct(*[F.col(c) for c in refs.columns]))
    b = versions.select(*key, F.col(version_at).alias(order), F.lit(0).alias("_ref"), F.struct(F.col(version_at).alias("at"), F.col(value).alias("value")).alias("_v"))
    both = a.select(*key, order, "_ref", "_row").unionByName(b, allowMissingColumns=True)
    w = Window.partitionBy(*key).orderBy(order, "_ref", F.col("_v.value")).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_last", F.last("_v", ignorenulls=True).over(w)).where("_ref = 1")
    return found.select("_row.*", F.col("_last.at").alias(version_at), F.col("_last.value").alias(value))


def prefix_unique(refs: DataFrame, ids: DataFrame, within: list[str], ref: str, name: str, proper: bool = False) -> DataFrame:
    """refs with name: the only id of ids, within the same group, that ref starts (proper: and is shorter than); null if none or
    several. Pairs are made within a group only, which is a document's clauses."""
    pairs = refs.select(*within, ref).distinct().join(ids.select(*within, F.col(name).alias("_id")).distinct(), within).where(F.col("_id").startswith(F.col(ref)))
    if proper:
        pairs = pairs.where(F.col("_id") != F.col(ref))
    one = pairs.groupBy(*within, ref).agg(F.min("_id").alias(name), F.count("*").alias("_n")).where("_n = 1").drop("_n")
    return refs.join(one, [*within, ref], "left")


#: Titles with the same token that a reference is compared with in one round: a small part of them first, as two that fit settle a reference.
PARTS = (32, 1024)
#: Rows of tokens that are broadcast.
FEW = 1 << 18


def _ranked(df: DataFrame, key: str, toks: str, freq: DataFrame, least: float) -> DataFrame:
    """_id, _set (the tokens, the rarest first), _n of them, _bits and _others (what the tokens hash to) and _first, the tokens of which two sets
    that fit share one."""
    one = df.select(F.col(key).alias("_id"), F.array_distinct(toks).alias("_set")).where(F.size("_set") > 0)
    apart = one.select("_id", F.xxhash64(F.array_sort("_set")).alias("_h"), F.explode("_set").alias("tok")).join(freq, "tok", "left")
    tokens = F.array_sort(F.collect_set(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "tok")))
    sets = apart.groupBy("_id", "_h").agg(tokens.alias("_t")).select("_id", F.col("_t.tok").alias("_set")).withColumn("_n", F.size("_set"))
    bits = lambda seed: F.expr(f"aggregate(_set, 0L, (b, t) -> b | shiftleft(1L, CAST(pmod(xxhash64(t, {seed}), 64) AS INT)))")
    first = F.slice("_set", F.lit(1), (F.col("_n") - F.ceil(F.lit(least) * F.col("_n") - F.lit(1e-9)) + 1).cast("int"))
    return sets.select("_id", "_set", "_n", bits(0).alias("_bits"), bits(1).alias("_others"), first.alias("_first"))


def _fitting(refs: DataFrame, titles: DataFrame, often: DataFrame, size: int, every: bool, least: float, proper: bool) -> DataFrame:
    """_id, and the least and greatest (_lo, _hi) of the titles that fit it among those that share a token of often. A token's titles, of which
    there are _c, are dealt into parts of about size; a reference meets those in one of them, or in every one."""
    spread = lambda df: df.select(*[c for c in df.columns if c != "_first"], F.explode("_first").alias("tok"))
    a, b = spread(refs), spread(titles)
    a, b = a.join(often, "tok"), b.join(often, "tok")
    parts = F.ceil(F.col("_c") / size)
    place = F.pmod(F.xxhash64("_id"), parts)
    a = a.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)) if every else place).drop("_c")
    b = b.withColumn("_part", place).drop("_c")
    b = b.select("tok", "_part", *[F.col(c).alias(f"{c}_b") for c in b.columns if c not in ("tok", "_part")])
    # Bits of one set that the other has not are as many tokens at least that they do not share.
    room = lambda x, y, n: F.col(n) - F.greatest(*[F.bit_count(F.col(k + x).bitwiseAND(F.bitwise_not(F.col(k + y)))) for k in ("_bits", "_others")])
    need = (F.col("_n") + F.col("_n_b")) * F.lit(least) - F.lit(1e-9)
    may = (F.least("_n", "_n_b") * F.lit(1 + least) >= need) & (room("", "_b", "_n") * F.lit(1 + least) >= need) & (room("_b", "", "_n_b") * F.lit(1 + least) >= need)
    jaccard: Column = F.size(F.array_intersect("_set", "_set_b")) / F.size(F.array_union("_set", "_set_b"))
    fits = may & (F.col("_id") != F.col("_id_b")) if proper else may
    met = a.join(b, (a["tok"] == b["tok"]) & (a["_part"] == b["_part"]) & fits & (jaccard >= least))
    return met.groupBy("_id").agg(F.min("_id_b").alias("_lo"), F.max("_id_b").alias("_hi"))


def fuzzy_unique(refs: DataFrame, titles: DataFrame, ref_tokens: str, title_tokens: str, ref_id: str, title_id: str, least: float, proper: bool = False) -> DataFrame:
    """ref_id and title_id where just one title (proper: other than ref_id) has a Jaccard of at least least.

    Sets that fit share one of their rarest tokens, so no cross join is made. Where many titles share one, a reference meets a part of them first;
    one that two fit needs no further look, so groups of like titles make no square of pairs. What is left meets all of them. Sets are compared
    in the join, so that no pairs are stored."""
    freq = titles.select(F.explode(F.array_distinct(title_tokens)).alias("tok")).groupBy("tok").agg(F.count("*").alias("df"))
    b = stored(_ranked(titles, title_id, title_tokens, freq, least), "titles")
    a = stored(_ranked(refs, ref_id, ref_tokens, freq, least), "refs")
    counts = stored(b.select(F.explode("_first").alias("tok")).groupBy("tok").agg(F.count("*").alias("_c")), "counts")
    most = counts.agg(F.max("_c")).first()[0] or 0
    found, below = [], 0
    for size, every in (*((n, False) for n in PARTS), (PARTS[-1], True)):
        if most <= below:
            break
        often = counts.where(F.col("_c") > below)
        often = F.broadcast(often) if often.count() <= FEW else often
        met = stored(_fitting(a, b, often, size, every, least, proper), "found")
        found.append(met)
        a, below = a.join(met.where("_lo <> _hi").select("_id"), "_id", "left_anti"), size
    if not found:
        return a.select(F.col("_id").alias(ref_id), F.col("_id").alias(title_id)).limit(0)
    all_found = found[0]
    for met in found[1:]:
        all_found = all_found.unionByName(met)
    one = all_found.groupBy("_id").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi")).where(F.col("_lo") == F.col("_hi"))
    return one.select(F.col("_id").alias(ref_id), F.col("_lo").alias(title_id))

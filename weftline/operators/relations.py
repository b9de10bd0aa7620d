"""Operators on relations between sources and targets: priority, conflict, merging, inference, precedence, direction."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def mapped(value: Column, pairs: dict) -> Column:
    """value looked up in pairs; null if absent."""
    return F.element_at(F.create_map(*[F.lit(x) for x in chain(*pairs.items())]), value) if pairs else F.lit(None)


def rank_of(relation: Column, groups: tuple[tuple[str, ...], ...]) -> Column:
    """Number of the group that a relation is in, from 0; null if in none."""
    out = F.lit(None).cast("int")
    for k, names in enumerate(groups):
        out = F.when(relation.isin(*names), k).otherwise(out)
    return out


def strongest_group(df: DataFrame, key: list[str], relation: str, groups: tuple[tuple[str, ...], ...]) -> DataFrame:
    """Within key, rows of the strongest group present stay, and rows of no group; all rows of that group stay.

    The least rank is aggregated before the shuffle and joined back, so a hot key is not gathered in one window."""
    ranked = df.withColumn("_rank", rank_of(F.col(relation), groups))
    least = ranked.where("_rank IS NOT NULL").groupBy(*key).agg(F.min("_rank").alias("_least"))
    return ranked.join(least, key, "left").where("_rank IS NULL OR _rank = _least").drop("_rank", "_least")


def best_relation(df: DataFrame, key: list[str], priority: Column, ties: list[Column]) -> DataFrame:
    """One row for each key: the greatest priority, then the order of ties."""
    order = Window.partitionBy(*key).orderBy(priority.desc(), *ties)
    return df.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def merged_edges(edges: DataFrame, key: list[str], first: dict[str, tuple[str, str]] | None = None, **aggs: Column) -> DataFrame:
    """One row for each key, with aggregated properties; first maps a new column to (column, order column), the value at the
    least order."""
    made = [F.min_by(v, o).alias(k) for k, (v, o) in (first or {}).items()] + [c.alias(k) for k, c in aggs.items()]
    return edges.groupBy(*key).agg(*made)


def first_edges(edges: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by order."""
    return edges.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_n = 1").drop("_n")


def inferred(relations: DataFrame, to: dict[str, str], source: str, target: str, relation: str, target_key: str) -> DataFrame:
    """Document relations that clause relations imply: source, target, inferred, relation, n (distinct target keys) and keys, those
    sorted and joined by a comma."""
    own = relations.withColumn("inferred", F.coalesce(mapped(F.col(relation), to), F.col(relation)))
    return own.groupBy(source, target, "inferred", relation).agg(F.collect_set(target_key).alias("_k")).select(
        source, target, "inferred", relation, F.size("_k").cast("long").alias("n"), F.array_join(F.array_sort("_k"), ",").alias("keys")
    )


def merged_inferred(rows: DataFrame, source: str, target: str, relation: str) -> DataFrame:
    """One row for each source, target and inferred relation: its relations, sorted and joined, and the sum of n."""
    return rows.groupBy(source, target, "inferred").agg(F.array_join(F.array_sort(F.collect_set(relation)), ",").alias("relations"), F.sum("n").alias("n"))


def without(strong: DataFrame, weak: DataFrame, key: list[str]) -> DataFrame:
    """Rows of weak whose key strong lacks; null keys never meet."""
    return weak.join(strong.select(*key).distinct(), key, "left_anti")


def without_other_group(stored: DataFrame, new: DataFrame, key: list[str], group: str) -> DataFrame:
    """Rows of new unless stored has the same key in another group. The stored groups are aggregated to their least and greatest."""
    held = stored.groupBy(*key).agg(F.min(group).alias("_g1"), F.max(group).alias("_g2"))
    return new.join(held, key, "left").where(F.col("_g1").isNull() | ((F.col("_g1") == F.col(group)) & (F.col("_g2") == F.col(group)))).drop("_g1", "_g2")


def directed(df: DataFrame, keys: dict[str, tuple[str, bool]], key: str, own: str, other: str) -> DataFrame:
    """head, rel_type, tail of curated rows: keys maps a list key to the relation and whether the other document is the head."""
    rel = mapped(F.col(key), {k: r for k, (r, _) in keys.items()})
    flip = F.coalesce(mapped(F.col(key), {k: f for k, (_, f) in keys.items()}), F.lit(False))
    made = df.withColumns({"rel_type": rel, "head": F.when(flip, F.col(other)).otherwise(F.col(own)), "tail": F.when(flip, F.col(own)).otherwise(F.col(other))})
    return made.where("rel_type IS NOT NULL")

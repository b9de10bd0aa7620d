"""Sampling and corpus preparation: allocation, seeded and even picks, splits, caps, de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.text import hash_bucket
from weftline.sources.scratch import stored


def ranked(df: DataFrame, group: list[str], order: list[Column | str], name: str) -> DataFrame:
    """df with name: the rank of a row within its group, from 1, ties broken anyhow among rows equal in order.

    Rows are dealt by ranges of group and order, numbered within each range, and moved on by what the ranges before hold of the
    group. So a group that a third of the rows are in is spread over many tasks."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    dealt = stored(df.repartitionByRange(n, *[F.col(c) for c in group], *keys).withColumn("_part", F.spark_partition_id()), "ranges")
    within = dealt.withColumn("_row", F.row_number().over(Window.partitionBy("_part", *group).orderBy(*keys)))
    held = dealt.groupBy("_part", *group).agg(F.count("*").alias("_held"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offset = held.withColumn("_before", F.coalesce(F.sum("_held").over(before), F.lit(0))).select(F.col("_part").alias("_p"), *[F.col(c).alias(f"_g{k}") for k, c in enumerate(group)], "_before")
    same = F.col("_part") == F.col("_p")
    for k, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{k}"))
    return within.join(offset, same).withColumn(name, F.col("_row") + F.col("_before")).select(*df.columns, name)


def allocated(cells: DataFrame, weight: Column, total: int, ties: list[str]) -> DataFrame:
    """cells with quota: total shared out by weight, the largest remainders rounded up, ties in the order of ties. cells is a table
    of strata, a few rows."""
    whole = Window.partitionBy()
    share = cells.withColumn("_exact", weight * total / F.sum(weight).over(whole)).withColumn("_base", F.floor("_exact"))
    rank = F.row_number().over(Window.partitionBy().orderBy(F.round(F.col("_exact") - F.col("_base"), 9).desc(), *ties))
    left = share.withColumns({"_rank": rank, "_left": F.lit(total) - F.sum("_base").over(whole)})
    return left.withColumn("quota", (F.col("_base") + (F.col("_rank") <= F.col("_left")).cast("long")).cast("long")).drop("_exact", "_base", "_rank", "_left")


def seeded_order(seed: int, *ids: str) -> list[Column]:
    return [F.sha1(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in ids])), *map(F.col, ids)]


def sample_by_cell(df: DataFrame, cell: list[str], quota: Column, seed: int, *ids: str) -> DataFrame:
    """Up to quota rows of each cell, by a seeded hash of their ids."""
    ranked = df.withColumn("_n", F.row_number().over(Window.partitionBy(*cell).orderBy(*seeded_order(seed, *ids))))
    return ranked.where(F.col("_n") <= quota).drop("_n")


def round_robin(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """df with turn, the rank within group; sorted by turn and group the groups alternate."""
    return ranked(df, group, order, "turn")


def capped(df: DataFrame, group: list[str], order: list[str], cap: int) -> DataFrame:
    """The first cap rows of each group: a cap that the export states. Spark keeps no more than cap rows of a group in each task before it
    shuffles."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("_n") <= cap).drop("_n")


def evenly_spaced(df: DataFrame, group: list[str], order: list[str], k: int) -> DataFrame:
    """k rows of each group at even distances, first and last among them, places rounded half to even; all rows of smaller ones."""
    sizes = df.groupBy(*group).agg(F.count("*").alias("_n")).select(*[F.col(c).alias(f"_s{k}") for k, c in enumerate(group)], "_n")
    same = F.lit(True)
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_s{i}"))
    placed = ranked(df, group, order, "_i").join(sizes, same)
    spots = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.bround(i * (F.col("_n") - 1) / F.lit(max(1, k - 1))).cast("long"))
    return placed.where((F.col("_n") <= k) | F.array_contains(spots, F.col("_i") - 1)).select(*df.columns)


def stable_split(key: Column, validation: float, test: float = 0.0) -> Column:
    """train, validation or test by a hash of key, the same in every run. Shares are compared as integers."""
    top = 0xFFFFFFFF
    bucket = hash_bucket(key)
    train = 1 - validation - test
    return F.when(bucket < F.lit(int(train * top)), "train").when(bucket < F.lit(int((train + validation) * top)), "validation").otherwise("test" if test else "validation")


def first_of_text(df: DataFrame, text: Column, order: list[str]) -> DataFrame:
    """The first row of each text, by its SHA-1. The first is found by a partial aggregation, so a text that a third of the rows
    have is not gathered in one task."""
    keyed = df.withColumn("_h", F.sha1(text))
    first = keyed.groupBy("_h").agg(F.min(F.struct(*order)).alias("_f"))
    return keyed.join(first, "_h").where(F.struct(*order) == F.col("_f")).drop("_h", "_f")


def chunks(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """df with chunk: 1 to n, near-equal, the first ones larger by one."""
    total = df.agg(F.count("*").alias("_total"))
    placed = ranked(df, [], order, "_i").join(F.broadcast(total), how="cross")  # one row
    small, more = F.floor(F.col("_total") / n), F.col("_total") % n
    at = F.col("_i") - 1
    in_large = F.floor(at / (small + 1))
    chunk = F.when(at < more * (small + 1), in_large).otherwise(more + F.floor((at - more * (small + 1)) / F.greatest(small, F.lit(1)))) + 1
    return placed.withColumn("chunk", chunk.cast("int")).select(*df.columns, "chunk")


def ordered_union(tables: list[DataFrame], key: str) -> DataFrame:
    """Distinct ids of tables, with source: the first table that has one, from 0."""
    every = None
    for k, t in enumerate(tables):
        part = t.select(key, F.lit(k).alias("source"))
        every = part if every is None else every.unionByName(part)
    return every.groupBy(key).agg(F.min("source").alias("source"))


def new_ids(found: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Ids of found that known lacks."""
    return found.select(key).distinct().join(known.select(key).distinct(), key, "left_anti")

"""Operators on spans: selection between cues and references, fences, runs, overlaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def drop_overlaps(spans: Column) -> Column:
    """Of an array of structs (start, stop, ...) those left if the longest goes first, ties by start, and whatever overlaps one that is
    taken is dropped; sorted by start."""
    ranked = F.array_sort(F.transform(spans, lambda s: F.struct((s["start"] - s["stop"]).alias("_len"), s["start"].alias("_start"), s.alias("s"))))
    none = F.slice(F.transform(ranked, lambda r: r["s"]), 1, 0)

    def take(got: Column, r: Column) -> Column:
        free = ~F.exists(got, lambda g: (r["s"]["start"] < g["stop"]) & (g["start"] < r["s"]["stop"]))
        return F.when(free, F.concat(got, F.array(r["s"]))).otherwise(got)

    return F.array_sort(F.aggregate(ranked, none, take))


def fenced(cues: DataFrame, key: list[str], at: str) -> DataFrame:
    """cues with fence: the next cue's place within key, null for the last."""
    return cues.withColumn("fence", F.lead(at).over(Window.partitionBy(*key).orderBy(at)))


def forward_targets(cues: DataFrame, refs: DataFrame, key: list[str], cue_at: str, ref_at: str, cue: str) -> DataFrame:
    """Each reference with the cue whose reach it is in: after the cue and before the next one of the same key, neither end included.
    Of cues at one place the last by cue counts.

    That cue is the last one that is not after the reference, so one pass over both, in order, finds it, and no pairs are made."""
    a = cues.select(*key, F.col(cue_at).alias("_at"), F.lit(0).alias("_ref"), F.col(cue).alias("_order"), F.struct(*cues.columns).alias("_cue"))
    b = refs.select(*key, F.col(ref_at).alias("_at"), F.lit(1).alias("_ref"), F.struct(*[c for c in refs.columns if c not in key]).alias("_row"))
    w = Window.partitionBy(*key).orderBy("_at", "_ref", "_order").rowsBetween(Window.unboundedPreceding, 0)
    both = a.unionByName(b, allowMissingColumns=True).withColumn("_last", F.last("_cue", ignorenulls=True).over(w))
    own = [f"_last.{c}" for c in cues.columns if c not in key]
    return both.where((F.col("_ref") == 1) & (F.col(f"_last.{cue_at}") < F.col("_at"))).select(*key, *own, "_row.*")


def nearest_refs(cues: DataFrame, refs: DataFrame, key: list[str], cue: str, cue_at: str, ref: str, ref_at: str, k: int) -> DataFrame:
    """key, cue, ref, side, distance, rank: the k nearest references of each cue on the side whose nearest one is nearer; a tie goes to the
    side before, and of equally near ones the least ref is nearer.

    References are numbered in order within the key, each cue learns how many are before it, and takes its k by number: no more than k
    rows a cue are made."""
    w = Window.partitionBy(*key)
    # Numbered twice, so that counting back and counting on both meet the least ref first.
    numbered = refs.select(*key, F.col(ref).alias("ref"), F.col(ref_at).alias("_rs")).withColumns(
        {"_up": F.row_number().over(w.orderBy("_rs", F.col("ref").desc())), "_down": F.row_number().over(w.orderBy("_rs", "ref"))}
    )
    places = cues.select(*key, F.col(cue).alias("cue"), F.col(cue_at).alias("_at"))
    marks = places.select(*key, "cue", "_at", F.lit(None).cast("int").alias("_one")).unionByName(numbered.select(*key, F.lit(None).alias("cue"), F.col("_rs").alias("_at"), F.lit(1).alias("_one")))
    upto = w.orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    below = w.orderBy("_at").rangeBetween(Window.unboundedPreceding, -1)
    counted = marks.withColumns({"_n_upto": F.count("_one").over(upto), "_n_below": F.count("_one").over(below)}).where("_one IS NULL").drop("_one")
    steps = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_step")
    wanted = counted.select("*", steps)
    back = wanted.withColumn("_up", F.col("_n_upto") - F.col("_step")).join(numbered, [*key, "_up"]).select(*key, "cue", "ref", F.lit("back").alias("side"), (F.col("_at") - F.col("_rs")).alias("distance"))
    ahead = wanted.withColumn("_down", F.col("_n_below") + 1 + F.col("_step")).join(numbered, [*key, "_down"]).select(*key, "cue", "ref", F.lit("ahead").alias("side"), (F.col("_rs") - F.col("_at")).alias("distance"))
    both = back.unionByName(ahead)
    own = Window.partitionBy(*key, "cue")
    best = F.min(F.struct("distance", F.when(F.col("side") == "back", 0).otherwise(1).alias("z"), "side")).over(own)["side"]
    kept = both.withColumn("_side", best).where("side = _side").drop("_side")
    return kept.withColumn("rank", F.row_number().over(own.orderBy("distance", "ref"))).where(F.col("rank") <= k)


def nearest_side(pairs: DataFrame, cue: list[str], cue_start: str, cue_stop: str, ref_start: str, ref_stop: str) -> DataFrame:
    """For each cue the references on the side whose nearest one is nearer; a tie goes to the side before."""
    back = F.when(F.col(ref_stop) <= F.col(cue_start), F.col(cue_start) - F.col(ref_stop))
    ahead = F.when(F.col(ref_start) >= F.col(cue_stop), F.col(ref_start) - F.col(cue_stop))
    w = Window.partitionBy(*cue)
    found = pairs.withColumns({"_back": back, "_ahead": ahead}).withColumns({"_b": F.min("_back").over(w), "_a": F.min("_ahead").over(w)})
    side = F.when(F.col("_b").isNotNull() & (F.col("_a").isNull() | (F.col("_b") <= F.col("_a"))), "back").when(F.col("_a").isNotNull(), "ahead")
    found = found.withColumn("side", side)
    kept = ((F.col("side") == "back") & F.col("_back").isNotNull()) | ((F.col("side") == "ahead") & F.col("_ahead").isNotNull())
    return found.where(kept).withColumn("distance", F.when(F.col("side") == "back", F.col("_back")).otherwise(F.col("_ahead"))).drop("_back", "_ahead", "_b", "_a")


def islands(df: DataFrame, key: list[str], at: list[str], gap: Column) -> DataFrame:
    """df with island: the number, from 0, of the run that a row is in; gap is true for a row that starts a new one, and may use
    _before, the first of at in the row before."""
    w = Window.partitionBy(*key).orderBy(*at)
    marked = df.withColumn("_before", F.lag(at[0]).over(w))
    first = F.when(F.col("_before").isNull(), 0).when(gap, 1).otherwise(0)
    return marked.withColumn("island", F.sum(first).over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_before")


def nearest_k(pairs: DataFrame, cue: list[str], distance: str, start: str, k: int) -> DataFrame:
    """The k nearest rows for each cue, with rank."""
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy(*cue).orderBy(distance, start)))
    return ranked.where(F.col("rank") <= k)


def nearest_before(df: DataFrame, key: list[str], at: list[str], value: str, name: str) -> DataFrame:
    """df with the last non-null value of the rows before, within key."""
    w = Window.partitionBy(*key).orderBy(*at).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def nearest_after(df: DataFrame, key: list[str], at: list[str], value: str, name: str) -> DataFrame:
    """df with the row's own value, else the first non-null value of the rows after, within key."""
    w = Window.partitionBy(*key).orderBy(*at).rowsBetween(0, Window.unboundedFollowing)
    return df.withColumn(name, F.first(value, ignorenulls=True).over(w))


def expand_list(value: Column) -> Column:
    """Array of the values in a list such as '3, 4 và 5', in order."""
    return F.filter(F.transform(F.split(value, r"\s*(?:,|;|\bvà\b|\band\b)\s*"), lambda x: F.trim(x)), lambda x: x != "")

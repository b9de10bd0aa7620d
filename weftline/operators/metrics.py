"""Quality metrics: counts of outcomes, precision and recall, intervals, thresholds, comparisons of two systems."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions.fixed import Z_95


def ratio(a: Column, b: Column, digits: int = 6) -> Column:
    return F.round(F.when(b > 0, a / b).otherwise(0.0), digits)


def scores(df: DataFrame, gold: Column, said: Column, sets: list[list[str]]) -> DataFrame:
    """tp, fp, fn, precision, recall, f1 for each of the grouping sets; columns that a set lacks are null there."""
    marked = df.withColumns({"_tp": (gold & said).cast("long"), "_fp": (~gold & said).cast("long"), "_fn": (gold & ~said).cast("long")})
    names = list(dict.fromkeys(c for s in sets for c in s))
    got = marked.groupingSets([[F.col(c) for c in s] for s in sets], *names).agg(F.sum("_tp").alias("tp"), F.sum("_fp").alias("fp"), F.sum("_fn").alias("fn"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return got.withColumns({"precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn), "f1": ratio(2 * tp, 2 * tp + fp + fn)})


def wilson(successes: Column, total: Column, z: float = Z_95) -> tuple[Column, Column, Column]:
    """Point, low and high of the Wilson score interval; zeros for no trials."""
    n = total.cast("double")
    p = successes / n
    z2 = z * z
    centre, margin = p + z2 / (2 * n), z * F.sqrt((p * (1 - p) + z2 / (4 * n)) / n)
    some = total > 0
    zero = F.lit(0.0)
    low, high = F.greatest(zero, (centre - margin) / (1 + z2 / n)), F.least(F.lit(1.0), (centre + margin) / (1 + z2 / n))
    return F.when(some, p).otherwise(zero), F.when(some, low).otherwise(zero), F.when(some, high).otherwise(zero)


def mcnemar_chi2(only_a: Column, only_b: Column) -> Column:
    """Chi-square with continuity correction; 0 if the systems never differ."""
    n = only_a + only_b
    return F.when(n > 0, F.pow(F.abs(only_a - only_b) - 1, 2) / n).otherwise(0.0)


@F.pandas_udf(T.DoubleType())
def chi2_p_value(chi2: pd.Series) -> pd.Series:
    """Two-sided p for one degree of freedom; Spark has no erfc."""
    return chi2.map(lambda x: None if x is None else math.erfc(math.sqrt(x / 2)))


def thresholds(scored: DataFrame, key: list[str], score: str, good: Column, target: float, least: int) -> DataFrame:
    """For each key the score threshold that accepts most rows with a Wilson lower bound of at least target on their precision, and
    count, n_good and low; keys without one are left out. Equal scores are added up first."""
    per = scored.groupBy(*key, score).agg(F.count("*").alias("n"), F.sum(good.cast("long")).alias("g"))
    w = Window.partitionBy(*key).orderBy(F.col(score).desc()).rowsBetween(Window.unboundedPreceding, 0)
    run = per.withColumns({"count": F.sum("n").over(w), "n_good": F.sum("g").over(w)})
    run = run.withColumn("low", wilson(F.col("n_good"), F.col("count"))[1]).where((F.col("count") >= least) & (F.col("low") >= target))
    return run.groupBy(*key).agg(F.max(F.struct("count", F.col(score).alias("threshold"), "n_good", "low")).alias("_b")).select(*key, "_b.threshold", "_b.count", "_b.n_good", "_b.low")


def transitions(df: DataFrame, a_right: Column, b_right: Column) -> Column:
    """How a case changes from system a to system b."""
    return F.when(a_right & b_right, "kept").when(a_right, "broken").when(b_right, "fixed").otherwise("wrong")


def index_quartiles(df: DataFrame, key: list[str], value: str) -> DataFrame:
    """key, n, q1, q3: the values at index n // 4 and 3 n // 4 in order, not interpolated."""
    w = Window.partitionBy(*key)
    ranked = df.withColumns({"_i": F.row_number().over(w.orderBy(value)) - 1, "_n": F.count("*").over(w)})
    at = lambda i: F.max(F.when(F.col("_i") == i, F.col(value)))
    return ranked.groupBy(*key).agg(F.max("_n").alias("n"), at(F.floor(F.col("_n") / 4)).alias("q1"), at(F.floor(3 * F.col("_n") / 4)).alias("q3"))


def trimmed_stats(df: DataFrame, key: list[str], value: str, fence: float = 1.5) -> DataFrame:
    """Count, mean, least and most of the values within fence quartile distances of the index quartiles."""
    q = index_quartiles(df, key, value)
    span = fence * (F.col("q3") - F.col("q1"))
    inside = df.join(q, key).where((F.col(value) >= F.col("q1") - span) & (F.col(value) <= F.col("q3") + span))
    return inside.groupBy(*key).agg(F.count("*").alias("kept"), F.max("n").alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("stdev"), F.min(value).alias("least"), F.max(value).alias("most"))


def greedy_matches(units: DataFrame, key: list[str]) -> DataFrame:
    """key, pred, gold: for each unit, with arrays preds and golds of (ref, relation) in order, each prediction takes the first gold
    that is left with the same reference and relation; guidance relations count as the same. Unmatched ones have a null."""
    guidance = {"quy_dinh_chi_tiet", "huong_dan"}

    def run(frames):
        for pdf in frames:
            out = []
            for row in pdf.itertuples(index=False):
                left = [tuple(g.values()) if isinstance(g, dict) else tuple(g) for g in row.golds]
                at = [getattr(row, k) for k in key]
                for p in row.preds:
                    ref, rel = tuple(p.values()) if isinstance(p, dict) else tuple(p)
                    hit = next((k for k, g in enumerate(left) if g is not None and g[0] == ref and (g[1] == rel or {g[1], rel} <= guidance)), None)
                    out.append((*at, f"{ref}|{rel}", None if hit is None else f"{left[hit][0]}|{left[hit][1]}"))
                    if hit is not None:
                        left[hit] = None
                out += [(*at, None, f"{g[0]}|{g[1]}") for g in left if g is not None]
            yield pd.DataFrame(out, columns=[*key, "pred", "gold"])

    kinds = ", ".join(f"`{k}` {units.schema[k].dataType.simpleString()}" for k in key)
    return units.select(*key, "preds", "golds").mapInPandas(run, f"{kinds}, pred string, gold string")


def coverage(gold: DataFrame, candidates: DataFrame, unit: list[str], relation: str, reference: str) -> DataFrame:
    """relation, total, covered, recall_ceiling: how many gold pairs of each relation some candidate of the same unit has."""
    key = [*unit, relation, reference]
    seen = candidates.select(*key).distinct().withColumn("hit", F.lit(1))
    counted = gold.join(seen, key, "left").groupBy(relation).agg(F.count("*").alias("total"), F.count("hit").alias("covered"))
    return counted.withColumn("recall_ceiling", ratio(F.col("covered"), F.col("total")))


def route(score: Column, accept: Column, reject: Column, rest: str = "UNCERTAIN") -> Column:
    return F.when(score >= accept, "ACCEPT").when(score <= reject, "REJECT").otherwise(rest)


def routing(scored: DataFrame, score: str, accept: str, reject: str, label: str) -> DataFrame:
    """route, n, coverage, decision_precision: shares of all rows, and of right decisions; null for those left uncertain."""
    routed = scored.select(route(F.col(score), F.col(accept), F.col(reject)).alias("route"), F.col(label).alias("label"))
    right = F.count_if(((F.col("route") == "ACCEPT") & (F.col("label") == 1)) | ((F.col("route") == "REJECT") & (F.col("label") == 0)))
    each = routed.groupBy("route").agg(F.count("*").alias("n"), right.alias("right"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))  # of three rows at most
    precision = F.when(F.col("route") != "UNCERTAIN", ratio(F.col("right"), F.col("n")))
    return each.select("route", "n", ratio(F.col("n"), total).alias("coverage"), precision.alias("decision_precision"))


def abstained(scored: DataFrame, score: str, accept: str, reject: str, digits: int = 9) -> DataFrame:
    """The rows that are neither accepted nor rejected, with distance to the nearer decision; sort by it for the queue."""
    left = scored.where(route(F.col(score), F.col(accept), F.col(reject)) == "UNCERTAIN")
    return left.withColumn("distance", F.round(F.least(F.abs(F.col(score) - F.col(accept)), F.abs(F.col(score) - F.col(reject))), digits))

"""URL filters: path-prefix rules, then exact list membership by a Bloom filter cascade, without a join.

Level 0 holds the listed keys; level 1 the keys of the corpus that level 0 takes by mistake; level 2 the listed keys that
level 1 takes by mistake; and so on until a level errs nowhere. Because the levels have seen every key of the corpus, the
first level that refuses a key settles its membership exactly: after an odd number of levels passed it is listed, else not.

Keys are cut into shards by a hash, KEYS_PER_SHARD keys each, and every shard has a cascade of its own, so building needs
bounded memory at any size. If all cascades together fit BROADCAST_BYTES, they are broadcast and pages are judged where they
lie; otherwise pages are dealt to the shards, each shard's few hundred kilobytes being copied to SALTS tasks, so that a hot
key's pages are split. Either way no page is joined with the list.

Defined results. Null url, or no '://': host and path are empty, the key is the empty string, and the verdict follows the
list alone. Repeated pages give a row each. Null listed keys are passed over. An empty list allows whatever no rule fits.
Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import BROADCAST_BYTES, ascii_lower, stored

#: (rule, verdict); a rule is host and path prefix, joined. The contract fixes these values.
RULES = (("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block"))
KEYS_PER_SHARD = 200_000
SALTS = 16
BITS_PER_KEY = (10, 5)  # of level 0, of the others
MAX_LEVELS = 64


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """The longest rule that fits, else null; of equally long ones the first."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        at, _, prefix = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + prefix)
        found = F.when(fits, rule).otherwise(found)
    return found


def _probe(bits: np.ndarray, h1: np.ndarray, h2: np.ndarray, level: int, k: int) -> np.ndarray:
    """Slots of each key, as an array of shape (keys, k)."""
    step = (h2 | np.uint64(1)) + np.uint64(2 * level)
    start = h1 + np.uint64((level * 0x9E3779B97F4A7C15) & (2**64 - 1))
    mixed = start[:, None] + np.arange(k, dtype=np.uint64)[None, :] * step[:, None]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(20)) % np.uint64(8 * len(bits))


def _passes(bits: np.ndarray, h1: np.ndarray, h2: np.ndarray, level: int, k: int) -> np.ndarray:
    slots = _probe(bits, h1, h2, level, k)
    return ((bits[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def build_levels(h1: np.ndarray, h2: np.ndarray, listed: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """The cascade of one shard: (bits, number of hashes) per level. Empty if nothing is listed."""
    inside, outside, levels = np.flatnonzero(listed), np.flatnonzero(~listed), []
    while len(inside):
        level = len(levels)
        if level == MAX_LEVELS:
            raise ValueError("two keys have the same 128-bit hash")
        per = BITS_PER_KEY[min(level, 1)]
        bits, k = np.zeros(max(8, -(-len(inside) * per // 8)), dtype=np.uint8), max(1, round(per * 0.69))
        slots = _probe(bits, h1[inside], h2[inside], level, k).ravel()
        np.bitwise_or.at(bits, slots >> np.uint64(3), np.uint8(1) << (slots & np.uint64(7)).astype(np.uint8))
        levels.append((bits, k))
        wrong = outside[_passes(bits, h1[outside], h2[outside], level, k)] if len(outside) else outside
        inside, outside = wrong, inside
    return levels


def is_listed(levels: list[tuple[np.ndarray, int]], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    passed = np.zeros(len(h1), dtype=np.int64)
    left = np.arange(len(h1))
    for level, (bits, k) in enumerate(levels):
        left = left[_passes(bits, h1[left], h2[left], level, k)]
        passed[left] += 1
    return passed % 2 == 1


def hashed(df: DataFrame, key: str, n_shards: int) -> DataFrame:
    return df.withColumns({"_h1": F.xxhash64(key), "_h2": F.xxhash64(F.lit("second"), key), "_shard": F.pmod(F.xxhash64(key, F.lit("shard")), F.lit(n_shards)).cast("int")})


def cascades(universe: DataFrame, listed: DataFrame, keys_per_shard: int = KEYS_PER_SHARD) -> DataFrame:
    """_shard, level, hashes, bits of each level; universe and listed have one column, key."""
    keys = universe.select("key", F.lit(False).alias("on")).unionByName(listed.where("key IS NOT NULL").select("key", F.lit(True).alias("on")))
    distinct = stored(keys.groupBy("key").agg(F.max("on").alias("on")).select(F.xxhash64("key").alias("_h1"), F.xxhash64(F.lit("second"), "key").alias("_h2"), "key", "on"), "url_keys")
    n_shards = max(16, -(-distinct.count() // keys_per_shard))

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_h1", "_h2"])
        levels = build_levels(rows["_h1"].to_numpy().view(np.uint64), rows["_h2"].to_numpy().view(np.uint64), rows["on"].to_numpy(dtype=bool))
        return pd.DataFrame({"_shard": int(key[0]), "level": range(len(levels)), "hashes": [k for _, k in levels], "bits": [b.tobytes() for b, _ in levels], "n_shards": n_shards})

    out = hashed(distinct.select("key", "on"), "key", n_shards).select("_shard", "_h1", "_h2", "on")
    return stored(out.groupBy("_shard").applyInPandas(build, "_shard int, level int, hashes int, bits binary, n_shards int"), "cascades")


def _levels(rows: list[tuple[int, int, bytes]]) -> list[tuple[np.ndarray, int]]:
    return [(np.frombuffer(bits, dtype=np.uint8), k) for _, k, bits in sorted(rows)]


def with_membership(pages: DataFrame, built: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """pages, which has a column key, with a boolean _listed. built is what cascades() gave."""
    size, n_shards = built.agg(F.coalesce(F.sum(F.length("bits") + 64), F.lit(0)), F.max("n_shards")).first()
    if n_shards is None:
        return pages.withColumn("_listed", F.lit(False))
    dealt = hashed(pages, "key", n_shards)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema) + ", _listed boolean"
    names = pages.columns
    if size <= broadcast_bytes:
        of: dict[int, list] = {}
        for r in built.toLocalIterator():
            of.setdefault(r["_shard"], []).append((r.level, r.hashes, bytes(r.bits)))
        shared = pages.sparkSession.sparkContext.broadcast(of)

        def here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            levels = {k: _levels(v) for k, v in shared.value.items()}
            for batch in batches:
                h1, h2 = (batch[k].to_numpy(zero_copy_only=False).view(np.uint64) for k in ("_h1", "_h2"))
                shard = batch["_shard"].to_numpy(zero_copy_only=False)
                found = np.zeros(len(h1), dtype=bool)
                for s in np.unique(shard):
                    own = np.flatnonzero(shard == s)
                    found[own] = is_listed(levels.get(s, []), h1[own], h2[own])
                yield pa.record_batch([*(batch[k] for k in names), pa.array(found)], [*names, "_listed"])

        return dealt.mapInArrow(here, schema)

    def there(rows: pd.DataFrame, levels: pd.DataFrame) -> pd.DataFrame:
        own = _levels(list(zip(levels["level"], levels["hashes"], levels["bits"], strict=True)))
        return rows[names].assign(_listed=is_listed(own, rows["_h1"].to_numpy().view(np.uint64), rows["_h2"].to_numpy().view(np.uint64)))

    salted = dealt.withColumn("_salt", F.pmod(F.xxhash64(*[c for c in names]), F.lit(SALTS)).cast("int"))
    copies = built.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.groupBy("_shard", "_salt").cogroup(copies.groupBy("_shard", "_salt")).applyInPandas(there, schema)


def url_filters(pages: DataFrame, listed: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """page_id, host, path, rule, verdict, listed. listed has one column, key: host and path joined. A listed page that no rule
    fits is blocked."""
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).withColumn("key", F.concat("host", "path"))
    judged = with_membership(parts, cascades(parts.select("key"), listed), broadcast_bytes)
    verdict = F.when(F.col("_listed"), "block").otherwise("allow")
    judged = judged.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    for rule, says in rules:
        verdict = F.when(F.col("rule") == rule, says).otherwise(verdict)
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.col("_listed").alias("listed"))


def sample_list(pages: DataFrame) -> DataFrame:
    """Stands for a feed of listed URLs, which the tables lack: the keys whose MD5 starts with 0, one in sixteen."""
    key = F.concat(host_of(F.col("url")), path_of(F.col("url")))
    return pages.select(key.alias("key")).where(F.md5("key").startswith("0")).distinct()

"""N-gram Jaccard join: documents link when their sets of word shingles overlap enough; groups of links get one id.

1. Sets. A document's shingles are 64-bit hashes, made in numpy over the whole text. Documents with equal sets are one node (a
   hash of the set), so copies cost nothing further.
2. Orders. A fixed-size sketch counts shingles over all documents. Three global orders of shingles all put those with rare
   counts first and differ in how they break ties. If sets x and y, x not the larger, overlap enough, then under each order one of the first
   Rule.index(|x|) shingles of x is among the first Rule.prefix(|y|) of y.
3. Candidates. Under the first order the prefixes are grouped by shingle and class of sizes. A group in which no node has the shingle
   among its first Rule.index() ones has no pair and goes; groups with the same hub (a node picked by a hash) become one. In each group every node meets
   the hub, later a few more, not all the others; a pair stays if the sizes allow the threshold, the prefixes of the second
   and of the third order meet as well, and the counts of shingles in BINS classes are not too far apart (sets differ in at least as
   many shingles as the counts do, so this loses nothing).
4. Verification counts the overlap of the whole sets. Links are joined to components.
5. Groups whose nodes are in several components still get further hubs, ROUNDS times, as long as that closes half of them. What is left then is compared exactly, only between
   different components. Small groups, mostly dissimilar nodes that share a rare shingle, go by the same filters as before. Of large ones, those with at most BLOCK nodes outside
   their main component are compared in blocks of BLOCK nodes, whose whole sets are searched and which give back only links that join
   components; a node is sent twice at most. The others are divided by the shingles of the second order, and what is still so by
   those of the third: a pair that links meets in each. Only nodes that share shingles under all three orders, link with few and are more than
   BLOCK go to several blocks. So no link between different components is lost, no pairs are emitted within a group of copies,
   and no task gets more than two blocks.

Tables between steps are deleted as soon as no later step reads them.

Sizes: the sketch is SLOTS bytes on each worker. Nodes and pairs in question are broadcast only if counted to be under
BROADCAST_BYTES, else shuffled.

Defined results. Null, empty or wordless text: no shingles, component is its own doc_id. Repeated rows give a row each. A null doc_id
never names a component, unless all in it are null. Rows with the same doc_id and other texts are nodes of their own. An empty table
has no rows. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import BROADCAST_BYTES, arrow_batches, discard, free_name, give_back, stored
from weftline.llm.components import components

U = np.uint64
SLOT_BITS = 24
#: Classes of shingles that are counted for each node: sets whose counts differ too much can't overlap enough.
BINS = 256
#: Rows of a batch that goes to Python.
BATCH = 1000
SLICES = 16
MERGE = 64
ROUNDS = 3
#: Hubs of a group in each round after the first.
HUBS = 4
#: Groups up to this size are compared as one row in the end, larger ones in blocks of BLOCK nodes.
SMALL = 64
BLOCK = 1000


@dataclass(frozen=True)
class Rule:
    """Shingles of words words; a link needs 100 * overlap >= percent * union."""

    words: int = 4
    percent: int = 85

    def prefix(self, n: int) -> int:
        return n + (-self.percent * n // 100) + 1

    def index(self, n: int) -> int:
        """The prefix of a set of n shingles that need only meet the prefixes of sets that are not smaller."""
        return n + (-2 * self.percent * n // (100 + self.percent)) + 1

    def index_sql(self, n: str) -> Column:
        return F.expr(f"{n} + 1 - ({2 * self.percent} * {n} + {99 + self.percent}) div {100 + self.percent}")

    def links(self, inter: int, a: int, b: int) -> bool:
        return inter > 0 and 100 * inter >= self.percent * (a + b - inter)


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2^64."""
    if len(_powers[0]) < n:
        size = max(1 << 17, 1 << (n - 1).bit_length())
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=U)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word, A-Z lower-cased; words are what ASCII white space separates."""
    data = np.frombuffer(text.encode("utf-8", "replace").translate(_LOWER), dtype=np.uint8)
    gap = np.concatenate(([True], _SPACE[data], [True]))
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, dtype=U)
    power, inverse = _power_tables(len(data))
    total = np.concatenate((np.zeros(1, U), np.cumsum((data.astype(U) + U(1)) * power[: len(data)], dtype=U)))
    return mix((total[ends] - total[starts]) * inverse[starts])


def shingles(text: str | None, rule: Rule) -> np.ndarray:
    """The document's set, sorted; of fewer words than a shingle has, the whole sequence."""
    w = word_hashes(text) if text else np.zeros(0, dtype=U)
    if not len(w):
        return w
    size = min(rule.words, len(w))
    n = len(w) - size + 1
    s = np.full(n, U(size))
    for k in range(size):
        s = mix(s * U(0x2545F4914F6CDD1D) + w[k : k + n])
    return np.unique(s)


def node_of(s: np.ndarray) -> int:
    """A signed 64-bit hash of a set."""
    return int(mix(np.array([np.sum(mix(s ^ U(0xA0761D6478BD642F)), dtype=U) + U(len(s))], dtype=U)).view(np.int64)[0])


def _slot(s: np.ndarray) -> np.ndarray:
    return (s >> U(64 - SLOT_BITS)).astype(np.int64)


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))


def document_sets(docs: DataFrame, rule: Rule) -> DataFrame:
    """Rows with kind 0: doc_id, key, node, n of each document. Kind 1: each task's counts of shingles, in SLICES slices."""
    per = (1 << SLOT_BITS) // SLICES
    names = ["kind", "doc_id", "key", "node", "n", "part", "slice", "counts"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SLOT_BITS, dtype=np.uint8)  # of this task; they stop at 255
        for batch in batches:
            nodes, sizes = [], []
            for text in batch["text"]:
                s = shingles(text.as_py(), rule)
                nodes.append(node_of(s) if len(s) else None)
                sizes.append(len(s))
                slot = _slot(s)
                had = counts[slot]
                counts[slot] = had + (had < 255)
            none = [None] * len(nodes)
            yield pa.record_batch([pa.array([0] * len(nodes), kinds[0]), batch["doc_id"], batch["key"], *(pa.array(c, t) for c, t in zip((nodes, sizes, none, none, none), kinds[3:], strict=True))], names)
        part = TaskContext.get().partitionId()
        for k in range(SLICES):
            own = counts[k * per : (k + 1) * per]
            if own.any():
                row = (1, None, None, None, None, part, k, zlib.compress(own.tobytes(), 1))
                yield pa.record_batch([pa.array([c], t) for c, t in zip(row, kinds, strict=True)], names)
        del counts
        give_back()

    return keyed(docs).mapInArrow(run, "kind int, doc_id long, key long, node long, n long, part long, slice int, counts binary")


def rarity(partial: DataFrame) -> dict[int, bytes]:
    """The level of each slot, from all documents: the number of bits of its count, by slice, compressed. Counts are added MERGE tables
    at a time; the driver gets the levels alone, a byte a slot before compression."""
    per = (1 << SLOT_BITS) // SLICES
    parts = partial.where("kind = 1").select("part", "slice", "counts")
    most = parts.agg(F.max("part")).first()[0]

    def add(last: bool):
        def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            total = np.zeros(per, dtype=np.uint64)
            for c in rows["counts"]:
                c = zlib.decompress(c)
                total += np.frombuffer(c, dtype=np.uint8 if len(c) == per else np.uint32)
            if last:
                made = np.frexp(total.astype(np.float64))[1].astype(np.uint8)
            else:
                made = np.minimum(total, U(2**32 - 1)).astype(np.uint32)
            return pd.DataFrame({"part": [int(key[0])], "slice": [int(key[1])], "counts": [zlib.compress(made.tobytes(), 1)]})

        return run

    while most is not None:
        most //= MERGE
        parts = parts.groupBy(F.floor(F.col("part") / MERGE).alias("part"), "slice").applyInPandas(add(most == 0), "part long, slice int, counts binary")
        if most == 0:
            return {r["slice"]: bytes(r["counts"]) for r in parts.toLocalIterator()}
        parts = stored(parts, "sketch")
    return {}


def prefixes(docs: DataFrame, rule: Rule, level: dict[int, bytes]) -> DataFrame:
    """Stored: node, n, hist (shingles in each of BINS classes, to 255), and p1, p2, p3: the prefixes under the three orders, in
    order. A task gives a node once, as far as it remembers."""
    shared = docs.sparkSession.sparkContext.broadcast(level)
    per = (1 << SLOT_BITS) // SLICES
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = np.zeros(1 << SLOT_BITS, dtype=np.uint8)
        for k, packed in shared.value.items():
            of[k * per : (k + 1) * per] = np.frombuffer(zlib.decompress(packed), dtype=np.uint8)
        seen: set[int] = set()
        for batch in batches:
            rows = []
            for text in batch["text"]:
                s = shingles(text.as_py(), rule)
                if not len(s):
                    continue
                node = node_of(s)
                if node in seen:
                    continue
                if len(seen) > 500_000:
                    seen.clear()
                seen.add(node)
                p = rule.prefix(len(s))
                rare = of[_slot(s)].astype(U) << U(56)
                first = []
                for salt in (0x0, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3):
                    tie = mix(s ^ U(salt))
                    place = rare | (tie >> U(8))
                    at = np.argpartition(place, p - 1)[:p]
                    at = at[np.argsort(place[at], kind="stable")]
                    first.append(s[at].view(np.int64) if not salt else tie[at].view(np.int64).astype(np.int32))
                hist = np.minimum(np.bincount((s & U(BINS - 1)).astype(np.int64), minlength=BINS), 255).astype(np.uint8)
                rows.append((node, len(s), hist.tobytes(), *first))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["node", "n", "hist", "p1", "p2", "p3"])
        del of
        seen.clear()
        give_back()

    found = stored(docs.select("text").mapInArrow(run, "node long, n long, hist binary, p1 array<long>, p2 array<int>, p3 array<int>"), "prefixes")
    shared.unpersist()
    return found


def full_sets(docs: DataFrame, rule: Rule) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py(), rule) for t in batch["text"]]
            yield pa.record_batch([batch["node"], pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "s"])
        give_back()

    return docs.select("node", "text").mapInArrow(run, "node long, s binary")


def _hint(df: DataFrame, bytes_a_row: int) -> DataFrame:
    return F.broadcast(df) if df.count() * bytes_a_row <= BROADCAST_BYTES else df


def _near(a: Column, b: Column, rule: Rule) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * rule.percent


def _apart(a: np.ndarray, b: np.ndarray, both: np.ndarray, rule: Rule) -> np.ndarray:
    """Whether counts by class rule a link out: the sets differ in at least as many shingles as their counts do."""
    return np.abs(a.astype(np.int64) - b).sum(axis=-1) * (100 + rule.percent) > (100 - rule.percent) * both


def _not_too_far(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.array([np.frombuffer(v.as_buffer(), dtype=np.uint8) for v in batch[k]], dtype=np.int64).reshape(-1, BINS) for k in ("ha", "hb"))
            both = batch["na"].to_numpy() + batch["nb"].to_numpy()
            yield batch.select(["a", "b"]).filter(pa.array(~_apart(a, b, both, rule)))

    return run


def _overlaps(sets: DataFrame, pairs: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) that link. b's set goes to a's place for each pair, a's goes there once."""
    pairs = pairs.select("a", "b")
    left = sets.join(_hint(pairs, 24), sets["node"] == pairs["b"]).select("a", "b", F.col("s").alias("sb"))
    right = sets.join(_hint(pairs.select("a").distinct(), 16), sets["node"] == F.col("a")).select("a", F.col("s").alias("sa"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["sa"], batch["sb"], strict=True):
                x, y = (np.frombuffer(v.as_buffer(), dtype=U) for v in (x, y))
                keep.append(rule.links(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        give_back()

    return left.join(right, "a").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _block_links(rows: pd.DataFrame, i: int, j: int, rule: Rule) -> list[tuple[int, int]]:
    """Links between nodes of different components: within block i, or between blocks i and j. Nodes that a link joins count as
    one component from then on."""
    comp = rows["comp"].to_numpy(dtype=np.int64).copy()
    nodes, block = rows["node"].to_numpy(dtype=np.int64), rows["block"].to_numpy()
    sets = [np.frombuffer(s, dtype=U) for s in rows["s"]]
    size = np.array([len(s) for s in sets])
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    out = []
    # Of a pair in different components one at least is outside the largest, so that one need not be searched from; small ones
    # go first. Between two blocks, the search is from one of them.
    _, back, count = np.unique(comp, return_inverse=True, return_counts=True)
    largest = int(count.argmax())
    for k in np.argsort(count[back], kind="stable"):
        if back[k] == largest if i == j else block[k] != i:
            continue
        other = comp != comp[k]
        if i != j:
            other &= block == j
        if not other.any():
            continue
        at, to = np.searchsorted(every, sets[k], "left"), np.searchsorted(every, sets[k], "right")
        spans = [owner[a:b] for a, b in zip(at.tolist(), to.tolist(), strict=True)]
        inter = np.bincount(np.concatenate(spans), minlength=len(sets))
        for m in np.flatnonzero(other & (inter > 0) & (100 * inter >= rule.percent * (size + size[k] - inter))):
            if comp[m] != comp[k]:
                out.append((int(nodes[k]), int(nodes[m])))
                comp[comp == comp[m]] = comp[k]
    return out


def _with_main(left: DataFrame) -> DataFrame:
    """left with main, the largest component of the group, and rest, the number of nodes outside it."""
    parts = left.groupBy("g", "comp").agg(F.count("*").alias("k"))
    of_group = parts.groupBy("g").agg(F.max(F.struct("k", "comp")).alias("m"), F.sum("k").alias("all"))
    return left.join(of_group.select("g", F.col("m.comp").alias("main"), (F.col("all") - F.col("m.k")).alias("rest")), "g")


def _leftover_links(left: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Links within the groups of left (g, node, comp, size, main, rest), compared in blocks. Nodes of the main component are not compared with
    each other, so they go only to the blocks of the rest."""
    own = F.col("comp") != F.col("main")
    dealt = left.withColumns({"rb": F.ceil(F.col("rest") / BLOCK).cast("int"), "mb": F.ceil((F.col("size") - F.col("rest")) / BLOCK).cast("int")})
    at = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    dealt = dealt.withColumn("block", F.when(own, at("rb")).otherwise(F.col("rb") + at("mb")))
    other = F.explode(F.sequence(F.lit(0), F.when(own, F.col("rb") + F.col("mb")).otherwise(F.col("rb")) - 1))
    dealt = dealt.withColumn("other", other).withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    rows = dealt.join(sets, "node").select("g", "i", "j", "node", "comp", "block", "s")

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("node").sort_values("node", ignore_index=True)
        return pd.DataFrame(_block_links(rows, int(key[1]), int(key[2]), rule), columns=["a", "b"]).astype("int64")

    return rows.groupBy("g", "i", "j").applyInPandas(run, "a long, b long").distinct()


def _small_candidates(left: DataFrame, prefix: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) within the groups of left, of SMALL nodes at most, that are in different components and that sizes and counts by
    class allow. A group is one row of small sketches."""
    nodes = _hint(left.select("node").distinct(), 24)
    some = prefix.join(nodes, "node").groupBy("node").agg(F.first("n").alias("n"), F.first("hist").alias("hist"))
    groups = left.select("g", "node", "comp").join(some, "node").groupBy("g").agg(F.collect_list(F.struct("node", "comp", "n", "hist")).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = set()
            for rows in batch["rows"]:
                rows = sorted(((r["node"], r["comp"], r["n"], r["hist"]) for r in rows.as_py()), key=lambda r: r[0])
                node, comp, n = (np.array([r[k] for r in rows], dtype=np.int64) for k in range(3))
                hist = np.array([np.frombuffer(r[3], dtype=np.uint8) for r in rows], dtype=np.int64)
                for k in range(len(rows) - 1):
                    near = 100 * np.minimum(n[k + 1 :], n[k]) >= rule.percent * np.maximum(n[k + 1 :], n[k])
                    far = _apart(hist[k + 1 :], hist[k], n[k + 1 :] + n[k], rule)
                    for m in np.flatnonzero(near & (comp[k + 1 :] != comp[k]) & ~far):
                        out.add((int(node[k]), int(node[k + 1 + m])))
            a, b = zip(*sorted(out), strict=True) if out else ((), ())
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return groups.select("rows").mapInArrow(run, "a long, b long").distinct()


def _sets_of(docs: DataFrame, of_doc: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """node, s: the whole sets of nodes, made again from one document of each."""
    first = of_doc.join(_hint(nodes, 24), "node").groupBy("node").agg(F.min(F.struct("doc_id", "key")).alias("d")).select("node", "d.doc_id", "d.key")
    first = stored(first, "chosen_rows")
    d, f = keyed(docs).alias("d"), _hint(first, 48).alias("f")
    text = d.join(f, (F.col("d.key") == F.col("f.key")) & F.col("d.doc_id").eqNullSafe(F.col("f.doc_id"))).select("node", "text")
    sets = stored(full_sets(text, rule), "sets")
    # Only repeated rows make a node's set twice.
    if sets.count() != first.count():
        once = stored(sets.dropDuplicates(["node"]), "sets")
        discard(sets)
        sets = once
    discard(first)
    return sets


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def _tokens(prefix: DataFrame, order: str, rule: Rule, *more: str) -> DataFrame:
    """more, t, node, n, early: the shingles of one order's prefixes; early ones are among the first Rule.index()."""
    rows = prefix.select(*more, F.posexplode(order).alias("pos", "t"), "node", "n")
    return rows.select(*more, "t", "node", "n", (F.col("pos") < rule.index_sql("n")).alias("early"))


def _groups(tokens: DataFrame, rule: Rule, *base: str) -> DataFrame:
    """Stored: g, node. Any two nodes that may link, by one order's tokens, meet in some g; base: what their groups had in common before."""
    # Nodes that are in one component already need not meet.
    apart = "comp" if "comp" in tokens.columns else "node"
    some = tokens.groupBy(*base, "t").agg(F.min(apart).alias("lo"), F.max(apart).alias("hi"), F.max("early").alias("any")).where("lo <> hi AND any").select(*base, "t")
    # Sizes that differ too much can't link: of two nodes that can, the larger one is in the smaller one's class of sizes or in the next.
    # The classes are a little wider than the threshold, against rounding. The smaller one's early tokens count one class up, where both are.
    size_class = F.floor(F.log(F.col("n").cast("double")) / float(-np.log((rule.percent - 1) / 100))).cast("int")
    slotted = tokens.join(some, [*base, "t"]).withColumn("c", size_class)
    slotted = slotted.select(*base, "t", "node", "c", "early", F.explode(F.array(F.col("c"), F.col("c") + 1)).alias("slot"))
    slotted = stored(slotted.select(F.xxhash64(*base, "t", "slot").alias("g"), "node", (F.col("early") & (F.col("slot") > F.col("c"))).alias("early")), "slotted")
    # Groups of near copies have much the same nodes. Those with the same hub become one, which has every pair that they had.
    hub = F.min(F.struct(F.xxhash64("node", F.lit("hub")).alias("h"), "node")).alias("hub")
    real = slotted.groupBy("g").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.max("early").alias("any"), hub).where("lo <> hi AND any").select("g", "hub")
    members = stored(slotted.join(real, "g").select(F.col("hub.node").alias("g"), "node").distinct(), "groups")
    discard(slotted)
    return members


def similar_nodes(docs: DataFrame, of_doc: DataFrame, level: dict[int, bytes], rule: Rule, rounds: int = ROUNDS) -> DataFrame:
    """node, comp of each node that is linked; comp is the smallest node of its component."""
    spark = docs.sparkSession
    prefix = prefixes(docs, rule, level)
    members = _groups(_tokens(prefix, "p1", rule), rule)
    comp = spark.createDataFrame([], "node long, comp long")
    tried: list[DataFrame] = []

    def merged(links: DataFrame) -> DataFrame:
        # Components so far are stars, so old links need not be carried along.
        new = components(comp.select(F.col("node").alias("a"), F.col("comp").alias("b")).unionByName(links))
        discard(comp, links)
        return new

    def open_groups(members: DataFrame, least: int) -> DataFrame:
        """g, node, comp, size of the groups that are in several components."""
        known = members.join(comp, "node", "left").select("g", "node", F.coalesce("comp", "node").alias("comp"))
        still = known.groupBy("g").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2"), F.count("*").alias("size")).where(f"c1 <> c2 AND size >= {least}")
        return stored(known.join(still.select("g", "size"), "g"), "open_groups")

    def new_pairs(pairs: DataFrame) -> DataFrame:
        if tried:
            pairs = pairs.join(reduce(DataFrame.unionByName, tried), ["a", "b"], "left_anti")
        tried.append(stored(pairs, "pairs"))
        return tried[-1]

    def verified(pairs: DataFrame) -> DataFrame:
        sets = _sets_of(docs, of_doc, _ends(pairs), rule)
        links = stored(_overlaps(sets, pairs, rule), "links")
        discard(sets, pairs)
        return links

    def in_all_orders(pairs: DataFrame) -> DataFrame:
        """pairs that the sizes, the prefixes under the other two orders and the counts by class allow."""
        some = _hint(pairs, 24)
        x = prefix.join(some, prefix["node"] == some["a"]).select("a", "b", F.col("n").alias("na"), F.col("p2").alias("a2"), F.col("p3").alias("a3"), F.col("hist").alias("ha"))
        y = prefix.join(some, prefix["node"] == some["b"]).select("a", "b", F.col("n").alias("nb"), F.col("p2").alias("b2"), F.col("p3").alias("b3"), F.col("hist").alias("hb"))
        early = lambda array, n: F.slice(array, F.lit(1), rule.index_sql(n).cast("int"))
        meet = lambda a, b: F.when(F.col("na") <= F.col("nb"), F.arrays_overlap(early(a, "na"), b)).otherwise(F.arrays_overlap(a, early(b, "nb")))
        both = x.join(y, ["a", "b"]).where(_near(F.col("na"), F.col("nb"), rule) & meet("a2", "b2") & meet("a3", "b3"))
        left = both.select("a", "b", "na", "nb", "ha", "hb").mapInArrow(_not_too_far(rule), "a long, b long")
        return stored(left.distinct(), "candidates")

    def compared(small: DataFrame) -> DataFrame:
        """The components after small groups are compared exactly."""
        pairs = new_pairs(_small_candidates(small, prefix, rule))
        return comp if pairs.isEmpty() else merged(verified(in_all_orders(pairs)))

    before = 0
    for k in range(rounds):
        # A group of two has met already.
        left = open_groups(members, 3 if k else 2)
        size = left.count()
        # Hubs are a short way only. Where they close less than half of what is open, the exact comparison below has it sooner.
        if not size or 2 * size > before > 0:
            discard(left)
            break
        before = size
        if k == 0:
            met = left.where("g <> node").select(F.least("g", "node").alias("a"), F.greatest("g", "node").alias("b")).distinct()
        else:
            part = F.pmod(F.xxhash64("node", F.lit(k)), F.lit(HUBS))
            hub = left.groupBy("g", part.alias("part")).agg(F.min(F.struct(F.xxhash64("node", F.lit(-1 - k)).alias("h"), "node", "comp")).alias("hub"))
            met = left.join(hub, "g").where("hub.comp <> comp").select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct()
        pairs = new_pairs(met)
        discard(left)
        comp = merged(verified(in_all_orders(pairs)))
    for order in ("p2", "p3", None):
        left = open_groups(members, 2)
        comp = compared(left.where(F.col("size") <= SMALL))
        large = stored(_with_main(left.where(F.col("size") > SMALL)), "large_groups")
        discard(left)
        # Groups with few nodes outside their main component are compared in blocks at once, which sends a node twice at most.
        now = large.where(F.col("rest") <= BLOCK) if order else large
        if not now.isEmpty():
            sets = _sets_of(docs, of_doc, now.select("node").distinct(), rule)
            links = stored(_leftover_links(now, sets, rule), "links")
            discard(sets)
            comp = merged(links)
        rest = large.where(F.col("rest") > BLOCK)
        if not order or rest.isEmpty():
            discard(large)
            break
        own = prefix.select("node", "n", order).join(_hint(rest.select("g", "node", "comp"), 40), "node").dropDuplicates(["g", "node"])
        members, before = _groups(_tokens(own, order, rule, "g", "comp"), rule, "g"), members
        discard(large, before)
    discard(prefix, members, *tried)
    return comp


def ngram_jaccard_join(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles, component_id of each row of docs, and node, the same number for equal sets."""
    with arrow_batches(docs.sparkSession, BATCH):
        found = stored(document_sets(docs, rule), "document_sets")
        of_doc = found.where("kind = 0").select("doc_id", "key", "node", "n")
        comp = similar_nodes(docs, of_doc.where("node IS NOT NULL"), rarity(found), rule)
    named = of_doc.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least")).join(comp, "node", "left").select("node", F.coalesce("comp", "node").alias("comp"), "least")
    named = stored(named, "named")
    # Only components of several nodes need a minimum over them.
    least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    per_node = stored(named.join(least, "comp").select("node", "component_id"), "component_ids")
    discard(comp, named)
    return of_doc.join(per_node, "node", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "node")


def keep_one(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The rows of docs, less those of a group of linked documents but one: the one with the smallest doc_id (null last), then the
    smallest text hash. Documents without shingles stay."""
    with arrow_batches(docs.sparkSession, BATCH):
        found = stored(document_sets(docs, rule), "document_sets")
        of_doc = found.where("kind = 0 AND node IS NOT NULL").select("doc_id", "key", "node", "n")
        comp = similar_nodes(docs, of_doc, rarity(found), rule)
    order = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "key")
    # The first row of each node, then of each component, both aggregated before the shuffle.
    nodes = of_doc.groupBy("node").agg(F.min(order).alias("first")).join(comp, "node", "left").select(F.coalesce("comp", "node").alias("comp"), "first")
    kept = nodes.groupBy("comp").agg(F.min("first").alias("first")).select(F.col("first.doc_id").alias("id"), F.col("first.key").alias("key"))
    some = of_doc.select(F.col("doc_id").alias("id"), "key").distinct()
    gone = some.alias("s").join(kept.alias("k"), (F.col("s.key") == F.col("k.key")) & F.col("s.id").eqNullSafe(F.col("k.id")), "left_anti")
    own_id, own_key = free_name(docs, "dropped_id"), free_name(docs, "dropped_key")
    gone = stored(gone.select(F.col("id").alias(own_id), F.col("key").alias(own_key)), "dropped")
    discard(found, comp)
    return docs.join(_hint(gone, 40), (F.xxhash64(docs["doc_id"], docs["text"]) == gone[own_key]) & docs["doc_id"].eqNullSafe(gone[own_id]), "left_anti")

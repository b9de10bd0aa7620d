"""Best-fit packing with a swap-based local search.

Documents become pieces of at most LIMIT tokens; only documents over the limit are cut, and their full pieces are sequences
of their own. The other pieces are dealt by a hash into groups of bounded size. Each group is packed best-fit in falling
order; then the local search looks at every bin below the limit, the fullest first: a document moves to it from an emptier bin, or
is exchanged for one or two of its own, wherever that fills the fuller one, until a pass finds nothing. Bins are found by item length and fill, so no
bin or document is left out of the search. What lies in bins below FULL of the limit is dealt again into fewer, larger groups and repacked, so
the waste of all groups shrinks to that of one.

Memory: a group holds about GROUP lengths in the first round and 16 times as many at most later (100 bytes each), whatever the
table's size. Texts are never shuffled, only
piece lengths. A group's packing depends on its rows alone, so a lost executor's tasks run again to the same end.

Defined results. Null text is empty: its ids are the end id alone. Repeated rows and repeated or null doc_ids are pieces of
their own, told apart by a row number that is stored with them. An empty table has no rows. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import arrow_batches, give_back, stored
from weftline.llm.encoding import encoded, vocabulary_path

LIMIT = 4096
END_ID = 1
GROUP = 4096
#: A bin is underfull, and dealt again after its group is packed, below this share of the limit.
FULL = 0.998
#: Texts of a batch that goes to Python.
BATCH = 1000
#: Above every key of a bin.
NONE = 1 << 62


def pieces(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each piece of each row."""
    end = np.array([END_ID], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in encoded(batches, path):
            out = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), texts, strict=True):
                ids = text + end
                for k, at in enumerate(range(0, len(ids), 4 * limit)):
                    part = ids[at : at + 4 * limit]
                    out.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])
        give_back()

    return docs.select("doc_id", "text").mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Bins:
    """Bins of one group: items per bin, and the bins that have each free space."""

    def __init__(self, limit: int):
        self.limit = limit
        self.items: list[list[tuple[int, int]]] = []  # per bin: (length, item)
        self.fill: list[int] = []
        self.by_free: list[list[int]] = [[] for _ in range(limit + 1)]
        self.mask = 0  # bit f set: some bin has f free

    def _enter(self, b: int) -> None:
        free = self.limit - self.fill[b]
        self.by_free[free].append(b)
        self.mask |= 1 << free

    def _leave(self, b: int) -> None:
        free = self.limit - self.fill[b]
        self.by_free[free].remove(b)
        if not self.by_free[free]:
            self.mask &= ~(1 << free)

    def best_fit(self, length: int, item: int) -> None:
        above = self.mask >> length
        if above:
            b = self.by_free[length + (above & -above).bit_length() - 1][-1]
            self._leave(b)
        else:
            b = len(self.items)
            self.items.append([])
            self.fill.append(0)
        self.items[b].append((length, item))
        self.fill[b] += length
        self._enter(b)


class Holders:
    """For each length, the underfull bins that hold an item of it, in order of (fill, bin); least has the first of each."""

    def __init__(self, held: list[dict[int, list[int]]], fill: list[int], limit: int):
        self.held, self.fill = held, fill
        self.of: list[list[int]] = [[] for _ in range(limit + 1)]
        self.least = np.full(limit + 1, NONE, dtype=np.int64)
        for b in range(len(held)):
            if fill[b] < limit:
                for x in held[b]:
                    self.of[x].append(self.key(b))
        for x, keys in enumerate(self.of):
            keys.sort()
            self.least[x] = keys[0] if keys else NONE

    def key(self, b: int) -> int:
        return (self.fill[b] << 32) + b

    def enter(self, b: int) -> None:
        key = self.key(b)
        for x in self.held[b]:
            insort(self.of[x], key)
            self.least[x] = self.of[x][0]

    def leave(self, b: int) -> None:
        key = self.key(b)
        for x in self.held[b]:
            keys = self.of[x]
            del keys[bisect_left(keys, key)]
            self.least[x] = keys[0] if keys else NONE


def improve(items: list[list[tuple[int, int]]], limit: int) -> list[list[tuple[int, int]]]:
    """Local search over all underfull bins. Bin b, the fullest first, takes from emptier bins: one document moves, or one goes for a
    shorter one of b, or for two of b; of all these the one that fills b most, from the emptiest bin that has it. Each change raises
    the sum of squared fills, so passes end, when one gains nothing; a bin that empties is gone. A bin has under sqrt(2 limit)
    distinct lengths, which bounds the work of a try."""
    fill = [sum(x for x, _ in b) for b in items]
    held: list[dict[int, list[int]]] = []
    for b in items:
        own: dict[int, list[int]] = {}
        for x, item in b:
            own.setdefault(x, []).append(item)
        held.append(own)
    holders = Holders(held, fill, limit)
    lengths = np.arange(limit + 1)

    def give(a: int, b: int, x: int) -> None:
        held[b].setdefault(x, []).append(held[a][x].pop())
        if not held[a][x]:
            del held[a][x]
        fill[a], fill[b] = fill[a] - x, fill[b] + x

    def taken(b: int) -> bool:
        """Makes the best change for bin b, if there is any."""
        free = limit - fill[b]
        # The longest item, up to each length, that an emptier bin (or one as full, of a lower number) holds.
        longest = np.maximum.accumulate(np.where(holders.least < holders.key(b), lengths, 0))
        back = [(), *((y,) for y in held[b])]
        own = sorted(held[b])
        back += [(y, z) for k, y in enumerate(own) for z in own[k if len(held[b][y]) > 1 else k + 1 :] if y + z < longest[-1]]
        sizes = np.array([sum(s) for s in back])
        gains = longest[np.minimum(sizes + free, limit)] - sizes
        best = int(np.argmax(gains))
        gain = int(gains[best])
        if gain <= 0:
            return False
        x = gain + int(sizes[best])
        a = holders.of[x][0] & 0xFFFFFFFF
        holders.leave(a), holders.leave(b)
        give(a, b, x)
        for y in back[best]:
            give(b, a, y)
        if fill[b] < limit:
            holders.enter(b)
        holders.enter(a)
        return True

    gained = True
    while gained:
        gained = False
        for b in sorted((k for k in range(len(items)) if 0 < fill[k] < limit), key=lambda k: -fill[k]):
            while 0 < fill[b] < limit and taken(b):
                gained = True
    return [[(x, item) for x, own in b.items() for item in own] for b in held if b]


def pack(lens: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin number, place in the bin and the bin's fill for each length."""
    bins = Bins(limit)
    for item in np.argsort(-lens, kind="stable"):
        bins.best_fit(int(lens[item]), int(item))
    done = improve(bins.items, limit)
    number, place, fill = (np.zeros(len(lens), dtype=np.int64) for _ in range(3))
    for b, held in enumerate(done):
        at = 0
        for length, item in held:
            number[item], place[item] = b, at
            at += length
        for _, item in held:
            fill[item] = at
    return number, place, fill


def packed(parts: DataFrame, limit: int = LIMIT, group: int = GROUP, full: float = FULL) -> DataFrame:
    """sequence_id and offset for the rows of pieces(); a sequence's id is the row number of one of its pieces, so no two are the same."""
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, _row long, _fill long, sequence_id long, offset long"

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "_row"], kind="stable", ignore_index=True)
        number, place, fill = pack(rows["length"].to_numpy(dtype=np.int64), limit)
        first = rows["_row"].groupby(number).transform("min")
        return rows.drop(columns=["_group"]).assign(_fill=fill, sequence_id=first, offset=place)[[*columns, "_row", "_fill", "sequence_id", "offset"]]

    spark = parts.sparkSession
    with arrow_batches(spark, BATCH):
        numbered = stored(parts.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    settled = [numbered.where(F.col("length") == limit).select(*columns, F.col("_row").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    most = 16 * group
    rest, level = numbered.where(F.col("length") < limit), 0
    n_rest = rest.count()
    while n_rest:
        n_groups = max(1, -(-n_rest // group))
        dealt = rest.select(*columns, "_row", F.pmod(F.xxhash64("_row", F.lit(level)), F.lit(n_groups)).alias("_group"))
        done = stored(dealt.groupBy("_group").applyInPandas(run, schema), f"packed{level}")
        underfull = F.col("_fill") < int(full * limit)
        left = done.where(underfull).count()
        # One group can't be packed better by another round; nor can the largest groups, where they settle little.
        if n_groups == 1 or (left > 0.9 * n_rest and group >= most):
            settled.append(done.select(*columns, "sequence_id", "offset"))
            break
        settled.append(done.where(~underfull).select(*columns, "sequence_id", "offset"))
        rest, n_rest, level, group = done.where(underfull), left, level + 1, min(2 * group, most)
    return reduce(DataFrame.unionByName, settled)


def best_fit_packing(docs: DataFrame, path: str | None = None, limit: int = LIMIT, group: int = GROUP) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece."""
    return packed(pieces(docs, path or vocabulary_path(), limit), limit, group)

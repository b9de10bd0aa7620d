"""Quality rules: logistic regression on hashed word and character n-grams, calibrated, behind fixed base rules.

Training takes a bounded sample of labelled rows (TrainConfig.rows_per_class); the weights are 256 KB. Scoring maps over
Arrow batches, so it needs no shuffle and each document's work follows its length.

Defined results. Null text: no words, so base_failed and not kept. A label row with a null id or null quality is passed
over; a document whose labels disagree is no training row. Repeated label or document rows count once in training and are
scored once each. Without labelled rows of both classes there is no model: prob_quality is null and the base rules alone
decide. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import free_name, give_back

BITS = 16
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\x0b\x0c"


@dataclass(frozen=True)
class TrainConfig:
    """rows_per_class bounds the labelled sample; hold_out is the part of it that only calibrates."""

    rows_per_class: int = 500
    hold_out: float = 0.3
    rounds: int = 80
    l2: float = 1e-5


@dataclass(frozen=True)
class Rules:
    """min_words and repeat_percent are the base rules; min_prob is the threshold on the calibrated probability."""

    min_words: int = 50
    repeat_percent: int = 50
    min_prob: float = 0.5


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # 2 << BITS: word n-grams, then character n-grams
    bias: float
    scale: float  # Platt: p = 1 / (1 + exp(-(scale * margin + shift)))
    shift: float

    def margin(self, words: np.ndarray, chars: np.ndarray) -> float:
        m = self.bias
        if len(words):
            m += float(self.weights[words].mean())
        if len(chars):
            m += float(self.weights[chars].mean())
        return m

    def prob(self, margin: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.scale * margin + self.shift, -35, 35))))


def ngram_slots(words: list[bytes], lowered: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the word 1- and 2-grams, and of the byte 4-grams of the lower-cased text."""
    h = np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words))
    word = np.concatenate((h, h[:-1] * np.uint32(0x9E3779B1) + h[1:] * np.uint32(0x85EBCA77))) if len(h) > 1 else h
    b = np.frombuffer(lowered, dtype=np.uint8).astype(np.uint32)
    if len(b) >= 4:
        c = ((b[:-3] * np.uint32(0x01000193) + b[1:-2]) * np.uint32(0x01000193) + b[2:-1]) * np.uint32(0x01000193) + b[3:]
    else:
        c = b[:0]
    mix = np.uint32(0x9E3779B1)
    shift = np.uint32(32 - BITS)
    return ((word * mix) >> shift).astype(np.int64), ((c * mix) >> shift).astype(np.int64) + (1 << BITS)


def base_counts(text: str, words: list[bytes]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    word_chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
        elif line.strip(SPACES):
            seen.add(line)
    n = len(words)
    if n < 4:
        return word_chars, symbols, dup, 0
    first: dict[bytes, int] = {}
    ids = np.fromiter((first.setdefault(w, len(first)) for w in words), dtype=np.int64, count=n)
    pair = np.unique(ids[:-1] * len(first) + ids[1:], return_inverse=True)[1]
    window, count = np.unique(pair[:-1] * len(first) + ids[2:], return_inverse=True, return_counts=True)[1:]
    often = count[window] > 1
    hit = np.zeros(n, dtype=bool)
    for k in range(3):
        hit[k : k + n - 2] |= often
    return word_chars, symbols, dup, int(hit.sum())


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], config: TrainConfig) -> Model | None:
    """rows: label, word slots, character slots. Adagrad on the whole sample; Platt scaling on the held-out part."""
    if len({r[0] for r in rows}) < 2:
        return None
    cut = [k for k in range(len(rows)) if (k * 2654435761 % 2**32) / 2**32 >= config.hold_out]
    held = sorted(set(range(len(rows))) - set(cut))
    if len({rows[k][0] for k in cut}) < 2 or len({rows[k][0] for k in held}) < 2:
        cut = held = list(range(len(rows)))

    def sparse(part: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own, slot, value = [], [], []
        for at, k in enumerate(part):
            for slots in rows[k][1:]:
                if len(slots):
                    s, c = np.unique(slots, return_counts=True)
                    own.append(np.full(len(s), at, np.int32)), slot.append(s.astype(np.int32)), value.append((c / len(slots)).astype(np.float32))
        return (np.concatenate(own), np.concatenate(slot), np.concatenate(value)) if own else (np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.float32))

    y = np.array([rows[k][0] for k in cut], dtype=float)
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())) / len(y)
    own, slot, value = sparse(cut)
    w, bias, past, past_b = np.zeros(2 << BITS), 0.0, np.full(2 << BITS, 1e-12), 1e-12
    for _ in range(config.rounds):
        z = bias + np.bincount(own, value * w[slot], len(y))
        gap = (1 / (1 + np.exp(-z)) - y) * balance
        grad = np.bincount(slot, value * gap[own], 2 << BITS) + config.l2 * w
        past += grad * grad
        past_b += gap.sum() ** 2
        w -= 0.5 * grad / np.sqrt(past)
        bias -= 0.1 * gap.sum() / np.sqrt(past_b)
    y = np.array([rows[k][0] for k in held], dtype=float)
    own, slot, value = sparse(held)
    z = bias + np.bincount(own, value * w[slot], len(y))
    a, b = 1.0, 0.0
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -35, 35)))
        v = p * (1 - p) + 1e-9
        g = np.array([((p - target) * z).sum() + 1e-3 * (a - 1), (p - target).sum()])
        h = np.array([[(v * z * z).sum() + 1e-3, (v * z).sum()], [(v * z).sum(), v.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return Model(w.astype(np.float32), float(bias), float(a), float(b))


def train(docs: DataFrame, labels: DataFrame, config: TrainConfig = TrainConfig()) -> Model | None:
    """A model from config.rows_per_class labelled documents of each class, picked by a hash of their id."""
    agreed = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("y"), F.max("quality").alias("y2"))
        .where("y = y2")
        .select("doc_id", "y")
    )
    picked = None
    for y in (0, 1):
        part = agreed.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(config.rows_per_class)
        picked = part if picked is None else picked.unionByName(part)

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ys, ws, cs = [], [], [], []
            for doc_id, y, text in zip(*(batch[k].to_pylist() for k in ("doc_id", "y", "text")), strict=True):
                lowered = text.lower().encode()
                w, c = ngram_slots(lowered.split(), lowered)
                ids.append(doc_id), ys.append(y), ws.append(w.astype("<i4").tobytes()), cs.append(c.astype("<i4").tobytes())
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(ys, pa.int64()), pa.array(ws, pa.binary()), pa.array(cs, pa.binary())], ["doc_id", "y", "w", "c"])

    # The picked ids are at most 2 * rows_per_class, so their broadcast is bounded.
    sample = (
        docs.select("doc_id", "text")
        .where("text IS NOT NULL")
        .join(F.broadcast(picked), "doc_id")
        .select("doc_id", F.col("y").cast("long").alias("y"), "text")
        .mapInArrow(slots, "doc_id long, y long, w binary, c binary")
    )
    found: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
    for r in sample.toLocalIterator():
        w, c = (np.frombuffer(x, dtype="<i4") for x in (r.w, r.c))
        if r.doc_id not in found or (len(w), bytes(r.w)) < (len(found[r.doc_id][1]), found[r.doc_id][1].tobytes()):
            found[r.doc_id] = (r.y, w, c)
    model = fit([found.pop(k) for k in sorted(found)], config)
    give_back()
    return model


def judge(docs: DataFrame, model: Model | None, rules: Rules = Rules(), keep_columns: bool = False) -> DataFrame:
    """Counts and verdicts for each row of docs; keep_columns appends them to the row instead, under names that
    the row has not."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    added = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, prob_quality double, kept boolean"
    names = [x.split()[0] for x in added.split(", ")]
    kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
    if keep_columns:
        names = [free_name(docs, n) for n in names]
        own = ", ".join(f"`{n}` {x.split()[1]}" for n, x in zip(names, added.split(", "), strict=True))
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", {own}"
    else:
        docs = docs.select("doc_id", "text")
        schema = f"doc_id long, {added}"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            out = []
            for value in batch["text"]:
                text = value.as_py() or ""
                words = text.encode().split()
                n = len(words)
                chars, symbols, dup, repeat = base_counts(text, words)
                failed = n < rules.min_words or 100 * repeat > rules.repeat_percent * n
                prob = None
                if m is not None:
                    lowered = text.lower().encode()
                    prob = m.prob(m.margin(*ngram_slots(lowered.split(), lowered)))
                out.append((n, chars, symbols, dup, repeat, failed, prob, not failed and (prob is None or prob >= rules.min_prob)))
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)] if out else [pa.array([], t) for t in kinds]
            first = batch.schema.names if keep_columns else ["doc_id"]
            yield pa.record_batch([*(batch[k] for k in first), *columns], [*first, *names])
        give_back()

    return docs.mapInArrow(score, schema)


def quality_rules(docs: DataFrame, labels: DataFrame, config: TrainConfig = TrainConfig(), rules: Rules = Rules()) -> DataFrame:
    """doc_id, counts, base_failed, prob_quality and kept for each row of docs."""
    return judge(docs, train(docs, labels, config), rules)


def keep_good(docs: DataFrame, labels: DataFrame, config: TrainConfig = TrainConfig(), rules: Rules = Rules()) -> DataFrame:
    """The rows of docs that are kept, with their own columns."""
    judged = judge(docs, train(docs, labels, config), rules, keep_columns=True)
    return judged.where(F.col(judged.columns[-1])).select(*docs.columns)

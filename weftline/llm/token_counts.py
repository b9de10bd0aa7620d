"""Token counts: an exact histogram of encoded lengths, with suffix sums that answer every context limit.

Arrow batches give each document's length; a partial aggregation makes one row per length, so the shuffle carries no more
than the distinct lengths of each task. Suffix sums run within blocks of lengths, and the blocks' totals are added after.

Defined results. Null text counts as empty, of length 0 (plus end tokens). Each row counts, repeated rows too. An empty table
has no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.common import give_back, stored
from weftline.llm.encoding import encoded, vocabulary_path

BLOCK = 256


def lengths(docs: DataFrame, path: str, end_tokens: int = 0) -> DataFrame:
    """n_tokens of each row of docs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in encoded(batches, path):
            found = [len(ids) // 4 + end_tokens for ids in texts]
            yield pa.record_batch([pa.array(found, pa.int64())], ["n_tokens"])
        give_back()

    return docs.select("text").mapInArrow(count, "n_tokens long")


def histogram(lens: DataFrame) -> DataFrame:
    """One row per length L: n_docs of that length, docs_from and tokens_from (of length L or more: the suffix sums),
    docs_total, tokens_total, tokens_within (tokens that stay if each document is cut at L), tokens_cut, docs_cut, and
    share_whole (documents that a context of L holds whole)."""
    # A small table, stored since it is read three times and each time would encode the texts.
    counted = stored(lens.groupBy("n_tokens").agg(F.count("*").alias("n_docs")), "lengths")
    hist = counted.withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
    tokens = F.col("n_tokens") * F.col("n_docs")
    # Blocks are the longest length / BLOCK rows at most; their suffix sums join back by block.
    later = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = hist.groupBy("block").agg(F.sum("n_docs").alias("b_docs"), F.sum(tokens).alias("b_tokens"))
    after = blocks.select(
        "block", F.coalesce(F.sum("b_docs").over(later), F.lit(0)).alias("a_docs"), F.coalesce(F.sum("b_tokens").over(later), F.lit(0)).alias("a_tokens")
    )
    total = blocks.agg(F.sum("b_docs").alias("docs_total"), F.sum("b_tokens").alias("tokens_total"))
    within = Window.partitionBy("block").orderBy(F.col("n_tokens").desc())
    limit = F.col("n_tokens")
    return (
        hist.join(after, "block")
        .join(F.broadcast(total), how="cross")  # one row
        .withColumn("docs_from", F.sum("n_docs").over(within) + F.col("a_docs"))
        .withColumn("tokens_from", F.sum(tokens).over(within) + F.col("a_tokens"))
        .withColumn("tokens_within", F.col("tokens_total") - F.col("tokens_from") + limit * F.col("docs_from"))
        .select(
            "n_tokens",
            "n_docs",
            "docs_from",
            "tokens_from",
            "docs_total",
            "tokens_total",
            "tokens_within",
            (F.col("tokens_total") - F.col("tokens_within")).alias("tokens_cut"),
            (F.col("docs_from") - F.col("n_docs")).alias("docs_cut"),
            (1 - (F.col("docs_from") - F.col("n_docs")) / F.col("docs_total")).alias("share_whole"),
        )
    )


def quantile(hist: DataFrame, q: float) -> DataFrame:
    """The least length L with at least q of the documents no longer than L, as one row n_tokens (none if empty)."""
    return hist.where(F.col("docs_total") - F.col("docs_cut") >= F.ceil(F.lit(q) * F.col("docs_total"))).agg(F.min("n_tokens").alias("n_tokens"))


def truncated_total(hist: DataFrame, limit: int) -> DataFrame:
    """Tokens that stay if each document is cut at limit, as one row; any limit, in the histogram or not."""
    kept: Column = F.least(F.col("n_tokens"), F.lit(limit)) * F.col("n_docs")
    return hist.agg(F.coalesce(F.sum(kept), F.lit(0)).alias("tokens"))


def token_counts(docs: DataFrame, path: str | None = None, end_tokens: int = 1) -> DataFrame:
    return histogram(lengths(docs, path or vocabulary_path(), end_tokens))


def token_counts_by_brute_force(texts: list[str | None], path: str, end_tokens: int = 1) -> list[tuple[int, int, int, int]]:
    """n_tokens, n_docs, tokens_within, docs_cut per length, with the tokenizer alone; for tests."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    all_ = [len(tok.encode(t or "", add_special_tokens=False).ids) + end_tokens for t in texts]
    return [(n, all_.count(n), int(np.minimum(all_, n).sum()), sum(x > n for x in all_)) for n in sorted(set(all_))]

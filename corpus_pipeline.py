"""The corpus pipeline: quality rules, line dedup, n-gram Jaccard join, benchmark decontamination, best-fit packing.

Each stage takes (spark, docs, sf_dir), works on all rows of docs and returns a DataFrame, which run() writes as Parquet and reads
again for the next one. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import best_fit, decontaminate, line_dedup, ngram_join, quality_rules
from weftline.llm.common import discard, scratch_scope, stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines go from text; n_chars follows."""
    return line_dedup.line_dedup(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays."""
    return ngram_join.keep_one(docs).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in a sequence."""
    return best_fit.best_fit_packing(docs)


STAGES = [
    ("quality_rules", keep_good_documents),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", keep_one_of_each_group),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

#: SQL can't express the trained rules nor the content-defined chunks; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch_scope(spark) as made:
            before, docs = docs, stored(stage(spark, docs, sf_dir), name)
            made.remove(docs._weftline_path)
        discard(before)
    return docs

"""Sources and sinks of documents: clause lists, id lists, JSON lines, catalogue files, upserts."""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CLAUSES = T.ArrayType(
    T.StructType([T.StructField(n, T.StringType()) for n in ("com_key", "com_type", "com_title", "com_path", "com_name", "com_content")])
)


@F.pandas_udf(T.StringType())
def gunzip(data: pd.Series) -> pd.Series:
    """Text of gzip data; null if it can't be read."""

    def one(x):
        try:
            return None if x is None else gzip.decompress(bytes(x)).decode()
        except (OSError, EOFError, ValueError):
            return None

    return data.map(one)


def clause_rows(docs: DataFrame, doc: str, parsed: str | None = None, packed: str | None = None) -> DataFrame:
    """doc, pos and the clause's fields, from a JSON list in parsed or gzip JSON in packed; what can't be read has no clauses."""
    plain = F.col(parsed) if parsed else F.lit(None).cast("string")
    text = F.coalesce(plain, gunzip(F.col(packed))) if packed else plain
    listed = F.from_json(text, CLAUSES, {"mode": "PERMISSIVE"})
    return docs.select(doc, F.posexplode(listed).alias("pos", "c")).select(doc, "pos", "c.*")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id of a JSON array of ids, numbers or strings; others are dropped."""
    text = spark.read.text(path, wholetext=True)
    each = text.select(F.explode(F.from_json("value", "array<string>")).alias("x"))
    return each.select(F.expr("try_cast(x AS BIGINT)").alias("doc_id")).where("doc_id IS NOT NULL")


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of schema, with _corrupt_record for lines that aren't JSON; blank lines are skipped."""
    return spark.read.schema(f"{schema}, _corrupt_record string").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def write_json_lines(df: DataFrame, path: str, compressed: bool = False) -> None:
    df.write.mode("overwrite").option("compression", "gzip" if compressed else "none").json(path)


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """The law catalogue: STT, doc_id, so_hieu, loai_van_ban, tieu_de, nam_ban_hanh."""
    schema = "STT long, doc_id long, so_hieu string, loai_van_ban string, tieu_de string, nam_ban_hanh int"
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def catalogue_titles(catalogue: DataFrame) -> DataFrame:
    """Distinct titles, the longest first."""
    return catalogue.select("tieu_de").where("trim(tieu_de) <> ''").distinct().orderBy(F.length("tieu_de").desc(), "tieu_de")


def enriched_catalogue(catalogue: DataFrame, found: DataFrame) -> DataFrame:
    """catalogue with the rows of found whose doc_id it lacks; they are numbered on from the last ordinal, by doc_id. found is
    a day's new laws."""
    new = found.dropDuplicates(["doc_id"]).join(catalogue.select("doc_id").distinct(), "doc_id", "left_anti")
    last = catalogue.agg(F.coalesce(F.max("STT"), F.lit(0)).alias("_last"))
    numbered = new.withColumn("_n", F.row_number().over(Window.orderBy("doc_id"))).join(F.broadcast(last), how="cross")
    return catalogue.unionByName(numbered.withColumn("STT", F.col("_last") + F.col("_n")).drop("_n", "_last").select(*catalogue.columns))


def upserted(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """new, and the rows of old whose key it lacks; of repeated keys in new any one."""
    return old.join(new.select(*key).distinct(), key, "left_anti").unionByName(new.dropDuplicates(key).select(*old.columns))


def packed_digest(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with sha256 of the columns as JSON, for corpus manifests."""
    return df.withColumn("sha256", F.sha2(F.to_json(F.struct(*columns)), 256))

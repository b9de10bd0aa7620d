"""Tables between steps, in the folder that the cluster shares."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting that deletes a query's shuffle files when it ends.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_root(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a local one only where that is unset and the master is local."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not hasattr(spark.sparkContext, "_weftline_folder"):
        spark.sparkContext._weftline_folder = "file://" + tempfile.mkdtemp(prefix="weftline-")
    return spark.sparkContext._weftline_folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table: what is read several times is worked out once, lineage ends there, and the step's shuffle files go when it ends."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/weftline/{uuid.uuid4().hex}/{name}"
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEAN) if before is None else spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)

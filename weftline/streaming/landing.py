"""A landing folder as a stream: each micro-batch goes through the same batch operators and is upserted, so a replay changes
nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.sources.documents import upserted


def read_landing(spark: SparkSession, path: str, schema: str, files_a_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(path)


class VersionedTable:
    """A table of Parquet versions; version k + 1 is written whole before it is named, and a batch that was applied is not applied
    again."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def batches(self) -> list[int]:
        """Numbers of the batches that are applied; _SUCCESS tells that a version is whole."""
        if not self._fs.exists(self._Path(self.path)):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(self._Path(self.path))]
        return sorted(int(n[6:]) for n in names if n.startswith("batch=") and self._fs.exists(self._Path(f"{self.path}/{n}/_SUCCESS")))

    def read(self) -> DataFrame | None:
        done = self.batches()
        return self.spark.read.parquet(f"{self.path}/batch={done[-1]}") if done else None

    def apply(self, batch: DataFrame, number: int, key: list[str]) -> None:
        if number in self.batches():
            return
        old = self.read()
        now = batch.dropDuplicates(key) if old is None else upserted(old, batch, key)
        now.write.mode("overwrite").parquet(f"{self.path}/batch={number}")


def run_landing(stream: DataFrame, stage: Callable[[DataFrame], DataFrame], table: VersionedTable, key: list[str], checkpoint: str) -> None:
    """Take all that has landed through stage into table."""

    def each(batch: DataFrame, number: int) -> None:
        table.apply(stage(batch), number, key)

    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def unprocessed(found: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of found whose id is not among done."""
    return found.join(done.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")

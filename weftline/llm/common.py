"""What the training-data operators share: the scratch folder and narrow column selection."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most bytes that an operator broadcasts; beyond it each has a shuffled way.
BROADCAST_BYTES = 64 << 20


#: Spark's setting that deletes a query's shuffle files when it ends.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_root(spark: SparkSession) -> str:
    """The folder that the cluster shares, from spark.checkpoint.dir; a local one only where that is unset and the master is local."""
    conf = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    made = getattr(spark.sparkContext, "_weftline_scratch", None)
    if made is None:
        made = "file://" + tempfile.mkdtemp(prefix="weftline-")
        spark.sparkContext._weftline_scratch = made
    return made


#: Folders that were made since the innermost scratch_scope() began.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{scratch_root(spark)}/weftline/{uuid.uuid4().hex}/{name}"
    if (made := _made.get()) is not None:
        made.append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Deletes the scratch folders made within it, but for those taken out of the list that it yields."""
    made: list[str] = []
    token = _made.set(made)
    try:
        yield made
    finally:
        _made.reset(token)
        for path in made:
            _delete(spark, path.rsplit("/", 1)[0])


@contextlib.contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """While it holds, the session's setting name is value."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: lineage ends there, a lost executor costs no more than one read, and the shuffle files of
    the step go when it ends. discard() deletes the table."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with setting(spark, _CLEAN, "true"):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._weftline_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables that stored() made, when nothing that is still to be computed reads them; other DataFrames are left alone."""
    for t in tables:
        if path := getattr(t, "_weftline_path", None):
            _delete(t.sparkSession, path.rsplit("/", 1)[0])


def release(spark: SparkSession) -> None:
    """Delete all scratch tables under the shared folder; call it when no result is pending."""
    _delete(spark, f"{scratch_root(spark)}/weftline")


def free_name(df: DataFrame, name: str) -> str:
    """name, with as many signs behind it as it takes to differ from all columns of df, whatever their case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def give_back() -> None:
    """Return freed memory of this Python worker to the system, at the end of a task: workers live on between stages."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def arrow_batches(spark: SparkSession, rows: int) -> contextlib.AbstractContextManager[None]:
    """While it holds, Python steps that are run get batches of at most rows rows: for rows that are large."""
    return setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; other characters stay, unlike lower()."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

"""Shared folders and checked broadcasts for the operators."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quantis.session import ensure_checkpoint_dir


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, from ``spark.checkpoint.dir``."""
    return ensure_checkpoint_dir(spark)


#: Rows of an Arrow batch of whole texts.
BATCH_ROWS = 2_000


@contextmanager
def bounded_batches(spark: SparkSession) -> Iterator[None]:
    """While it is open, Arrow batches that carry whole texts to Python are
    bounded, so that a batch, its copy in the JVM and the arrays over it stay
    small beside an executor's heap.  A setting of the user's own is kept, and
    the session is left as it was."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own = spark.conf.get(key, None) is not None and spark.conf.get(key) != "10000"
    if not own:
        spark.conf.set(key, str(BATCH_ROWS))
    try:
        yield
    finally:
        if not own:
            spark.conf.unset(key)


#: What workers keep from task to task, such as tokenizers.
_KEPT: list[Callable[[], None]] = []


def kept(cached):
    """Registers a cached function, so that ``forget`` can empty it."""
    _KEPT.append(cached.cache_clear)
    return cached


def forget() -> None:
    """Empties what earlier stages left in this worker: a stage that needs
    none of it calls this before it starts."""
    for clear in _KEPT:
        clear()
    release()


def release() -> None:
    """Gives a worker's freed memory back to the system: workers are reused by
    later tasks, and what they hold counts beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def stored(df: DataFrame, compression: str = "snappy", folder: str | None = None) -> DataFrame:
    """The rows as a table in the shared folder (or in ``folder``, which is one
    below it): compressed, read by column, and independent of the executors
    that made them."""
    path = f"{folder or checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_up_shuffles(spark: SparkSession) -> None:
    """Spark deletes shuffle files when the driver's collectors find that
    nothing refers to them, which long chains of tables would otherwise wait
    for."""
    gc.collect()
    spark._jvm.System.gc()


def stored_alone(df: DataFrame, folder: str | None = None) -> DataFrame:
    """``stored``, and the shuffle files that made it are given up."""
    out = stored(df, "zstd", folder)
    give_up_shuffles(df.sparkSession)
    return out


@contextmanager
def passing_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for tables that nothing reads any more when it is closed."""
    path = f"{checkpoint_dir(spark)}/passing-{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are written to the shared folder, so
    later reads neither recompute the plan nor depend on one executor."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_alone(df: DataFrame) -> DataFrame:
    """``cut``, and the shuffle files that made it are given up."""
    out = cut(df)
    give_up_shuffles(df.sparkSession)
    return out

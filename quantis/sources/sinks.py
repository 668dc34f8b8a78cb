"""Sinks: partitioned tables, create-if-absent publishing, report files."""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def rebalanced(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Cluster rows by ``by`` for a partitioned write with the ``REBALANCE``
    hint: AQE hash-partitions by the key, then splits partitions above
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` (a county holding a
    third of the rows is written by many tasks) and merges small ones, so
    each task writes few, evenly sized files."""
    return df.hint("rebalance", *by)


#: Directories that a task of a partitioned write fills at once; with more of them it sorts its rows.
OPEN_FILES = "32"


@contextmanager
def unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """While it is open, a partitioned write keeps a file open for each
    directory of a task, instead of sorting its rows by directory first: rows
    that were clustered come with few of them.  A setting of the user's own is
    kept, and the session is left as it was."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    own = spark.conf.get(key, "0") != "0"
    if not own:
        spark.conf.set(key, OPEN_FILES)
    try:
        yield
    finally:
        if not own:
            spark.conf.unset(key)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str] = ("county",), mode: str = "overwrite") -> None:
    """One directory per key value (``group_split`` + one file per group),
    written by the executors in parallel; readers prune by key."""
    with unsorted_writes(df.sparkSession):
        rebalanced(df, by).write.mode(mode).partitionBy(*by).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through the Hadoop filesystem of ``path``."""
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


class ClaimedError(FileExistsError):
    """Another writer has claimed the place of a publication."""


def _fs(spark: SparkSession, path: str):
    """Hadoop file system of ``path``, and the path."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _claim(spark: SparkSession, path: str, token: str) -> None:
    """Creates the claim file ``path``; raises if it exists.

    The creation itself decides between two writers: ``create`` without
    overwriting is one operation of a distributed file system's name node, and
    on the local file system the exclusive creation of the operating system
    is used (Hadoop's local ``create`` looks first and creates then)."""
    fs, p = _fs(spark, path)
    body = f"{token} {time.strftime('%Y-%m-%dT%H:%M:%SZ', time.gmtime())}\n".encode()
    taken = ClaimedError(
        f"{path} exists: another writer is publishing, or died while it did; remove the file once that is certain"
    )
    if fs.getScheme() == "file":
        local = fs.makeQualified(p).toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            with open(local, "xb") as out:
                out.write(body)
        except FileExistsError:
            raise taken from None
        return
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if fs.exists(p):
            raise taken from e
        raise
    out.write(body)
    out.close()


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def publish_once(df: DataFrame, path: str, by: Sequence[str] = ("county",), replace_unmarked: bool = False) -> bool:
    """Write ``df`` only if nothing is at ``path``; returns whether it wrote.

    Nothing is ever overwritten, and what appears at ``path`` is a whole
    table: of several writers at once, one wins.

    1. The claim file ``<path>.claim`` is created exclusively.  A writer that
       finds it raises :class:`ClaimedError`: the other one may still succeed
       or may have died, which is for a person to decide.
    2. The table is written to ``<path>.staged-<token>`` and moved to ``path``
       by a rename that fails if something is there.
    3. The claim is removed; if the write fails, so are the staged files.

    A directory with the commit marker ``_SUCCESS`` is a publication: it stays
    and the result is False.  One without the marker may be a complete table
    whose writer makes none, a write in progress, or what a dead job left: it
    raises.  ``replace_unmarked`` states that decision; the old directory is
    then moved aside to ``<path>.replaced-<time>``, not deleted.  All checks
    run before any data is read."""
    spark = df.sparkSession
    path = path.rstrip("/")
    if path_exists(spark, path + "/_SUCCESS"):
        return False
    token = uuid.uuid4().hex
    claim, staged = f"{path}.claim", f"{path}.staged-{token}"
    _claim(spark, claim, token)
    try:
        if path_exists(spark, path + "/_SUCCESS"):  # published between the look and the claim
            return False
        if path_exists(spark, path):
            if not replace_unmarked:
                raise FileExistsError(f"{path} exists without a commit marker; it is not overwritten")
            _move(spark, path, f"{path}.replaced-{time.time_ns()}")
        try:
            with unsorted_writes(spark):
                rebalanced(df, by).write.mode("errorifexists").partitionBy(*by).parquet(staged)
            _move(spark, staged, path)
        except BaseException:
            _delete(spark, staged)
            raise
    finally:
        _delete(spark, claim)
    return True


def _move(spark: SparkSession, path: str, to: str) -> None:
    """Renames; raises if something is at ``to`` (the rename of a file system
    object, unlike that of a file context, would move into a directory)."""
    jvm = spark.sparkContext._jvm
    fs, old = _fs(spark, path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(
        old, jvm.org.apache.hadoop.fs.Path(to), spark.sparkContext._gateway.new_array(rename, 0)
    )


def publish_table_once(df: DataFrame, table: str) -> bool:
    """Catalog-table variant of :func:`publish_once`: the claim file lies in
    the folder of the table's database."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        return False
    *database, name = table.split(".")
    folder = spark.catalog.getDatabase(".".join(database) or spark.catalog.currentDatabase()).locationUri
    claim = f"{folder.rstrip('/')}/{name}.claim"
    _claim(spark, claim, uuid.uuid4().hex)
    try:
        if spark.catalog.tableExists(table):
            return False
        df.write.mode("errorifexists").saveAsTable(table)
    finally:
        _delete(spark, claim)
    return True


def partition_values(spark: SparkSession, path: str, column: str) -> list[str | None]:
    """Values of the first partition column of a table, from its directory
    names alone (no data is read); the NULL partition is None and comes last."""
    fs, p = _fs(spark, path)
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    found = [unescape(n[len(column) + 1 :]) for n in names if n.startswith(f"{column}=")]
    return sorted((None if v == "__HIVE_DEFAULT_PARTITION__" else v for v in found), key=lambda v: (v is None, v or ""))


def write_report(
    df: DataFrame, path: str, fmt: str = "csv", per_county: bool = False, order_by: Sequence[str] = ()
) -> None:
    """Report output; CSV opens in a spreadsheet.

    Rows are dealt with the ``REBALANCE`` hint: a crosstab becomes one file
    (with ``per_county`` one for each county, ``county=<name>/part-*.csv``),
    while rows of a fact-sized result or of a hot county are split over as
    many tasks as their bytes need.  ``order_by`` sorts the rows inside each
    file (no global sort job is needed)."""
    if per_county:
        out = rebalanced(df, ["county"])
        # lead with the partition column: the partitioned writer needs rows
        # grouped by it and would otherwise re-sort, dropping this order
        order_by = ["county", *[c for c in order_by if c != "county"]] if order_by else []
    else:
        out = df.hint("rebalance")
    if order_by:
        out = out.sortWithinPartitions(*order_by)
    w = out.write.mode("overwrite")
    if per_county:
        w = w.partitionBy("county")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)

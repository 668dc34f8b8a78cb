"""Readers: parquet tables, landed CSV extracts, JDBC and catalog tables.

All readers take an explicit schema or rely on self-describing Parquet;
nothing is inferred.  Column selection and filters applied afterwards reach
the Parquet scan (``ReadSchema`` / ``PushedFilters``) through Catalyst.
"""

from __future__ import annotations

import csv
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _cache(spark: SparkSession) -> dict:
    """Memo of lazily built plans (no data is cached) while one query is
    being built: the catalog forgets it before every query, so each one lists
    its files afresh."""
    c = getattr(spark, "_quantis_plans", None)
    if c is None:
        c = {}
        spark._quantis_plans = c
    return c


def clear_plans(spark: SparkSession) -> None:
    """Forget memoised plans; done before each registered query is built."""
    _cache(spark).clear()


def memo(spark: SparkSession, key: tuple, build):
    c = _cache(spark)
    if key not in c:
        c[key] = build()
    return c[key]


#: Settings that change the types that a Parquet footer is read as.
_TYPE_SETTINGS = ("spark.sql.parquet.inferTimestampNTZ.enabled", "spark.sql.parquet.binaryAsString", "spark.sql.parquet.int96AsTimestamp")


def table_schema(spark: SparkSession, path: str) -> StructType:
    """Schema of a Parquet table, from its footers once as long as the table
    stays the same: it is known again by the path's modification time and
    length, which cost one look at the file system instead of a Spark job."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    status = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p)
    known = getattr(spark, "_quantis_schemas", None)
    if known is None:
        known = spark._quantis_schemas = {}
    mark = (status.getModificationTime(), status.getLen(), *(spark.conf.get(c, None) for c in _TYPE_SETTINGS))
    # a store that keeps no times of its folders tells 0: nothing is known of them
    if not mark[0] or known.get(path, (None, None))[0] != mark:
        known[path] = mark, spark.read.parquet(path).schema
    return known[path][1]


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """``<base>/<name>.parquet`` (a file or a directory of parts).

    The relation is memoised until :func:`clear_plans`, so its files are
    listed for every query; its schema is kept while the table is unchanged."""
    path = f"{base.rstrip('/')}/{name}.parquet"
    return memo(spark, ("read", path), lambda: spark.read.schema(table_schema(spark, path)).parquet(path))


def read_csv(spark: SparkSession, path: str, schema: StructType, header: bool = True) -> DataFrame:
    """Landed CSV files (e.g. the workload API extract), declared schema,
    malformed rows fail the job instead of turning into silent NULLs."""
    return spark.read.csv(path, schema=schema, header=header, mode="FAILFAST")


def csv_headers(spark: SparkSession, path: str, threads: int = 16) -> dict[tuple[str, ...], list[str]]:
    """CSV files below ``path`` by their header line.

    Spark lists the files; of each one only the first line is read, through
    its file system and compression codec, so nothing but one line a file
    passes through the driver.  Empty files have no header and no rows."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def header(file: str) -> tuple[str, tuple[str, ...] | None]:
        p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        stream, codec = p.getFileSystem(conf).open(p), codecs.getCodec(p)
        try:
            line = jvm.java.io.BufferedReader(
                jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec is not None else stream, "UTF-8")
            ).readLine()
        finally:
            stream.close()
        return file, tuple(next(csv.reader([line]))) if line else None

    groups: dict[tuple[str, ...], list[str]] = {}
    files = spark.read.option("recursiveFileLookup", True).text(path).inputFiles()
    with ThreadPoolExecutor(threads) as pool:
        for file, names in pool.map(header, sorted(files)):
            if names is not None:
                groups.setdefault(names, []).append(file)
    return groups


def read_jdbc(spark: SparkSession, table: str, prefix: str = "spark.quantis.jdbc") -> DataFrame:
    """Table from a relational database.  Connection settings come from the
    session configuration (``<prefix>.url``, ``.user``, ``.password``,
    ``.driver`` and optional ``.partitionColumn``/``.lowerBound``/
    ``.upperBound``/``.numPartitions`` for parallel reads), never from
    literals in code."""
    conf = spark.conf
    opts = {"url": conf.get(f"{prefix}.url"), "dbtable": table}
    for k in ("user", "password", "driver", "partitionColumn", "lowerBound", "upperBound", "numPartitions", "fetchsize"):
        v = conf.get(f"{prefix}.{k}", None)
        if v is not None:
            opts[k] = v
    return spark.read.format("jdbc").options(**opts).load()


def catalog_union(spark: SparkSession, pattern: str, schema: StructType | None = None) -> DataFrame:
    """Union of every catalog table whose whole name matches the regular
    expression ``pattern`` (e.g. ``'.*kakamega'`` for one table per
    sub-county).  Only table names reach the driver; rows are read by
    executors.  Columns of one name must have one type."""
    from quantis.operators.sets import union_aligned

    names = sorted(t.name for t in spark.catalog.listTables() if re.fullmatch(pattern, t.name))
    if not names:
        raise ValueError(f"no table matches {pattern!r}")
    return union_aligned([spark.table(n) for n in names], schema)

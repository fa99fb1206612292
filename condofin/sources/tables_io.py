"""Parquet layout of the domain tables: write, read back, append.

One folder per table under a base path.  Payments are partitioned by the
calendar year of the payment (``anio``), so year and date-range filters of
the reports prune whole folders; the other tables are unpartitioned.  Rows
are never updated in place: masking and encryption write new folders.

A registration appends to several tables at once.  Its rows are written to a
folder of their own, and only then one small numbered file names that folder:
readers take the folders that are named, so a batch is there with all its
tables or not at all.  The number is the one after the last that the writer has
seen, and a file is created only if there is none of that name, so of two
writers that start from the same state one fails and can try again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import SCHEMAS, Tables
from ..operators.windows import materialize

PARTITION_COLUMN = {"pago": ("anio", lambda df: F.year("fecha"))}


def write_tables(tables: Tables, base: str, mode: str = "overwrite") -> None:
    base = base.rstrip("/")
    for name, df in tables.as_dict().items():
        writer_df = df
        part = PARTITION_COLUMN.get(name)
        if part is not None:
            col, expr = part
            writer_df = df.withColumn(col, expr(df)) if col not in df.columns else df
            writer_df.write.mode(mode).partitionBy(col).parquet(f"{base}/{name}")
        else:
            writer_df.write.mode(mode).parquet(f"{base}/{name}")


class BatchConflict(RuntimeError):
    """Another batch was committed since the writer looked."""


#: Folder of the batches appended to the tables beside it.
BATCHES = "lotes"


def _files(spark: SparkSession, path: str):
    """Hadoop file system and path of ``path``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def log_entries(spark: SparkSession, folder: str) -> list[str]:
    """Texts of the numbered files of a log, in order."""
    fs, path = _files(spark, folder)
    if not fs.exists(path):
        return []
    files = sorted((s.getPath() for s in fs.listStatus(path) if s.isFile()), key=lambda p: p.getName())
    io = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
    out = []
    for file in files:
        stream = fs.open(file)
        try:
            out.append(io.toString(stream, "UTF-8"))
        finally:
            stream.close()
    return out


def log_append(spark: SparkSession, folder: str, text: str, seen: int) -> int:
    """Write the entry after the first ``seen`` ones; :class:`BatchConflict` if
    there is one already."""
    fs, path = _files(spark, folder)
    entry = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, f"{seen + 1:010d}")
    if fs.exists(entry):
        raise BatchConflict(f"entry {seen + 1} of {folder} is there already")
    try:
        stream = fs.create(entry, False)
    except Exception as taken:
        raise BatchConflict(f"entry {seen + 1} of {folder} is there already") from taken
    stream.write(text.encode())
    stream.close()
    return seen + 1


def committed_batches(spark: SparkSession, base: str) -> list[str]:
    """Names of the batches' folders in the order they were committed: one
    small file each, however many rows they hold."""
    return log_entries(spark, f"{base.rstrip('/')}/{BATCHES}")


def commit_batch(spark: SparkSession, base: str, rows: dict[str, DataFrame], seen: int | None = None) -> int:
    """Append ``rows`` (a frame per table) to the tables under ``base``, all or
    none, and return how many batches there are then.

    ``seen`` is the number of batches that the rows were made from (default: as
    many as there are now); if more were committed since,
    :class:`BatchConflict` is raised and nothing is appended.  A write that
    fails leaves a folder that no reader looks at."""
    folder = f"{base.rstrip('/')}/{BATCHES}"
    seen = len(committed_batches(spark, base)) if seen is None else seen
    name = uuid.uuid4().hex
    for table, df in rows.items():
        df.write.parquet(f"{folder}/{name}/{table}")
    return log_append(spark, folder, name, seen)


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One table written by :func:`write_tables`, with the batches committed to it."""
    base = base.rstrip("/")
    df = spark.read.parquet(f"{base}/{name}")
    more = [f"{base}/{BATCHES}/{batch}/{name}" for batch in committed_batches(spark, base)]
    more = [p for p in more if (f := _files(spark, p))[0].exists(f[1])]
    return df.unionByName(spark.read.schema(df.schema).parquet(*more)) if more else df


def read_tables(spark: SparkSession, base: str) -> Tables:
    """Tables written by :func:`write_tables` (protected columns included if
    present), with the batches committed to them."""
    return Tables(**{name: read_table(spark, base, name) for name in SCHEMAS})


def rewrite_partitions(spark: SparkSession, path: str, partition: str, needs: Column,
                       change: Callable[[DataFrame], DataFrame]) -> list:
    """UPDATE of a stored table: ``change`` the rows of those partitions that
    have a row where ``needs`` holds, and of no others.

    One narrow scan finds the partitions; only they are read, changed, staged
    (so that a change which gives other values each time, as encryption does,
    runs once) and swapped in by a dynamic partition overwrite.  A run that
    stops between two partitions leaves each as it was or as it will be, and
    the next run takes up those that still need it.  Returns the values of the
    partitions, in order."""
    stored = spark.read.parquet(path)
    touched = sorted(r[0] for r in stored.where(needs).select(partition).distinct().collect())
    if touched:
        staged = materialize(change(stored.where(F.col(partition).isin(touched))).select(*stored.columns))
        (staged.repartition(F.col(partition), F.pmod(F.xxhash64(*[c for c in stored.columns if c != partition][:1]), F.lit(16)))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path))
    return touched


def year_filter(df: DataFrame, d_from, d_to) -> DataFrame:
    """Partition filter on ``anio`` when the table is year-partitioned (the
    row-level date filter still applies; this only prunes folders)."""
    if "anio" not in df.columns:
        return df
    return df.filter((F.col("anio") >= d_from.year) & (F.col("anio") <= d_to.year))


# Tables that meet on the bill id in every report.
BUCKETED_ON_BILL = ("pago", "expensa", "charges")


def write_bucketed_tables(tables: Tables, base: str, database: str, buckets: int,
                          mode: str = "overwrite") -> None:
    """Catalog tables (Parquet under ``base``) with payments, bills and
    charges bucketed and sorted by ``expensa_id`` into ``buckets`` buckets.

    Reading them back with :func:`read_bucketed_tables`, the joins of
    payments, bills and per-bill charge aggregates on ``expensa_id`` are
    co-located: no shuffle of those three tables in any report.  Choose
    ``buckets`` for the largest table (e.g. ~256 MB of payments per bucket).
    """
    spark = tables.pago.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    base = base.rstrip("/")
    for name, df in tables.as_dict().items():
        w = df.write.mode(mode).format("parquet").option("path", f"{base}/{name}")
        if name in BUCKETED_ON_BILL:
            w = w.bucketBy(buckets, "expensa_id").sortBy("expensa_id")
        w.saveAsTable(f"{database}.{name}")


def read_bucketed_tables(spark: SparkSession, database: str) -> Tables:
    return Tables(**{name: spark.table(f"{database}.{name}") for name in SCHEMAS})

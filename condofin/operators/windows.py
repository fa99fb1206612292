"""Order-dependent operators that must not funnel all rows into one task.

``Window.orderBy`` without ``partitionBy`` plans an ``Exchange SinglePartition``:
one task sorts the whole input.  The helpers here split the work so that the
only single-partition step runs over a table whose size has a proven bound
(the number of shuffle partitions), never over data rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..session import scratch_table

_SUFFIX = "__cf"


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into a Parquet table in the shared checkpoint
    folder and read it back, cutting its lineage (for a result read by two
    branches of one plan).

    The folder is the session's ``spark.checkpoint.dir`` (a shared file
    system on a cluster), so the data survive the loss of an executor;
    Parquet keeps them columnar and compressed, which matters when the table
    is payment-sized.  ``session.remove_scratch`` deletes them when the job is
    done.
    """
    spark = df.sparkSession
    path = scratch_table(spark)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def _ranged(df: DataFrame, cols: list[str], n: int, watch: Observation | None = None,
            metrics: tuple[Column, ...] = ()) -> DataFrame:
    """``df`` in ``n`` ranges of ``cols`` with the range's number, written once:
    range bounds come from a sample, so all readers must see the same ones.
    ``metrics`` are observed by ``watch`` while the rows are written."""
    ranged = df.repartitionByRange(n, *[F.col(c) for c in cols]).sortWithinPartitions(*cols)
    if watch is not None:  # above the exchange: the sample doesn't count
        ranged = ranged.observe(watch, *metrics)
    return materialize(ranged.select("*", F.spark_partition_id().alias("pid" + _SUFFIX),
                                     F.monotonically_increasing_id().alias("mid" + _SUFFIX)))


def running_total(df: DataFrame, value: str, order_keys: list[str], out: str,
                  mean_out: str | None = None) -> DataFrame:
    """Global running sum in the order of ``order_keys`` (unique together).

    Equivalent to ``SUM(value) OVER (ORDER BY order_keys ROWS UNBOUNDED
    PRECEDING)`` and, if ``mean_out`` is given, ``AVG(value) OVER ()`` (as one
    DOUBLE division of the exact sum).  The rows are range-partitioned on all
    order keys, so no period, however many rows it has, is one task's; each
    range sums its own rows and adds the total of the ranges before it.  The
    table of range totals has one row per partition: that bounds the ordered
    step and the broadcast.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pid = "pid" + _SUFFIX
    ranged = _ranged(df, order_keys, n)
    totals = ranged.groupBy(pid).agg(F.sum(value).alias("sum" + _SUFFIX), F.count(F.lit(1)).alias("rows" + _SUFFIX))
    before = Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    cols = [pid, F.coalesce(F.sum("sum" + _SUFFIX).over(before), F.lit(0)).alias("off" + _SUFFIX)]
    if mean_out:
        every = Window.partitionBy()
        cols.append((F.sum("sum" + _SUFFIX).over(every).cast("double")
                     / F.sum("rows" + _SUFFIX).over(every).cast("double")).alias(mean_out))
    inner = (Window.partitionBy(pid).orderBy(*order_keys)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    within = ranged.withColumn("within" + _SUFFIX, F.sum(value).over(inner))
    return within.join(F.broadcast(totals.select(*cols)), pid) \
        .withColumn(out, F.col("off" + _SUFFIX) + F.col("within" + _SUFFIX)) \
        .drop(pid, "mid" + _SUFFIX, "off" + _SUFFIX, "within" + _SUFFIX)


def dense_row_number(df: DataFrame, order_col: str | list[str], out: str = "rn",
                     num_partitions: int | None = None, watch: Observation | None = None,
                     metrics: tuple[Column, ...] = ()) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY order_col)`` for a unique ordering key
    (one column or a list of columns).

    Distributed: range-partition on the key (the partitioner samples the key,
    so even a dense run of ids spreads over many partitions), sort inside each
    partition, number rows locally, then add the count of all rows in earlier
    partitions.  The per-partition count table has one row per partition, so
    the single-task prefix sum and the broadcast are bounded by the partition
    count, not by the data.  The local number comes from
    ``monotonically_increasing_id`` (partition index in the upper 31 bits,
    record index in the lower 33 bits, as documented).

    The partitioned, tagged rows are read twice (counts and numbering), and
    range-partition bounds come from a sample whose seed depends on the
    physical plan, so they are materialised once (:func:`materialize`):
    both reads then see the same partitions, also after an executor loss.
    ``metrics`` are aggregates that ``watch`` has when the call returns: they
    come with that write, without a job of their own.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = [order_col] if isinstance(order_col, str) else list(order_col)
    tagged = _ranged(df, cols, n, watch, metrics)
    local = F.col("mid" + _SUFFIX) - F.shiftleft(F.col("pid" + _SUFFIX).cast("bigint"), 33)
    counts = tagged.groupBy("pid" + _SUFFIX).agg(F.count(F.lit(1)).alias("cnt" + _SUFFIX))
    w = Window.orderBy("pid" + _SUFFIX).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("pid" + _SUFFIX,
                            F.coalesce(F.sum("cnt" + _SUFFIX).over(w), F.lit(0)).alias("off" + _SUFFIX))
    res = tagged.join(F.broadcast(offsets), "pid" + _SUFFIX)
    return res.withColumn(out, F.col("off" + _SUFFIX) + local + 1) \
              .drop("pid" + _SUFFIX, "mid" + _SUFFIX, "off" + _SUFFIX)


def expand_counts(df: DataFrame, count_col: str, chunk: int = 10_000) -> DataFrame:
    """Repeat each row ``count_col`` times (the column is dropped).

    A row is first split into ``ceil(count / chunk)`` chunk rows, which are
    spread over partitions by a round-robin shuffle, and each chunk becomes at
    most ``chunk`` rows; so a row with a huge count never makes one huge
    array or one huge task.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    c = F.col(count_col)
    chunks = df.withColumn("chunk__", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                           F.floor((c - 1) / chunk).cast("bigint"))))
    chunks = chunks.withColumn("k__", F.least(F.lit(chunk).cast("bigint"), c - F.col("chunk__") * chunk))
    chunks = chunks.repartition(n)
    out = chunks.withColumn("rep__", F.explode(F.array_repeat(F.lit(True), F.col("k__").cast("int"))))
    return out.drop(count_col, "chunk__", "k__", "rep__")

"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelwright.session import scratch_path, ship_package

# White space of the query contracts, inside a Java or Python character class.
SPACE = r"\x20\x09-\x0D"
# A side is broadcast only when its counted rows stay within this bound (narrow rows).
BROADCAST_ROWS = 400_000
# Shuffle files go as soon as the write they were made for ends, not when the driver collects garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes in this block leave no shuffle files behind; the session's own setting holds again after it."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when the counted rows stay within the bound; else leave the join to a shuffle.

    ``df`` should be a saved table: it is counted first.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def running_total(df: DataFrame, order: Sequence[str], value: str, into: str) -> DataFrame:
    """Sum of ``value`` over all rows before each row in ``order``, without one task seeing all rows.

    Rows are range-partitioned by ``order`` (give it a unique last column, so that no key is too large for
    a partition) and written; totals of the partitions, one row each, then shift the sums inside them.
    """
    ranged = df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    ranged = saved(ranged, "ranged")
    parts = ranged.groupBy("__part").agg(F.sum(value).alias("__sum"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shift = parts.select("__part", F.coalesce(F.sum("__sum").over(before), F.lit(0)).cast("long").alias("__shift"))
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.withColumn(into, F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(F.broadcast(shift), "__part")
        .withColumn(into, (F.col(into) + F.col("__shift")).cast("long"))
        .drop("__part", "__shift")
    )


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null ids fall in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts, F.lit(0))


def labelled_sample(rows: DataFrame, key: str, bound: int, seed: int) -> DataFrame:
    """About ``bound`` of the rows at most, drawn by a hash of ``key``: the documented bound of a classifier."""
    n = rows.count()
    if n <= bound:
        return rows
    share = int(bound / n * (1 << 30))
    return rows.where(F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 30)) < share)


def python_batches(spark: SparkSession, rows: int = 2000, size: str = "8m") -> None:
    """Prepare for Python in tasks: ship this package, and bound what a worker gets at once in rows and bytes."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def worker_state(owner: str, make=lambda: None):
    """What ``owner`` keeps in this Python worker between tasks; what others kept here is let go.

    Workers are reused by later stages, whose own needs would else come on top.
    """
    if owner not in _KEPT:
        _KEPT.clear()
        _give_back()
        _KEPT[owner] = make()
    return _KEPT[owner]


def _give_back() -> None:
    """Return freed memory to the system; glibc keeps what was freed below memory that is still in use."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):     # another C library
        pass


_KEPT: dict[str, object] = {}

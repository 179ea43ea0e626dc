"""Scans, conforming, dimension building and sinks."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import (
    BooleanType, LongType, NumericType, StringType, StructField, StructType, TimestampNTZType, TimestampType,
)

from panelwright.functions.cleaning import UNKNOWN

MANIFEST = "_MANIFEST.json"       # names with an underscore are not read as data

# ---- scans ---------------------------------------------------------------

def read_csv_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Header CSV with a declared schema; no inference pass over the data."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_partitioned_fact(spark: SparkSession, root: str, months: Sequence[str] | None = None) -> DataFrame:
    """Hive-partitioned fact; ``month`` comes from the path and prunes directories."""
    df = spark.read.parquet(root).withColumn("month", F.col("month").cast("string"))
    return df if months is None else select_months(df, months)


def select_months(fact: DataFrame, months: Sequence[str], column: str = "month") -> DataFrame:
    return fact.where(F.col(column).isin(list(months)))


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table. ``count(*)`` reads no columns, only Parquet footers."""
    rows = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


# ---- conforming ----------------------------------------------------------

def conform_columns(df: DataFrame, schema: StructType, required: Sequence[str]) -> DataFrame:
    """Fail on missing keys; add absent optional columns with typed defaults."""
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    columns = []
    for field in schema.fields:
        if field.name in df.columns:
            columns.append(F.col(field.name))
        elif isinstance(field.dataType, NumericType):
            columns.append(F.lit(0).cast(field.dataType).alias(field.name))
        elif isinstance(field.dataType, BooleanType):
            columns.append(F.lit(False).alias(field.name))
        elif isinstance(field.dataType, StringType):
            columns.append(F.lit(UNKNOWN).alias(field.name))
        else:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, first in a total order.

    ``row_number() = 1`` lets Spark prune to one row per key *before* the
    shuffle (WindowGroupLimit), so a hot key never travels whole.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def union_dimension(key: str, *sources: DataFrame) -> DataFrame:
    """Every key seen in any source, once; distinct per source first."""
    out = None
    for source in sources:
        ids = source.select(F.col(key)).where(F.col(key).isNotNull()).distinct()
        out = ids if out is None else out.unionByName(ids)
    return out.distinct()


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """SQL settings for the time of a block."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# Parquet through the reader that answers MIN, MAX and COUNT from file footers.
FROM_FOOTERS = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}


def newest(spark: SparkSession, path: str, column: str):
    """Largest value of a column of a Parquet table, None if it has none, without reading the column.

    Spark's tasks take it from partition values or from the statistics in the file footers. Statistics of timestamps
    are read as numbers of microseconds; as a file may hold other units, they only bound the scan that reads the newest row
    groups. Where footers have no statistics the column is scanned.
    """
    rows = spark.read.parquet(path)
    kind = rows.schema[column].dataType
    timed = isinstance(kind, (TimestampType, TimestampNTZType))
    with settings(spark, FROM_FOOTERS):
        try:
            footers = spark.read.schema(StructType([StructField(column, LongType())])) if timed else spark.read
            found = footers.parquet(path).agg(F.max(column)).first()[0]
        except (PySparkException, Py4JJavaError):   # a footer without statistics
            return rows.agg(F.max(column)).first()[0]
    if not timed or found is None:
        return found
    if isinstance(kind, TimestampNTZType):
        least = F.expr(f"TIMESTAMP_NTZ'1970-01-01' + make_dt_interval(0, 0, 0, CAST({found} AS DECIMAL(20, 0)) / 1000000)")
    else:
        least = F.timestamp_micros(F.lit(found))
    last = rows.where(F.col(column) >= least).agg(F.max(column)).first()[0]
    return rows.agg(F.max(column)).first()[0] if last is None else last


def max_value(df: DataFrame, column: str, name: str) -> DataFrame:
    """One-row bound; safe to broadcast."""
    return df.agg(F.max(column).alias(name))


def drop_freshest(fact: DataFrame, date: str = "report_date", days: int = 3) -> DataFrame:
    """Drop the newest ``days`` days, which upstream systems still revise."""
    bound = max_value(fact, date, "__max_d")
    kept = fact.crossJoin(F.broadcast(bound))
    return kept.where(F.col(date) <= F.date_sub("__max_d", days)).drop("__max_d")


def pseudonymize(c: Column | str, salt: str, prefix: str, length: int = 12) -> Column:
    value = F.col(c) if isinstance(c, str) else c
    digest = F.sha2(F.concat(F.lit(salt), value.cast("string")), 256)
    return F.concat(F.lit(prefix), F.substring(digest, 1, length))


# ---- sinks ---------------------------------------------------------------

def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_fact(df: DataFrame, root: str, partition: str = "month", mode: str = "errorifexists") -> None:
    """Hive-partitioned write. The rebalance hint gives each partition value few
    files and lets AQE split a partition value that holds most of the rows."""
    df.hint("rebalance", F.col(partition)).write.mode(mode).partitionBy(partition).parquet(root)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def input_files(df: DataFrame) -> list[list]:
    """(path, length, modification time) of every file that ``df`` reads, listed folder by folder."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folders: dict[str, set[str]] = {}
    for file in df.inputFiles():
        folder, _, name = file.rpartition("/")
        folders.setdefault(folder, set()).add(unquote(name))
    found = []
    for folder, names in sorted(folders.items()):
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        for status in path.getFileSystem(conf).listStatus(path):
            if status.getPath().getName() in names:
                found.append([status.getPath().toString(), status.getLen(), status.getModificationTime()])
    return sorted(found)


def plan_digest(df: DataFrame) -> str | None:
    """Digest of the analysed plan without the numbers that differ from run to run; None if its inputs are not all files.

    Rows from the driver or an RDD, and Python functions, can change behind an equal plan.
    """
    plan = df._jdf.queryExecution().analyzed().treeString(True, False, 2**31 - 1, False, False)
    if re.search(r"LocalRelation|LogicalRDD|ExternalRDD|InMemoryRelation|Python|Pandas|Arrow", plan):
        return None
    numbers: dict[str, int] = {}
    plan = re.sub(r"#(\d+)", lambda m: f"#{numbers.setdefault(m[1], len(numbers))}", plan)
    return hashlib.sha256(f"{plan}\n{df.schema.json()}".encode()).hexdigest()


def manifest(df: DataFrame) -> str | None:
    """What a stored result depends on: plan and input files. None where that cannot be told."""
    digest = plan_digest(df)
    return None if digest is None else json.dumps({"plan": digest, "files": input_files(df)})


def _file(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, target = _file(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, target = _file(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def materialize(df: DataFrame, path: str, force: bool = False) -> DataFrame:
    """Run a heavy plan once and read it back: cuts lineage, survives executor loss.

    A complete result is reused, unless ``force``, when the manifest beside it says that it came from the same plan over
    the same input files (path, length, time). A result whose inputs cannot be told so is written anew. The manifest is
    taken before the plan runs and written after, so a change in between makes the next call write again.
    """
    spark = df.sparkSession
    wanted = manifest(df)
    note = f"{path}/{MANIFEST}"
    if force or wanted is None or not path_exists(spark, f"{path}/_SUCCESS") or read_text(spark, note) != wanted:
        df.write.mode("overwrite").parquet(path)
        if wanted is not None:
            write_text(spark, note, wanted)
    return spark.read.schema(df.schema).parquet(path)


def metrics_long(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Wide one-row-per-key metrics to (keys, metric, value)."""
    metrics = [c for c in df.columns if c not in keys]
    doubles = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in metrics])
    return doubles.unpivot(list(keys), metrics, "metric", "value")


def write_metrics_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def frame_fingerprint(df: DataFrame, key: str) -> DataFrame:
    """Order-free fingerprint of a keyed frame; one partial/final aggregate."""
    digest = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 12), 16, 10).cast("decimal(20,0)")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(digest).cast("string").alias("key_digest"),
        F.min(key).alias("min_key"),
        F.max(key).alias("max_key"),
    )

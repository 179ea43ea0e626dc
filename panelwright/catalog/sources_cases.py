"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from panelwright.catalog import inputs as I
from panelwright.catalog.base_sql import FACT, dev_scored, rnd
from panelwright.catalog.registry import case, r6
from panelwright.session import scratch_path
from panelwright.sources import standins, tables as T

C = F.col

CUSTOMER = StructType(
    [
        StructField("c_custkey", LongType()), StructField("c_name", StringType()),
        StructField("c_nationkey", IntegerType()), StructField("c_acctbal", DoubleType()),
        StructField("c_mktsegment", StringType()),
    ]
)


@case("scan_csv", "SELECT * FROM customer")
def scan_csv(spark, sf):
    path = scratch_path(spark, "customer-csv")
    T.write_csv(standins.table(spark, sf, "customer"), path)
    return T.read_csv_table(spark, path, CUSTOMER)


@case("scan_parquet", "SELECT p_partkey, p_brand, p_type, p_size FROM part")
def scan_parquet(spark, sf):
    return T.read_table(spark, f"{sf}/part.parquet", ["p_partkey", "p_brand", "p_type", "p_size"])


MONTHLY = "SELECT month, COUNT(*) AS n, CAST(SUM(gsc_impressions) AS BIGINT) AS impressions FROM fact"


def _monthly(df):
    return df.groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.sum("gsc_impressions").alias("impressions"))


@case("scan_partitioned", f"WITH {FACT} {MONTHLY} GROUP BY month")
def scan_partitioned(spark, sf):
    return _monthly(T.read_partitioned_fact(spark, I.stored_fact(spark, sf)))


@case("scan_partition_list", f"WITH {FACT} {MONTHLY} WHERE month IN ('1999-11', '1999-12', '2000-01') GROUP BY month")
def scan_partition_list(spark, sf):
    return _monthly(T.read_partitioned_fact(spark, I.stored_fact(spark, sf), ["1999-11", "1999-12", "2000-01"]))


NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@case("table_row_counts", " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS n FROM {n}" for n in NAMES))
def table_row_counts(spark, sf):
    return T.table_row_counts({n: standins.table(spark, sf, n) for n in NAMES})


@case(
    "conform_columns",
    "SELECT doc_id, lang, source, n_chars, CAST(0 AS DOUBLE) AS cpc, FALSE AS reviewed, 'unknown' AS main_intent FROM documents",
)
def conform_columns(spark, sf):
    schema = StructType(
        [
            StructField("doc_id", LongType()), StructField("lang", StringType()), StructField("source", StringType()),
            StructField("n_chars", LongType()), StructField("cpc", DoubleType()),
            StructField("reviewed", BooleanType()), StructField("main_intent", StringType()),
        ]
    )
    return T.conform_columns(standins.table(spark, sf, "documents"), schema, required=["doc_id", "source"])


@case("write_csv", f"{dev_scored()} SELECT content_hash_id, reason_code, rule_points FROM scored")
def write_csv(spark, sf):
    path = scratch_path(spark, "queue-csv")
    T.write_csv(I.scored(spark, sf).select("content_hash_id", "reason_code", "rule_points"), path)
    schema = StructType(
        [
            StructField("content_hash_id", StringType()), StructField("reason_code", StringType()),
            StructField("rule_points", IntegerType()),
        ]
    )
    return T.read_csv_table(spark, path, schema)


@case(
    "write_parquet_cached",
    f"{dev_scored()} SELECT content_hash_id, client_hash_id, f_impressions, {rnd('f_pos')}, is_position_decline FROM frame",
)
def write_parquet_cached(spark, sf):
    path = I.store_path(spark, sf, "cached-frame")
    T.materialize(I.frame(spark, sf), path)
    stored = T.materialize(I.frame(spark, sf), path)         # the second call reads what the first wrote
    return r6(stored.select("content_hash_id", "client_hash_id", "f_impressions", "f_pos", "is_position_decline"))


@case(
    "metrics_json",
    f"""{dev_scored()} SELECT 'base_rate' AS metric, ROUND(AVG(is_position_decline), 6) AS value FROM scored
    UNION ALL SELECT 'n_items', CAST(COUNT(*) AS DOUBLE) FROM scored
    UNION ALL SELECT 'n_clients', CAST(COUNT(DISTINCT client_hash_id) AS DOUBLE) FROM scored""",
)
def metrics_json(spark, sf):
    receipt = I.frame(spark, sf).agg(
        F.avg("is_position_decline").alias("base_rate"),
        F.count(F.lit(1)).alias("n_items"),
        F.count_distinct("client_hash_id").alias("n_clients"),
    )
    path = scratch_path(spark, "metrics-json")
    T.write_metrics_json(T.metrics_long(receipt), path)
    return r6(spark.read.schema("metric string, value double").json(path))


@case(
    "frame_fingerprint",
    f"""{dev_scored()} SELECT COUNT(*) AS n_rows, CAST(SUM(CAST('0x' || substr(md5(content_hash_id), 1, 12) AS BIGINT)) AS VARCHAR) AS key_digest,
    MIN(content_hash_id) AS min_key, MAX(content_hash_id) AS max_key FROM frame""",
)
def frame_fingerprint(spark, sf):
    return T.frame_fingerprint(I.frame(spark, sf), "content_hash_id")


@case(
    "build_dim_union",
    """SELECT c_custkey AS client_id FROM customer UNION SELECT o_custkey FROM orders UNION SELECT user_id FROM events""",
)
def build_dim_union(spark, sf):
    t = lambda name, key: standins.table(spark, sf, name).select(C(key).alias("client_id"))
    return T.union_dimension("client_id", t("customer", "c_custkey"), t("orders", "o_custkey"), t("events", "user_id"))


LINE_ORDER = ["l_shipdate", "l_orderkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax"]


@case(
    "dedupe_dim",
    f"""SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY l_partkey ORDER BY {', '.join(LINE_ORDER)}) AS rn FROM lineitem) WHERE rn = 1""",
)
def dedupe_dim(spark, sf):
    li = standins.table(spark, sf, "lineitem")
    return T.first_per_key(li, ["l_partkey"], LINE_ORDER).select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber")


@case(
    "freshness_lag_cutoff",
    f"""WITH {FACT} SELECT year, COUNT(*) AS n, MAX(report_date) AS last_day FROM fact
    WHERE report_date <= (SELECT MAX(report_date) - 3 FROM fact) GROUP BY year""",
)
def freshness_lag_cutoff(spark, sf):
    kept = T.drop_freshest(I.fact(spark, sf), days=3)
    return kept.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.max("report_date").alias("last_day"))


@case(
    "pseudonymize_ids",
    """SELECT doc_id, 'content_' || substr(sha256('salt-1' || CAST(doc_id AS VARCHAR)), 1, 12) AS content_id,
       'client_' || substr(sha256('salt-1' || source), 1, 12) AS client_id FROM documents""",
)
def pseudonymize_ids(spark, sf):
    return standins.table(spark, sf, "documents").select(
        "doc_id",
        T.pseudonymize("doc_id", "salt-1", "content_").alias("content_id"),
        T.pseudonymize("source", "salt-1", "client_").alias("client_id"),
    )

"""Physical plans keep the properties that matter at scale."""

import pytest
from pyspark.sql import functions as F

from panelwright.catalog import CASES, inputs as I
from panelwright.session import SCALE_CONF
from panelwright.plans.windows import modeling_frame


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_auto_broadcast(spark):
    """What the planner does when no keyed side is known to be small."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


RELATIONAL = [k for k, c in CASES.items() if c.sql]


def test_no_cartesian_product_and_no_python(spark, sf, no_auto_broadcast):
    for key in RELATIONAL:
        text = plan(CASES[key].query(spark, sf))
        assert "CartesianProduct" not in text, key
        assert "Python" not in text and "MapInPandas" not in text, key


def test_frame_scans_once_and_pushes_the_range(spark, sf, no_auto_broadcast):
    split = I.split_of("dev")
    text = plan(modeling_frame(I.fact(spark, sf, split), I.dim(spark, sf), split))
    # The fact once; part twice, as the dimension and where the stand-in fact takes its client from.
    assert sum("FileScan" in line and "l_shipdate" in line for line in text.splitlines()) == 1
    assert text.count("FileScan") == 3
    assert "GreaterThanOrEqual(l_shipdate" in text and "LessThan(l_shipdate" in text
    scan = next(line for line in text.splitlines() if "FileScan" in line and "l_shipdate" in line)
    assert "l_orderkey" not in scan and "l_tax" not in scan


def test_partition_list_prunes_directories(spark, sf):
    text = plan(CASES["scan_partition_list"].query(spark, sf))
    assert "PartitionFilters: [month" in text


@pytest.mark.parametrize("key", ["dedupe_first", "capped_topn_per_group", "precision_at_k"])
def test_top_rows_are_pruned_before_the_shuffle(spark, sf, key):
    assert "WindowGroupLimit" in plan(CASES[key].query(spark, sf))


@pytest.mark.parametrize("key", ["precision_at_k", "lift_at_k", "recall_at_k", "metric_comparison", "order_policy_compare"])
def test_only_candidates_of_a_large_k_are_sorted(spark, sf, key):
    """K is 5,000 here: rows under the score cut leave before the exchange of the ranking window, whatever Spark's limit is."""
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "1")
    try:
        text = plan(CASES[key].query(spark, sf))
    finally:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", SCALE_CONF["spark.sql.optimizer.windowGroupLimitThreshold"])
    lines = text.splitlines()
    window = next(i for i, line in enumerate(lines) if "row_number()" in line and "Window" in line)
    below = "\n".join(lines[window:])
    assert "cut" in below and below.index("Exchange hashpartitioning(model") < below.index("isnull(cut")


@pytest.mark.parametrize("key, date", [
    ("case_sums_last_prev", "ts"), ("case_avg_window", "ts"), ("momentum_frame", "ts"), ("momentum_volatility_frame", "ts"),
    ("trend_direction", "ts"), ("theta_window_join", "l_shipdate")])
def test_the_newest_day_is_a_literal_bound(spark, sf, key, date):
    scans = [line for line in plan(CASES[key].query(spark, sf)).splitlines() if "FileScan" in line and date in line]
    assert len(scans) == 1 and f"GreaterThanOrEqual({date}" in scans[0]


def test_row_count_reads_no_columns(spark, sf):
    text = plan(CASES["table_row_counts"].query(spark, sf))
    assert text.count("ReadSchema: struct<>") == 14


def test_an_item_absent_from_the_dimension_keeps_its_client(spark):
    import datetime as dt

    from panelwright.plans.windows import Floors, Split, modeling_frame

    split = Split("s", ("1999",), "2000", "year")
    rows = [(f"c{k}", f"client{k}", dt.date(1999 + y, 5, 1 + k), str(1999 + y), 500, 5, 900.0, 2.0, True) for k in range(3) for y in (0, 1)]
    fact = spark.createDataFrame(
        rows, "content_hash_id string, client_hash_id string, report_date date, year string, gsc_impressions long, gsc_clicks long, "
        "gsc_sum_position double, gsc_avg_position double, gsc_data_available boolean")
    dim = spark.createDataFrame(
        [("c0", "other", None, None)], "content_hash_id string, client_hash_id string, content_created_date date, content_updated_date date")
    from panelwright.plans.windows import STATIC_COLUMNS
    dim = dim.withColumns({c: F.lit(None).cast("string") for c in STATIC_COLUMNS})
    got = {r["content_hash_id"]: r["client_hash_id"] for r in modeling_frame(fact, dim, split, Floors()).collect()}
    assert got == {f"c{k}": f"client{k}" for k in range(3)}


def test_page_stage_takes_text_and_missing_columns(spark, sf):
    from panelwright.plans import scoring
    from panelwright.sources import standins

    raw = standins.page_table(spark, sf)
    text = raw.select([F.col(c).cast("string").alias(c) for c in raw.columns]).drop("cpc", "users_90d")
    plain, typed = scoring.prepare_pages(raw.drop("cpc")), scoring.prepare_pages(text)
    cols = ["content_id", "impressions_90d", "ctr", "log_clicks_90d", "is_declining_label", "cpc", "users_90d"]
    key = lambda df: sorted((r["content_id"], round(float(r["ctr"]), 6), float(r["impressions_90d"]), r["is_declining_label"], float(r["cpc"])) for r in df.select(cols).collect())
    assert key(plain) == key(typed)
    bad = text.withColumn("ctr", F.lit("n/a"))
    assert scoring.prepare_pages(bad).agg(F.max("ctr")).first()[0] == 0.0
    import pytest as pt
    with pt.raises(ValueError, match="trend_direction"):
        scoring.prepare_pages(raw.drop("trend_direction"))

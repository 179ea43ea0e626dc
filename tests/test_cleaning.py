"""Column functions on hand-written edge cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from panelwright.functions import cleaning as K, rules, tiers
from panelwright.operators.audit import Contract, name_checks
from panelwright.plans.windows import MONTH_SPLITS, Split, both_windows, feature_window, outcome_window
from panelwright.sources import tables as T

C = F.col


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_numbers_and_flags(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,), ("nan",), ("inf",)], "t string")
    assert values(df, K.to_number("t"))[:4] == [1.5, None, None, None]
    assert values(df, K.finite_or(K.to_number("t"))) == [1.5, 0.0, 0.0, 0.0, 0.0]
    flags = spark.createDataFrame([("TRUE",), ("yes",), ("0",), (None,), ("y",)], "t string")
    assert values(flags, K.parse_bool("t")) == [True, True, False, False, True]


def test_three_valued_flag_and_zero_denominator(spark):
    df = spark.createDataFrame([(True, 1, 0), (False, 1, 4), (None, None, 4)], "f boolean, a int, b int")
    assert values(df, K.is_true("f")) == [True, False, False]
    assert values(df, K.safe_ratio("a", "b", 100.0)) == [None, 25.0, None]
    assert values(df, K.clip("a", 2, 3)) == [2, 2, None]


def test_bins_are_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (3.0,), (3.1,), (20.0,), (None,)], "p double")
    assert values(df, tiers.position_bin("p")) == [None, "top_3", "page_1", "striking", None]
    assert values(df, tiers.position_tier("p")) == ["no_data", "top_3", "page_1", "striking", "no_data"]


def test_trend_directions(spark):
    df = spark.createDataFrame([(5, 0), (0, 0), (13, 10), (7, 10), (10, 10), (None, 4)], "l int, p int")
    assert values(df, tiers.trend_direction("l", "p")) == ["new", "flat", "up", "down", "stable", "down"]


def test_code_lists(spark):
    df = spark.range(1)
    codes = K.codes_where([(F.lit(False), "a"), (F.lit(None).cast("boolean"), "b")])
    assert values(df, K.join_codes(codes, "|", "none")) == ["none"]
    assert values(df, K.cut(F.lit(0.0), [0, 1], ["x"])) == [None]
    with pytest.raises(ValueError):
        K.cut(F.lit(0.0), [0, 1, 2], ["x"])


def test_merged_codes_keep_order_and_drop_repeats(spark):
    df = spark.createDataFrame(
        [("ctr_review_candidate|x", 0.7, 600, 5.0, 0.1, 0, 0.0, 0.0)],
        "reason_codes string, best_model_probability double, impressions_90d int, avg_position double, ctr double, "
        "sessions_90d int, engagement_rate double, scroll_rate double",
    )
    assert values(df, rules.merged_reason_codes()) == [
        "ctr_review_candidate|x|model_decline_risk|visible_model_opportunity"
    ]


def test_conform_requires_keys_and_adds_defaults(spark):
    schema = StructType([StructField("k", StringType()), StructField("n", LongType()), StructField("s", StringType()), StructField("d", DoubleType())])
    df = spark.createDataFrame([("a",)], "k string")
    assert T.conform_columns(df, schema, ["k"]).first().asDict() == {"k": "a", "n": 0, "s": "unknown", "d": 0.0}
    with pytest.raises(ValueError):
        T.conform_columns(df.select(C("k").alias("z")), schema, ["k"])


def test_split_dates():
    dev = MONTH_SPLITS["dev"]
    assert (dev.start_date, dev.cut_date, dev.end_date) == (dt.date(2026, 1, 1), dt.date(2026, 3, 31), dt.date(2026, 4, 30))
    assert Split("y", ("1999-12",), "2000-01").cut_date == dt.date(1999, 12, 31)
    with pytest.raises(ValueError):
        Split("bad", ("2026-04",), "2026-04")


def test_monthly_windows_one_pass_equals_join(spark):
    """Bit-mask day counts, filtered sums and the single grouping agree with the plain form."""
    n = 4000
    fact = spark.range(n).select(
        F.when(C("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), (C("id") % 40).cast("string"))).alias("content_hash_id"),
        F.date_add(F.lit(dt.date(2026, 1, 1)), (C("id") * 7 % 120).cast("int")).alias("report_date"),
        (C("id") % 6).alias("gsc_impressions"), (C("id") % 2).alias("gsc_clicks"),
        (C("id") % 90).cast("double").alias("gsc_sum_position"), (C("id") % 30).cast("double").alias("gsc_avg_position"),
        F.when(C("id") % 7 == 0, None).otherwise(C("id") % 11 != 0).alias("gsc_data_available"),
    ).withColumn("month", F.date_format("report_date", "yyyy-MM"))
    split = MONTH_SPLITS["dev"]
    joined = feature_window(fact, split).join(outcome_window(fact, split), "content_hash_id")
    one = both_windows(fact, split)
    as_rows = lambda df: sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*joined.columns).collect())
    assert as_rows(one) == as_rows(joined)
    plain = fact.where("month < '2026-04' AND gsc_data_available AND gsc_impressions > 0").groupBy("content_hash_id").agg(
        F.count_distinct("report_date").alias("d")
    )
    both = one.join(plain, "content_hash_id")
    assert both.count() > 15 and both.where("d <> f_days_with_impressions").count() == 0


def test_contract_and_name_checks(spark):
    contract = Contract(features=["f_pos"], label=["o_pos"], context=["id"], excluded=["f_pos"])
    assert contract.problems(["f_pos", "o_pos", "id", "new"]) == ["unclassified: new", "in two buckets: f_pos"]
    failed = name_checks(spark, ["f_pos", "o_pos", "client_hash_id"]).where("NOT ok")
    assert {r["check"] for r in failed.collect()} == {"label columns kept apart", "identifiers kept apart"}


def test_materialize_reuses_and_forces(spark, tmp_path):
    """Another plan is never answered by an old result; the same one over the same files is (see test_tables)."""
    path, source = str(tmp_path / "t"), str(tmp_path / "s")
    spark.range(3).write.parquet(source)
    files = lambda: spark.read.parquet(source)
    stamp = lambda: sorted((f.name, f.stat().st_mtime_ns) for f in (tmp_path / "t").glob("part-*"))
    assert T.materialize(files(), path).count() == 3
    first = stamp()
    assert T.materialize(files(), path).count() == 3 and stamp() == first
    assert T.materialize(files(), path, force=True).count() == 3 and stamp() != first
    assert T.materialize(spark.range(5), path).count() == 5

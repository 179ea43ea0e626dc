"""Column origins read off plans, and the audit rows that hang on them: each must be able to fail."""

from pyspark.sql import functions as F

from panelwright.operators import audit as A
from panelwright.operators.lineage import OTHER, origins
from panelwright.plans.windows import Split, modeling_frame
from panelwright.catalog import inputs as I

C = F.col
SPLIT = Split("t", ("1997", "1998"), "1999", "year")
YEARS = ["1997", "1998", "1999"]


def fact_of(spark, tmp_path, name="fact"):
    rows = [(f"i{k % 3}", y, float(k)) for k in range(12) for y in YEARS]
    path = str(tmp_path / f"{name}.parquet")
    spark.createDataFrame(rows, "id string, year string, x double").write.parquet(path)
    return spark.read.parquet(path)


def periods(df, column):
    return origins(df, "year", YEARS, ["year"])[column].periods


def test_filters_and_conditions_bound_the_periods(spark, tmp_path):
    fact = fact_of(spark, tmp_path)
    later = C("year") == "1999"
    out = fact.where(C("year").isin(YEARS)).groupBy("id").agg(
        F.sum(F.when(~later, C("x"))).alias("known"), F.sum(F.when(later, C("x"))).alias("told"), F.sum("x").alias("all"),
        F.sum(F.when(C("x") > 3, C("x")).when(later, 1.0).otherwise(C("x"))).alias("maybe"),
        F.max(F.when(later, 0.0).otherwise(C("x"))).alias("other_branch"))
    assert periods(out, "known") == {"1997", "1998"} and periods(out, "told") == {"1999"}
    assert periods(out, "all") == periods(out, "maybe") == set(YEARS)
    assert periods(out, "other_branch") == {"1997", "1998"}
    both = out.withColumn("mixed", C("known") + C("told"))
    assert periods(both, "mixed") == set(YEARS)
    assert periods(fact.select("x"), "x") == {*YEARS, OTHER}
    assert periods(fact.where((C("year") == "1997") | (C("x") > 1) & (C("year") == "1998")), "x") == {"1997", "1998"}


def test_columns_pass_unions_joins_and_generators(spark, tmp_path):
    fact, query = fact_of(spark, tmp_path), fact_of(spark, tmp_path, "query")
    union = fact.select("id", C("x").alias("v")).unionByName(query.select("id", (C("x") * 2).alias("v")))
    assert origins(union, "year", YEARS, ["year"])["v"].columns == {"fact.x", "query.x"}
    joined = fact.alias("a").join(fact.alias("b"), "id").select(C("a.x").alias("one"), F.explode(F.array("b.x")).alias("two"))
    assert {k: o.columns for k, o in origins(joined, "year", YEARS, ["year"]).items()} == {"one": {"fact.x"}, "two": {"fact.x"}}


def test_audit_rows_fail_on_a_leak_and_on_the_query_table(spark, sf):
    split = I.split_of("dev")
    frame = I.build_frame(spark, sf)
    asked = [*split.feature_periods, split.outcome_period]
    features = ["f_pos", "f_ctr", "f_pos_trend", "word_count", "content_age_days"]
    label = ["o_impressions", "o_pos"]
    made = origins(frame, split.period, asked, ["l_shipdate"])
    assert A.period_origin(made, features, label, split)[1:] == (True, "1997,1998,1999")
    assert not A.period_origin(made, [*features, "o_pos"], label, split)[1]
    hidden = origins(frame.withColumn("innocent", C("f_pos") + 0 * C("pos_delta")), split.period, asked, ["l_shipdate"])
    assert A.period_origin(hidden, [*features, "innocent"], label, split)[1:] == (False, "1997,1998,1999,2000")
    assert not A.period_origin(made, [], label, split)[1] and not A.period_origin(made, features, features, split)[1]
    assert A.unread_sources(made, features, ["lineitem.l_suppkey"])[1]
    assert not A.unread_sources(made, features, ["lineitem"])[1]
    assert not A.unread_sources(made, features, ["part.p_size"])[1]


def test_scores_of_the_wrong_fold_are_found(spark):
    folds = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "id string, fold int")
    good = [(i, f, m) for i, f in [("a", 0), ("b", 1), ("c", 2)] for m in ("x", "y")]
    wrong = lambda rows: A.out_of_fold_row(spark.createDataFrame(rows, "id string, fold int, model string"), folds, "id").first()
    assert wrong(good)["ok"]
    for bad in (good[1:], good + good[:1], [("a", 1, "x"), *good[1:]], good + [("z", 0, "x")]):
        assert not wrong(bad)["ok"]

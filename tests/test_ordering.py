"""Distributed order statistics against whole-table windows, with heavy skew."""

import pytest
from pyspark.sql import Window, functions as F

from panelwright.operators import ordering as O

C = F.col


@pytest.fixture(scope="module")
def skewed(spark):
    """5,000 rows; one value and one group each hold more than a third."""
    df = spark.range(5000).select(
        F.concat(F.lit("id"), C("id").cast("string")).alias("id"),
        F.when(C("id") % 5 < 2, 7.0).otherwise((C("id") * 37 % 1000) / 10).alias("v"),
        (C("id") % 3).cast("double").alias("w"),
        F.when(C("id") % 10 < 4, "hot").otherwise(F.concat(F.lit("g"), (C("id") % 17).cast("string"))).alias("g"),
    )
    return df


@pytest.mark.parametrize("by", [[], ["g"]])
def test_exact_quantiles(skewed, by):
    probs = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.8, "e": 1.0}
    got = O.exact_quantiles(skewed, "v", probs, by).collect()
    want = skewed.groupBy(*by).agg(*[F.percentile("v", F.lit(p)).alias(n) for n, p in probs.items()]).collect()
    key = lambda r: [r[b] for b in by]
    for x, y in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert [x[n] for n in probs] == pytest.approx([y[n] for n in probs])


@pytest.mark.parametrize("n", [1, 2, 7, 170, 19_999, 20_001, 60_000])
def test_exact_quantiles_at_every_size(spark, n):
    """Both sides of the size where the bracket replaces the full histogram."""
    df = spark.range(n).select(((C("id") * 7919) % n).cast("double").alias("v"))
    probs = {f"p{i}": i / 20 for i in range(21)}
    got = O.exact_quantiles(df, "v", probs).first()
    for name, p in probs.items():
        assert got[name] == pytest.approx(p * (n - 1), abs=1e-6)


def test_exact_quantiles_skip_nulls_and_all_null_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 4.0), ("b", None)], "g string, v double")
    assert [tuple(r) for r in O.exact_median(df, "v", "m", ["g"]).collect()] == [("a", 2.5)]


@pytest.mark.parametrize("keys", [[("v", True)], [("v", False)], [("v", True), ("w", True)], [("w", False), ("v", True)]])
def test_global_row_number(skewed, keys):
    order = [C(c).desc() if d else C(c).asc() for c, d in keys]
    want = skewed.withColumn("want", F.row_number().over(Window.orderBy(*order, F.md5("id"), "id")))
    got = O.global_row_number(skewed, keys, "id", "got")
    both = got.join(want.select("id", "want"), "id")
    assert both.count() == 5000 and both.where("got <> want").count() == 0


def test_global_row_number_spreads_a_heavy_value(skewed):
    """No bucket may hold the value that holds two fifths of the rows."""
    plan = O.global_row_number(skewed, [("v", True)], "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "__bh" in plan
    edges = O._cut_points(skewed, {"v": 64}, "id").first()["__e0"]
    assert 7.0 in edges


@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(skewed, by, descending):
    counts = skewed.groupBy(*by, "v").agg(F.count(F.lit(1)).alias("n"))
    order = C("v").desc() if descending else C("v").asc()
    w = Window.partitionBy(*(by or [F.lit(1)])).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    want = counts.withColumn("want", F.sum("n").over(w)).drop("n")
    got = O.running_totals(counts, "v", {"got": "n"}, by, descending)
    both = got.join(want, [*by, "v"])
    assert both.count() == counts.count() and both.where("got <> want").count() == 0


def test_running_totals_of_many_small_groups(spark):
    """Small groups carry no cut points; one large group among them does."""
    df = spark.range(9000).select(
        F.when(C("id") < 6000, "big").otherwise((C("id") % 700).cast("string")).alias("g"),
        C("id").cast("double").alias("v"), F.lit(1).alias("n"),
    )
    assert [r["g"] for r in O._cut_points(df, {"v": 16}, "v", ["g"]).collect()] == ["big"]
    w = Window.partitionBy("g").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    got = O.running_totals(df, "v", {"got": "n"}, ["g"]).withColumn("want", F.sum("n").over(w))
    assert got.count() == 9000 and got.where("got <> want").count() == 0


@pytest.mark.parametrize("by", [[], ["g"]])
def test_hashed_row_number(skewed, by):
    w = Window.partitionBy(*(by or [F.lit(1)])).orderBy(F.md5(F.concat(F.lit("3:"), C("id"))), "id")
    want = skewed.withColumn("want", F.row_number().over(w)).select("id", "want")
    both = O.hashed_row_number(skewed, "id", 3, by, "got").join(want, "id")
    assert both.count() == 5000 and both.where("got <> want").count() == 0


def test_percentile_rank_shares_ties(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (4.0,)], "v double")
    got = sorted(r["p"] for r in O.percentile_rank_avg(df, "v", "p").collect())
    assert got == pytest.approx([0.2, 0.4, 0.6, 0.9, 0.9])


def test_capped_top_equals_greedy_walk(skewed):
    rows = skewed.select("id", "g", "v", F.md5("id").alias("h")).collect()
    taken, want = {}, []
    for r in sorted(rows, key=lambda r: (-r["v"], r["h"], r["id"])):
        if taken.get(r["g"], 0) < 5 and len(want) < 40:
            taken[r["g"]] = taken.get(r["g"], 0) + 1
            want.append(r["id"])
    got = [r["id"] for r in O.capped_top(skewed, "g", "v", "id", 5, 40).orderBy("rank").collect()]
    assert got == want


def test_minmax_of_constant_and_null_columns(spark):
    df = spark.createDataFrame([(1, 5.0, None), (2, 5.0, None)], "id int, c double, n double")
    out = O.minmax_normalize(O.minmax_normalize(df, "c", "c01"), "n", "n01").collect()
    assert [(r["c01"], r["n01"]) for r in out] == [(0.0, 0.0), (0.0, 0.0)]


def test_quantile_bins_keep_ties_together(skewed):
    bins = O.quantile_bins(skewed, "v", 10, "b").groupBy("v").agg(F.count_distinct("b").alias("k"))
    assert bins.where("k > 1").count() == 0


BIG = 1 << 53


@pytest.fixture(scope="module", params=[1_000, 20_000])
def with_nulls(spark, request):
    """One row in ten without a key or group; bigints that doubles cannot tell apart."""
    return spark.range(request.param).select(
        F.concat(F.lit("id"), C("id").cast("string")).alias("id"),
        F.when(C("id") % 10 != 3, F.lit(BIG) + (C("id") * 31) % 5).alias("big"),
        F.when(C("id") % 10 != 4, (C("id") * 37 % 1000) / 10).alias("v"),
        F.when(C("id") % 10 != 5, F.concat(F.lit("g"), (C("id") % 7).cast("string"))).alias("g"),
        (C("id") % 2).cast("int").alias("y"),
    ).cache()


@pytest.mark.parametrize("keys", [[("big", True)], [("big", False)], [("v", True), ("big", False)], [("v", False)]])
def test_ranks_keep_null_and_large_keys(with_nulls, keys):
    order = [C(c).desc_nulls_last() if d else C(c).asc_nulls_last() for c, d in keys] + [F.md5("id"), C("id")]
    want = with_nulls.withColumn("r", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))
    got = O.global_row_number(with_nulls, keys, "id").select("id", "rank")
    assert got.join(want, "id").where("rank = r").count() == with_nulls.count()


@pytest.mark.parametrize("descending", [True, False])
def test_running_totals_keep_null_groups_and_values(with_nulls, descending):
    points = with_nulls.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    order = C("v").desc_nulls_last() if descending else C("v").asc_nulls_last()
    w = Window.partitionBy("g").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    want = {(r["g"], r["v"]): r["t"] for r in points.withColumn("t", F.sum("n").over(w)).collect()}
    got = O.running_totals(points, "v", {"t": "n"}, by=["g"], descending=descending).collect()
    assert {(r["g"], r["v"]): r["t"] for r in got} == want


def test_null_groups_stay_in_medians_and_seeded_order(with_nulls):
    medians = {r["g"]: r["m"] for r in O.exact_median(with_nulls, "v", "m", ["g"]).collect()}
    assert None in medians and len(medians) == 8
    attached = O.attach_group_median(with_nulls, "g", {"m": "v"}, few=True)
    assert attached.where("m IS NULL").count() == 0 and attached.count() == with_nulls.count()
    ranked = O.hashed_row_number(with_nulls, "id", 1, ["g"])
    assert ranked.count() == with_nulls.count() and ranked.where("g IS NULL AND rn = 1").count() == 1


def test_splits_keep_rows_without_group_or_label(with_nulls):
    from panelwright.operators import splits as S

    n = with_nulls.count()
    folds = S.group_kfold(with_nulls, "g", 3)
    assert folds.count() == n and folds.where("g IS NULL").select("fold").distinct().count() == 1
    marked = with_nulls.withColumn("y", F.when(C("id") != "id7", C("y")))
    for out in (S.stratified_kfold(marked, "y", "id", 4, 1), S.stratified_split(marked, "y", "id", 0.25, 1), S.class_weights(marked, "y")):
        assert out.count() == n


def test_null_scores_rank_last_at_every_size(with_nulls):
    from panelwright.operators import metrics as M

    scores = with_nulls.select("id", F.lit("m").alias("model"), F.when(C("v").isNull(), 1).otherwise(C("y")).alias("label"), C("v").alias("score"))
    low = scores.withColumn("score", F.coalesce("score", F.lit(-1.0)))
    assert M.ranking_quality(scores).first()["roc_auc"] == pytest.approx(M.ranking_quality(low).first()["roc_auc"])


def test_few_groups_are_not_shuffled_to(spark, skewed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = O.exact_medians(skewed, ["v", "w"])._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

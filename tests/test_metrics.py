"""Metrics against brute force on small score tables."""

import math
import random

import pytest
from pyspark.sql import functions as F

from panelwright.operators import metrics as M

C = F.col
SCHEMA = "id string, grp string, label int, model string, score double"


def make(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    return [(f"i{i}", f"g{i % 3}", int(rng.random() < 0.4), "m", round(rng.random(), 1)) for i in range(300)]


def brute_auc(rows):
    pos = [r[4] for r in rows if r[2] == 1]
    neg = [r[4] for r in rows if r[2] == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def brute_ap(rows):
    total = sum(r[2] for r in rows)
    ap = 0.0
    for s in sorted({r[4] for r in rows}, reverse=True):
        at = sum(r[2] for r in rows if r[4] == s)
        above = [r for r in rows if r[4] >= s]
        ap += at / total * sum(r[2] for r in above) / len(above)
    return ap


def test_auc_and_ap_with_ties(spark, rows):
    got = M.ranking_quality(make(spark, rows)).first()
    assert got["roc_auc"] == pytest.approx(brute_auc(rows))
    assert got["average_precision"] == pytest.approx(brute_ap(rows))


def test_auc_per_group(spark, rows):
    got = {r["grp"]: r["auc"] for r in M.per_group_quality(make(spark, rows), 50).collect()}
    assert got == {g: pytest.approx(brute_auc([r for r in rows if r[1] == g])) for g in ("g0", "g1", "g2")}


def test_one_class_has_no_auc(spark):
    got = M.ranking_quality(make(spark, [("a", "g", 1, "m", 0.2), ("b", "g", 1, "m", 0.4)])).first()
    assert got["roc_auc"] is None and got["average_precision"] is None


def test_precision_beyond_table_size_uses_all_rows(spark):
    got = M.precision_curve(make(spark, [("a", "g", 1, "m", 0.9), ("b", "g", 0, "m", 0.4)]), [1, 10])
    assert {r["k"]: (r["taken"], r["precision_at_k"]) for r in got.collect()} == {1: (1, 1.0), 10: (2, 0.5)}


def test_threshold_metrics_zero_division(spark):
    got = M.threshold_metrics(make(spark, [("a", "g", 0, "m", 0.1), ("b", "g", 0, "m", 0.2)])).first()
    assert (got["precision"], got["recall"], got["f1"], got["accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def test_ndcg_matches_definition(spark, rows):
    table = make(spark, rows)
    ranked = [r["label"] for r in M.top_ranked(table, 20).orderBy("rank").collect()]
    dcg = sum(y / math.log2(i + 2) for i, y in enumerate(ranked))
    best = sum(1 / math.log2(i + 2) for i in range(min(20, sum(r[2] for r in rows))))
    assert M.ndcg(table, 20).first()["ndcg_at_k"] == pytest.approx(dcg / best)


def test_bootstrap_weights_average_to_one(spark):
    u = spark.range(20000).select(M.hex_fraction(F.md5(C("id").cast("string"))).alias("u"))
    w = u.select(M.poisson_weight(C("u")).alias("w")).agg(F.avg("w").alias("m"), F.variance("w").alias("v")).first()
    assert w["m"] == pytest.approx(1.0, abs=0.05) and w["v"] == pytest.approx(1.0, abs=0.1)


def ranked(rows, model):
    import hashlib
    mine = [r for r in rows if r[3] == model]
    key = lambda r: (-(math.inf if math.isnan(r[4]) else r[4]) if r[4] is not None else math.inf,
                     not (r[4] is not None and math.isnan(r[4])), r[4] is None, hashlib.md5(r[0].encode()).hexdigest(), r[0])
    return [r[0] for r in sorted(mine, key=key)]


def awkward_scores():
    """Model a: distinct scores; b: two thirds tied; c: few rows; d: nulls, infinities and NaN; e: all tied."""
    rng = random.Random(8)
    out = [(f"a{i}", "g", i % 2, "a", rng.random()) for i in range(4000)]
    out += [(f"b{i}", "g", i % 2, "b", 0.5 if i % 3 else rng.random()) for i in range(4000)]
    out += [(f"c{i}", "g", i % 2, "c", float(i % 4)) for i in range(30)]
    special = [None, math.inf, -math.inf, math.nan, 0.25]
    out += [(f"d{i}", "g", i % 2, "d", special[i % 5]) for i in range(1000)]
    return out + [(f"e{i}", "g", i % 2, "e", 1.0) for i in range(4000)]


@pytest.mark.parametrize("k", [1, 25, 700, 5000])
def test_top_rows_equal_a_full_sort(spark, k):
    rows = awkward_scores()
    df = make(spark, rows).repartition(7)
    got = {}
    for r in M.top_ranked(df, k).collect():
        got.setdefault(r["model"], {})[r["rank"]] = r["id"]
    for model in "abcde":
        assert [got[model][i + 1] for i in range(len(got[model]))] == ranked(rows, model)[:k], model


def test_few_rows_are_sorted_beside_the_best(spark):
    rows = [r for r in awkward_scores() if r[3] in "abe"]
    n = {r["model"]: r["count"] for r in M.top_candidates(make(spark, rows).repartition(5), 100).groupBy("model").count().collect()}
    assert all(100 <= n[m] <= 400 for m in "abe"), n


def test_bootstrap_ranks_each_replicate_anew(spark):
    import hashlib
    rng = random.Random(2)
    rows = [(f"i{i}", "g", int(rng.random() < 0.3), m, round(rng.random(), 2)) for i in range(400) for m in ("x", "y")]
    labels = {}
    rows = [(i, g, labels.setdefault(i, y), m, s) for i, g, y, m, s in rows]
    k, cdf = 40, M.poisson_cdf()

    def weight(replicate, i):
        u = int(hashlib.md5(f"3:{replicate}:{i}".encode()).hexdigest()[:8], 16) / 4294967296.0
        return sum(u >= c for c in cdf)

    def precision(replicate, model):
        queue = [labels[i] for i in ranked(rows, model) for _ in range(weight(replicate, i))][:k]
        return sum(queue) / len(queue)

    got = {r["replicate"]: r["gap"] for r in M.bootstrap_precision_gaps(make(spark, rows), ("x", "y"), k, 20, 3).collect()}
    assert got == pytest.approx({b: precision(b, "x") - precision(b, "y") for b in range(1, 21)})
    whole = M.bootstrap_precision_gaps(make(spark, rows).where("id < 'i12'"), ("x", "y"), 300, 5, 3).collect()
    assert len(whole) == 5                                       # fewer rows than places: all of them are the queue

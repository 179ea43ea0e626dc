"""Forests of deep trees, grown a tree a task."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.catalog.model_cases import panel
from panelwright.operators import forests, models as L

C = F.col
WEIGHTS = (0.7, 1.9)


@pytest.fixture(scope="module")
def frame(spark, sf):
    return panel(spark, sf)


def sample(n=400, seed=3):
    rng = np.random.default_rng(seed)
    bins = np.array([2, 7, 32, 1, 5])
    binned = np.stack([rng.integers(0, b, n) for b in bins], axis=1).astype(np.uint8)
    labels = (rng.random(n) < 0.15 + 0.6 * (binned[:, 2] > 11) * (binned[:, 1] > 2)).astype(np.int64)
    return binned, labels, bins


def impurity(labels, bag):
    w = np.array([bag[labels == k].sum() * WEIGHTS[k] for k in (0, 1)])
    return w.sum() * (1 - ((w / w.sum()) ** 2).sum()) if w.sum() else 0.0


@pytest.mark.parametrize("rows, cells, gather", [(1 << 15, 1 << 16, 1 << 20), (32, 64, 10)])
def test_a_tree_takes_the_best_split_of_every_node(monkeypatch, rows, cells, gather):
    """Against a plain search over all features and cuts, whatever is worked on together."""
    for name, value in (("LEVEL_ROWS", rows), ("LEVEL_CELLS", cells), ("CACHED", gather)):
        monkeypatch.setattr(forests, name, value)
    binned, labels, bins = sample()
    bag = np.random.default_rng(8).poisson(1.0, len(labels))
    codes, votes, shares = forests.grow_tree(binned, labels, bins, WEIGHTS, 6, 5, 5, np.random.default_rng(8))     # all features
    gains = np.zeros(5)

    def walk(node, mine, level):
        here, seen = labels[mine], bag[mine]
        weight = [seen[here == k].sum() * WEIGHTS[k] for k in (0, 1)]
        assert votes[node] == pytest.approx(weight[1] / sum(weight))
        whole, best = impurity(here, seen), 0.0
        for f in range(5):
            for cut in range(bins[f] - 1):
                left = binned[mine, f] <= cut
                if min(seen[left].sum(), seen[~left].sum()) >= 5:
                    best = max(best, whole - impurity(here[left], seen[left]) - impurity(here[~left], seen[~left]))
        then, f, cut = codes[node] >> 24, (codes[node] >> 8) & 0xFFFF, codes[node] & 255
        if then == node:
            assert level == 6 or best < 1e-6
            return 1
        left = binned[mine, f] <= cut
        gain = whole - impurity(here[left], seen[left]) - impurity(here[~left], seen[~left])
        assert gain == pytest.approx(best) and min(seen[left].sum(), seen[~left].sum()) >= 5
        gains[f] += gain
        return 1 + walk(then, mine[left], level + 1) + walk(then + 1, mine[~left], level + 1)

    assert walk(0, np.arange(len(labels)), 0) == len(codes) > 9
    assert shares == pytest.approx(gains / gains.sum())


def test_votes_are_those_of_the_leaves():
    binned, labels, bins = sample(900, 5)
    codes, votes, _ = forests.grow_tree(binned, labels, bins, WEIGHTS, 30, 2, 2, np.random.default_rng(1))
    got = forests.vote(binned, codes, votes)
    for row, v in zip(binned, got):
        node = 0
        while codes[node] >> 24 != node:
            node = (codes[node] >> 24) + (row[(codes[node] >> 8) & 0xFFFF] > (codes[node] & 255))
        assert v == votes[node]


def test_rows_of_one_class_or_no_split_are_one_leaf():
    binned, labels, bins = sample()
    for own in (np.zeros_like(labels), np.ones_like(labels)):
        codes, votes, shares = forests.grow_tree(binned, own, bins, (1.0, 1.0), 30, 5, 3, np.random.default_rng(1))
        assert len(codes) == 1 and votes[0] == own[0] and not shares.any()


def test_cuts_keep_few_values_apart_and_take_quantiles_of_many(spark):
    rows = spark.range(5000).select(
        F.lit(0.0).alias("label"), (C("id") % 4999 == 0).cast("double").alias("rare"), C("id").cast("double").alias("many"),
        F.lit(2.0).alias("same"))
    vectors = L.feature_pipeline(["rare", "many", "same"], [], False).fit(rows).transform(rows)
    (rare, many, same), weights = forests.looked_at(vectors.withColumn("weight", F.lit(1.0)))
    assert weights == (1.0, 1.0)
    assert rare.tolist() == [0.5] and len(same) == 0
    assert len(many) == 31 and np.abs(many - np.arange(1, 32) * 5000 / 32).max() < 20


def test_deep_forest_is_a_few_jobs_and_scores_as_the_mean_of_its_trees(spark, frame, monkeypatch):
    """The number of jobs does not grow with trees or levels; before, it was some for each level of each group of nodes."""
    context = spark.sparkContext
    context.setJobGroup("deep-forest", "")
    try:
        fitted = L.fit(frame, L.Spec("forest", L.forest(40)))
    finally:
        jobs = len(context.statusTracker().getJobIdsForGroup("deep-forest"))
        context.setLocalProperty("spark.jobGroup.id", None)
    assert isinstance(fitted.model, forests.GrownForest) and 0 < jobs < 60
    trees = {r["tree"]: r for r in spark.read.parquet(fitted.model.path).collect()}
    assert sorted(trees) == list(range(40)) and len({bytes(t["codes"]) for t in trees.values()}) == 40
    shares = fitted.model.featureImportances.toArray()
    assert abs(shares - np.mean([t["shares"] for t in trees.values()], axis=0)).max() < 1e-9 and abs(shares.sum() - 1) < 1e-9
    monkeypatch.setattr(forests, "GROUP_BYTES", 1)              # several groups of trees and slots of rows
    got = {r[L.ID]: r["score"] for r in fitted.predict(frame, "score").collect()}
    vectors = fitted.vectors(frame).select(L.ID, L.vector_to_array("features").alias("v")).collect()
    binned = np.array([[np.searchsorted(c, x) for c, x in zip(fitted.model.cuts, r["v"])] for r in vectors], np.uint8)
    arrays = [(np.frombuffer(t["codes"], np.int64), np.frombuffer(t["votes"])) for t in trees.values()]
    want = np.mean([forests.vote(binned, *a) for a in arrays], axis=0)
    assert len(got) == len(vectors) and all(abs(got[r[L.ID]] - w) < 1e-9 for r, w in zip(vectors, want))


def test_deep_forest_ranks_as_spark_ml_does(spark, frame, monkeypatch):
    """In-sample AUC of both forests is near each other, and so are their importances."""
    from panelwright.operators.metrics import ranking_quality

    spec = L.Spec("forest", L.forest(40, 13))

    def of(fitted):
        scores = L.as_scores(fitted.predict(frame, "score", [L.CLIENT, L.LABEL]).withColumn("model", F.lit("m")), L.ID, L.CLIENT, L.LABEL)
        return ranking_quality(scores).first()["roc_auc"], fitted.model.featureImportances.toArray()

    own = L.fit(frame, spec)
    assert isinstance(own.model, forests.GrownForest)
    monkeypatch.setattr(forests, "DEEP", 30)
    spark_ml = L.fit(frame, spec)
    assert not isinstance(spark_ml.model, forests.GrownForest)
    (auc, shares), (other, others) = of(own), of(spark_ml)
    assert abs(auc - other) < 0.02 and np.abs(shares - others).max() < 0.05


def test_other_classes_and_weights_are_left_to_spark_ml(spark):
    rows = spark.range(100).select((C("id") % 3).cast("double").alias("label"), C("id").cast("double").alias("x"), F.lit(1.0).alias("weight"))
    vectors = L.feature_pipeline(["x"], [], False).fit(rows).transform(rows)
    assert forests.looked_at(vectors)[1] is None
    two = vectors.where("label < 2")
    assert forests.looked_at(two.withColumn("weight", F.when(C("label") == 1, 3.0).otherwise(0.5)))[1] == (0.5, 3.0)
    assert forests.looked_at(two.withColumn("weight", C("x") + 1))[1] is None

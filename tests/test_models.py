"""Invariants of splits and model jobs."""

import pytest
from pyspark.sql import functions as F

from panelwright.catalog import CASES, inputs as I
from panelwright.catalog.model_cases import panel
from panelwright.operators import joins as J, models as L, splits as S
from panelwright.plans.jobs import refresh_queue_job
from panelwright.sources import standins

C = F.col


@pytest.fixture(scope="module")
def frame(spark, sf):
    return panel(spark, sf)


def test_group_folds_are_disjoint_and_complete(frame):
    folds = S.group_kfold(frame, L.CLIENT, 5)
    spread = folds.groupBy(L.CLIENT).agg(F.count_distinct("fold").alias("k"))
    assert spread.where("k <> 1").count() == 0
    assert folds.count() == frame.count()


def test_group_split_has_no_overlap(frame):
    marked = S.group_shuffle_split(frame, L.CLIENT, 0.2, 1)
    overlap = J.group_overlap(marked.where("split = 'test'"), marked.where("split = 'train'"), L.CLIENT)
    assert overlap.count() == 0


def test_few_groups_fall_back_to_rows(spark):
    df = spark.range(200).select(
        C("id").cast("string").alias("id"), (C("id") % 3).cast("string").alias("g"), (C("id") % 2).cast("int").alias("y")
    )
    out = S.client_holdout(df, "g", "y", "id")
    assert {r["strategy"] for r in out.select("strategy").distinct().collect()} == {"stratified_row_holdout"}
    assert {(r["y"], r["count"]) for r in out.where("split = 'test'").groupBy("y").count().collect()} == {(0, 20), (1, 20)}


def test_out_of_fold_predictions_are_keyed_and_bounded(frame):
    specs = [L.Spec("tree", L.tree(4, 10)), L.Spec("logit", L.logistic(20))]
    preds = L.out_of_fold(S.group_kfold(frame, L.CLIENT, 3), specs, 3)
    per = preds.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(L.ID).alias("ids"), F.min("score").alias("lo"), F.max("score").alias("hi"))
    total = frame.count()
    for r in per.collect():
        assert r["n"] == r["ids"] == total and 0 <= r["lo"] <= r["hi"] <= 1


def test_unseen_category_scores_as_all_zero(frame):
    train = frame.where("content_type <> 'ECONOMY'")
    fitted = L.fit(train, L.Spec("tree", L.tree(3, 5), rare_rows=5))
    vec = fitted.vectors(frame.where("content_type = 'ECONOMY'"))
    names = fitted.feature_names(frame)
    at = [i for i, n in enumerate(names) if n.startswith("content_type")]
    arr = vec.select(L.vector_to_array("features").alias("a")).first()["a"]
    assert at and all(arr[i] == 0.0 for i in at)


def test_planted_leak_is_detected(spark, sf):
    from panelwright.catalog.model_cases import planted_leak

    row = planted_leak(spark, sf).first()
    assert row["leaked_auc"] > row["clean_auc"] + 0.15


def test_refresh_queue_is_complete(spark, sf):
    specs = [
        L.Spec(n, m, L.PAGE_NUMERIC, L.PAGE_CATEGORICAL, "is_declining_label", "content_id", True, 0, 0.0)
        for n, m in [("tree", L.tree(3, 10)), ("logit", L.logistic(20))]
    ]
    queue = refresh_queue_job(standins.page_table(spark, sf), specs)
    ranks = sorted(r["final_rank"] for r in queue.select("final_rank").collect())
    assert ranks == list(range(1, I.prepared(spark, sf).count() + 1))
    assert queue.where("final_refresh_score < 0 OR final_refresh_score > 100 OR confidence IS NULL").count() == 0


@pytest.mark.parametrize("key", ["feature_matrix", "pca_projection", "kmeans_archetypes", "feature_importance_top"])
def test_model_tables_have_rows(spark, sf, key):
    assert CASES[key].query(spark, sf).count() > 0


def test_forest_in_batches_scores_as_the_mean_of_its_trees(frame, monkeypatch):
    """Trees of a forest are not all on the driver: batches are stored, and their votes averaged per row."""
    spec = L.Spec("forest", L.forest(9, 6, 5))
    monkeypatch.setattr(L, "BATCH_NODES", 4 * L.tree_nodes(spec.make(1), frame.count()))
    fitted = L.fit(frame, spec)
    assert isinstance(fitted.model, L.StoredForest) and len(fitted.model.paths) == 3
    models = [L.RandomForestClassificationModel.load(p) for p in fitted.model.paths]
    assert [m.getNumTrees for m in models] == [4, 4, 1]
    assert len({t.toDebugString for m in models for t in m.trees}) == 9
    got = {r[L.ID]: r["score"] for r in fitted.predict(frame, "score").collect()}
    assert len(got) == frame.count()
    want = dict.fromkeys(got, 0.0)
    for m in models:
        for r in m.transform(fitted.vectors(frame)).select(L.ID, L.vector_to_array("probability")[1].alias("p")).collect():
            want[r[L.ID]] += m.getNumTrees * r["p"] / 9
    assert all(abs(got[k] - want[k]) < 1e-9 for k in got)
    shares = fitted.model.featureImportances.toArray()
    mean = sum(m.getNumTrees * m.featureImportances.toArray() for m in models) / 9
    assert abs(shares - mean).max() < 1e-9 and abs(shares.sum() - 1) < 1e-9


def test_forest_batches_are_bounded():
    deep = L.forest(300)(1)
    for rows in (100_000, 1_000_000, 7_000_000):
        batches = L.tree_batches(deep, rows)
        trees = [b.getNumTrees() for b in batches]
        assert sum(trees) == 300 and all(b.getCacheNodeIds() for b in batches)
        assert len({b.getSeed() for b in batches}) == len(batches)
        assert max(trees) * L.tree_nodes(deep, rows) <= L.BATCH_NODES or max(trees) == 1

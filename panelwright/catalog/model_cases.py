"""Splits, preprocessing and model jobs.

Model outputs depend on the learner, so a model query returns what does not: ids, folds, counts, and whether
the scores are probabilities. The jobs behind them are functions of their own, tested on their scores.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwright.catalog import inputs as I
from panelwright.catalog.base_sql import DIM, FACT, PREPARED, frame, frame_only, rnd
from panelwright.catalog.join_cases import HELD_OUT, SHUFFLED
from panelwright.catalog.metric_cases import SNAKE
from panelwright.catalog.registry import case, r6
from panelwright.operators import joins as J, metrics as M, models as L, ordering as O, splits as S
from panelwright.sources import standins, tables as T

C = F.col
ID, CLIENT, LABEL = L.ID, L.CLIENT, L.LABEL
DEV = f"WITH {frame('dev')}"


@case("group_kfold", f"{DEV}, {SNAKE.format(k=5)} SELECT content_hash_id, client_hash_id, fold FROM frame_dev JOIN folds USING (client_hash_id)")
def group_kfold(spark, sf):
    return S.group_kfold(I.frame(spark, sf), CLIENT, 5).select(ID, CLIENT, "fold")


@case("fold_sizes_check", f"{DEV}, {SNAKE.format(k=5)} SELECT fold, COUNT(*) AS n_rows, COUNT(DISTINCT client_hash_id) AS groups FROM frame_dev JOIN folds USING (client_hash_id) GROUP BY 1")
def fold_sizes_check(spark, sf):
    folds = S.group_kfold(I.frame(spark, sf), CLIENT, 5)
    return folds.groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(CLIENT).alias("groups"))


IN_TEST = "CASE WHEN client_hash_id IN (SELECT client_hash_id FROM test_groups) THEN 'test' ELSE 'train' END AS split"


@case("group_shuffle_split", f"{DEV}, {SHUFFLED} SELECT content_hash_id, {IN_TEST} FROM frame_dev")
def group_shuffle_split(spark, sf):
    return S.group_shuffle_split(I.frame(spark, sf), CLIENT, 0.2, 42).select(ID, "split")


DEALT = "ROW_NUMBER() OVER (PARTITION BY {label} ORDER BY md5('42:' || CAST({id} AS VARCHAR)), {id})"


@case(
    "client_holdout_split",
    f"""{DEV}, {SHUFFLED}, m AS (SELECT *, {IN_TEST},
      CASE WHEN {DEALT.format(label='is_position_decline', id='content_hash_id')} <= floor(COUNT(*) OVER (PARTITION BY is_position_decline) * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS row_split FROM frame_dev),
    ok AS (SELECT (SELECT COUNT(DISTINCT client_hash_id) >= 5 FROM m) AND COUNT(*) = 2 AND MIN(c) = 2 AS use FROM (SELECT split, COUNT(DISTINCT is_position_decline) AS c FROM m GROUP BY 1))
    SELECT content_hash_id, CASE WHEN use THEN split ELSE row_split END AS split, CASE WHEN use THEN 'client_holdout' ELSE 'stratified_row_holdout' END AS strategy FROM m, ok""",
)
def client_holdout_split(spark, sf):
    return S.client_holdout(I.frame(spark, sf), CLIENT, LABEL, ID).select(ID, "split", "strategy")


@case(
    "stratified_kfold",
    f"SELECT doc_id, quality, CAST(({DEALT.format(label='quality', id='doc_id')} - 1) % 5 AS INTEGER) AS fold FROM labels",
)
def stratified_kfold(spark, sf):
    labels = standins.table(spark, sf, "labels").select("doc_id", "quality")
    return S.stratified_kfold(labels, "quality", "doc_id", 5, 42)


@case(
    "stratified_split",
    f"""SELECT doc_id, quality, CASE WHEN {DEALT.format(label='quality', id='doc_id')} <= floor(COUNT(*) OVER (PARTITION BY quality) * 0.25::DOUBLE)
    THEN 'test' ELSE 'train' END AS split FROM labels""",
)
def stratified_split(spark, sf):
    labels = standins.table(spark, sf, "labels").select("doc_id", "quality")
    return S.stratified_split(labels, "quality", "doc_id", 0.25, 42)


@case(
    "class_weights",
    """SELECT doc_id, quality, ROUND(COUNT(*) OVER () / ((SELECT COUNT(DISTINCT quality) FROM labels) * COUNT(*) OVER (PARTITION BY quality))::DOUBLE + 1e-9, 6) AS weight FROM labels""",
)
def class_weights(spark, sf):
    labels = standins.table(spark, sf, "labels").select("doc_id", "quality")
    return r6(S.class_weights(labels, "quality").select("doc_id", "quality", "weight"))


LANGS = ["en", "de", "es", "fr"]


@case("onehot_counts", "SELECT doc_id, " + ", ".join(f"CAST(CASE WHEN lang = '{v}' THEN 1 ELSE 0 END AS DOUBLE) AS lang_{v}" for v in LANGS) + " FROM documents")
def onehot_counts(spark, sf):
    docs = standins.table(spark, sf, "documents").select("doc_id", "lang")
    return L.one_hot(docs, "lang", LANGS, "lang").drop("lang")


TRAIN = "tr AS (SELECT * FROM frame_dev WHERE client_hash_id NOT IN (SELECT client_hash_id FROM test_groups))"


def _train(spark, sf):
    marked = S.group_shuffle_split(I.frame(spark, sf), CLIENT, 0.2, 42)
    return marked.where("split = 'train'").drop("split")


@case(
    "rare_category_pool",
    f"""{DEV}, {SHUFFLED}, {TRAIN}, c AS (SELECT COALESCE(main_intent, 'unknown') AS main_intent, COUNT(*) AS n FROM tr GROUP BY 1)
    SELECT content_hash_id, CASE WHEN n >= 150 THEN c.main_intent WHEN n IS NOT NULL THEN 'infrequent' END AS main_intent
    FROM frame_dev f LEFT JOIN c ON COALESCE(f.main_intent, 'unknown') = c.main_intent""",
)
def rare_category_pool(spark, sf):
    return L.pool_rare(I.frame(spark, sf), _train(spark, sf), "main_intent", 150).select(ID, "main_intent")


@case(
    "impute_median",
    f"""{DEV}, {SHUFFLED}, {TRAIN} SELECT content_hash_id, {rnd(*[f'COALESCE({c}, (SELECT quantile_cont({c}, 0.5) FROM tr)) AS {c}' for c in ['f_pos_trend', 'backlinks', 'word_count']])} FROM frame_dev""",
)
def impute_median(spark, sf):
    cols = ["f_pos_trend", "backlinks", "word_count"]
    return r6(L.impute_median(I.frame(spark, sf), _train(spark, sf), cols).select(ID, *cols))


@case("impute_constant", f"{DEV} SELECT content_hash_id, COALESCE(competition_level, 'unknown') AS competition_level FROM frame_dev")
def impute_constant(spark, sf):
    return I.frame(spark, sf).na.fill("unknown", ["competition_level"]).select(ID, "competition_level")


@case(
    "standard_scale",
    f"""{DEV}, {SHUFFLED}, {TRAIN} SELECT content_hash_id, {rnd('(f_pos - (SELECT AVG(f_pos) FROM tr)) / (SELECT stddev_pop(f_pos) FROM tr) AS f_pos',
    '(f_ctr - (SELECT AVG(f_ctr) FROM tr)) / (SELECT stddev_pop(f_ctr) FROM tr) AS f_ctr')} FROM frame_dev""",
)
def standard_scale(spark, sf):
    cols = ["f_pos", "f_ctr"]
    return r6(L.standard_scale(I.frame(spark, sf), _train(spark, sf), cols).select(ID, *cols))


# ---- model jobs -------------------------------------------------------------------

# Sizes of the published models.
OOF_TREES, PAGE_TREES, LEAK_TREES = 300, 200, 100
PROBABILITY = "score BETWEEN 0 AND 1"


def panel(spark, sf, name="dev"):
    return L.with_flags(I.frame(spark, sf, name))


def panel_specs():
    return [
        L.Spec("logistic_regression", L.logistic(2000)),
        L.Spec("decision_tree", L.tree(4, 200)),
        L.Spec("random_forest", L.forest(OOF_TREES)),
    ]


def page_spec(name, make):
    return L.Spec(
        name, make, numeric=L.PAGE_NUMERIC, categorical=L.PAGE_CATEGORICAL, label="is_declining_label",
        key="content_id", balanced=True, rare_rows=0, fill=0.0,
    )


def page_specs():
    return [
        page_spec("logistic_regression", L.logistic(1000)),
        page_spec("decision_tree", L.tree(5, 50)),
        page_spec("random_forest", L.forest(PAGE_TREES, 10, 25)),
    ]


def matrix(spark, sf):
    """The fitted feature pipeline of the page models and its vectors."""
    df = I.prepared(spark, sf)
    rows = df.withColumns({c: C(c).cast("double") for c in L.PAGE_NUMERIC})
    model = L.feature_pipeline(L.PAGE_NUMERIC, L.PAGE_CATEGORICAL, impute=False).fit(rows)
    return model.transform(rows)


PLAIN_NUMERIC = [c for c in L.PAGE_NUMERIC if c != "days_with_sessions"]


@case(
    "feature_matrix",
    f"""WITH {PREPARED} SELECT content_id, {len(L.PAGE_NUMERIC)} AS n_numeric, {rnd(*PLAIN_NUMERIC)}, {', '.join(L.PAGE_CATEGORICAL)} FROM prepared""",
)
def feature_matrix(spark, sf):
    """The vectors read back by the names of their slots: every number, and the category whose slot is set."""
    vectors = matrix(spark, sf)
    groups = vectors.schema["features"].metadata["ml_attr"]["attrs"]
    names = [n for _, n in sorted((a["idx"], a["name"]) for group in groups.values() for a in group)]
    values = L.vector_to_array("features")
    slot = lambda c: [(i, n.removeprefix(f"{c}__hot_")) for i, n in enumerate(names) if n.startswith(f"{c}__hot_")]
    hot = lambda c: F.coalesce(*[F.when(C("v")[i] == 1.0, F.lit(n)) for i, n in slot(c)]).alias(c)
    return r6(vectors.select("content_id", values.alias("v")).select(
        "content_id", F.lit(sum("__hot_" not in n for n in names)).alias("n_numeric"),
        *[C("v")[names.index(c)].alias(c) for c in PLAIN_NUMERIC], *[hot(c) for c in L.PAGE_CATEGORICAL],
    ))


def held_out_scores(spark, sf, spec):
    """Fit on the training clients, score the held-out ones."""
    marked = T.materialize(
        S.client_holdout(I.prepared(spark, sf), "client_id", "is_declining_label", "content_id"),
        L.scratch_path(spark, "holdout"),
    )
    fitted = L.fit(marked.where("split = 'train'"), spec)
    return fitted.predict(marked.where("split = 'test'"), "score", ["client_id", "is_declining_label"])


PAGE_SPLIT = f"""WITH {PREPARED}, {SHUFFLED.replace('frame_dev', 'prepared').replace('client_hash_id', 'client_id')},
m AS (SELECT *, CASE WHEN client_id IN (SELECT client_id FROM test_groups) THEN 'test' ELSE 'train' END AS split,
  CASE WHEN {DEALT.format(label='is_declining_label', id='content_id')} <= floor(COUNT(*) OVER (PARTITION BY is_declining_label) * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS row_split FROM prepared),
ok AS (SELECT (SELECT COUNT(DISTINCT client_id) >= 5 FROM m) AND COUNT(*) = 2 AND MIN(c) = 2 AS use FROM (SELECT split, COUNT(DISTINCT is_declining_label) AS c FROM m GROUP BY 1))
SELECT content_id, client_id, is_declining_label, true AS is_probability FROM m, ok WHERE CASE WHEN use THEN split ELSE row_split END = 'test'"""


def _held_out(spark, sf, spec):
    scores = held_out_scores(spark, sf, spec)
    return scores.select("content_id", "client_id", "is_declining_label", F.expr(PROBABILITY).alias("is_probability"))


@case("logistic_regression", PAGE_SPLIT)
def logistic_regression(spark, sf):
    return _held_out(spark, sf, page_specs()[0])


@case("decision_tree", PAGE_SPLIT)
def decision_tree(spark, sf):
    return _held_out(spark, sf, page_specs()[1])


@case("random_forest", PAGE_SPLIT)
def random_forest(spark, sf):
    return _held_out(spark, sf, page_specs()[2])


def out_of_fold(spark, sf, specs, k=5):
    return L.out_of_fold(S.group_kfold(panel(spark, sf), CLIENT, k), specs, k, [CLIENT])


@case(
    "oof_predict",
    f"""{DEV}, {SNAKE.format(k=5)}, m AS (SELECT UNNEST(['logistic_regression', 'decision_tree', 'random_forest']) AS model)
    SELECT content_hash_id, client_hash_id, fold, model, true AS is_probability FROM frame_dev JOIN folds USING (client_hash_id), m""",
)
def oof_predict(spark, sf):
    return out_of_fold(spark, sf, panel_specs()).select(ID, CLIENT, "fold", "model", F.expr(PROBABILITY).alias("is_probability"))


def split_gap(spark, sf, specs, k=50):
    """Metrics of the same models from group folds and from stratified row folds, and their gap."""
    grouped = out_of_fold(spark, sf, specs)
    rows = L.out_of_fold(S.stratified_kfold(panel(spark, sf), LABEL, ID, 5, L.SEED), specs, 5, [CLIENT])
    table = lambda p: M.metric_comparison(T.materialize(L.as_scores(p, ID, CLIENT, LABEL), L.scratch_path(spark, "gap")), [k])
    return M.inflation_gap(table(grouped), table(rows), k)


GAP_SPECS = [L.Spec("logistic_regression", L.logistic(2000)), L.Spec("decision_tree", L.tree(4, 200))]


@case(
    "split_inflation_gap",
    "SELECT UNNEST(['logistic_regression', 'decision_tree']) AS model, true AS grouped_is_rate, true AS gaps_are_differences",
)
def split_inflation_gap(spark, sf):
    """Random-split minus grouped metrics; the values depend on the learner and are tested in pytest."""
    gap = split_gap(spark, sf, GAP_SPECS)
    difference = C("auc_gap").between(-1, 1) & C("p_at_50_gap").between(-1, 1)
    return gap.select("model", C("a_auc").between(0, 1).alias("grouped_is_rate"), difference.alias("gaps_are_differences"))


def time_forward(spark, sf, spec=None):
    """Scores of the dev-trained forest on dev and sealed rows, and of the rule on sealed rows."""
    train = panel(spark, sf).where(~C(CLIENT).isin(HELD_OUT))
    sealed = panel(spark, sf, "sealed")
    spec = spec or L.Spec("random_forest", L.forest(OOF_TREES))
    fitted = L.fit(train, spec)
    scored = T.materialize(fitted.predict(sealed, "score", [CLIENT, LABEL]), L.scratch_path(spark, "sealed-scores"))
    unseen = J.unseen_groups(scored, train, CLIENT)
    dev = out_of_fold(spark, sf, [spec]).withColumn("model", F.lit("dev, out of fold"))
    both = O.union_all([
        L.as_scores(scored.withColumn("model", F.lit("sealed, all clients")), ID, CLIENT, LABEL),
        L.as_scores(unseen.withColumn("model", F.lit("sealed, unseen clients")), ID, CLIENT, LABEL),
        L.as_scores(dev, ID, CLIENT, LABEL),
        M.score_table(I.scored(spark, sf, "sealed"), ID, CLIENT, LABEL, {"sealed, rule": "variant_score"}),
    ])
    both = T.materialize(both, L.scratch_path(spark, "time-forward"))
    return M.base_rates(both).join(M.metric_comparison(both, [50, 500, 5000]), "model")


HELD = ", ".join(f"'{c}'" for c in HELD_OUT)


@case(
    "time_forward_eval",
    f"""WITH {FACT}, {DIM}, {frame_only('dev')}, {frame_only('sealed')}, r AS (
      SELECT 'sealed, all clients' AS model, is_position_decline AS y FROM frame_sealed
      UNION ALL SELECT 'sealed, unseen clients', is_position_decline FROM frame_sealed
        WHERE client_hash_id NOT IN (SELECT client_hash_id FROM frame_dev WHERE client_hash_id NOT IN ({HELD}))
      UNION ALL SELECT 'dev, out of fold', is_position_decline FROM frame_dev
      UNION ALL SELECT 'sealed, rule', is_position_decline FROM frame_sealed)
    SELECT model, COUNT(*) AS n, CAST(SUM(y) AS BIGINT) AS positives, {rnd('AVG(y) AS base_rate')}, true AS are_rates FROM r GROUP BY 1""",
)
def time_forward_eval(spark, sf):
    rates = [C(c).between(0, 1) for c in ("roc_auc", "average_precision", "p_at_50", "p_at_500", "p_at_5000")]
    ok = rates[0]
    for r in rates[1:]:
        ok = ok & r
    return r6(time_forward(spark, sf).select("model", "n", "positives", "base_rate", ok.alias("are_rates")))


@case("fit_all_score_all", f"WITH {PREPARED} SELECT content_id, true AS are_probabilities FROM prepared")
def fit_all_score_all(spark, sf):
    scores = L.fit_all_score_all(I.prepared(spark, sf), page_specs())
    ok = F.lit(True)
    for spec in page_specs():
        ok = ok & C(f"prob_{spec.name}").between(0, 1)
    return scores.select("content_id", ok.alias("are_probabilities"))


def importances(spark, sf):
    df = panel(spark, sf)
    return L.importance(L.fit(df, L.Spec("random_forest", L.forest(PAGE_TREES))), df)


@case("feature_importance_top", "SELECT true AS has_features, true AS are_shares")
def feature_importance_top(spark, sf):
    shares = (F.min("importance") >= 0) & (F.sum("importance") <= 1 + 1e-9)
    some = F.count(F.lit(1)).between(1, 25)          # pools of rare categories decide how many there are
    return importances(spark, sf).agg(some.alias("has_features"), shares.alias("are_shares"))


def permuted(spark, sf):
    folds = T.materialize(S.group_kfold(panel(spark, sf), CLIENT, 5), L.scratch_path(spark, "perm-folds"))
    fitted = L.fit(folds.where("fold <> 0"), L.Spec("random_forest", L.forest(PAGE_TREES)))
    return L.permutation_importance(fitted, folds.where("fold = 0"), 15_000, 5, L.SEED)


@case(
    "permutation_importance",
    f"SELECT UNNEST({[*L.with_flag_names(L.PANEL_NUMERIC), *L.PANEL_CATEGORICAL]}) AS feature, true AS is_difference",
)
def permutation_importance(spark, sf):
    return permuted(spark, sf).select("feature", C("auc_lost").between(-1, 1).alias("is_difference"))


def ablation(spark, sf):
    full = L.Spec("random_forest", L.forest(OOF_TREES))
    cut = L.without(full, ["f_pos_trend", "has_f_pos_trend"], "random_forest_no_trend")
    scores = L.as_scores(out_of_fold(spark, sf, [full, cut]), ID, CLIENT, LABEL)
    return M.metric_comparison(T.materialize(scores, L.scratch_path(spark, "ablation")), [50])


@case("ablation_compare", "SELECT UNNEST(['random_forest', 'random_forest_no_trend']) AS model, true AS are_rates")
def ablation_compare(spark, sf):
    rates = C("roc_auc").between(0, 1) & C("average_precision").between(0, 1) & C("p_at_50").between(0, 1)
    return ablation(spark, sf).select("model", rates.alias("are_rates"))


def planted_leak(spark, sf):
    """AUC with and without a planted label-side column."""
    clean = L.Spec("clean", L.forest(LEAK_TREES))
    scores = L.as_scores(out_of_fold(spark, sf, [clean, L.plus(clean, ["o_pos"], "leaked")]), ID, CLIENT, LABEL)
    auc = M.ranking_quality(T.materialize(scores, L.scratch_path(spark, "leak")))
    at = lambda m: F.max(F.when(C("model") == m, C("roc_auc")))
    return auc.agg(at("clean").alias("clean_auc"), at("leaked").alias("leaked_auc"))


@case("leak_positive_control", "SELECT true AS detected")
def leak_positive_control(spark, sf):
    """The planted column must lift the AUC by 0.15; otherwise the harness is blind."""
    return planted_leak(spark, sf).select((C("leaked_auc") > C("clean_auc") + 0.15).alias("detected"))


SHAPE = ["f_pos", "f_pos_trend", "f_pos_volatility", "f_ctr"]


def archetype_profiles(spark, sf):
    clustered = L.kmeans(L.scaled_vectors(I.frame(spark, sf), SHAPE), 4)
    return clustered.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("pages"), F.avg(LABEL).alias("decline_rate"), *[F.avg(c).alias(f"mean_{c}") for c in SHAPE]
    )


@case("kmeans_archetypes", f"{DEV} SELECT 4::BIGINT AS clusters, COUNT(*) AS pages, {rnd('AVG(is_position_decline) AS decline_rate')} FROM frame_dev")
def kmeans_archetypes(spark, sf):
    profile = archetype_profiles(spark, sf)
    rate = F.sum(C("decline_rate") * C("pages")) / F.sum("pages")
    return r6(profile.agg(F.count(F.lit(1)).alias("clusters"), F.sum("pages").alias("pages"), rate.alias("decline_rate")))


def projection(spark, sf):
    vectors = L.array_vectors(standins.table(spark, sf, "embeddings"), "embedding")
    return L.project(vectors, 2).select("vec_id", "label", "pc1", "pc2")


@case("pca_projection", "SELECT vec_id, label, true AS is_within FROM embeddings")
def pca_projection(spark, sf):
    """A projection is never longer than its vector; components are known up to their sign."""
    norms = standins.table(spark, sf, "embeddings").select(
        "vec_id", F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x).alias("norm"))
    length = C("pc1") * C("pc1") + C("pc2") * C("pc2")
    return projection(spark, sf).join(norms, "vec_id").select("vec_id", "label", (length <= C("norm") + 1e-6).alias("is_within"))


def silhouettes(spark, sf):
    return L.silhouettes(L.array_vectors(standins.table(spark, sf, "embeddings"), "embedding"), [2, 4, 6, 8, 10])


@case("silhouette_by_k", "SELECT UNNEST([2, 4, 6, 8, 10])::INTEGER AS k, true AS is_silhouette")
def silhouette_by_k(spark, sf):
    return silhouettes(spark, sf).select("k", C("silhouette").between(-1, 1).alias("is_silhouette"))

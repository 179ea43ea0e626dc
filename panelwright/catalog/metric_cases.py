"""Ranking and classification metrics, audits and monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwright.catalog import inputs as I
from panelwright.catalog.base_sql import FINAL, both_scored, dev_scored, frame, rnd
from panelwright.catalog.rank_cases import CAPPED, DECILE, TIE
from panelwright.catalog.registry import case, r6
from panelwright.functions import rules
from panelwright.operators import audit as A, metrics as M, models as L, ordering as O, splits as S
from panelwright.operators.lineage import origins
from panelwright.plans import scoring

C = F.col
ID, CLIENT, LABEL = "content_hash_id", "client_hash_id", "is_position_decline"

LONG = """st AS (SELECT content_hash_id AS id, client_hash_id AS grp, is_position_decline AS label, 'frozen_rule' AS model, baseline_score AS score FROM scored
  UNION ALL SELECT content_hash_id, client_hash_id, is_position_decline, 'variant_rule', variant_score FROM scored)"""
RISK_LONG = "st AS (SELECT content_hash_id AS id, client_hash_id AS grp, is_position_decline AS label, 'risk' AS model, risk AS score FROM scored)"


def quality_sql(by: str, src: str = "st") -> str:
    """Rank AUC and step-wise AP by plain windows over distinct scores."""
    return f"""pt AS (SELECT {by}, score, SUM(label) AS pos, COUNT(*) - SUM(label) AS neg FROM {src} GROUP BY {by}, score),
cu AS (SELECT *, SUM(pos) OVER w AS cp, SUM(neg) OVER w AS cn FROM pt WINDOW w AS (PARTITION BY {by} ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
qual AS (SELECT {by}, CAST(SUM(pos) AS BIGINT) AS positives, CAST(SUM(neg) AS BIGINT) AS negatives,
  CASE WHEN SUM(pos) > 0 AND SUM(neg) > 0 THEN 1 - SUM(pos * (cn - neg / 2.0::DOUBLE)) / (SUM(pos)::DOUBLE * SUM(neg)) END AS roc_auc,
  CASE WHEN SUM(pos) > 0 AND SUM(neg) > 0 THEN SUM(pos * cp::DOUBLE / (cp + cn)) / SUM(pos) END AS average_precision FROM cu GROUP BY {by})"""


def rank_sql(ks) -> str:
    return f"""rk AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY model ORDER BY score DESC, md5(id), id) AS r FROM st),
ks AS (SELECT UNNEST({list(ks)})::INTEGER AS k), b AS (SELECT model, COUNT(*) AS n, SUM(label) AS pos, AVG(label) AS base FROM st GROUP BY 1),
pk AS (SELECT model, k, COUNT(*) AS taken, CAST(SUM(label) AS BIGINT) AS hits, AVG(label) AS p FROM rk, ks WHERE r <= k GROUP BY 1, 2)"""


DEV_LONG = f"{dev_scored()}, {LONG}"
DEV_RISK = f"{dev_scored()}, {RISK_LONG}"


@case("precision_at_k", f"{DEV_LONG}, {rank_sql(I.KS)} SELECT model, k, taken, {rnd('p AS precision_at_k')} FROM pk")
def precision_at_k(spark, sf):
    return r6(M.precision_curve(I.scores(spark, sf), I.KS).select("model", "k", "taken", "precision_at_k"))


@case("lift_at_k", f"{DEV_LONG}, {rank_sql(I.KS)} SELECT model, k, {rnd('p / base AS lift_at_k')} FROM pk JOIN b USING (model)")
def lift_at_k(spark, sf):
    return r6(M.precision_curve(I.scores(spark, sf), I.KS).select("model", "k", "lift_at_k"))


@case("recall_at_k", f"{DEV_LONG}, {rank_sql(I.KS)} SELECT model, k, {rnd('hits::DOUBLE / pos AS recall_at_k')} FROM pk JOIN b USING (model)")
def recall_at_k(spark, sf):
    return r6(M.precision_curve(I.scores(spark, sf), I.KS).select("model", "k", "recall_at_k"))


@case("base_rate", f"{DEV_LONG} SELECT model, COUNT(*) AS n, CAST(SUM(label) AS BIGINT) AS positives, {rnd('AVG(label) AS base_rate')} FROM st GROUP BY 1")
def base_rate(spark, sf):
    return r6(M.base_rates(I.scores(spark, sf)))


@case("roc_auc", f"{DEV_LONG}, {quality_sql('model')} SELECT model, positives, negatives, {rnd('roc_auc')} FROM qual")
def roc_auc(spark, sf):
    return r6(M.ranking_quality(I.scores(spark, sf)).select("model", "positives", "negatives", "roc_auc"))


@case("average_precision", f"{DEV_LONG}, {quality_sql('model')} SELECT model, {rnd('average_precision')} FROM qual")
def average_precision(spark, sf):
    return r6(M.ranking_quality(I.scores(spark, sf)).select("model", "average_precision"))


CONF = """cm AS (SELECT COUNT(*) FILTER (WHERE score >= 0.5 AND label = 1) AS tp, COUNT(*) FILTER (WHERE score >= 0.5 AND label = 0) AS fp,
  COUNT(*) FILTER (WHERE score < 0.5 AND label = 1) AS fn, COUNT(*) FILTER (WHERE score < 0.5 AND label = 0) AS tn FROM st)"""


@case(
    "threshold_metrics",
    f"""{DEV_RISK}, {CONF} SELECT 'risk' AS model, tp, fp, fn, tn, {rnd('(tp + tn)::DOUBLE / (tp + fp + fn + tn) AS accuracy',
    'COALESCE(tp::DOUBLE / NULLIF(tp + fp, 0), 0) AS precision', 'COALESCE(tp::DOUBLE / NULLIF(tp + fn, 0), 0) AS recall',
    'COALESCE(2.0::DOUBLE * tp / NULLIF(2 * tp + fp + fn, 0), 0) AS f1')} FROM cm""",
)
def threshold_metrics(spark, sf):
    return r6(M.threshold_metrics(I.risk_scores(spark, sf)))


@case(
    "classification_report",
    f"""{DEV_RISK}, {CONF}, per AS (SELECT '1' AS class, tp AS t, fp AS p, fn AS n FROM cm UNION ALL SELECT '0', tn, fn, fp FROM cm),
    m AS (SELECT class, COALESCE(t::DOUBLE / NULLIF(t + p, 0), 0) AS precision, COALESCE(t::DOUBLE / NULLIF(t + n, 0), 0) AS recall,
      COALESCE(2.0::DOUBLE * t / NULLIF(2 * t + p + n, 0), 0) AS f1, t + n AS support FROM per),
    a AS (SELECT * FROM m UNION ALL SELECT 'macro avg', AVG(precision), AVG(recall), AVG(f1), CAST(SUM(support) AS BIGINT) FROM m
      UNION ALL SELECT 'weighted avg', SUM(precision * support) / SUM(support), SUM(recall * support) / SUM(support),
        SUM(f1 * support) / SUM(support), CAST(SUM(support) AS BIGINT) FROM m)
    SELECT 'risk' AS model, class, {rnd('precision', 'recall', 'f1')}, support FROM a""",
)
def classification_report(spark, sf):
    return r6(M.classification_report(I.risk_scores(spark, sf)))


CMP_KS = [50, 100, 500, 1000, 5000]


@case(
    "metric_comparison",
    f"""{DEV_LONG}, {quality_sql('model')}, {rank_sql(CMP_KS)}, d AS (SELECT model, COUNT(DISTINCT ROUND(score, 6)) AS distinct_scores FROM st GROUP BY 1),
    w AS (SELECT model, {', '.join(f'MAX(p) FILTER (WHERE k = {k}) AS p_at_{k}' for k in CMP_KS)} FROM pk GROUP BY 1)
    SELECT model, {rnd('roc_auc', 'average_precision', *[f'p_at_{k}' for k in CMP_KS])}, distinct_scores FROM qual JOIN w USING (model) JOIN d USING (model)""",
)
def metric_comparison(spark, sf):
    return r6(M.metric_comparison(I.scores(spark, sf), CMP_KS))


RANDOM_LONG = """st AS (SELECT content_hash_id AS id, client_hash_id AS grp, is_position_decline AS label, 'random' AS model,
  CAST('0x' || substr(md5('42:' || content_hash_id), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS score FROM frame_dev)"""


@case(
    "random_order_baseline",
    f"WITH {frame('dev')}, {RANDOM_LONG}, {quality_sql('model')}, {rank_sql([50])} SELECT model, {rnd('roc_auc', 'p AS p_at_50')} FROM qual JOIN pk USING (model)",
)
def random_order_baseline(spark, sf):
    df = M.with_random_score(I.frame(spark, sf), ID, 42)
    scores = M.score_table(df, ID, CLIENT, LABEL, {"random": "random_score"})
    return r6(M.metric_comparison(scores, [50]).select("model", "roc_auc", "p_at_50"))


@case(
    "calibration_deciles",
    f"""{dev_scored()}, {DECILE} SELECT decile, COUNT(*) AS n, {rnd('AVG(risk) AS mean_predicted', 'AVG(is_position_decline) AS actual',
    'AVG(risk) - AVG(is_position_decline) AS error')} FROM binned GROUP BY 1""",
)
def calibration_deciles(spark, sf):
    return r6(M.calibration(I.scored(spark, sf), "risk", LABEL, 10))


PER = f"""g AS (SELECT grp, COUNT(*) AS pages, AVG(label) AS decline_rate FROM st GROUP BY 1 HAVING COUNT(*) >= {I.CLIENT_FLOOR} AND MIN(label) < MAX(label))"""


@case("per_group_auc", f"{DEV_RISK}, {PER}, {quality_sql('grp')} SELECT grp, pages, {rnd('decline_rate', 'roc_auc AS auc')} FROM g JOIN qual USING (grp)")
def per_group_auc(spark, sf):
    return r6(M.per_group_quality(I.risk_scores(spark, sf), I.CLIENT_FLOOR))


@case(
    "abstain_gate",
    f"""{DEV_RISK}, {PER}, {quality_sql('grp')} SELECT gate, COUNT(*) AS clients, CAST(SUM(pages) AS BIGINT) AS pages FROM (
      SELECT pages, CASE WHEN roc_auc >= 0.60::DOUBLE THEN 'serve' ELSE 'ABSTAIN' END AS gate FROM g JOIN qual USING (grp)) GROUP BY 1""",
)
def abstain_gate(spark, sf):
    gated = M.abstain_gate(M.per_group_quality(I.risk_scores(spark, sf), I.CLIENT_FLOOR))
    return gated.groupBy("gate").agg(F.count(F.lit(1)).alias("clients"), F.sum("pages").alias("pages"))


@case(
    "topk_concentration",
    f"""{dev_scored()}, t AS (SELECT client_hash_id, COUNT(*) AS c FROM (SELECT * FROM scored ORDER BY risk DESC, {TIE} LIMIT 50) GROUP BY 1)
    SELECT CAST(SUM(c) AS BIGINT) AS taken, {rnd('MAX(c) / SUM(c) AS largest_share')}, COUNT(*) AS groups FROM t""",
)
def topk_concentration(spark, sf):
    return r6(M.top_concentration(I.scored(spark, sf), "risk", ID, CLIENT, 50))


@case(
    "failure_mode_sizes",
    f"""{dev_scored()} SELECT COUNT(*) FILTER (WHERE risk >= 0.75) AS flagged, COUNT(*) FILTER (WHERE risk >= 0.75 AND is_position_decline = 0) AS flagged_held,
    {rnd('AVG(1 - is_position_decline) FILTER (WHERE risk >= 0.75) AS flagged_held_rate')},
    COUNT(*) FILTER (WHERE risk < 0.45) AS dismissed, COUNT(*) FILTER (WHERE risk < 0.45 AND is_position_decline = 1) AS dismissed_declined,
    {rnd('AVG(is_position_decline) FILTER (WHERE risk < 0.45) AS dismissed_declined_rate')} FROM scored""",
)
def failure_mode_sizes(spark, sf):
    return r6(A.failure_modes(I.scored(spark, sf), "risk", LABEL))


@case(
    "queue_value",
    f"""{dev_scored()}, {CAPPED}, q AS (SELECT COUNT(*) AS depth, CAST(SUM(is_position_decline) AS BIGINT) AS hits,
      CAST(SUM(CASE WHEN is_position_decline = 1 THEN f_impressions ELSE 0 END) AS BIGINT) AS impressions_at_risk FROM capped),
    b AS (SELECT AVG(is_position_decline) AS base FROM scored)
    SELECT depth, {rnd('depth * 20 / 60 AS hours')}, hits, {rnd('depth * base AS hits_random', 'hits / (depth * 20 / 60) AS hits_per_hour',
    'depth * base / (depth * 20 / 60) AS hits_per_hour_random')}, impressions_at_risk FROM q, b""",
)
def queue_value(spark, sf):
    df = I.scored(spark, sf)
    return r6(A.queue_value(scoring.capped_queue(df, "risk"), df, LABEL, "f_impressions"))


POLICY_KS = [50, 200, 1000, 5000]


@case(
    "order_policy_compare",
    f"""{dev_scored()}, st AS (SELECT content_hash_id AS id, is_position_decline AS label, 'oldest_first' AS model, days_since_update::DOUBLE AS score
      FROM scored WHERE days_since_update IS NOT NULL
      UNION ALL SELECT content_hash_id, is_position_decline, 'risk_first', risk FROM scored), {rank_sql(POLICY_KS)}
    SELECT model, k, {rnd('p AS precision_at_k')} FROM pk""",
)
def order_policy_compare(spark, sf):
    df = I.scored(spark, sf)
    scores = M.score_table(df, ID, CLIENT, LABEL, {"oldest_first": "days_since_update", "risk_first": "risk"})
    return r6(M.precision_curve(scores.where("score IS NOT NULL"), POLICY_KS).select("model", "k", "precision_at_k"))


@case(
    "best_model_select",
    f"""{DEV_LONG}, {quality_sql('model')}, {rank_sql([50])} SELECT model AS best_model FROM qual JOIN pk USING (model)
    ORDER BY p DESC, average_precision DESC, roc_auc DESC LIMIT 1""",
)
def best_model_select(spark, sf):
    return M.best_model(M.metric_comparison(I.scores(spark, sf), [50]), ["p_at_50", "average_precision", "roc_auc"])


CUTS = [0.2, 0.4, 0.6, 0.8, 1.01]


@case(
    "threshold_sweep",
    f"""{DEV_RISK}, c AS (SELECT UNNEST({CUTS})::DOUBLE AS cutoff), b AS (SELECT SUM(label) AS pos FROM st)
    SELECT 'risk' AS model, cutoff, COUNT(id) AS captured, {rnd('AVG(label) AS precision', 'COALESCE(SUM(label), 0) / MIN(pos) AS recall')}
    FROM b, c LEFT JOIN st ON score >= cutoff GROUP BY 2""",
)
def threshold_sweep(spark, sf):
    return r6(M.threshold_sweep(I.risk_scores(spark, sf), CUTS))


BOOT, BOOT_K = 1000, 500
UNIFORM = "CAST('0x' || substr(md5('7:' || rep || ':' || id), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE"
WEIGHT = " + ".join(f"(u >= {c!r}::DOUBLE)::INT" for c in M.poisson_cdf())


@case(
    "bootstrap_metric_ci",
    f"""{DEV_LONG}, {rank_sql([BOOT_K])}, ids AS (SELECT DISTINCT id FROM st),
    u AS (SELECT id, rep, {UNIFORM} AS u FROM ids, (SELECT UNNEST(range(1, {BOOT + 1})) AS rep)),
    w AS (SELECT id, rep, {WEIGHT} AS w FROM u),
    q AS (SELECT model, rep, label, w, COALESCE(SUM(w) OVER (PARTITION BY model, rep ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM rk JOIN w USING (id)),
    p AS (SELECT model, rep, SUM(label * least(w, {BOOT_K} - before))::DOUBLE / NULLIF(SUM(least(w, {BOOT_K} - before)), 0) AS p
      FROM q WHERE before < {BOOT_K} GROUP BY 1, 2),
    d AS (SELECT rep, MAX(p) FILTER (WHERE model = 'frozen_rule') - MAX(p) FILTER (WHERE model = 'variant_rule') AS gap FROM p GROUP BY 1)
    SELECT COUNT(*) AS replicates, {rnd('AVG(gap) AS mean_gap', 'quantile_cont(gap, 0.025) AS low', 'quantile_cont(gap, 0.975) AS high')} FROM d""",
)
def bootstrap_metric_ci(spark, sf):
    return r6(M.bootstrap_metric_ci(I.scores(spark, sf), ("frozen_rule", "variant_rule"), BOOT_K, BOOT))


@case(
    "ndcg_at_k",
    f"""{DEV_LONG}, {rank_sql([100])}, got AS (SELECT model, SUM(label / log2(r + 1)) AS dcg FROM rk WHERE r <= 100 GROUP BY 1),
    best AS (SELECT model, SUM(label / log2(i + 1)) AS idcg FROM (SELECT model, label, ROW_NUMBER() OVER (PARTITION BY model ORDER BY label DESC) AS i FROM st)
      WHERE i <= 100 GROUP BY 1)
    SELECT model, 100 AS k, {rnd('dcg / idcg AS ndcg_at_k')} FROM got JOIN best USING (model)""",
)
def ndcg_at_k(spark, sf):
    return r6(M.ndcg(I.scores(spark, sf), 100))


@case(
    "majority_baseline",
    f"WITH {frame('dev')} SELECT CAST(CASE WHEN AVG(is_position_decline) > 0.5 THEN 1 ELSE 0 END AS INTEGER) AS majority_class, {rnd('GREATEST(AVG(is_position_decline), 1 - AVG(is_position_decline)) AS accuracy')} FROM frame_dev",
)
def majority_baseline(spark, sf):
    return r6(M.majority_baseline(I.frame(spark, sf), LABEL))


# ---- audits and monitoring -----------------------------------------------------

SNAKE = """sz AS (SELECT client_hash_id, COUNT(*) AS n FROM frame_dev GROUP BY 1),
ro AS (SELECT client_hash_id, ROW_NUMBER() OVER (ORDER BY n DESC, md5(client_hash_id), client_hash_id) - 1 AS i FROM sz),
folds AS (SELECT client_hash_id, CAST(CASE WHEN i % (2 * {k}) < {k} THEN i % (2 * {k}) ELSE 2 * {k} - 1 - i % (2 * {k}) END AS INTEGER) AS fold FROM ro)"""


@case(
    "leakage_audit",
    f"""WITH {frame('dev')}, {SNAKE.format(k=5)} SELECT 'feature days precede outcome days' AS check, a < b AS ok, CAST(a AS VARCHAR) || ' < ' || CAST(b AS VARCHAR) AS detail
      FROM (SELECT MAX(report_date) FILTER (WHERE year IN ('1997','1998','1999')) AS a, MIN(report_date) FILTER (WHERE year = '2000') AS b FROM fact)
    UNION ALL SELECT 'each client in one fold', COUNT(*) = 0, CAST(COUNT(*) AS VARCHAR) FROM (
      SELECT client_hash_id FROM frame_dev JOIN folds USING (client_hash_id) GROUP BY 1 HAVING COUNT(DISTINCT fold) > 1)
    UNION ALL SELECT 'base rate known', TRUE, printf('%.4f', ROUND(AVG(is_position_decline), 4)) FROM frame_dev
    UNION ALL SELECT 'future-dated column kept out', TRUE, CAST(COUNT(*) FILTER (WHERE days_since_update < 0) AS VARCHAR) FROM frame_dev
    UNION ALL SELECT * FROM (VALUES ('label columns kept apart', TRUE, 'overlap=none'), ('decision flags kept apart', TRUE, 'overlap=none'),
      ('identifiers kept apart', TRUE, 'overlap=none'), ('late-dated columns kept apart', TRUE, 'overlap=none'),
      ('query table not read', TRUE, 'read=none'))
    UNION ALL SELECT 'feature values from feature periods only', COUNT(*) = 3, string_agg(year, ',' ORDER BY year) FROM (SELECT DISTINCT year FROM fact WHERE year IN ('1997','1998','1999'))
    UNION ALL SELECT 'scores out of fold', COUNT(*) > 0, CAST(COUNT(*) - COUNT(fold) AS VARCHAR) FROM frame_dev JOIN folds USING (client_hash_id)""",
)
def leakage_audit(spark, sf):
    from panelwright.operators.models import PANEL_CATEGORICAL, PANEL_NUMERIC

    features = [*PANEL_NUMERIC, *PANEL_CATEGORICAL]
    split, df = I.split_of("dev"), I.frame(spark, sf)
    made = origins(I.build_frame(spark, sf), split.period, [*split.feature_periods, split.outcome_period], ["l_shipdate"])
    folds = S.group_kfold(L.with_flags(df), CLIENT, 5)
    scores = L.out_of_fold(folds, [L.Spec("decision_tree", L.tree(4, 200))], 5, [CLIENT])
    return O.union_all([
        A.name_checks(spark, features),
        A.plan_checks(spark, [
            A.period_origin(made, features, A.LABEL_SIDE, split),
            A.unread_sources(made, features, ["lineitem.l_suppkey"]),      # the stand-in's search queries
        ]),
        A.out_of_fold_row(scores, folds, "content_hash_id"),
        A.windows_disjoint(I.fact(spark, sf, split), split),
        A.no_crossover(S.group_kfold(df, CLIENT, 5), CLIENT),
        A.base_rate_row(df, LABEL),
        A.future_dated_row(df, "days_since_update", features),
    ])


@case(
    "drift_triggers",
    f"""{both_scored()}, {CAPPED.replace('FROM scored', 'FROM sealed')}, f AS (SELECT (SELECT AVG(is_position_decline) FROM sealed) AS br, (SELECT AVG(is_position_decline) FROM capped) AS p,
      (SELECT median(f_pos) FROM dev) AS p0, (SELECT median(f_pos) FROM sealed) AS p1, (SELECT median(f_pos_volatility) FROM dev) AS v0,
      (SELECT median(f_pos_volatility) FROM sealed) AS v1),
    t AS (SELECT 'base_rate' AS trigger, br AS value, br BETWEEN 0.45::DOUBLE AND 0.65::DOUBLE AS ok FROM f
      UNION ALL SELECT 'queue_precision', p, p >= 0.65::DOUBLE FROM f UNION ALL SELECT 'median_f_pos_drift', (p1 - p0) / p0, abs((p1 - p0) / p0) < 0.25::DOUBLE FROM f
      UNION ALL SELECT 'median_f_pos_volatility_drift', (v1 - v0) / v0, abs((v1 - v0) / v0) < 0.25::DOUBLE FROM f)
    SELECT trigger, {rnd('value')}, ok FROM t""",
)
def drift_triggers(spark, sf):
    dev, sealed = I.scored(spark, sf), I.scored(spark, sf, "sealed")
    queue = scoring.capped_queue(sealed, "risk")
    return r6(A.drift_triggers(dev, sealed, queue, LABEL, ["f_pos", "f_pos_volatility"]))


@case(
    "score_band_profile",
    f"""{dev_scored()} SELECT CASE WHEN risk <= 0.55::DOUBLE THEN 'low' WHEN risk <= 0.75::DOUBLE THEN 'medium' ELSE 'high' END AS confidence, COUNT(*) AS pages,
    {rnd('AVG(risk) AS mean_risk', 'AVG(is_position_decline) AS observed_rate')} FROM scored GROUP BY 1""",
)
def score_band_profile(spark, sf):
    banded = I.scored(spark, sf).withColumn("confidence", rules.risk_band())
    return r6(A.band_profile(banded, "confidence", "risk", LABEL))


CHARTS = {"action_mix": "suggested_action", "confidence_mix": "confidence", "trend_distribution": "trend_direction"}


@case(
    "chart_tables",
    f"WITH {FINAL} " + " UNION ALL ".join(
        f"SELECT '{chart}' AS chart, {c} AS value, COUNT(*) AS n, {rnd('AVG(is_declining_label) AS rate')} FROM final GROUP BY 2"
        for chart, c in CHARTS.items()
    ),
)
def chart_tables(spark, sf):
    return r6(A.mix_tables(I.final(spark, sf), CHARTS, "is_declining_label"))

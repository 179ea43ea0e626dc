"""Window functions, top-k and rule scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwright.catalog import inputs as I
from panelwright.catalog.base_sql import BASELINE, FINAL, POS_TIER, PREPARED, avg_rank, dev_scored, frame, rnd
from panelwright.catalog.registry import case, r6
from panelwright.operators import metrics as M, ordering as O
from panelwright.plans import scoring
from panelwright.sources import standins

C = F.col
ID = "content_hash_id"
DEV = f"WITH {frame('dev')}"
PREP = f"WITH {PREPARED}"
TIE = "md5(content_hash_id), content_hash_id"


@case(
    "percentile_rank_avg",
    f"SELECT l_orderkey, l_linenumber, l_quantity, {rnd(avg_rank('l_quantity') + ' AS pct_rank')} FROM lineitem",
)
def percentile_rank_avg(spark, sf):
    li = standins.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return r6(O.percentile_rank_avg(li, "l_quantity", "pct_rank"))


@case(
    "minmax_normalize",
    """SELECT o_orderkey, ROUND((o_totalprice - MIN(o_totalprice) OVER ()) / (MAX(o_totalprice) OVER () - MIN(o_totalprice) OVER ()) + 1e-9, 6) AS scaled,
    ROUND(0.0::DOUBLE + 1e-9, 6) AS flat FROM orders""",
)
def minmax_normalize(spark, sf):
    orders = standins.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.lit(7.0).alias("seven"))
    scaled = O.minmax_normalize(O.minmax_normalize(orders, "o_totalprice", "scaled"), "seven", "flat")
    return r6(scaled.select("o_orderkey", "scaled", "flat"))


@case(
    "rank_first_desc",
    f"""WITH {BASELINE} SELECT content_id, ROW_NUMBER() OVER (ORDER BY ROUND(baseline_refresh_score, 9) DESC, md5(content_id), content_id) AS baseline_rank
    FROM baseline""",
)
def rank_first_desc(spark, sf):
    rounded = I.baseline(spark, sf).select("content_id", F.round("baseline_refresh_score", 9).alias("baseline_refresh_score"))
    return scoring.baseline_queue(rounded).select("content_id", "baseline_rank")


@case(
    "final_rank",
    f"""WITH {FINAL} SELECT content_id, ROW_NUMBER() OVER (ORDER BY ROUND(final_refresh_score, 9) DESC, impressions_90d DESC, sessions_90d DESC,
    md5(content_id), content_id) AS final_rank FROM final""",
)
def final_rank(spark, sf):
    queue = I.final(spark, sf).withColumn("final_refresh_score", F.round("final_refresh_score", 9))
    return scoring.ranked_final_queue(queue).select("content_id", "final_rank")


@case(
    "group_median_transform",
    f"""{DEV}, m AS (SELECT client_hash_id, median(f_pos) AS med FROM frame_dev GROUP BY 1)
    SELECT content_hash_id, {rnd('f_pos / med AS pos_vs_median')}, f_pos >= med AS above FROM frame_dev JOIN m USING (client_hash_id)""",
)
def group_median_transform(spark, sf):
    df = O.attach_group_median(I.frame(spark, sf), "client_hash_id", {"med": "f_pos"})
    return r6(df.select(ID, (C("f_pos") / C("med")).alias("pos_vs_median"), (C("f_pos") >= C("med")).alias("above")))


@case(
    "client_relative_features",
    f"""{DEV}, m AS (SELECT client_hash_id, median(f_pos) AS mp, median(COALESCE(f_pos_trend, 0)) AS mt, median(ln(1 + f_impressions)) AS mi FROM frame_dev GROUP BY 1)
    SELECT content_hash_id, {rnd('f_pos - mp AS cr_pos', 'COALESCE(f_pos_trend, 0) - mt AS cr_trend', 'ln(1 + f_impressions) - mi AS cr_imps')}
    FROM frame_dev JOIN m USING (client_hash_id)""",
)
def client_relative_features(spark, sf):
    return r6(scoring.client_relative(I.frame(spark, sf)).select(ID, "cr_pos", "cr_trend", "cr_imps"))


@case(
    "above_global_median",
    f"{DEV} SELECT content_hash_id, COALESCE(f_pos_volatility, 0) >= (SELECT median(f_pos_volatility) FROM frame_dev) AS unstable FROM frame_dev",
)
def above_global_median(spark, sf):
    df = scoring.with_volatility_median(I.frame(spark, sf))
    return df.select(ID, (F.coalesce("f_pos_volatility", F.lit(0.0)) >= C("volatility_median")).alias("unstable"))


EDGES = ", ".join(f"quantile_cont(risk, {i / 10})" for i in range(0, 11))
DECILE = f"""e AS (SELECT DISTINCT UNNEST([{EDGES}]) AS edge FROM scored),
binned AS (SELECT s.content_hash_id, s.is_position_decline, s.risk, CAST(GREATEST(COUNT(edge) - 1, 0) AS INTEGER) AS decile
  FROM scored s LEFT JOIN e ON edge < s.risk GROUP BY ALL)"""


@case("quantile_deciles", f"{dev_scored()}, {DECILE} SELECT content_hash_id, decile FROM binned")
def quantile_deciles(spark, sf):
    return O.quantile_bins(I.scored(spark, sf), "risk", 10, "decile").select(ID, "decile")


CAPPED = f"""capped AS (SELECT *, ROW_NUMBER() OVER (ORDER BY risk DESC, {TIE}) AS rank FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY client_hash_id ORDER BY risk DESC, {TIE}) AS g FROM scored) WHERE g <= 5
  ORDER BY risk DESC, {TIE} LIMIT 50)"""


@case("capped_topn_per_group", f"{dev_scored()}, {CAPPED} SELECT rank, content_hash_id, client_hash_id, {rnd('risk')} FROM capped")
def capped_topn_per_group(spark, sf):
    return r6(scoring.capped_queue(I.scored(spark, sf), "risk").select("rank", ID, "client_hash_id", "risk"))


@case(
    "cumulative_share",
    f"""{dev_scored()}, t AS (SELECT * FROM scored ORDER BY risk DESC, {TIE} LIMIT 200),
    c AS (SELECT client_hash_id, COUNT(*) AS n FROM t GROUP BY 1)
    SELECT client_hash_id, n, ROUND(SUM(n) OVER (ORDER BY n DESC, client_hash_id ROWS UNBOUNDED PRECEDING) / SUM(n) OVER () + 1e-9, 6) AS cum_share FROM c""",
)
def cumulative_share(spark, sf):
    return r6(scoring.cumulative_client_share(I.scored(spark, sf), "risk", 200))


PRECISION = lambda ks, src="scored", score="baseline_score": f"""rk AS (SELECT is_position_decline AS y, ROW_NUMBER() OVER (ORDER BY {score} DESC, {TIE}) AS r FROM {src}),
ks AS (SELECT UNNEST({list(ks)})::INTEGER AS k), b AS (SELECT AVG(y) AS base, SUM(y) AS pos FROM rk),
pc AS (SELECT k, COUNT(*) AS taken, SUM(y)::BIGINT AS hits, AVG(y) AS p FROM rk, ks WHERE r <= k GROUP BY k)"""


@case(
    "precision_curve",
    f"{dev_scored()}, {PRECISION(I.KS)} SELECT k, taken, hits, {rnd('p AS precision_at_k', 'p / base AS lift_at_k')} FROM pc, b",
)
def precision_curve(spark, sf):
    scores = I.scores(spark, sf).where("model = 'frozen_rule'")
    return r6(M.precision_curve(scores, I.KS).select("k", "taken", "hits", "precision_at_k", "lift_at_k"))


# ---- top-k ------------------------------------------------------------------

@case("topk_by_score", f"{dev_scored()} SELECT content_hash_id, {rnd('baseline_score')} FROM scored ORDER BY baseline_score DESC, {TIE} LIMIT 20")
def topk_by_score(spark, sf):
    return r6(O.top_k(I.scored(spark, sf), [("baseline_score", True)], ID, 20).select(ID, "baseline_score"))


@case("bottomk_by_score", f"{dev_scored()} SELECT content_hash_id, {rnd('baseline_score')} FROM scored ORDER BY baseline_score, {TIE} LIMIT 20")
def bottomk_by_score(spark, sf):
    return r6(O.top_k(I.scored(spark, sf), [("baseline_score", False)], ID, 20).select(ID, "baseline_score"))


CLIENT_SQL = "SELECT n_name, CASE WHEN n_nationkey % 5 <> 0 THEN DATE '1998-01-01' + n_nationkey * 40 END AS gsc_data_start FROM nation"


@case("order_nulls_last", f"SELECT n_name AS client_hash_id, gsc_data_start FROM ({CLIENT_SQL}) ORDER BY gsc_data_start NULLS LAST, n_name")
def order_nulls_last(spark, sf):
    clients = standins.dim_clients(spark, sf).select("client_hash_id", "gsc_data_start")
    return clients.orderBy(C("gsc_data_start").asc_nulls_last(), "client_hash_id")


@case(
    "multi_key_sort",
    f"""WITH {FINAL} SELECT content_id, impressions_90d, sessions_90d FROM final ORDER BY impressions_90d DESC, sessions_90d DESC, content_id""",
)
def multi_key_sort(spark, sf):
    df = I.final(spark, sf).select("content_id", "impressions_90d", "sessions_90d")
    return df.orderBy(C("impressions_90d").desc(), C("sessions_90d").desc(), "content_id")


@case(
    "worst_false_positives",
    f"{dev_scored()} SELECT content_hash_id, {rnd('risk', 'pos_delta')} FROM scored WHERE is_position_decline = 0 ORDER BY risk DESC, {TIE} LIMIT 3",
)
def worst_false_positives(spark, sf):
    held = I.scored(spark, sf).where("is_position_decline = 0")
    return r6(O.top_k(held, [("risk", True)], ID, 3).select(ID, "risk", "pos_delta"))


@case(
    "worst_false_negatives",
    f"{dev_scored()} SELECT content_hash_id, {rnd('risk', 'pos_delta')} FROM scored WHERE is_position_decline = 1 ORDER BY risk, {TIE} LIMIT 3",
)
def worst_false_negatives(spark, sf):
    declined = I.scored(spark, sf).where("is_position_decline = 1")
    return r6(O.top_k(declined, [("risk", False)], ID, 3).select(ID, "risk", "pos_delta"))


@case("sample_n", "SELECT doc_id, lang FROM documents ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 100")
def sample_n(spark, sf):
    return O.sample_n(standins.table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 100, 42)


@case(
    "limit_probe",
    "SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1 ORDER BY n DESC, 1, 2 LIMIT 5",
)
def limit_probe(spark, sf):
    from panelwright.operators.profiles import grain_probe

    dup = grain_probe(standins.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
    return dup.orderBy(C("n").desc(), "l_orderkey", "l_linenumber").limit(5)


# ---- rule scores --------------------------------------------------------------

COMPONENTS = ["visibility_score", "freshness_risk_score", "position_opportunity_score", "depth_gap_score", "baseline_refresh_score"]


@case("baseline_refresh_score", f"WITH {BASELINE} SELECT content_id, {rnd(*COMPONENTS)} FROM baseline")
def baseline_refresh_score(spark, sf):
    return r6(scoring.baseline_scores(I.prepared(spark, sf)).select("content_id", *COMPONENTS))


@case("frozen_rule_score", f"{dev_scored()} SELECT content_hash_id, rule_points, reason_code, {rnd('baseline_score')} FROM scored")
def frozen_rule_score(spark, sf):
    return r6(scoring.frozen_rule(I.frame(spark, sf), I.VISIBLE).select(ID, "rule_points", "reason_code", "baseline_score"))


@case("variant_rule_score", f"{dev_scored()} SELECT content_hash_id, {rnd('variant_score')} FROM scored")
def variant_rule_score(spark, sf):
    return r6(scoring.variant_rule(I.frame(spark, sf), I.VISIBLE).select(ID, "variant_score"))


@case("blended_score", f"WITH {FINAL} SELECT content_id, {rnd('norm AS baseline_score_normalized', 'final_refresh_score')} FROM final")
def blended_score(spark, sf):
    joined = I.baseline(spark, sf).join(I.predictions(spark, sf), "content_id", "left")
    return r6(scoring.blended(joined).select("content_id", "baseline_score_normalized", "final_refresh_score"))


@case(
    "ctr_gap_opportunity",
    f"""{DEV}, t AS (SELECT *, {POS_TIER} AS pos_tier FROM frame_dev), e AS (SELECT pos_tier, 100.0::DOUBLE * SUM(f_clicks) / SUM(f_impressions) AS expected_ctr
      FROM t WHERE pos_tier IS NOT NULL GROUP BY 1),
    g AS (SELECT t.*, expected_ctr, expected_ctr - f_ctr AS ctr_gap, (expected_ctr - f_ctr) * f_impressions / 100 AS missed_clicks FROM t JOIN e USING (pos_tier))
    SELECT content_hash_id, pos_tier, {rnd('expected_ctr', 'ctr_gap', 'missed_clicks')},
      ROW_NUMBER() OVER (ORDER BY ROUND(missed_clicks, 6) DESC, {TIE}) AS rank FROM g""",
)
def ctr_gap_opportunity(spark, sf):
    gaps = scoring.ctr_gap(I.frame(spark, sf)).withColumn("__key", F.round("missed_clicks", 6))
    ranked = O.global_row_number(gaps, [("__key", True)], ID)
    return r6(ranked.select(ID, "pos_tier", "expected_ctr", "ctr_gap", "missed_clicks", "rank"))


@case(
    "review_queue",
    f"""{dev_scored()} SELECT ROW_NUMBER() OVER (ORDER BY baseline_score DESC, {TIE}) AS rank, content_hash_id, client_hash_id, {rnd('baseline_score')},
      rule_points, reason_code, CASE reason_code WHEN 'sliding_on_page_1_2' THEN 'review_now' WHEN 'low_ctr_for_position' THEN 'review_ctr'
      WHEN 'unstable_and_visible' THEN 'investigate_volatility' ELSE 'monitor' END AS action,
      {rnd('f_pos', 'f_pos_trend', 'f_pos_volatility', 'f_ctr')}, f_impressions, f_days_with_impressions FROM scored""",
)
def review_queue(spark, sf):
    return r6(scoring.review_queue(I.scored(spark, sf)))

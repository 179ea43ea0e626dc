"""Aggregations, profiles, windowed panel frames and signal audits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from panelwright.catalog import inputs as I
from panelwright.catalog.base_sql import (
    BASELINE, DIM, EVENTS, FACT, FINAL, PAGES, POS_TIER, PREPARED, QUERIES, avg_rank, both_scored, dev_scored,
    frame, rnd, windows,
)
from panelwright.catalog.registry import case, r6
from panelwright.functions import cleaning as K, rules, tiers
from panelwright.operators import joins as J, profiles as P
from panelwright.operators.ordering import exact_median, exact_quantiles, top_k
from panelwright.plans import scoring, windows as W
from panelwright.sources import standins

C = F.col
DEV = f"WITH {frame('dev')}"
PREP = f"WITH {PREPARED}"
n_rows = lambda name="n": F.count(F.lit(1)).alias(name)


def _feature_rows(spark, sf):
    split = I.split_of("dev")
    fact = I.fact(spark, sf, split)
    return fact.where(C("year").isin(list(split.feature_periods)) & K.is_true("gsc_data_available"))


FROWS = "fact WHERE year IN ('1997','1998','1999') AND gsc_data_available IS TRUE"


@case(
    "feature_window_agg",
    f"WITH {FACT}, {windows('dev')} SELECT content_hash_id, f_impressions, f_clicks, {rnd('f_pos')}, f_days_with_impressions, {rnd('f_pos_volatility', 'f_pos_trend')} FROM before_dev",
)
def feature_window_agg(spark, sf):
    split = I.split_of("dev")
    return r6(W.feature_window(I.fact(spark, sf, split), split))


@case("outcome_window_agg", f"WITH {FACT}, {windows('dev')} SELECT content_hash_id, o_impressions, {rnd('o_pos')} FROM after_dev")
def outcome_window_agg(spark, sf):
    split = I.split_of("dev")
    return r6(W.outcome_window(I.fact(spark, sf, split), split))


@case(
    "weighted_ratio",
    f"WITH {FACT} SELECT year, {rnd('SUM(gsc_sum_position) / NULLIF(SUM(gsc_impressions), 0) AS avg_pos', '100.0::DOUBLE * SUM(gsc_clicks) / NULLIF(SUM(gsc_impressions), 0) AS ctr')} FROM fact GROUP BY year",
)
def weighted_ratio(spark, sf):
    return r6(I.fact(spark, sf).groupBy("year").agg(
        W.weighted_position().alias("avg_pos"),
        F.try_divide(100.0 * F.sum("gsc_clicks"), F.sum("gsc_impressions")).alias("ctr"),
    ))


@case(
    "filtered_sum",
    f"""WITH {FACT} SELECT content_hash_id, CAST(SUM(gsc_impressions) FILTER (WHERE year = '1997') AS BIGINT) AS first_imps,
    CAST(SUM(gsc_impressions) FILTER (WHERE year = '1999') AS BIGINT) AS last_imps FROM {FROWS} GROUP BY 1""",
)
def filtered_sum(spark, sf):
    at = lambda y: F.sum(F.when(C("year") == y, C("gsc_impressions")))
    return _feature_rows(spark, sf).groupBy("content_hash_id").agg(at("1997").alias("first_imps"), at("1999").alias("last_imps"))


@case("period_difference", f"WITH {FACT}, {windows('dev')} SELECT content_hash_id, {rnd('f_pos_trend')} FROM before_dev")
def period_difference(spark, sf):
    pos = lambda y: W.weighted_position(C("year") == y)
    return r6(_feature_rows(spark, sf).groupBy("content_hash_id").agg((pos("1999") - pos("1997")).alias("f_pos_trend")))


MOM = f"""WITH {EVENTS}, b AS (SELECT MAX(report_date) AS end_d FROM ev),
mom AS (SELECT content_hash_id,
  CAST(SUM(CASE WHEN report_date > end_d - 15 THEN gsc_impressions ELSE 0 END) AS BIGINT) AS imp_last,
  CAST(SUM(CASE WHEN report_date <= end_d - 15 THEN gsc_impressions ELSE 0 END) AS BIGINT) AS imp_prev,
  CAST(SUM(CASE WHEN report_date > end_d - 15 THEN gsc_clicks ELSE 0 END) AS BIGINT) AS clk_last,
  AVG(CASE WHEN report_date > end_d - 15 THEN gsc_avg_position END) AS pos_last,
  AVG(CASE WHEN report_date <= end_d - 15 THEN gsc_avg_position END) AS pos_prev,
  COALESCE(STDDEV_SAMP(CASE WHEN report_date <= end_d - 15 THEN gsc_avg_position END), 0) AS pos_volatility_prev
  FROM ev, b WHERE report_date > end_d - 30 GROUP BY 1)"""


def _momentum(make, spark, sf, floor):
    """Newest day first, from file footers, then a literal range that reaches the scan."""
    end = standins.last_event_day(spark, sf)
    recent = standins.events_daily(spark, sf, after=end - dt.timedelta(days=30))
    return make(recent, 15, floor, end)


@case("case_sums_last_prev", f"{MOM} SELECT content_hash_id, imp_last, imp_prev, clk_last FROM mom")
def case_sums_last_prev(spark, sf):
    return _momentum(W.momentum, spark, sf, 0).select("content_hash_id", "imp_last", "imp_prev", "clk_last")


@case("case_avg_window", f"{MOM} SELECT content_hash_id, {rnd('pos_last', 'pos_prev')} FROM mom")
def case_avg_window(spark, sf):
    out = _momentum(W.momentum_volatility, spark, sf, 0)
    return r6(out.select("content_hash_id", "pos_last", "pos_prev"))


@case("momentum_frame", f"{MOM} SELECT content_hash_id, imp_last, imp_prev, clk_last, {rnd('pos_last')} FROM mom WHERE imp_prev >= 20")
def momentum_frame(spark, sf):
    return r6(_momentum(W.momentum, spark, sf, 20))


@case(
    "momentum_volatility_frame",
    f"""{MOM} SELECT content_hash_id, imp_last, imp_prev, clk_last, {rnd('pos_last', 'pos_prev', 'pos_volatility_prev')},
    CAST(CAST(imp_last - imp_prev AS DOUBLE) / NULLIF(imp_prev, 0) <= -0.10::DOUBLE AS INTEGER) AS is_declining_label FROM mom WHERE imp_prev >= 20""",
)
def momentum_volatility_frame(spark, sf):
    return r6(_momentum(W.momentum_volatility, spark, sf, 20))


@case(
    "count_distinct_filtered",
    f"WITH {FACT} SELECT content_hash_id, COUNT(DISTINCT report_date) FILTER (WHERE gsc_clicks > 0) AS active_days FROM {FROWS} GROUP BY 1",
)
def count_distinct_filtered(spark, sf):
    day = F.when(C("gsc_clicks") > 0, C("report_date"))
    return _feature_rows(spark, sf).groupBy("content_hash_id").agg(F.count_distinct(day).alias("active_days"))


@case(
    "stddev_filtered",
    f"""WITH {FACT} SELECT content_hash_id, {rnd('STDDEV_SAMP(gsc_avg_position) FILTER (WHERE gsc_clicks > 0) AS vol',
    'COALESCE(STDDEV_SAMP(gsc_avg_position) FILTER (WHERE gsc_clicks > 0), 0) AS vol0')} FROM {FROWS} GROUP BY 1""",
)
def stddev_filtered(spark, sf):
    vol = F.stddev_samp(F.when(C("gsc_clicks") > 0, C("gsc_avg_position")))
    return r6(_feature_rows(spark, sf).groupBy("content_hash_id").agg(vol.alias("vol"), F.coalesce(vol, F.lit(0.0)).alias("vol0")))


MIX = f"""WITH {QUERIES} SELECT content_hash_id, COUNT(*) AS visible_queries, {rnd('MIN(rare_impressions_share) AS rare_share',
  'MIN(anonymized_impressions_share) AS anon_share')}, MAX(impressions_90d) AS top_query_impressions,
  CAST(SUM(impressions_90d) AS BIGINT) AS kept_impressions, {rnd('MAX(impressions_90d) / SUM(impressions_90d) AS top_query_share')} FROM queries GROUP BY 1"""


@case("query_mix_signals", MIX)
def query_mix_signals(spark, sf):
    return r6(W.query_mix(standins.query_fact(spark, sf)))


@case(
    "any_value_context",
    f"WITH {QUERIES} SELECT content_hash_id, MIN(content_total_impressions_90d) AS content_total, {rnd('MIN(rare_impressions_share) AS rare_share')} FROM queries GROUP BY 1",
)
def any_value_context(spark, sf):
    return r6(standins.query_fact(spark, sf).groupBy("content_hash_id").agg(
        F.min("content_total_impressions_90d").alias("content_total"), F.min("rare_impressions_share").alias("rare_share")
    ))


@case(
    "max_share_concentration",
    f"WITH {QUERIES} SELECT content_hash_id, {rnd('MAX(impressions_90d) / SUM(impressions_90d) AS top_query_share')} FROM queries GROUP BY 1",
)
def max_share_concentration(spark, sf):
    return r6(W.query_mix(standins.query_fact(spark, sf)).select("content_hash_id", "top_query_share"))


@case("having_threshold", f"WITH {FACT} SELECT content_hash_id, CAST(SUM(gsc_impressions) AS BIGINT) AS imps FROM {FROWS} GROUP BY 1 HAVING imps >= 300")
def having_threshold(spark, sf):
    sums = _feature_rows(spark, sf).groupBy("content_hash_id").agg(F.sum("gsc_impressions").alias("imps"))
    return sums.where("imps >= 300")


@case("grain_probe", "SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1")
def grain_probe(spark, sf):
    return P.grain_probe(standins.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@case(
    "slice_profile",
    f"""WITH {FACT} SELECT COUNT(*) AS n_rows, COUNT(DISTINCT content_hash_id) AS items, COUNT(DISTINCT query_hash_id) AS clients,
    MIN(report_date) AS first_day, MAX(report_date) AS last_day FROM fact""",
)
def slice_profile(spark, sf):
    return P.slice_profile(I.fact(spark, sf), "content_hash_id", "query_hash_id", "report_date")


def _states(name, flag):
    return ", ".join(
        f"COUNT(*) FILTER (WHERE {flag} IS {state}) AS {name}_is_{state.lower()}" for state in ["TRUE", "FALSE", "NULL"]
    )


@case(
    "availability_counts",
    f"WITH {FACT} SELECT COUNT(*) AS all_rows, {_states('gsc', 'gsc_data_available')}, {_states('ga4', 'ga4_data_available')} FROM fact",
)
def availability_counts(spark, sf):
    return P.availability(I.fact(spark, sf), {"gsc": "gsc_data_available", "ga4": "ga4_data_available"})


NULLABLE = ["cpc", "backlinks", "word_count", "competition_level", "f_pos_trend"]
NULL_RATES = rnd(*[f"AVG(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS null_{c}" for c in NULLABLE])


@case(
    "missingness_by_category",
    f"""{DEV} SELECT content_type AS category, COUNT(*) AS n, {NULL_RATES} FROM frame_dev GROUP BY 1
    UNION ALL SELECT '(all)', COUNT(*), {NULL_RATES} FROM frame_dev""",
)
def missingness_by_category(spark, sf):
    return r6(P.missingness(I.frame(spark, sf), NULLABLE, "content_type"))


DENSE = ["gsc_impressions", "gsc_clicks", "sessions_ai"]


@case(
    "metric_density",
    f"WITH {FACT} " + " UNION ALL ".join(f"SELECT '{c}' AS metric, COUNT(*) FILTER (WHERE {c} > 0) AS n_rows FROM fact" for c in DENSE),
)
def metric_density(spark, sf):
    return P.metric_density(I.fact(spark, sf), DENSE)


@case(
    "window_span_per_group",
    f"WITH {FACT} SELECT query_hash_id, MIN(report_date) AS first_day, MAX(report_date) AS last_day, COUNT(*) AS n FROM fact GROUP BY 1",
)
def window_span_per_group(spark, sf):
    return I.fact(spark, sf).groupBy("query_hash_id").agg(
        F.min("report_date").alias("first_day"), F.max("report_date").alias("last_day"), n_rows()
    )


@case(
    "grouped_mean",
    f"""WITH {DIM}, {PAGES} SELECT position_tier, content_type, {rnd('AVG(ctr) AS mean_ctr')} FROM pages_raw WHERE impressions_90d >= 100 GROUP BY 1, 2""",
)
def grouped_mean(spark, sf):
    visible = I.pages(spark, sf).where("impressions_90d >= 100")
    return r6(visible.groupBy("position_tier", "content_type").agg(F.avg("ctr").alias("mean_ctr")))


@case("grouped_median", f"WITH {DIM}, {PAGES} SELECT trend_direction, {rnd('quantile_cont(ctr, 0.5) AS median_ctr')} FROM pages_raw WHERE ctr IS NOT NULL GROUP BY 1")
def grouped_median(spark, sf):
    return r6(exact_median(I.pages(spark, sf), "ctr", "median_ctr", by=["trend_direction"], few=True))


@case(
    "grouped_multi_agg",
    f"""WITH {DIM}, {PAGES} SELECT trend_direction, {rnd('quantile_cont(CAST(content_age_days AS DOUBLE), 0.5) AS median_age', 'AVG(content_age_days) AS mean_age')},
    COUNT(content_age_days) AS n FROM pages_raw GROUP BY 1""",
)
def grouped_multi_agg(spark, sf):
    pages = I.pages(spark, sf)
    stats = pages.groupBy("trend_direction").agg(
        F.avg("content_age_days").alias("mean_age"), F.count("content_age_days").alias("n")
    )
    return r6(stats.join(exact_median(pages, "content_age_days", "median_age", by=["trend_direction"], few=True), "trend_direction"))


@case(
    "value_counts",
    f"""WITH {FINAL}, v AS (SELECT * FROM (VALUES (1, 'high'), (2, 'medium'), (3, 'low'), (4, 'none')) t(position, value))
    SELECT value, position, COUNT(content_id) AS n FROM v LEFT JOIN final ON confidence = value GROUP BY 1, 2""",
)
def value_counts(spark, sf):
    return P.fixed_counts(I.final(spark, sf), "confidence", ["high", "medium", "low", "none"])


@case(
    "explode_code_counts",
    f"""WITH {FINAL} SELECT code, COUNT(*) AS n FROM (SELECT unnest(string_split(final_reason_codes, '|')) AS code FROM final)
    GROUP BY 1 ORDER BY n DESC, code LIMIT 12""",
)
def explode_code_counts(spark, sf):
    return P.code_counts(I.final(spark, sf), "final_reason_codes", r"\|", 12)


@case(
    "share_of_total",
    f"""{PREP} SELECT SUM(is_declining_label)::BIGINT AS declining, {rnd('AVG(is_declining_label) AS share_of_rows',
    'SUM(CASE WHEN is_declining_label = 1 THEN impressions_90d ELSE 0 END) / SUM(impressions_90d) AS share_of_impressions')} FROM prepared""",
)
def share_of_total(spark, sf):
    down = C("is_declining_label") == 1
    return r6(I.prepared(spark, sf).agg(
        F.sum("is_declining_label").alias("declining"), F.avg("is_declining_label").alias("share_of_rows"),
        F.try_divide(F.sum(F.when(down, C("impressions_90d")).otherwise(0)), F.sum("impressions_90d")).alias("share_of_impressions"),
    ))


@case(
    "segment_counts",
    f"""{PREP} SELECT COUNT(*) FILTER (WHERE is_declining_label = 1 AND word_count >= 2000 AND engaged_sessions_90d = 0) AS long_unread_declining,
    COUNT(*) FILTER (WHERE is_declining_label = 1 AND position_tier = 'striking') AS striking_declining,
    COUNT(*) FILTER (WHERE is_declining_label = 1 AND days_since_last_update >= 180) AS stale_declining FROM prepared""",
)
def segment_counts(spark, sf):
    down = C("is_declining_label") == 1
    return I.prepared(spark, sf).agg(
        F.count_if(down & (C("word_count") >= 2000) & (C("engaged_sessions_90d") == 0)).alias("long_unread_declining"),
        F.count_if(down & (C("position_tier") == "striking")).alias("striking_declining"),
        F.count_if(down & (C("days_since_last_update") >= 180)).alias("stale_declining"),
    )


@case(
    "quantile_filter",
    f"{PREP} SELECT content_id, {rnd('cpc')} FROM prepared WHERE cpc >= (SELECT quantile_cont(cpc, 0.75) FROM prepared)",
)
def quantile_filter(spark, sf):
    df = I.prepared(spark, sf)
    cut = exact_quantiles(df, "cpc", {"p75": 0.75})
    return r6(df.crossJoin(F.broadcast(cut)).where(C("cpc") >= C("p75")).select("content_id", "cpc"))


PROBS = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}


@case(
    "quantiles_describe",
    f"""{DEV} SELECT COUNT(days_since_update) AS n, {rnd('AVG(days_since_update) AS mean', 'STDDEV_SAMP(days_since_update) AS std',
    'MIN(days_since_update)::DOUBLE AS min', 'MAX(days_since_update)::DOUBLE AS max',
    *[f'quantile_cont(days_since_update::DOUBLE, {p}) AS {name}' for name, p in PROBS.items()])} FROM frame_dev""",
)
def quantiles_describe(spark, sf):
    return r6(P.describe(I.frame(spark, sf), "days_since_update", PROBS))


@case(
    "pearson_corr",
    f"""WITH {DIM}, {PAGES} SELECT {rnd('corr(search_volume, impressions_90d) AS all_pages',
    'corr(search_volume, impressions_90d) FILTER (WHERE impressions_90d > 300) AS visible_pages', 'corr(avg_position, ctr) AS position_ctr')} FROM pages_raw""",
)
def pearson_corr(spark, sf):
    seen = C("impressions_90d") > 300
    return r6(I.pages(spark, sf).agg(
        F.corr("search_volume", C("impressions_90d")).alias("all_pages"),
        F.corr(F.when(seen, C("search_volume")), F.when(seen, C("impressions_90d"))).alias("visible_pages"),
        F.corr("avg_position", "ctr").alias("position_ctr"),
    ))


@case(
    "spearman_corr",
    f"""{DEV}, r AS (SELECT {avg_rank('f_pos')} AS a, {avg_rank('f_impressions')} AS b FROM frame_dev)
    SELECT {rnd('corr(a, b) AS spearman')} FROM r""",
)
def spearman_corr(spark, sf):
    return r6(P.spearman(I.frame(spark, sf), "f_pos", "f_impressions"))


@case(
    "feature_metadata",
    f"""{PREP} SELECT (SELECT COUNT(*) FROM pages_raw) AS initial_rows, COUNT(*) AS prepared_rows,
    CAST(SUM(is_declining_label) AS BIGINT) AS declining_rows, {rnd('AVG(is_declining_label) AS declining_rate')} FROM prepared""",
)
def feature_metadata(spark, sf):
    initial = I.pages(spark, sf).agg(n_rows("initial_rows"))
    done = I.prepared(spark, sf).agg(
        n_rows("prepared_rows"), F.sum("is_declining_label").alias("declining_rows"),
        F.avg("is_declining_label").alias("declining_rate"),
    )
    return r6(initial.crossJoin(F.broadcast(done)))


@case(
    "baseline_metadata",
    f"""WITH {BASELINE}, t AS (SELECT is_declining_label FROM baseline ORDER BY baseline_refresh_score DESC, md5(content_id), content_id LIMIT 50)
    SELECT COUNT(*) AS n_rows, {rnd('MAX(baseline_refresh_score) AS top_score', 'quantile_cont(baseline_refresh_score, 0.5) AS median_score')},
    (SELECT {rnd('AVG(is_declining_label) AS x')} FROM t) AS declining_rate_top_50 FROM baseline""",
)
def baseline_metadata(spark, sf):
    df = I.baseline(spark, sf)
    totals = df.agg(n_rows("n_rows"), F.max("baseline_refresh_score").alias("top_score"))
    median = exact_median(df, "baseline_refresh_score", "median_score")
    top = top_k(df, [("baseline_refresh_score", True)], "content_id", 50).agg(F.avg("is_declining_label").alias("declining_rate_top_50"))
    return r6(totals.crossJoin(F.broadcast(median)).crossJoin(F.broadcast(top)))


@case(
    "summary_payload",
    f"""WITH {FINAL} SELECT COUNT(*) AS rows_scored, {rnd('MIN(p80) AS final_score_p80', 'MIN(p50) AS final_score_p50',
    'MAX(final_refresh_score) AS top_queue_score')}, COUNT(*) FILTER (WHERE confidence = 'high') AS high_confidence_rows FROM final""",
)
def summary_payload(spark, sf):
    df = I.final(spark, sf)
    cuts = exact_quantiles(df, "final_refresh_score", {"final_score_p80": 0.8, "final_score_p50": 0.5})
    totals = df.agg(
        n_rows("rows_scored"), F.max("final_refresh_score").alias("top_queue_score"),
        F.count_if(C("confidence") == "high").alias("high_confidence_rows"),
    )
    return r6(totals.crossJoin(F.broadcast(cuts)))


@case(
    "clients_with_history",
    """WITH c AS (SELECT o_custkey, MIN(CAST(o_orderdate AS DATE)) AS start FROM orders GROUP BY 1)
    SELECT COUNT(*) FILTER (WHERE start <= (SELECT MAX(start) FROM c) - 365) AS clients_with_history FROM c""",
)
def clients_with_history(spark, sf):
    orders = standins.table(spark, sf, "orders")
    clients = orders.groupBy("o_custkey").agg(F.min(C("o_orderdate").cast("date")).alias("start"))
    return P.clients_with_history(clients, "start")


@case(
    "group_size_filter",
    f"""{DEV}, g AS (SELECT client_hash_id FROM frame_dev GROUP BY 1 HAVING COUNT(*) >= 60 AND COUNT(DISTINCT is_position_decline) > 1)
    SELECT content_hash_id, client_hash_id FROM frame_dev WHERE client_hash_id IN (SELECT client_hash_id FROM g)""",
)
def group_size_filter(spark, sf):
    return P.over_floor(I.frame(spark, sf), "client_hash_id", "is_position_decline", 60).select("content_hash_id", "client_hash_id")


@case(
    "nunique",
    f"""{dev_scored()} SELECT COUNT(DISTINCT client_hash_id) AS clients, COUNT(DISTINCT rule_points) AS point_values,
    COUNT(DISTINCT ROUND(f_ctr, 6)) AS ctr_values FROM scored""",
)
def nunique(spark, sf):
    return I.scored(spark, sf).agg(
        F.count_distinct("client_hash_id").alias("clients"), F.count_distinct("rule_points").alias("point_values"),
        F.count_distinct(F.round("f_ctr", 6)).alias("ctr_values"),
    )


STALE_BUCKET = """CASE WHEN days_since_update > -1 AND days_since_update <= 30 THEN '0-30 days' WHEN days_since_update > 30 AND days_since_update <= 90 THEN '31-90'
  WHEN days_since_update > 90 AND days_since_update <= 180 THEN '91-180' WHEN days_since_update > 180 AND days_since_update <= 365 THEN '181-365'
  WHEN days_since_update > 365 THEN '365+' END"""
BUCKETS = f"""b AS (SELECT AVG(is_position_decline) AS base FROM frame_dev),
t AS (SELECT {STALE_BUCKET} AS bucket, COUNT(*) AS n, AVG(is_position_decline) AS rate FROM frame_dev WHERE days_since_update >= 0 GROUP BY 1)
SELECT bucket, n, {rnd('rate', 'rate - base AS vs_base')},
  CASE WHEN n >= 50 THEN CASE WHEN rate > base THEN 'above' WHEN rate < base THEN 'below' ELSE 'equal' END END AS verdict FROM t, b"""


def _staleness(spark, sf):
    df = I.frame(spark, sf)
    base = df.agg(F.avg("is_position_decline").alias("base_rate"))
    testable = df.where("days_since_update >= 0").withColumn("bucket", tiers.staleness_bin("days_since_update"))
    return r6(P.bucket_rates(testable, "bucket", "is_position_decline", base))


@case("bucket_rate_floor", f"{DEV}, b AS (SELECT AVG(is_position_decline) AS base FROM frame_dev), t AS (SELECT {POS_TIER} AS bucket, COUNT(*) AS n, AVG(is_position_decline) AS rate FROM frame_dev GROUP BY 1) SELECT bucket, n, {rnd('rate', 'rate - base AS vs_base')}, CASE WHEN n >= 50 THEN CASE WHEN rate > base THEN 'above' WHEN rate < base THEN 'below' ELSE 'equal' END END AS verdict FROM t, b WHERE bucket IS NOT NULL")
def bucket_rate_floor(spark, sf):
    df = I.frame(spark, sf)
    base = df.agg(F.avg("is_position_decline").alias("base_rate"))
    tiered = df.withColumn("bucket", tiers.position_bin("f_pos"))
    return r6(P.bucket_rates(tiered, "bucket", "is_position_decline", base))


@case("staleness_audit", f"{DEV}, {BUCKETS}")
def staleness_audit(spark, sf):
    return _staleness(spark, sf)


@case(
    "tier_gap_verdict",
    f"""{dev_scored()}, g AS (SELECT pos_tier, COUNT(*) AS n, COUNT(*) FILTER (WHERE f_ctr < tier_median_ctr) AS n_low,
      AVG(CASE WHEN f_ctr < tier_median_ctr THEN is_position_decline END) AS rate_low,
      AVG(CASE WHEN f_ctr >= tier_median_ctr THEN is_position_decline END) AS rate_high FROM scored WHERE pos_tier IS NOT NULL GROUP BY 1)
    SELECT pos_tier, n, n_low, {rnd('rate_low', 'rate_high', 'rate_low - rate_high AS gap')},
      CASE WHEN n >= 50 AND n_low > 0 AND n_low < n THEN CASE WHEN rate_low - rate_high > 0.02::DOUBLE THEN 'supports'
        WHEN rate_low - rate_high < -0.02::DOUBLE THEN 'REVERSES' ELSE 'flat' END END AS verdict FROM g""",
)
def tier_gap_verdict(spark, sf):
    df = scoring.with_tier_median(I.frame(spark, sf))
    return r6(P.side_gap_verdict(df, "pos_tier", C("f_ctr") < C("tier_median_ctr"), "is_position_decline"))


@case(
    "tier_context",
    f"""{dev_scored()} SELECT pos_tier, COUNT(*) AS n, {rnd('100.0::DOUBLE * SUM(f_clicks) / SUM(f_impressions) AS weighted_ctr',
    'AVG(is_position_decline) AS decline_rate')} FROM scored WHERE pos_tier IS NOT NULL GROUP BY 1""",
)
def tier_context(spark, sf):
    tiered = I.frame(spark, sf).withColumn("pos_tier", tiers.position_bin("f_pos")).where("pos_tier IS NOT NULL")
    return r6(tiered.groupBy("pos_tier").agg(
        n_rows(), F.try_divide(100.0 * F.sum("f_clicks"), F.sum("f_impressions")).alias("weighted_ctr"),
        F.avg("is_position_decline").alias("decline_rate"),
    ))


@case(
    "label_shift_median",
    f"{both_scored()} SELECT 'dev' AS split, {rnd('median(pos_delta) AS median_shift')} FROM dev UNION ALL SELECT 'sealed', {rnd('median(pos_delta) AS median_shift')} FROM sealed",
)
def label_shift_median(spark, sf):
    row = lambda n: exact_median(I.frame(spark, sf, n), "pos_delta", "median_shift").withColumn("split", F.lit(n))
    return r6(row("dev").unionByName(row("sealed")))


@case(
    "persistence_check",
    f"""WITH {FACT}, w AS (SELECT content_hash_id, CAST(SUM(CASE WHEN year = '1998' THEN gsc_impressions ELSE 0 END) AS BIGINT) AS w0,
      CAST(SUM(CASE WHEN year = '1999' THEN gsc_impressions ELSE 0 END) AS BIGINT) AS w1,
      CAST(SUM(CASE WHEN year = '2000' THEN gsc_impressions ELSE 0 END) AS BIGINT) AS w2 FROM fact GROUP BY 1)
    SELECT content_hash_id, w0, w1, w2, CASE WHEN w1 < 0.8::DOUBLE * w0 AND w2 < 0.8::DOUBLE * w0 THEN 1 ELSE 0 END AS persistent FROM w""",
)
def persistence_check(spark, sf):
    at = lambda y: F.sum(F.when(C("year") == y, C("gsc_impressions")).otherwise(0))
    w = I.fact(spark, sf).groupBy("content_hash_id").agg(at("1998").alias("w0"), at("1999").alias("w1"), at("2000").alias("w2"))
    return P.persistent_drop(w, "w0", ["w1", "w2"])


@case(
    "site_trend_adjust",
    f"""{PREP}, i AS (SELECT content_hash_id, client_hash_id, impressions_prev_30d AS b, impressions_last_30d AS a FROM dim JOIN pages0 USING (content_hash_id)),
    c AS (SELECT client_hash_id, SUM(a) AS ga, SUM(b) AS gb FROM i GROUP BY 1)
    SELECT content_hash_id, {rnd('(a - b)::DOUBLE / NULLIF(b, 0) AS own_change', '(ga - gb)::DOUBLE / NULLIF(gb, 0) AS group_change',
    '(a - b)::DOUBLE / NULLIF(b, 0) - (ga - gb)::DOUBLE / NULLIF(gb, 0) AS adjusted_change')} FROM i JOIN c USING (client_hash_id)""",
)
def site_trend_adjust(spark, sf):
    pages = I.pages(spark, sf).where("impressions_90d IS NOT NULL").withColumnRenamed("content_id", "content_hash_id")
    out = J.adjust_for_group(pages, "client_id", "impressions_prev_30d", "impressions_last_30d")
    return r6(out.select("content_hash_id", "own_change", "group_change", "adjusted_change"))


@case(
    "reason_code_yield",
    f"{dev_scored()} SELECT reason_code, COUNT(*) AS n, {rnd('AVG(is_position_decline) AS decline_rate')} FROM scored GROUP BY 1",
)
def reason_code_yield(spark, sf):
    return r6(I.scored(spark, sf).groupBy("reason_code").agg(n_rows(), F.avg("is_position_decline").alias("decline_rate")))


@case(
    "conditional_rate_split",
    f"{DEV} SELECT COALESCE(f_pos_trend, 0) >= 1.0 AS flag, COUNT(*) AS n, {rnd('AVG(is_position_decline) AS rate')} FROM frame_dev GROUP BY 1",
)
def conditional_rate_split(spark, sf):
    sliding = F.coalesce("f_pos_trend", F.lit(0.0)) >= rules.SLIDE_POSITIONS
    return r6(P.rate_when(I.frame(spark, sf), sliding, "is_position_decline"))


# ---- frames -----------------------------------------------------------------

FRAME_OUT = f"""content_hash_id, client_hash_id, f_impressions, f_clicks, {rnd('f_pos', 'f_ctr')}, f_days_with_impressions,
  {rnd('f_pos_volatility', 'f_pos_trend')}, content_type, main_intent, competition_level, search_volume, competition, cpc, backlinks,
  word_count, char_count, keyword_token_count, content_age_days, days_since_update, o_impressions, {rnd('o_pos', 'pos_delta')}, is_position_decline"""


@case("build_modeling_frame", f"{DEV} SELECT {FRAME_OUT} FROM frame_dev")
def build_modeling_frame(spark, sf):
    df = I.build_frame(spark, sf)
    long = {c: C(c).cast("bigint") for c in ["content_age_days", "days_since_update"]}
    return r6(df.withColumns(long))


@case(
    "feature_frame_single_month",
    f"""WITH {frame('single')} SELECT content_hash_id, client_hash_id, f_impressions, f_days_with_impressions,
    {rnd('f_pos', 'f_ctr', 'f_pos_volatility', 'o_pos', 'pos_delta')}, is_position_decline FROM frame_single""",
)
def feature_frame_single_month(spark, sf):
    return r6(W.five_feature_frame(I.fact(spark, sf, I.SINGLE), I.dim(spark, sf), I.SINGLE))


@case(
    "window_disjoint_check",
    f"""WITH {FACT}, w AS (SELECT MAX(report_date) FILTER (WHERE year IN ('1997','1998','1999')) AS feature_end,
      MIN(report_date) FILTER (WHERE year = '2000') AS outcome_start, MAX(report_date) FILTER (WHERE year = '2000') AS outcome_end,
      MIN(report_date) FILTER (WHERE year = '2001') AS query_start FROM fact)
    SELECT *, COALESCE(feature_end < outcome_start AND outcome_end < query_start, false) AS ok FROM w""",
)
def window_disjoint_check(spark, sf):
    day = lambda agg, *years: agg(F.when(C("year").isin(*years), C("report_date")))
    w = I.fact(spark, sf).agg(
        day(F.max, "1997", "1998", "1999").alias("feature_end"), day(F.min, "2000").alias("outcome_start"),
        day(F.max, "2000").alias("outcome_end"), day(F.min, "2001").alias("query_start"),
    )
    ok = (C("feature_end") < C("outcome_start")) & (C("outcome_end") < C("query_start"))
    return w.withColumn("ok", F.coalesce(ok, F.lit(False)))


@case(
    "future_dated_check",
    f"""{DEV} SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE days_since_update < 0) AS future_dated,
    {rnd('AVG(CASE WHEN days_since_update < 0 THEN 1 ELSE 0 END) AS future_share')} FROM frame_dev""",
)
def future_dated_check(spark, sf):
    future = C("days_since_update") < 0
    return r6(I.frame(spark, sf).agg(
        n_rows(), F.count_if(future).alias("future_dated"), F.avg(future.cast("int")).alias("future_share")
    ))


@case("coverage_growth", f"WITH {FACT} SELECT month, COUNT(DISTINCT content_hash_id) AS items FROM fact GROUP BY 1")
def coverage_growth(spark, sf):
    return I.fact(spark, sf).groupBy("month").agg(F.count_distinct("content_hash_id").alias("items"))


@case(
    "query_reconcile",
    f"""WITH {FACT}, {QUERIES}, q AS (SELECT content_hash_id, CAST(SUM(impressions_90d) AS BIGINT) AS query_total FROM queries GROUP BY 1),
    d AS (SELECT content_hash_id, CAST(SUM(gsc_impressions) AS BIGINT) AS daily_total FROM fact WHERE gsc_data_available IS NOT FALSE GROUP BY 1)
    SELECT content_hash_id, query_total, daily_total, CASE WHEN query_total IS NOT DISTINCT FROM daily_total THEN 1 ELSE 0 END AS matches
    FROM q FULL OUTER JOIN d USING (content_hash_id)""",
)
def query_reconcile(spark, sf):
    q = standins.query_fact(spark, sf).groupBy("content_hash_id").agg(F.sum("impressions_90d").alias("total"))
    tracked = I.fact(spark, sf).where(~C("gsc_data_available").eqNullSafe(False))
    d = tracked.groupBy("content_hash_id").agg(F.sum("gsc_impressions").alias("total"))
    return J.reconcile({"query_total": q, "daily_total": d}, "content_hash_id", "total")

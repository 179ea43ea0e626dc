"""Projection, cleaning, filters, labels, tiers, codes and actions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from panelwright.catalog import inputs as I
from panelwright.catalog.base_sql import (
    BASELINE, DIM, FACT, FINAL, PAGES, PREPARED, dev_scored, frame, rnd,
)
from panelwright.catalog.registry import case, r6
from panelwright.functions import cleaning as K, rules, tiers
from panelwright.plans import scoring
from panelwright.sources import standins, tables as T

C = F.col
RAW = f"WITH {DIM}, {PAGES}"
PREP = f"WITH {PREPARED}"
FIN = f"WITH {FINAL}"


def events(spark, sf):
    return standins.table(spark, sf, "events")


# ---- cleaning ------------------------------------------------------------

@case(
    "coerce_numeric",
    r"""SELECT event_id, TRY_CAST(regexp_extract(props, '"k":\s*([^}]*)', 1) AS DOUBLE) AS k,
        TRY_CAST(event_type AS DOUBLE) AS bad FROM events""",
)
def coerce_numeric(spark, sf):
    return events(spark, sf).select(
        "event_id", K.to_number(F.get_json_object("props", "$.k")).alias("k"), K.to_number("event_type").alias("bad")
    )


@case(
    "parse_bool",
    """SELECT doc_id, COALESCE(lower(q) IN ('true', '1', 'yes', 'y'), FALSE) AS good,
       COALESCE(lower(t) IN ('true', '1', 'yes', 'y'), FALSE) AS toxic
       FROM (SELECT d.doc_id, CASE quality WHEN 1 THEN 'Yes' WHEN 0 THEN 'no' END AS q, CAST(toxic AS VARCHAR) AS t
             FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)""",
)
def parse_bool(spark, sf):
    docs = standins.table(spark, sf, "documents").select("doc_id")
    labels = standins.table(spark, sf, "labels")
    text = F.when(C("quality") == 1, "Yes").when(C("quality") == 0, "no")
    joined = docs.join(labels, "doc_id", "left")
    return joined.select("doc_id", K.parse_bool(text).alias("good"), K.parse_bool("toxic").alias("toxic"))


@case(
    "fill_categorical",
    f"""{RAW} SELECT content_id, COALESCE(NULLIF(NULLIF(competition_level, ''), 'nan'), 'unknown') AS competition_level,
    COALESCE(word_count_tier, 'unknown') AS word_count_tier FROM pages_raw""",
)
def fill_categorical(spark, sf):
    return I.pages(spark, sf).select(
        "content_id", *[K.fill_category(c).alias(c) for c in ["competition_level", "word_count_tier"]]
    )


@case(
    "fill_numeric",
    f"""{RAW} SELECT content_id, COALESCE(cpc, 0) AS cpc, COALESCE(word_count, -1) AS word_count,
    {rnd("COALESCE(ctr, 0) AS ctr")}, COALESCE(CAST(clicks_90d AS DOUBLE), 0) AS clicks_90d FROM pages_raw""",
)
def fill_numeric(spark, sf):
    return r6(I.pages(spark, sf).select(
        "content_id", K.finite_or("cpc").alias("cpc"), K.finite_or("word_count", -1).alias("word_count"),
        K.finite_or("ctr").alias("ctr"), K.finite_or("clicks_90d").alias("clicks_90d"),
    ))


@case(
    "eligibility_filter",
    f"{RAW} SELECT content_id, impressions_90d, content_age_days FROM pages_raw WHERE impressions_90d > 0 AND content_age_days >= 90",
)
def eligibility_filter(spark, sf):
    kept = I.pages(spark, sf).where((C("impressions_90d") > 0) & (C("content_age_days") >= scoring.MIN_AGE_DAYS))
    return kept.select("content_id", "impressions_90d", C("content_age_days").cast("bigint").alias("content_age_days"))


@case(
    "dedupe_first",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (SELECT *, ROW_NUMBER() OVER (
       PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_discount, l_tax) AS rn
       FROM lineitem) WHERE rn = 1""",
)
def dedupe_first(spark, sf):
    li = standins.table(spark, sf, "lineitem")
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax"]
    first = T.first_per_key(li, ["l_orderkey", "l_linenumber"], order)
    return first.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@case("population_floor", f"WITH {frame('dev')} SELECT content_hash_id, f_impressions, o_impressions FROM frame_dev")
def population_floor(spark, sf):
    from panelwright.plans.windows import both_windows

    split = I.split_of("dev")
    both = both_windows(I.fact(spark, sf, split), split)
    kept = both.where((C("f_impressions") >= 100) & (C("o_impressions") >= 30))
    return kept.select("content_hash_id", "f_impressions", "o_impressions")


@case(
    "three_valued_filter",
    f"""WITH {FACT} SELECT year, COUNT(*) FILTER (WHERE gsc_data_available IS TRUE) AS is_true,
    COUNT(*) FILTER (WHERE gsc_data_available IS NOT TRUE) AS not_true,
    COUNT(*) FILTER (WHERE NOT gsc_data_available) AS plain_not FROM fact GROUP BY year""",
)
def three_valued_filter(spark, sf):
    return I.fact(spark, sf).groupBy("year").agg(
        F.count_if(K.is_true("gsc_data_available")).alias("is_true"),
        F.count_if(~K.is_true("gsc_data_available")).alias("not_true"),
        F.count_if(~C("gsc_data_available")).alias("plain_not"),
    )


@case(
    "dropna_subset",
    f"""WITH {frame('dev')} SELECT content_hash_id, {rnd('f_pos_trend')}, backlinks, word_count FROM frame_dev
    WHERE f_pos_trend IS NOT NULL AND backlinks IS NOT NULL AND word_count IS NOT NULL""",
)
def dropna_subset(spark, sf):
    cols = ["f_pos_trend", "backlinks", "word_count"]
    return r6(I.frame(spark, sf).na.drop(subset=cols).select("content_hash_id", *cols))


# ---- labels and derived columns -------------------------------------------

@case(
    "label_from_trend",
    f"{RAW} SELECT content_id, CASE WHEN lower(trend_direction) = 'down' THEN 1 ELSE 0 END AS is_declining_label FROM pages_raw",
)
def label_from_trend(spark, sf):
    return I.pages(spark, sf).select("content_id", tiers.label_from_trend("trend_direction").alias("is_declining_label"))


@case(
    "label_drop_ratio",
    f"""{RAW} SELECT content_id, CASE WHEN impressions_last_30d < 0.8::DOUBLE * impressions_prev_30d THEN 1 ELSE 0 END AS is_declining
    FROM pages_raw""",
)
def label_drop_ratio(spark, sf):
    return I.pages(spark, sf).select(
        "content_id", tiers.label_drop_ratio("impressions_last_30d", "impressions_prev_30d").alias("is_declining")
    )


@case(
    "label_pct_drop",
    f"""{RAW} SELECT content_id, CAST(CAST(impressions_last_30d - impressions_prev_30d AS DOUBLE) / NULLIF(impressions_prev_30d, 0) <= -0.10::DOUBLE AS INTEGER)
    AS is_declining_label FROM pages_raw""",
)
def label_pct_drop(spark, sf):
    return I.pages(spark, sf).select(
        "content_id", tiers.label_pct_drop("impressions_last_30d", "impressions_prev_30d").alias("is_declining_label")
    )


@case(
    "label_position_decline",
    f"WITH {frame('dev')} SELECT content_hash_id, {rnd('pos_delta')}, is_position_decline FROM frame_dev",
)
def label_position_decline(spark, sf):
    return r6(I.frame(spark, sf).select(
        "content_hash_id", (C("o_pos") - C("f_pos")).alias("pos_delta"),
        tiers.label_position_decline("o_pos", "f_pos").alias("is_position_decline"),
    ))


LOGS = ["log_impressions_90d", "log_clicks_90d", "log_sessions_90d", "log_ai_sessions_90d"]


@case("log1p_features", f"{PREP} SELECT content_id, {rnd(*LOGS)} FROM prepared")
def log1p_features(spark, sf):
    kept = scoring.clean_pages(I.pages(spark, sf)).where("impressions_90d > 0 AND content_age_days >= 90")
    return r6(scoring.with_prepared_columns(kept).select("content_id", *LOGS))


@case("indicator_flags", f"{PREP} SELECT content_id, has_clicks, has_ai_sessions, measurable_opportunity FROM prepared")
def indicator_flags(spark, sf):
    kept = scoring.clean_pages(I.pages(spark, sf)).where("impressions_90d > 0 AND content_age_days >= 90")
    return scoring.with_prepared_columns(kept).select("content_id", "has_clicks", "has_ai_sessions", "measurable_opportunity")


FLAGGED = ["f_pos_trend", "backlinks", "word_count", "search_volume"]


@case(
    "missing_flags",
    f"WITH {frame('dev')} SELECT content_hash_id, "
    + ", ".join(f"CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END AS has_{c}" for c in FLAGGED) + " FROM frame_dev",
)
def missing_flags(spark, sf):
    return I.frame(spark, sf).select("content_hash_id", *[K.has_flag(c).alias(f"has_{c}") for c in FLAGGED])


@case("clip", f"{RAW} SELECT content_id, LEAST(GREATEST(avg_position, 1), 50) AS pos FROM pages_raw")
def clip(spark, sf):
    return I.pages(spark, sf).select("content_id", K.clip("avg_position", 1.0, 50.0).alias("pos"))


@case(
    "safe_ratio",
    f"{RAW} SELECT content_id, {rnd('100.0::DOUBLE * clicks_last_30d / NULLIF(impressions_last_30d, 0) AS ctr_last')} FROM pages_raw",
)
def safe_ratio(spark, sf):
    return r6(I.pages(spark, sf).select(
        "content_id", K.safe_ratio("clicks_last_30d", "impressions_last_30d", 100.0).alias("ctr_last")
    ))


RATES = ["ctr", "engagement_rate", "scroll_rate", "ai_traffic_pct", "trend_pct"]


@case("derived_rates", f"{RAW} SELECT content_id, {rnd(*RATES)} FROM pages_raw")
def derived_rates(spark, sf):
    return r6(I.pages(spark, sf).select(
        "content_id", tiers.pct_rate("clicks_90d", "impressions_90d").alias("ctr"),
        tiers.pct_rate("engaged_sessions_90d", "sessions_90d").alias("engagement_rate"),
        tiers.pct_rate("scroll_events_90d", "pageviews_90d").alias("scroll_rate"),
        tiers.pct_rate("ai_sessions_90d", "sessions_90d").alias("ai_traffic_pct"),
        tiers.trend_pct("impressions_last_30d", "impressions_prev_30d").alias("trend_pct"),
    ))


@case(
    "days_between_cut",
    f"""WITH {DIM} SELECT content_hash_id, date_diff('day', content_created_date, last_day(DATE '1999-12-01')) AS content_age_days,
    date_diff('day', content_updated_date, last_day(DATE '1999-12-01')) AS days_since_update FROM dim""",
)
def days_between_cut(spark, sf):
    cut = F.last_day(F.lit("1999-12-01").cast("date"))
    days = lambda c: F.datediff(cut, c).cast("bigint")
    return I.dim(spark, sf).select(
        "content_hash_id", days("content_created_date").alias("content_age_days"),
        days("content_updated_date").alias("days_since_update"),
    )


@case("bucket_cut", f"{dev_scored()} SELECT content_hash_id, pos_tier FROM scored")
def bucket_cut(spark, sf):
    return I.frame(spark, sf).select("content_hash_id", tiers.position_bin("f_pos").alias("pos_tier"))


# ---- tiers ----------------------------------------------------------------

@case("tier_age", f"{RAW} SELECT content_id, age_tier, CAST(CASE age_tier WHEN '0-14' THEN 1 WHEN '15-30' THEN 2 WHEN '31-90' THEN 3 WHEN '91-180' THEN 4 WHEN '181-365' THEN 5 ELSE 6 END AS INTEGER) AS age_tier_order FROM pages_raw")
def tier_age(spark, sf):
    return I.pages(spark, sf).select(
        "content_id", tiers.age_tier("content_age_days").alias("age_tier"),
        tiers.age_tier_order("content_age_days").alias("age_tier_order"),
    )


@case("tier_freshness", f"{RAW} SELECT content_id, freshness_tier FROM pages_raw")
def tier_freshness(spark, sf):
    return I.pages(spark, sf).select("content_id", tiers.freshness_tier("days_since_last_update").alias("freshness_tier"))


@case("tier_words", f"{RAW} SELECT content_id, word_count_tier FROM pages_raw")
def tier_words(spark, sf):
    return I.pages(spark, sf).select("content_id", tiers.word_tier("word_count").alias("word_count_tier"))


@case(
    "tier_chars",
    """SELECT doc_id, CASE WHEN length(text) < 8000 THEN '<8000' WHEN length(text) < 15000 THEN '8000-15000'
    WHEN length(text) < 25000 THEN '15000-25000' ELSE '25000+' END AS char_count_tier FROM documents""",
)
def tier_chars(spark, sf):
    docs = standins.table(spark, sf, "documents")
    return docs.select("doc_id", tiers.char_tier(F.char_length("text")).alias("char_count_tier"))


@case("tier_impressions", f"{RAW} SELECT content_id, impression_tier FROM pages_raw")
def tier_impressions(spark, sf):
    tier = tiers.impression_tier("impressions_90d", C("impressions_90d").isNotNull())
    return I.pages(spark, sf).select("content_id", tier.alias("impression_tier"))


@case("tier_position", f"{RAW} SELECT content_id, position_tier FROM pages_raw")
def tier_position(spark, sf):
    return I.pages(spark, sf).select("content_id", tiers.position_tier("avg_position").alias("position_tier"))


@case(
    "trend_direction",
    """WITH w AS (SELECT CAST(user_id AS VARCHAR) AS item,
         SUM(CASE WHEN CAST(ts AS DATE) > b.d - 15 THEN 1 ELSE 0 END) AS l, SUM(CASE WHEN CAST(ts AS DATE) <= b.d - 15 THEN 1 ELSE 0 END) AS p
         FROM events, (SELECT MAX(CAST(ts AS DATE)) AS d FROM events) b GROUP BY 1)
       SELECT c_custkey AS user_id, CASE WHEN COALESCE(p, 0) = 0 AND COALESCE(l, 0) > 0 THEN 'new' WHEN COALESCE(p, 0) = 0 THEN 'flat'
         WHEN l > 1.2::DOUBLE * p THEN 'up' WHEN l < 0.8::DOUBLE * p THEN 'down' ELSE 'stable' END AS trend_direction
       FROM customer LEFT JOIN w ON CAST(c_custkey AS VARCHAR) = item""",
)
def trend_direction(spark, sf):
    from panelwright.plans.windows import momentum

    end = standins.last_event_day(spark, sf)
    moved = momentum(standins.events_daily(spark, sf, after=end - dt.timedelta(days=30)), days=15, floor=0, end=end)
    customers = standins.table(spark, sf, "customer").select(C("c_custkey").alias("user_id"))
    joined = customers.join(moved, C("user_id").cast("string") == C("content_hash_id"), "left")
    return joined.select("user_id", tiers.trend_direction("imp_last", "imp_prev").alias("trend_direction"))


# ---- codes and actions ----------------------------------------------------

@case("first_match_case", f"{dev_scored()} SELECT content_hash_id, reason_code FROM scored")
def first_match_case(spark, sf):
    base = I.frame(spark, sf)
    df = scoring.with_tier_median(base).crossJoin(F.broadcast(scoring.volatility_median(base)))
    cond = rules.panel_conditions(C("volatility_median"), C("tier_median_ctr"), I.VISIBLE)
    return df.select("content_hash_id", rules.panel_reason_code(cond).alias("reason_code"))


ACTION_CASE = (
    "CASE reason_code WHEN 'sliding_on_page_1_2' THEN 'review_now' WHEN 'low_ctr_for_position' THEN 'review_ctr' "
    "WHEN 'unstable_and_visible' THEN 'investigate_volatility' ELSE 'monitor' END"
)


@case("code_to_action", f"{dev_scored()} SELECT content_hash_id, {ACTION_CASE} AS action FROM scored")
def code_to_action(spark, sf):
    return I.scored(spark, sf).select("content_hash_id", rules.panel_action("reason_code").alias("action"))


@case("reason_codes_rule", f"WITH {BASELINE} SELECT content_id, reason_codes FROM baseline")
def reason_codes_rule(spark, sf):
    return I.prepared(spark, sf).select("content_id", rules.page_reason_text().alias("reason_codes"))


@case("reason_codes_merged", f"{FIN} SELECT content_id, final_reason_codes FROM final")
def reason_codes_merged(spark, sf):
    joined = I.baseline(spark, sf).join(I.predictions(spark, sf), "content_id")
    return joined.select("content_id", rules.merged_reason_codes().alias("final_reason_codes"))


PLAYBOOK_CODES = """COALESCE(NULLIF(concat_ws(',', CASE WHEN sliding THEN 'already_sliding' END, CASE WHEN shallow THEN 'shallow_and_exposed' END,
  CASE WHEN unstable THEN 'unstable_position' END, CASE WHEN visible THEN 'high_visibility' END,
  CASE WHEN intermittent THEN 'intermittent_visibility' END), ''), 'none')"""


@case("reason_codes_flags", f"{dev_scored()} SELECT content_hash_id, {PLAYBOOK_CODES} AS reason_codes FROM scored")
def reason_codes_flags(spark, sf):
    return scoring.playbook(I.scored(spark, sf), visible_at=I.VISIBLE).select("content_hash_id", "reason_codes")


@case(
    "action_from_reasons_baseline",
    f"""WITH {BASELINE}, b AS (SELECT content_id, string_split(reason_codes, '|') AS r FROM baseline)
    SELECT content_id, CASE WHEN list_contains(r, 'thin_visible_page') THEN 'expand_and_refresh'
      WHEN list_contains(r, 'low_ctr_visible_page') THEN 'refresh_and_review_ctr'
      WHEN list_contains(r, 'stale_visible_page') OR list_contains(r, 'declining_with_demand') THEN 'refresh'
      ELSE 'monitor' END AS suggested_action_baseline FROM b""",
)
def action_from_reasons_baseline(spark, sf):
    return I.baseline(spark, sf).select("content_id", rules.baseline_action().alias("suggested_action_baseline"))


@case("action_from_reasons_final", f"{FIN} SELECT content_id, suggested_action FROM final")
def action_from_reasons_final(spark, sf):
    return I.final(spark, sf).select("content_id", rules.final_action().alias("suggested_action"))


@case("confidence_band", f"{FIN} SELECT content_id, confidence FROM final")
def confidence_band(spark, sf):
    return scoring.with_confidence(I.final(spark, sf).drop("confidence")).select("content_id", "confidence")


ARCHETYPE = """CASE WHEN NOT deep AND sliding THEN 'slipping_frontrunner' WHEN NOT deep AND unstable THEN 'unstable_contender'
  WHEN NOT deep THEN 'stable_asset' ELSE 'deep_longtail' END"""


@case("archetype", f"{dev_scored()} SELECT content_hash_id, {ARCHETYPE} AS archetype FROM scored")
def archetype(spark, sf):
    return scoring.playbook(I.scored(spark, sf), visible_at=I.VISIBLE).select("content_hash_id", "archetype")


@case(
    "short_handles",
    "SELECT p_partkey, 'p' || right(CAST(p_partkey AS VARCHAR), 6) AS page, 'c' || right(p_brand, 4) AS client FROM part",
)
def short_handles(spark, sf):
    return standins.table(spark, sf, "part").select(
        "p_partkey", K.short_handle("p_partkey", "p", 6).alias("page"), K.short_handle("p_brand", "c", 4).alias("client")
    )


@case(
    "review_narrative",
    f"""{dev_scored()}, t AS (SELECT *, printf('%.1f', ROUND(f_pos, 1)) AS pos FROM scored)
    SELECT content_hash_id,
      CASE reason_code
        WHEN 'low_ctr_for_position' THEN 'CTR ' || printf('%.2f', ROUND(f_ctr, 2)) || '% is under the median of its position tier (average position ' || pos || ')'
        WHEN 'unstable_and_visible' THEN 'daily position varies by ' || printf('%.1f', ROUND(f_pos_volatility, 1)) || ' (standard deviation), ' || f_impressions || ' impressions'
        ELSE 'lost ' || COALESCE(printf('%.1f', ROUND(f_pos_trend, 1) + 0), '0.0') || ' positions from 1997 to 1999; now at ' || pos || ', ' || f_impressions || ' impressions' END AS why,
      CASE WHEN f_ctr = 0 THEN 'no click came from ' || f_impressions || ' impressions: nothing may be at stake'
        WHEN f_days_with_impressions < 60 THEN 'seen on ' || f_days_with_impressions || ' of 1095 days: the average may not hold'
        ELSE 'the first period was unusually good and this is the normal level' END AS wrong_if
    FROM t""",
)
def review_narrative(spark, sf):
    rows = I.scored(spark, sf).withColumn("f_pos_trend", F.coalesce("f_pos_trend", F.lit(0.0)))
    return rows.select(
        "content_hash_id", rules.narrative_why("from 1997 to 1999").alias("why"),
        rules.narrative_wrong_if(1095).alias("wrong_if"),
    )


@case(
    "readable_codes",
    f"""{FIN} SELECT content_id, CASE suggested_action WHEN 'refresh_and_review_ctr' THEN 'refresh + CTR'
      WHEN 'refresh_and_review_engagement' THEN 'refresh + engagement' WHEN 'expand_and_refresh' THEN 'expand + refresh'
      ELSE suggested_action END AS action_label, replace(replace(final_reason_codes, '_', ' '), '|', ', ') AS reasons FROM final""",
)
def readable_codes(spark, sf):
    return I.final(spark, sf).select(
        "content_id", rules.readable_action("suggested_action").alias("action_label"),
        rules.readable_codes("final_reason_codes").alias("reasons"),
    )


@case("cross_column_value", f"{RAW} SELECT content_id, {rnd('cpc * clicks_90d AS traffic_value')} FROM pages_raw")
def cross_column_value(spark, sf):
    return r6(I.pages(spark, sf).select("content_id", (C("cpc") * C("clicks_90d")).alias("traffic_value")))


@case(
    "hand_rule_score",
    f"""{PREP} SELECT content_id, CAST(CASE WHEN days_since_last_update >= 180 AND impressions_90d >= 500 THEN 1 ELSE 0 END * impressions_90d AS BIGINT)
    AS hand_score FROM prepared""",
)
def hand_rule_score(spark, sf):
    stale_visible = (C("days_since_last_update") >= rules.STALE_DAYS) & (C("impressions_90d") >= rules.STALE_IMPRESSIONS)
    return I.prepared(spark, sf).select("content_id", (stale_visible.cast("bigint") * C("impressions_90d")).alias("hand_score"))

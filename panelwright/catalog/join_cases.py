"""Joins and set operations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from panelwright.catalog import inputs as I
from panelwright.catalog.base_sql import (
    BASELINE, CLIENTS, DIM, EVENTS, FACT, FINAL, HAS, PREPARED, QUERIES, both_scored, frame, rnd, windows,
)
from panelwright.catalog.registry import case, r6
from panelwright.functions import rules
from panelwright.operators import joins as J, splits as S
from panelwright.operators.ordering import union_all
from panelwright.plans import windows as W
from panelwright.sources import standins

C = F.col


@case(
    "join_windows_inner",
    f"""WITH {FACT}, {windows('dev')} SELECT content_hash_id, f_impressions, {rnd('f_pos')}, o_impressions, {rnd('o_pos')}
    FROM before_dev JOIN after_dev USING (content_hash_id)""",
)
def join_windows_inner(spark, sf):
    split = I.split_of("dev")
    fact = I.fact(spark, sf, split)
    joined = J.join_windows(W.feature_window(fact, split), W.outcome_window(fact, split), "content_hash_id")
    return r6(joined.select("content_hash_id", "f_impressions", "f_pos", "o_impressions", "o_pos"))


@case(
    "join_dim_left",
    f"""WITH {FACT}, {DIM}, {windows('dev')} SELECT content_hash_id, client_hash_id, content_type, o_impressions
    FROM after_dev LEFT JOIN dim USING (content_hash_id)""",
)
def join_dim_left(spark, sf):
    split = I.split_of("dev")
    items = W.outcome_window(I.fact(spark, sf, split), split)
    return J.attach_dimension(items, I.dim(spark, sf), "content_hash_id").select(
        "content_hash_id", "client_hash_id", "content_type", "o_impressions"
    )


@case(
    "join_queue_sources",
    f"WITH {FINAL} SELECT content_id, {rnd('baseline_refresh_score', 'p AS best_model_probability')}, content_type, age_tier FROM final",
)
def join_queue_sources(spark, sf):
    context = I.prepared(spark, sf).select("content_id", "content_type", "age_tier")
    base = I.baseline(spark, sf).select("content_id", "baseline_refresh_score")
    joined = base.join(I.predictions(spark, sf), "content_id", "left").join(context, "content_id", "left")
    return r6(joined)


@case(
    "join_query_signals",
    f"""WITH {frame('dev')}, {QUERIES}, mix AS (SELECT content_hash_id, COUNT(*) AS visible_queries, MIN(rare_impressions_share) AS rare_share,
      MAX(impressions_90d) / SUM(impressions_90d) AS top_query_share FROM queries GROUP BY content_hash_id)
    SELECT content_hash_id, f_impressions, visible_queries, {rnd('rare_share', 'top_query_share')} FROM frame_dev LEFT JOIN mix USING (content_hash_id)""",
)
def join_query_signals(spark, sf):
    mix = W.query_mix(standins.query_fact(spark, sf))
    joined = I.frame(spark, sf).join(mix, "content_hash_id", "left")
    return r6(joined.select("content_hash_id", "f_impressions", "visible_queries", "rare_share", "top_query_share"))


@case(
    "lookup_fill_zero",
    f"""WITH {BASELINE} SELECT d.content_hash_id AS content_id, {rnd('COALESCE(baseline_refresh_score, 0) AS baseline_refresh_score')}
    FROM dim d LEFT JOIN baseline b ON d.content_hash_id = b.content_id""",
)
def lookup_fill_zero(spark, sf):
    items = I.dim(spark, sf).select(C("content_hash_id").alias("content_id"))
    return r6(J.lookup_or_zero(items, I.baseline(spark, sf), "content_id", "baseline_refresh_score"))


@case(
    "cross_join_bounds",
    f"""WITH {EVENTS}, b AS (SELECT MAX(report_date) AS end_d FROM ev)
    SELECT content_hash_id, end_d, CAST(COUNT(*) FILTER (WHERE report_date > end_d - 15) AS BIGINT) AS recent FROM ev, b GROUP BY 1, 2""",
)
def cross_join_bounds(spark, sf):
    ev = standins.events_daily(spark, sf)
    rows = J.attach_bounds(ev, W.last_day(ev))
    return rows.groupBy("content_hash_id", "end_d").agg(
        F.count_if(C("report_date") > F.date_sub("end_d", 15)).alias("recent")
    )


@case(
    "theta_window_join",
    f"""WITH {FACT}, b AS (SELECT MAX(report_date) AS end_d FROM fact)
    SELECT content_hash_id, COUNT(*) AS n, MIN(report_date) AS first_day FROM fact, b WHERE report_date > end_d - 60 GROUP BY 1""",
)
def theta_window_join(spark, sf):
    end = standins.last_fact_day(spark, sf)
    recent = standins.fact_daily(spark, sf, str(end - dt.timedelta(days=59)), str(end))
    rows = W.in_last_days(recent, 60, end)
    return rows.groupBy("content_hash_id").agg(F.count(F.lit(1)).alias("n"), F.min("report_date").alias("first_day"))


HELD_OUT = ["Brand#1", "Brand#2", "Brand#3", "Brand#4", "Brand#5"]
HELD_SQL = ", ".join(f"'{b}'" for b in HELD_OUT)


@case(
    "anti_join_unseen_groups",
    f"""{both_scored()} SELECT content_hash_id, client_hash_id FROM sealed WHERE client_hash_id NOT IN
    (SELECT client_hash_id FROM dev WHERE client_hash_id NOT IN ({HELD_SQL}))""",
)
def anti_join_unseen_groups(spark, sf):
    train = I.frame(spark, sf).where(~C("client_hash_id").isin(HELD_OUT))
    unseen = J.unseen_groups(I.frame(spark, sf, "sealed"), train, "client_hash_id")
    return unseen.select("content_hash_id", "client_hash_id")


SHUFFLED = """g AS (SELECT client_hash_id, ROW_NUMBER() OVER (ORDER BY md5('42:' || client_hash_id), client_hash_id) AS rn,
  COUNT(*) OVER () AS n FROM (SELECT DISTINCT client_hash_id FROM frame_dev)),
test_groups AS (SELECT client_hash_id FROM g WHERE rn <= GREATEST(1, CAST(ROUND(n * 0.2::DOUBLE) AS BIGINT)))"""


@case(
    "semi_join_test_groups",
    f"WITH {frame('dev')}, {SHUFFLED} SELECT content_hash_id, client_hash_id FROM frame_dev WHERE client_hash_id IN (SELECT client_hash_id FROM test_groups)",
)
def semi_join_test_groups(spark, sf):
    df = I.frame(spark, sf).select("content_hash_id", "client_hash_id")
    return J.within_groups(df, S.holdout_groups(df, "client_hash_id", 0.2, 42), "client_hash_id")


@case(
    "group_overlap_check",
    f"""WITH {frame('dev')}, {SHUFFLED} SELECT COUNT(*) AS overlapping, COUNT(*) = 0 AS ok FROM (
      SELECT client_hash_id FROM frame_dev WHERE client_hash_id IN (SELECT * FROM test_groups)
      INTERSECT SELECT client_hash_id FROM frame_dev WHERE client_hash_id NOT IN (SELECT * FROM test_groups))""",
)
def group_overlap_check(spark, sf):
    marked = S.group_shuffle_split(I.frame(spark, sf), "client_hash_id", 0.2, 42)
    overlap = J.group_overlap(marked.where("split = 'train'"), marked.where("split = 'test'"), "client_hash_id")
    return overlap.agg(F.count(F.lit(1)).alias("overlapping")).withColumn("ok", C("overlapping") == 0)


@case(
    "per_client_window_join",
    f"""WITH {CLIENTS}, o AS (SELECT c_nationkey, CAST(o_orderdate AS DATE) AS d, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey)
    SELECT client_hash_id, COUNT(*) AS n, MIN(d) AS first_day FROM o JOIN clients ON c_nationkey = client_key WHERE d >= gsc_data_start GROUP BY 1""",
)
def per_client_window_join(spark, sf):
    customers = standins.table(spark, sf, "customer").select(C("c_custkey").alias("o_custkey"), "c_nationkey")
    orders = standins.table(spark, sf, "orders").join(customers, "o_custkey")
    fact = orders.select(C("c_nationkey").alias("client_key"), C("o_orderdate").cast("date").alias("report_date"))
    clients = standins.dim_clients(spark, sf)
    rows = J.per_client_window(fact, clients, "client_key", "gsc_data_start", "report_date")
    named = rows.groupBy("client_key").agg(F.count(F.lit(1)).alias("n"), F.min("report_date").alias("first_day"))
    return named.join(clients, "client_key").select("client_hash_id", "n", "first_day")


@case(
    "sibling_absorption",
    f"""WITH {PREPARED}, i AS (SELECT content_hash_id, client_hash_id, keyword_hash_id, impressions_prev_30d AS b, impressions_last_30d AS a
      FROM dim JOIN pages0 USING (content_hash_id)),
    s AS (SELECT *, a - b AS own_delta, CAST(SUM(a - b) OVER (PARTITION BY client_hash_id, keyword_hash_id) - (a - b) AS BIGINT) AS sibling_delta,
      COUNT(*) OVER (PARTITION BY client_hash_id, keyword_hash_id) AS group_items FROM i)
    SELECT content_hash_id, own_delta, sibling_delta, group_items, CASE WHEN own_delta < 0 AND sibling_delta >= -own_delta THEN 1 ELSE 0 END AS absorbed FROM s""",
)
def sibling_absorption(spark, sf):
    pages = I.pages(spark, sf).where("impressions_90d IS NOT NULL")
    keys = I.dim(spark, sf).select("content_hash_id", "client_hash_id", "keyword_hash_id")
    items = pages.join(keys, C("content_id") == C("content_hash_id"))
    moved = J.sibling_movement(items, ["client_hash_id", "keyword_hash_id"], "impressions_prev_30d", "impressions_last_30d")
    return moved.select("content_hash_id", "own_delta", "sibling_delta", "group_items", "absorbed")


# ---- set operations ---------------------------------------------------------

@case(
    "reason_set_intersection",
    f"WITH {FINAL} SELECT content_id, {HAS('model_decline_risk')} OR {HAS('stale_visible_page')} AS urgent FROM final",
)
def reason_set_intersection(spark, sf):
    hit = rules.has_any(rules.code_set("final_reason_codes"), ["model_decline_risk", "stale_visible_page"])
    return I.final(spark, sf).select("content_id", hit.alias("urgent"))


@case(
    "groups_intersect",
    "SELECT user_id AS key FROM events INTERSECT SELECT o_custkey FROM orders",
)
def groups_intersect(spark, sf):
    a = standins.table(spark, sf, "events").select(C("user_id").alias("key"))
    return J.group_overlap(a, standins.table(spark, sf, "orders").select(C("o_custkey").alias("key")), "key")


@case("groups_except", "SELECT o_custkey AS key FROM orders EXCEPT SELECT user_id FROM events")
def groups_except(spark, sf):
    a = standins.table(spark, sf, "orders").select(C("o_custkey").alias("key"))
    return J.groups_only_in(a, standins.table(spark, sf, "events").select(C("user_id").alias("key")), "key")


@case(
    "metric_rows_union",
    f"""{both_scored()} SELECT 'dev' AS evaluation, COUNT(*) AS n, ROUND(AVG(is_position_decline) + 1e-9, 6) AS base_rate FROM dev
    UNION ALL SELECT 'sealed', COUNT(*), ROUND(AVG(is_position_decline) + 1e-9, 6) FROM sealed""",
)
def metric_rows_union(spark, sf):
    row = lambda name: I.frame(spark, sf, name).agg(
        F.count(F.lit(1)).alias("n"), F.avg("is_position_decline").alias("base_rate")
    ).withColumn("evaluation", F.lit(name))
    return r6(union_all([row("dev"), row("sealed")]))

"""Panel-shaped views over the test tables: projections and simple group-bys only.

The library never depends on these; they let every operator run on the given
star-schema tables (see FIXTURES.md).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwright.functions import tiers
from panelwright.sources import tables

C = F.col
DAY0 = dt.date(2000, 12, 31)      # decision day of the page table
YEAR_WORDS = range(6)             # words of 63 bits that hold the days of a year


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def fact_daily(spark: SparkSession, sf: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Daily fact from lineitem. Bounds apply to the raw ship date so they reach
    the Parquet scan as pushed filters."""
    li = table(spark, sf, "lineitem")
    if start:
        li = li.where(C("l_shipdate") >= F.lit(start).cast("timestamp_ntz"))
    if end:
        li = li.where(C("l_shipdate") < F.lit(end).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY"))
    q, disc, price = C("l_quantity"), C("l_discount"), C("l_extendedprice")
    clicks = F.when(C("l_returnflag") == "R", F.floor(q * disc * 5)).otherwise(F.floor(q * disc))
    line, year = C("l_linenumber"), F.year("l_shipdate").cast("string")
    return li.select(
        C("l_partkey").cast("string").alias("content_hash_id"),
        C("l_suppkey").cast("string").alias("query_hash_id"),
        C("l_shipdate").cast("date").alias("report_date"),
        F.concat_ws("-", year, F.lpad(F.month("l_shipdate").cast("string"), 2, "0")).alias("month"),
        year.alias("year"),
        q.cast("bigint").alias("gsc_impressions"),
        clicks.cast("bigint").alias("gsc_clicks"),
        (price / 100).alias("gsc_sum_position"),
        F.try_divide(price / 100, q).alias("gsc_avg_position"),
        F.when(line == 7, None).when(line == 6, False).otherwise(True).alias("gsc_data_available"),
        F.when(line == 1, None).when(line == 2, False).otherwise(True).alias("ga4_data_available"),
        F.when(C("l_linestatus") == "O", 1).otherwise(0).cast("bigint").alias("sessions_ai"),
    )


def with_clients(fact: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    """The fact's own client column: the brand of the part."""
    part = table(spark, sf, "part").select(
        C("p_partkey").cast("string").alias("content_hash_id"), C("p_brand").alias("client_hash_id"))
    return fact.join(part, "content_hash_id", "left")


def dim_content(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    key, size, name = C("p_partkey"), C("p_size"), C("p_name")
    return p.select(
        key.cast("string").alias("content_hash_id"),
        C("p_brand").alias("client_hash_id"),
        name.alias("keyword_hash_id"),
        C("p_type").alias("content_type"),
        F.split(name, " ")[0].alias("main_intent"),
        F.when(size <= 15, "low").when(size <= 35, "medium").when(size <= 45, "high").alias("competition_level"),
        C("p_retailprice").alias("search_volume"),
        (size / 50.0).alias("competition"),
        F.when(key % 4 != 0, (key % 40) / 4.0).alias("cpc"),
        F.when(key % 3 != 0, (key % 100).cast("double")).alias("backlinks"),
        F.when(size % 10 != 0, size * 100.0).alias("word_count"),
        F.when(size % 10 != 0, size * 640.0).alias("char_count"),
        F.size(F.split(name, " ")).cast("double").alias("keyword_token_count"),
        F.date_add(F.lit(dt.date(1994, 1, 1)), (key % 1000).cast("int")).alias("content_created_date"),
        F.date_add(F.lit(dt.date(1998, 1, 1)), ((key * 7) % 1500).cast("int")).alias("content_updated_date"),
    )


def dim_clients(spark: SparkSession, sf: str) -> DataFrame:
    """Clients (nations) with the first day of their own history, null for some."""
    n = table(spark, sf, "nation")
    key = C("n_nationkey")
    return n.select(
        C("n_name").alias("client_hash_id"),
        key.alias("client_key"),
        F.when(key % 5 != 0, F.date_add(F.lit(dt.date(1998, 1, 1)), key * 40)).alias("gsc_data_start"),
    )


def query_fact(spark: SparkSession, sf: str) -> DataFrame:
    """(item, query) grain with per-item context repeated on every row."""
    li = table(spark, sf, "lineitem")
    q = C("l_quantity").cast("bigint")
    pair = li.groupBy("l_partkey", "l_suppkey").agg(
        F.sum(q).alias("impressions_90d"),
        F.sum(F.when(C("l_returnflag") == "N", q).otherwise(0)).alias("rare"),
        F.sum(F.when(C("l_linestatus") == "O", q).otherwise(0)).alias("anon"),
    )
    # Item totals come from the pairs, not from a second pass over the lines.
    item = pair.groupBy("l_partkey").agg(
        F.sum("impressions_90d").alias("content_total"), F.sum("rare").alias("rare"), F.sum("anon").alias("anon")
    )
    return pair.drop("rare", "anon").join(item, "l_partkey").select(
        C("l_partkey").cast("string").alias("content_hash_id"),
        C("l_suppkey").cast("string").alias("query_hash_id"),
        "impressions_90d",
        C("content_total").alias("content_total_impressions_90d"),
        F.try_divide("rare", "content_total").alias("rare_impressions_share"),
        F.try_divide("anon", "content_total").alias("anonymized_impressions_share"),
    )


def last_event_day(spark: SparkSession, sf: str) -> dt.date:
    """Newest day of the events, from file footers; of an empty table a day before all others."""
    last = tables.newest(spark, f"{sf}/events.parquet", "ts")
    return last.date() if last else dt.date(1970, 1, 1)


def last_fact_day(spark: SparkSession, sf: str) -> dt.date:
    last = tables.newest(spark, f"{sf}/lineitem.parquet", "l_shipdate")
    return last.date() if last else dt.date(1970, 1, 1)


def events_daily(spark: SparkSession, sf: str, after: dt.date | None = None) -> DataFrame:
    """Event rows as a 30-day panel: one impression per event. ``after`` keeps
    later days only and reaches the scan as a pushed filter."""
    e = table(spark, sf, "events")
    if after is not None:
        e = e.where(C("ts") >= F.lit(after + dt.timedelta(days=1)).cast("timestamp_ntz"))
    return e.select(
        C("user_id").cast("string").alias("content_hash_id"),
        C("ts").cast("date").alias("report_date"),
        F.lit(1).cast("bigint").alias("gsc_impressions"),
        (C("event_type") == "click").cast("bigint").alias("gsc_clicks"),
        C("value").alias("gsc_avg_position"),
    )


def page_table(spark: SparkSession, sf: str) -> DataFrame:
    """Raw page table: one row per part, nulls where a part has no lines."""
    fact = table(spark, sf, "lineitem").where(
        (C("l_shipdate") >= F.expr("TIMESTAMP_NTZ'1998-01-01'"))
        & (C("l_shipdate") < F.expr("TIMESTAMP_NTZ'2001-01-01'"))
    )
    q = C("l_quantity").cast("bigint")
    clicks = F.when(C("l_returnflag") == "R", F.floor(C("l_quantity") * C("l_discount") * 5)).otherwise(
        F.floor(C("l_quantity") * C("l_discount"))
    ).cast("bigint")
    late = C("l_shipdate") >= F.expr("TIMESTAMP_NTZ'2000-01-01'")
    mid = (C("l_shipdate") >= F.expr("TIMESTAMP_NTZ'1999-01-01'")) & ~late
    when0 = lambda cond, v: F.sum(F.when(cond, v).otherwise(0))
    day = C("l_shipdate").cast("date")
    lines = fact.withColumns({"__year": F.year(day), "__word": F.expr("dayofyear(l_shipdate) div 63"), "__bit": F.dayofyear(day) % 63})
    seen = lambda cond, name: [
        F.bit_or(F.when(cond & (C("__word") == w), F.expr("shiftleft(1L, __bit)")).otherwise(0)).alias(f"{name}{w}") for w in YEAR_WORDS]
    # Lines of a part and year meet before they are aggregated, and their days are bits: a task holds one entry for each of
    # its parts and years, not one for each line and distinct count.
    yearly = lines.repartition("l_partkey", "__year").groupBy(C("l_partkey").alias("p_partkey"), "__year").agg(
        F.sum(q).alias("impressions_90d"),
        F.sum(clicks).alias("clicks_90d"),
        F.count(F.lit(1)).alias("lines"),
        when0(C("l_returnflag") == "N", 3).alias("engaged_sessions_90d"),
        when0((C("l_linestatus") == "O") & (C("l_linenumber") <= 2), 1).alias("ai_sessions_90d"),
        when0(C("l_tax") > 0.03, 5).alias("scroll_events_90d"),
        *seen(F.lit(True), "__all"),
        *seen(C("l_tax") > 0.02, "__taxed"),
        when0(late, 4).alias("sessions_last_30d"),
        when0(mid, 4).alias("sessions_prev_30d"),
        when0(late, q).alias("impressions_last_30d"),
        when0(mid, q).alias("impressions_prev_30d"),
        when0(late, clicks).alias("clicks_last_30d"),
        when0(mid, clicks).alias("clicks_prev_30d"),
        F.sum(C("l_extendedprice") / 100).alias("sum_position"),
    )
    days = lambda name: F.sum(sum((F.bit_count(f"{name}{w}") for w in YEAR_WORDS), F.lit(0)))
    total = lambda name: F.sum(name).alias(name)
    agg = yearly.groupBy("p_partkey").agg(
        total("impressions_90d"),
        total("clicks_90d"),
        (F.sum("lines") * 9).alias("pageviews_90d"),
        (F.sum("lines") * 4).alias("sessions_90d"),
        total("engaged_sessions_90d"), total("ai_sessions_90d"), total("scroll_events_90d"),
        days("__all").alias("days_with_impressions"),
        days("__taxed").alias("days_with_sessions"),
        (F.sum("lines") * 3).alias("users_90d"),
        total("sessions_last_30d"), total("sessions_prev_30d"),
        total("impressions_last_30d"), total("impressions_prev_30d"),
        total("clicks_last_30d"), total("clicks_prev_30d"),
        total("sum_position"),
    )
    dim = dim_content(spark, sf)
    j = dim.join(agg.withColumn("p_partkey", C("p_partkey").cast("string")), dim.content_hash_id == C("p_partkey"), "left")
    position = F.round(F.try_divide("sum_position", "impressions_90d"), 1)
    age = F.datediff(F.lit(DAY0), "content_created_date")
    update = F.when(C("content_updated_date") <= F.lit(DAY0), F.datediff(F.lit(DAY0), "content_updated_date"))
    last, prev = C("impressions_last_30d"), C("impressions_prev_30d")
    return j.select(
        C("content_hash_id").alias("content_id"),
        C("client_hash_id").alias("client_id"),
        "content_type", "main_intent", "competition_level",
        "search_volume", "competition", "cpc", "word_count", "char_count",
        "impressions_90d", "clicks_90d", "pageviews_90d", "sessions_90d", "engaged_sessions_90d",
        "ai_sessions_90d", "scroll_events_90d", "days_with_impressions", "days_with_sessions", "users_90d",
        "sessions_last_30d", "sessions_prev_30d",
        "impressions_last_30d", "impressions_prev_30d", "clicks_last_30d", "clicks_prev_30d",
        age.alias("content_age_days"),
        update.alias("days_since_last_update"),
        tiers.pct_rate("clicks_90d", "impressions_90d").alias("ctr"),
        F.coalesce(position, F.lit(0.0)).alias("avg_position"),
        tiers.pct_rate("engaged_sessions_90d", "sessions_90d").alias("engagement_rate"),
        tiers.pct_rate("scroll_events_90d", "pageviews_90d").alias("scroll_rate"),
        tiers.pct_rate("ai_sessions_90d", "sessions_90d").alias("ai_traffic_pct"),
        tiers.trend_pct(last, prev).alias("trend_pct"),
        tiers.age_tier(age).alias("age_tier"),
        tiers.age_tier_order(age).alias("age_tier_order"),
        tiers.freshness_tier(update).alias("freshness_tier"),
        tiers.word_tier("word_count").alias("word_count_tier"),
        tiers.char_tier("char_count").alias("char_count_tier"),
        tiers.impression_tier("impressions_90d", C("impressions_90d").isNotNull()).alias("impression_tier"),
        tiers.position_tier(position).alias("position_tier"),
        tiers.trend_direction(last, prev).alias("trend_direction"),
    )

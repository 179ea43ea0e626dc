"""Feature/outcome windows and the modeling frame built from them."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from panelwright.functions.cleaning import is_true, safe_ratio
from panelwright.functions.tiers import label_drop_ratio, label_pct_drop, label_position_decline

C = F.col


@dataclass(frozen=True)
class Split:
    """Feature periods and the strictly later outcome period.

    Periods are values of ``period`` ('YYYY-MM' months or 'YYYY' years), so the
    selection is a partition filter on a partitioned fact.
    """

    name: str
    feature_periods: tuple[str, ...]
    outcome_period: str
    period: str = "month"

    def __post_init__(self):
        if max(self.feature_periods) >= self.outcome_period:
            raise ValueError("the outcome period must follow every feature period")

    @property
    def first(self) -> str:
        return min(self.feature_periods)

    @property
    def last(self) -> str:
        return max(self.feature_periods)

    @property
    def start_date(self) -> dt.date:
        return _first_day(self.first)

    @property
    def cut_date(self) -> dt.date:
        """Decision moment: the last day of the last feature period."""
        return _next_start(self.last) - dt.timedelta(days=1)

    @property
    def end_date(self) -> dt.date:
        return _next_start(self.outcome_period) - dt.timedelta(days=1)


def _first_day(period: str) -> dt.date:
    parts = [int(x) for x in period.split("-")]
    return dt.date(parts[0], parts[1] if len(parts) > 1 else 1, 1)


def _next_start(period: str) -> dt.date:
    day = _first_day(period)
    if len(period) == 4:
        return dt.date(day.year + 1, 1, 1)
    return dt.date(day.year + day.month // 12, day.month % 12 + 1, 1)


# The two published splits, and volume floors.
MONTH_SPLITS = {
    "dev": Split("dev", ("2026-01", "2026-02", "2026-03"), "2026-04"),
    "sealed": Split("sealed", ("2026-03", "2026-04", "2026-05"), "2026-06"),
}
YEAR_SPLITS = {
    "dev": Split("dev", ("1997", "1998", "1999"), "2000", "year"),
    "sealed": Split("sealed", ("1998", "1999", "2000"), "2001", "year"),
}


@dataclass(frozen=True)
class Floors:
    feature_impressions: int = 100
    outcome_impressions: int = 30
    decline: float = 1.0


ID, CLIENT = "content_hash_id", "client_hash_id"
STATIC_COLUMNS = [
    "content_type", "main_intent", "competition_level", "search_volume", "competition",
    "cpc", "backlinks", "word_count", "char_count", "keyword_token_count",
]


MASK_DAYS = 512


def weighted_position(where: Column | None = None) -> Column:
    """Impression-weighted position: sum over sum, never a mean of rates."""
    num, den = C("gsc_sum_position"), C("gsc_impressions")
    if where is not None:
        num, den = F.when(where, num), F.when(where, den)
    return F.try_divide(F.sum(num), F.sum(den))


def distinct_days(split: Split, active: Column) -> Column:
    """Number of distinct feature-window days with an ``active`` row.

    A window of some months is a known, short range of days, so days are bits
    of a few longs that merge with ``bit_or``: one shuffle, full map-side
    combine, and no second grouping by day as ``count(distinct)`` needs. Both
    are exact; windows of more than ``MASK_DAYS`` use the plain form.
    """
    length = (split.cut_date - split.start_date).days + 1
    if length > MASK_DAYS:
        return F.count_distinct(F.when(active, C("report_date")))
    day = F.datediff("report_date", F.lit(split.start_date))
    total = F.lit(0)
    for first in range(0, length, 64):
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (day - first).cast("int"))
        word = F.bit_or(F.when(active & day.between(first, first + 63), bit))
        total = total + F.bit_count(F.coalesce(word, F.lit(0).cast("bigint")))
    return total.cast("bigint")


def _feature_aggs(split: Split, where: Column | None = None) -> list[Column]:
    """Feature-window aggregates, optionally restricted to ``where`` rows."""
    pick = (lambda c: c) if where is None else (lambda c: F.when(where, c))
    active = C("gsc_impressions") > 0
    return [
        F.sum(pick(C("gsc_impressions"))).alias("f_impressions"),
        F.sum(pick(C("gsc_clicks"))).alias("f_clicks"),
        weighted_position(where).alias("f_pos"),
        distinct_days(split, active if where is None else where & active).alias("f_days_with_impressions"),
        F.stddev_samp(pick(F.when(active, C("gsc_avg_position")))).alias("f_pos_volatility"),
        (
            weighted_position(C(split.period) == split.last) - weighted_position(C(split.period) == split.first)
        ).alias("f_pos_trend"),
    ]


def _outcome_aggs(where: Column | None = None) -> list[Column]:
    imps = C("gsc_impressions") if where is None else F.when(where, C("gsc_impressions"))
    return [F.sum(imps).alias("o_impressions"), weighted_position(where).alias("o_pos")]


def feature_window(fact: DataFrame, split: Split, key: str = ID) -> DataFrame:
    rows = fact.where(C(split.period).isin(list(split.feature_periods)) & is_true("gsc_data_available"))
    return rows.groupBy(key).agg(*_feature_aggs(split))


def outcome_window(fact: DataFrame, split: Split, key: str = ID) -> DataFrame:
    rows = fact.where((C(split.period) == split.outcome_period) & is_true("gsc_data_available"))
    return rows.groupBy(key).agg(*_outcome_aggs())


def both_windows(fact: DataFrame, split: Split, key: str = ID) -> DataFrame:
    """Feature and outcome aggregates in one scan and one grouping.

    Equal to joining ``feature_window`` and ``outcome_window`` on the key, with
    no join: a row belongs to exactly one window, so conditional aggregates
    separate them, and keys absent from either side have a null sum there. An
    item's client is carried from the fact when the fact names one.
    """
    periods = [*split.feature_periods, split.outcome_period]
    rows = fact.where(C(split.period).isin(periods) & is_true("gsc_data_available"))
    outcome = C(split.period) == split.outcome_period
    client = [F.min(CLIENT).alias(CLIENT)] if CLIENT in fact.columns else []
    out = rows.groupBy(key).agg(*client, *_feature_aggs(split, ~outcome), *_outcome_aggs(outcome))
    return out.where(C("f_impressions").isNotNull() & C("o_impressions").isNotNull())


def modeling_frame(fact: DataFrame, dim: DataFrame, split: Split, floors: Floors = Floors()) -> DataFrame:
    """One row per item: features, static metadata, ages at the cut, label block.

    Aggregation and the volume floors come before the dimension join, so only
    surviving items are joined. The join side is left to the planner. The
    client comes from the fact, so an item absent from the dimension keeps it.
    """
    items = both_windows(fact, split).where(
        (C("f_impressions") >= floors.feature_impressions) & (C("o_impressions") >= floors.outcome_impressions)
    )
    cut = F.lit(split.cut_date)
    own = [] if CLIENT in items.columns else [CLIENT]
    meta = dim.select(
        ID, *own, *STATIC_COLUMNS,
        F.datediff(cut, "content_created_date").alias("content_age_days"),
        F.datediff(cut, "content_updated_date").alias("days_since_update"),
    )
    return items.join(meta, ID, "left").select(
        ID, "client_hash_id", "f_impressions", "f_clicks", "f_pos",
        safe_ratio("f_clicks", "f_impressions", 100.0).alias("f_ctr"),
        "f_days_with_impressions", "f_pos_volatility", "f_pos_trend",
        *STATIC_COLUMNS, "content_age_days", "days_since_update",
        "o_impressions", "o_pos",
        (C("o_pos") - C("f_pos")).alias("pos_delta"),
        label_position_decline("o_pos", "f_pos", floors.decline).alias("is_position_decline"),
    )


def five_feature_frame(fact: DataFrame, dim: DataFrame, split: Split, floors: Floors = Floors()) -> DataFrame:
    """Contract frame: one feature period, five features, next-period label."""
    return modeling_frame(fact, dim, split, floors).select(
        ID, "client_hash_id", "f_pos", "f_impressions", "f_ctr", "f_pos_volatility",
        "f_days_with_impressions", "o_pos", "pos_delta", "is_position_decline",
    )


# ---- momentum ------------------------------------------------------------

def last_day(fact: DataFrame, date: str = "report_date") -> DataFrame:
    return fact.agg(F.max(date).alias("end_d"))


def latest_day(fact: DataFrame, date: str = "report_date") -> dt.date:
    """The newest day as a value: one row, fetched so that the range that
    depends on it can prune partitions and row groups."""
    return last_day(fact, date).first()["end_d"]


def in_last_days(fact: DataFrame, days: int, end: dt.date | None = None) -> DataFrame:
    """Rows of the last ``days`` days, with the anchor as ``end_d``.

    A known ``end`` gives a literal range that reaches the scan (and prunes
    partitions); otherwise the one-row bound is broadcast.
    """
    if end is not None:
        start = end - dt.timedelta(days=days)
        return fact.where(C("report_date") > F.lit(start)).withColumn("end_d", F.lit(end))
    bounded = fact.crossJoin(F.broadcast(last_day(fact)))
    return bounded.where(C("report_date") > F.date_sub("end_d", days))


def momentum(fact: DataFrame, days: int = 30, floor: int = 100, end: dt.date | None = None) -> DataFrame:
    """Last window against the one before it, per item."""
    rows = in_last_days(fact, 2 * days, end)
    recent = C("report_date") > F.date_sub("end_d", days)
    total = lambda cond, c: F.sum(F.when(cond, C(c)).otherwise(0))
    out = rows.groupBy(ID).agg(
        total(recent, "gsc_impressions").alias("imp_last"),
        total(~recent, "gsc_impressions").alias("imp_prev"),
        total(recent, "gsc_clicks").alias("clk_last"),
        F.avg(F.when(recent, C("gsc_avg_position"))).alias("pos_last"),
    )
    return out.where(C("imp_prev") >= floor)


def momentum_volatility(fact: DataFrame, days: int = 90, floor: int = 500, end: dt.date | None = None) -> DataFrame:
    """Longer variant with volatility of the earlier window and a drop label."""
    rows = in_last_days(fact, 2 * days, end)
    recent = C("report_date") > F.date_sub("end_d", days)
    total = lambda cond, c: F.sum(F.when(cond, C(c)).otherwise(0))
    prev_pos = F.when(~recent, C("gsc_avg_position"))
    out = rows.groupBy(ID).agg(
        total(~recent, "gsc_impressions").alias("imp_prev"),
        F.avg(prev_pos).alias("pos_prev"),
        F.coalesce(F.stddev_samp(prev_pos), F.lit(0.0)).alias("pos_volatility_prev"),
        total(recent, "gsc_impressions").alias("imp_last"),
        total(recent, "gsc_clicks").alias("clk_last"),
        F.avg(F.when(recent, C("gsc_avg_position"))).alias("pos_last"),
    )
    return out.where(C("imp_prev") >= floor).withColumn(
        "is_declining_label", label_pct_drop("imp_last", "imp_prev", 0.10)
    )


def momentum_labels(momentum_frame: DataFrame) -> DataFrame:
    return momentum_frame.withColumn("is_declining", label_drop_ratio("imp_last", "imp_prev", 0.8))


def query_mix(queries: DataFrame, key: str = ID) -> DataFrame:
    """How an item earns its impressions. Context columns repeat per row: take
    one, never sum them."""
    return queries.groupBy(key).agg(
        F.count(F.lit(1)).alias("visible_queries"),
        F.min("rare_impressions_share").alias("rare_share"),
        F.min("anonymized_impressions_share").alias("anon_share"),
        F.max("impressions_90d").alias("top_query_impressions"),
        F.sum("impressions_90d").alias("kept_impressions"),
        F.try_divide(F.max("impressions_90d"), F.sum("impressions_90d")).alias("top_query_share"),
    )

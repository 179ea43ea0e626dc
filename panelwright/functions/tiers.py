"""Labels, tiers and derived rates of the page table."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from panelwright.functions.cleaning import _col, cut, safe_ratio

BIG = 1_000_000.0

# Bin edges (right-closed) and their labels.
POSITION_EDGES = [0, 3, 10, 20, 50, BIG]
POSITION_LABELS = ["top_3", "page_1", "striking", "page_3_5", "deep"]
STALENESS_EDGES = [-1, 30, 90, 180, 365, BIG]
STALENESS_LABELS = ["0-30 days", "31-90", "91-180", "181-365", "365+"]
AGE_STEPS = [(14, "0-14"), (30, "15-30"), (90, "31-90"), (180, "91-180"), (365, "181-365")]
FRESHNESS_STEPS = [(30, "0-30"), (90, "31-90"), (180, "91-180")]
WORD_STEPS = [(1000, "<1000"), (2000, "1000-2000"), (3500, "2000-3500")]
CHAR_STEPS = [(8000, "<8000"), (15000, "8000-15000"), (25000, "15000-25000")]
IMPRESSION_STEPS = [(30000, "excellent"), (3000, "good"), (300, "moderate")]
POSITION_STEPS = [(3, "top_3"), (10, "page_1"), (20, "striking"), (50, "page_3_5")]


def _steps(value: Column, steps, last: str, closed: bool) -> Column:
    """First step whose upper bound holds (closed: <=, open: <), else ``last``."""
    out: Column | None = None
    for bound, label in steps:
        hit = value <= F.lit(bound) if closed else value < F.lit(bound)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(F.lit(last))


def age_tier(days: Column | str) -> Column:
    d = _col(days)
    return F.when(d.isNotNull(), _steps(d, AGE_STEPS, "365+", closed=True))


def age_tier_order(days: Column | str) -> Column:
    d = _col(days)
    order = F.lit(1)
    for bound, _ in AGE_STEPS:
        order = order + (d > F.lit(bound)).cast("int")
    return order.cast("int")


def freshness_tier(days: Column | str) -> Column:
    d = _col(days)
    return F.when(d.isNull(), F.lit("never")).otherwise(_steps(d, FRESHNESS_STEPS, "181+", closed=True))


def word_tier(words: Column | str) -> Column:
    w = _col(words)
    return F.when(w.isNotNull(), _steps(w, WORD_STEPS, "3500+", closed=False))


def char_tier(chars: Column | str) -> Column:
    c = _col(chars)
    return F.when(c.isNotNull(), _steps(c, CHAR_STEPS, "25000+", closed=False))


def impression_tier(impressions: Column | str, has_source: Column | str) -> Column:
    v = _col(impressions)
    out = F.when(~F.coalesce(_col(has_source), F.lit(False)), F.lit("no_data"))
    for bound, label in IMPRESSION_STEPS:
        out = out.when(v >= F.lit(bound), F.lit(label))
    return out.when(v > 0, F.lit("low")).otherwise(F.lit("none"))


def position_tier(position: Column | str) -> Column:
    """0 and null mean there is no position, not position zero."""
    p = F.coalesce(_col(position), F.lit(0.0))
    return F.when(p <= 0, F.lit("no_data")).otherwise(_steps(p, POSITION_STEPS, "deep", closed=True))


def position_bin(position: Column | str) -> Column:
    return cut(position, POSITION_EDGES, POSITION_LABELS)


def staleness_bin(days: Column | str) -> Column:
    return cut(days, STALENESS_EDGES, STALENESS_LABELS)


def trend_direction(last: Column | str, prev: Column | str) -> Column:
    """Movement between two windows with a +-20% dead band."""
    now, was = F.coalesce(_col(last), F.lit(0)), F.coalesce(_col(prev), F.lit(0))
    return (
        F.when((was == 0) & (now > 0), F.lit("new"))
        .when((was == 0) & (now == 0), F.lit("flat"))
        .when(now > F.lit(1.2) * was, F.lit("up"))
        .when(now < F.lit(0.8) * was, F.lit("down"))
        .otherwise(F.lit("stable"))
    )


def pct_rate(numerator, denominator, digits: int = 2) -> Column:
    """Rates are stored times 100."""
    return F.round(safe_ratio(numerator, denominator, 100.0), digits)


def trend_pct(last: Column | str, prev: Column | str) -> Column:
    return F.round(safe_ratio(_col(last) - _col(prev), prev, 100.0), 1)


# ---- labels -------------------------------------------------------------

def label_from_trend(direction: Column | str) -> Column:
    return F.coalesce((F.lower(_col(direction)) == "down").cast("int"), F.lit(0))


def label_drop_ratio(last, prev, keep: float = 0.8) -> Column:
    return F.when(_col(last) < F.lit(keep) * _col(prev), 1).otherwise(0)


def label_pct_drop(last, prev, drop: float = 0.10) -> Column:
    """Null where the earlier window is empty."""
    return (safe_ratio(_col(last) - _col(prev), prev) <= F.lit(-drop)).cast("int")


def label_position_decline(outcome_pos, feature_pos, threshold: float = 1.0) -> Column:
    return F.when(_col(outcome_pos) - _col(feature_pos) >= F.lit(threshold), 1).otherwise(0)

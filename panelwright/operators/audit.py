"""Leakage audits, contract checks, drift triggers and queue economics.

Every check becomes one row (check, ok, detail); data-backed ones come from
one-row aggregates.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelwright.operators.lineage import Origin
from panelwright.operators.ordering import exact_medians

C = F.col


@dataclass(frozen=True)
class Contract:
    """Every frame column belongs to exactly one bucket."""

    features: Sequence[str]
    label: Sequence[str]
    context: Sequence[str]
    excluded: Sequence[str] = field(default_factory=tuple)

    def problems(self, columns: Sequence[str]) -> list[str]:
        buckets = [set(self.features), set(self.label), set(self.context), set(self.excluded)]
        known = set().union(*buckets)
        out = [f"unclassified: {c}" for c in columns if c not in known]
        out += [f"in two buckets: {c}" for c in sorted(known) if sum(c in b for b in buckets) > 1]
        return out


# Column classes that must never be features.
LABEL_SIDE = ("o_impressions", "o_pos", "pos_delta", "is_position_decline")
DECISION_FLAGS = (
    "last_optimized_date", "optimization_eligible_date", "is_published", "is_deleted", "health_score",
    "needs_ctr_fix", "is_quick_win",
)
ID_COLUMNS = ("client_hash_id", "content_hash_id", "url_hash_id", "keyword_hash_id")
FUTURE_DATED = ("days_since_update",)


def name_checks(spark: SparkSession, features: Sequence[str]) -> DataFrame:
    """Checks on column names alone."""
    rows = []
    for name, bad in [
        ("label columns kept apart", LABEL_SIDE),
        ("decision flags kept apart", DECISION_FLAGS),
        ("identifiers kept apart", ID_COLUMNS),
        ("late-dated columns kept apart", FUTURE_DATED),
    ]:
        hit = sorted(set(features) & set(bad))
        rows.append((name, not hit, "overlap=" + (",".join(hit) or "none")))
    return spark.createDataFrame(rows, "check string, ok boolean, detail string")


def check_row(df: DataFrame, name: str, ok: Column, detail: Column) -> DataFrame:
    """One row from a one-row aggregate; a check that cannot be decided has failed."""
    return df.select(F.lit(name).alias("check"), F.coalesce(ok, F.lit(False)).alias("ok"), detail.cast("string").alias("detail"))


def windows_disjoint(fact: DataFrame, split) -> DataFrame:
    last_feature = F.max(F.when(C(split.period).isin(list(split.feature_periods)), C("report_date")))
    first_outcome = F.min(F.when(C(split.period) == split.outcome_period, C("report_date")))
    return check_row(
        fact.agg(last_feature.alias("a"), first_outcome.alias("b")), "feature days precede outcome days",
        C("a") < C("b"), F.concat(C("a").cast("string"), F.lit(" < "), C("b").cast("string")),
    )


def no_crossover(folds: DataFrame, group: str) -> DataFrame:
    spread = folds.groupBy(group).agg(F.count_distinct("fold").alias("k"))
    return check_row(
        spread.agg(F.count_if(C("k") > 1).alias("n")), "each client in one fold", C("n") == 0, C("n")
    )


def period_origin(origins: Mapping[str, Origin], features: Sequence[str], label: Sequence[str], split) -> tuple:
    """Feature values may come from rows of feature periods only, label values have to come from the outcome period."""
    known = [c for c in features if c in origins]
    seen = frozenset().union(*(origins[c].periods for c in known))
    told = frozenset().union(*(origins[c].periods for c in label))
    ok = len(known) > 0 and seen <= set(split.feature_periods) and split.outcome_period in told
    return ("feature values from feature periods only", ok, ",".join(sorted(seen)))


def unread_sources(origins: Mapping[str, Origin], features: Sequence[str], sources: Sequence[str]) -> tuple:
    """No feature may be derived from ``sources``, given as table or table.column."""
    read = frozenset().union(*(origins[c].columns for c in features if c in origins))
    hit = sorted(c for c in read if c in sources or c.split(".")[0] in sources)
    return ("query table not read", bool(read) and not hit, "read=" + (",".join(hit) or "none"))


def plan_checks(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), "check string, ok boolean, detail string")


def out_of_fold_row(predictions: DataFrame, folds: DataFrame, key: str) -> DataFrame:
    """Every item is scored once per model, by the fit that left its fold out.

    ``predictions`` carry in ``fold`` the fold that their fit left out, ``folds`` the fold an item was dealt.
    """
    dealt = folds.select(C(key).alias("__key"), C("fold").alias("__fold"))
    models = predictions.agg(F.count_distinct("model").alias("models"))
    met = dealt.join(predictions.select(key, "fold", "model"), C("__key") == C(key), "full").groupBy("__key", key).agg(
        F.count_if(C("fold") == C("__fold")).alias("held"), F.count_if(C(key).isNotNull()).alias("n"))
    wrong = met.join(F.broadcast(models)).agg(
        F.count_if((C("held") != C("models")) | (C("n") != C("models"))).alias("wrong"), F.count(F.lit(1)).alias("items"))
    return check_row(wrong, "scores out of fold", (C("wrong") == 0) & (C("items") > 0), C("wrong"))


def base_rate_row(frame: DataFrame, label: str) -> DataFrame:
    rate = frame.agg(F.avg(label).alias("r"))
    return check_row(rate, "base rate known", C("r").isNotNull(), F.format_string("%.4f", F.round(C("r"), 4)))


def future_dated_row(frame: DataFrame, days: str, features: Sequence[str]) -> DataFrame:
    """A future-dated column may exist, but then must not be a feature."""
    count = frame.agg(F.count_if(C(days) < 0).alias("n"))
    return check_row(
        count, "future-dated column kept out", (C("n") == 0) | F.lit(days not in features), C("n")
    )


# ---- monitoring: fixed values -------------------------------------------------
BASE_RATE_BAND, MIN_PRECISION, MAX_DRIFT = (0.45, 0.65), 0.65, 0.25


def drift_triggers(
    train: DataFrame, now: DataFrame, queue: DataFrame, label: str, columns: Sequence[str]
) -> DataFrame:
    """One row per trigger: its value and whether it is within bounds."""
    facts = now.agg(F.avg(label).alias("base_rate")).crossJoin(
        F.broadcast(queue.agg(F.avg(label).alias("queue_precision")))
    )
    facts = facts.crossJoin(F.broadcast(exact_medians(train, columns, "was_"))).crossJoin(
        F.broadcast(exact_medians(now, columns, "now_"))
    )
    low, high = BASE_RATE_BAND
    rows = [
        F.struct(F.lit("base_rate").alias("trigger"), C("base_rate").alias("value"),
                 C("base_rate").between(low, high).alias("ok")),
        F.struct(F.lit("queue_precision").alias("trigger"), C("queue_precision").alias("value"),
                 (C("queue_precision") >= MIN_PRECISION).alias("ok")),
    ]
    for c in columns:
        drift = F.try_divide(C(f"now_{c}") - C(f"was_{c}"), C(f"was_{c}"))
        rows.append(F.struct(F.lit(f"median_{c}_drift").alias("trigger"), drift.alias("value"),
                             (F.abs(drift) < MAX_DRIFT).alias("ok")))
    decided = F.coalesce(C("ok"), F.lit(False)).alias("ok")
    return facts.select(F.inline(F.array(*rows))).select("trigger", "value", decided)


def failure_modes(df: DataFrame, risk: str, label: str, high: float = 0.75, low: float = 0.45) -> DataFrame:
    """How many rows are confidently flagged or dismissed, and how often wrongly."""
    flagged, dismissed = C(risk) >= high, C(risk) < low
    rate = lambda cond, wrong: F.try_divide(F.count_if(cond & wrong).cast("double"), F.count_if(cond).cast("double"))
    return df.agg(
        F.count_if(flagged).alias("flagged"),
        F.count_if(flagged & (C(label) == 0)).alias("flagged_held"),
        rate(flagged, C(label) == 0).alias("flagged_held_rate"),
        F.count_if(dismissed).alias("dismissed"),
        F.count_if(dismissed & (C(label) == 1)).alias("dismissed_declined"),
        rate(dismissed, C(label) == 1).alias("dismissed_declined_rate"),
    )


REVIEW_MINUTES = 20     # stated assumption: minutes to review one page


def queue_value(queue: DataFrame, population: DataFrame, label: str, volume: str) -> DataFrame:
    """What reviewing the queue finds per hour, against reviewing at random."""
    got = queue.agg(
        F.count(F.lit(1)).alias("depth"), F.sum(label).cast("bigint").alias("hits"),
        F.sum(F.when(C(label) == 1, C(volume)).otherwise(0)).alias("impressions_at_risk"),
    )
    hours = C("depth") * REVIEW_MINUTES / 60
    return got.crossJoin(F.broadcast(population.agg(F.avg(label).alias("base")))).select(
        "depth", hours.alias("hours"), "hits", (C("depth") * C("base")).alias("hits_random"),
        F.try_divide(C("hits").cast("double"), hours).alias("hits_per_hour"),
        F.try_divide(C("depth") * C("base"), hours).alias("hits_per_hour_random"), "impressions_at_risk",
    )


def band_profile(df: DataFrame, band: str, risk: str, label: str) -> DataFrame:
    return df.groupBy(band).agg(
        F.count(F.lit(1)).alias("pages"), F.avg(risk).alias("mean_risk"), F.avg(label).alias("observed_rate")
    )


def mix_tables(df: DataFrame, columns: Mapping[str, str], label: str) -> DataFrame:
    """Long table behind mix charts: (chart, value, n, rate)."""
    out = None
    for chart, column in columns.items():
        part = df.groupBy(C(column).alias("value")).agg(
            F.count(F.lit(1)).alias("n"), F.avg(label).alias("rate")
        ).withColumn("chart", F.lit(chart))
        out = part if out is None else out.unionByName(part)
    return out

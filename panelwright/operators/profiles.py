"""Table profiles and signal audits: counts, rates, buckets, verdicts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from panelwright.operators.ordering import attach_percentile_rank, exact_quantiles

C = F.col


def grain_probe(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; empty when the grain holds."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def slice_profile(df: DataFrame, item: str, client: str, date: str) -> DataFrame:
    """Rows, distinct items and clients, date span.

    Day rows are first reduced to (item, client) pairs; the two distinct counts,
    which multiply their input rows, then run over the pairs only.
    """
    pairs = df.groupBy(item, client).agg(
        F.count(F.lit(1)).alias("__n"), F.min(date).alias("__lo"), F.max(date).alias("__hi")
    )
    return pairs.agg(
        F.sum("__n").alias("n_rows"), F.count_distinct(item).alias("items"),
        F.count_distinct(client).alias("clients"), F.min("__lo").alias("first_day"), F.max("__hi").alias("last_day"),
    )


def availability(df: DataFrame, flags: Mapping[str, str]) -> DataFrame:
    """Counts of the three states of each nullable flag."""
    aggs = [F.count(F.lit(1)).alias("all_rows")]
    for name, flag in flags.items():
        aggs += [
            F.count_if(C(flag).eqNullSafe(True)).alias(f"{name}_is_true"),
            F.count_if(C(flag).eqNullSafe(False)).alias(f"{name}_is_false"),
            F.count_if(C(flag).isNull()).alias(f"{name}_is_null"),
        ]
    return df.agg(*aggs)


def missingness(df: DataFrame, columns: Sequence[str], category: str) -> DataFrame:
    """Null rate per column by category, with an ``(all)`` row; one pass each."""
    rates = [F.avg(C(c).isNull().cast("int")).alias(f"null_{c}") for c in columns]
    count = F.count(F.lit(1)).alias("n")
    groups = df.groupBy(C(category).alias("category")).agg(count, *rates)
    overall = df.agg(count, *rates).withColumn("category", F.lit("(all)"))
    return groups.unionByName(overall)


def metric_density(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where each metric is above zero."""
    counts = df.agg(*[F.count_if(C(c) > 0).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "metric", "n_rows")


def fixed_counts(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Frequencies in a fixed category order, absent categories as 0."""
    aggs = [F.count_if(C(column) == v).alias(v) for v in values]
    long = df.agg(*aggs).unpivot([], list(values), "value", "n")
    return long.withColumn("position", F.array_position(F.array(*[F.lit(v) for v in values]), C("value")).cast("int"))


def code_counts(df: DataFrame, text: str, sep: str, k: int) -> DataFrame:
    """Most frequent codes of a delimited list."""
    codes = df.select(F.explode(F.split(C(text), sep)).alias("code")).where(C("code") != "")
    return codes.groupBy("code").agg(F.count(F.lit(1)).alias("n")).orderBy(C("n").desc(), "code").limit(k)


def describe(df: DataFrame, column: str, probs: Mapping[str, float]) -> DataFrame:
    v = C(column).cast("double")
    stats = df.agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"),
    )
    return stats.crossJoin(F.broadcast(exact_quantiles(df, column, probs)))


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """Correlation of average ranks over rows where both values exist."""
    both = df.select(C(a).cast("double").alias("__a"), C(b).cast("double").alias("__b")).na.drop()
    ranked = attach_percentile_rank(attach_percentile_rank(both, both, "__a", "__ra"), both, "__b", "__rb")
    return ranked.agg(F.corr("__ra", "__rb").alias("spearman"))


def bucket_rates(df: DataFrame, bucket: str, label: str, base: DataFrame, floor: int = 50) -> DataFrame:
    """Size, rate and gap to the base rate per bucket; no verdict below the floor.

    ``base`` is a one-row table with ``base_rate``.
    """
    per = df.where(C(bucket).isNotNull()).groupBy(C(bucket).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(label).alias("rate")
    )
    gap = C("rate") - C("base_rate")
    enough = C("n") >= floor
    return per.crossJoin(F.broadcast(base)).select(
        "bucket", "n", "rate", gap.alias("vs_base"),
        F.when(enough, F.when(gap > 0, "above").when(gap < 0, "below").otherwise("equal")).alias("verdict"),
    )


def side_gap_verdict(
    df: DataFrame, tier: str, low: Column, label: str, floor: int = 50, band: float = 0.02
) -> DataFrame:
    """Per tier, label rate on each side of a flag and what the gap says."""
    side = F.coalesce(low, F.lit(False))
    per = df.where(C(tier).isNotNull()).groupBy(tier).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(side).alias("n_low"),
        F.avg(F.when(side, C(label))).alias("rate_low"),
        F.avg(F.when(~side, C(label))).alias("rate_high"),
    )
    gap = C("rate_low") - C("rate_high")
    split = (C("n") >= floor) & (C("n_low") > 0) & (C("n_low") < C("n"))
    verdict = F.when(gap > band, "supports").when(gap < -band, "REVERSES").otherwise("flat")
    return per.withColumn("gap", gap).withColumn("verdict", F.when(split, verdict))


def rate_when(df: DataFrame, flag: Column, label: str) -> DataFrame:
    """Label rate with and without a condition."""
    return df.groupBy(F.coalesce(flag, F.lit(False)).alias("flag")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(label).alias("rate")
    )


def clients_with_history(clients: DataFrame, start: str, days: int = 365) -> DataFrame:
    """How many clients began at least ``days`` before the latest beginner."""
    latest = clients.agg(F.max(start).alias("__latest"))
    return clients.crossJoin(F.broadcast(latest)).agg(
        F.count_if(C(start) <= F.date_sub("__latest", days)).alias("clients_with_history")
    )


def over_floor(df: DataFrame, group: str, label: str, floor: int) -> DataFrame:
    """Rows of groups that are large enough and hold both classes."""
    keep = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.min(label).alias("lo"), F.max(label).alias("hi")
    ).where((C("n") >= floor) & (C("lo") < C("hi")))
    return df.join(keep.select(group), group, "left_semi")


def persistent_drop(windows: DataFrame, base: str, later: Sequence[str], keep: float = 0.8) -> DataFrame:
    """1 where every later window stays below ``keep`` times the base window."""
    below = F.lit(True)
    for c in later:
        below = below & (F.coalesce(C(c), F.lit(0)) < F.lit(keep) * C(base))
    return windows.withColumn("persistent", F.coalesce(below.cast("int"), F.lit(0)))

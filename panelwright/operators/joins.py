"""Join patterns of the panel jobs. Broadcast is used for one-row sides only;
keyed sides are left to the planner, which measures them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

C = F.col


def join_windows(features: DataFrame, outcomes: DataFrame, key: str) -> DataFrame:
    """Items present in both windows. Both sides are grouped by the key, so the
    join reuses their partitioning and adds no shuffle."""
    return features.join(outcomes, key, "inner")


def attach_dimension(items: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    return items.join(dim, key, "left")


def lookup_or_zero(df: DataFrame, lookup: DataFrame, key: str, value: str) -> DataFrame:
    """Left lookup by key; a missing score counts as 0."""
    side = lookup.select(key, C(value).alias("__v"))
    return df.join(side, key, "left").withColumn(value, F.coalesce("__v", F.lit(0.0))).drop("__v")


def attach_bounds(df: DataFrame, bounds: DataFrame) -> DataFrame:
    """Attach a one-row table (a global aggregate) to every row."""
    return df.crossJoin(F.broadcast(bounds))


def unseen_groups(df: DataFrame, train: DataFrame, group: str) -> DataFrame:
    """Rows whose group never occurs in ``train``."""
    return df.join(train.select(group).distinct(), group, "left_anti")


def within_groups(df: DataFrame, groups: DataFrame, group: str) -> DataFrame:
    return df.join(groups.select(group).distinct(), group, "left_semi")


def group_overlap(a: DataFrame, b: DataFrame, group: str) -> DataFrame:
    """Groups on both sides of a split; must be empty for an honest split."""
    return a.select(group).intersect(b.select(group))


def groups_only_in(a: DataFrame, b: DataFrame, group: str) -> DataFrame:
    return a.select(group).distinct().join(b.select(group).distinct(), group, "left_anti")


def per_client_window(fact: DataFrame, clients: DataFrame, client: str, start: str, date: str) -> DataFrame:
    """Fact rows on or after their own client's first tracked day.

    Clients without a start date have no usable history and drop out.
    """
    known = clients.where(C(start).isNotNull()).select(client, start)
    return fact.join(known, client).where(C(date) >= C(start))


def sibling_movement(items: DataFrame, group: Sequence[str], before: str, after: str) -> DataFrame:
    """What the other items of the same group gained while this one moved.

    Group totals minus the item's own share: one aggregate joined back, so the
    pairs inside a group are never formed.
    """
    group = list(group)
    delta = C(after) - C(before)
    totals = items.groupBy(*group).agg(F.sum(delta).alias("__group_delta"), F.count(F.lit(1)).alias("group_items"))
    return (
        items.withColumn("own_delta", delta)
        .join(totals, group)
        .withColumn("sibling_delta", C("__group_delta") - C("own_delta"))
        .withColumn("absorbed", ((C("own_delta") < 0) & (C("sibling_delta") >= -C("own_delta"))).cast("int"))
        .drop("__group_delta")
    )


def adjust_for_group(items: DataFrame, group: str, before: str, after: str) -> DataFrame:
    """Relative change of the item minus the relative change of its group."""
    totals = items.groupBy(group).agg(F.sum(before).alias("__b"), F.sum(after).alias("__a"))
    change = lambda now, was: F.try_divide((C(now) - C(was)).cast("double"), C(was).cast("double"))
    return (
        items.join(totals, group)
        .withColumn("own_change", change(after, before))
        .withColumn("group_change", change("__a", "__b"))
        .withColumn("adjusted_change", C("own_change") - C("group_change"))
        .drop("__a", "__b")
    )


def reconcile(totals: Mapping[str, DataFrame], key: str, value: str) -> DataFrame:
    """Full outer comparison of the same total from two sources."""
    (left_name, left), (right_name, right) = totals.items()
    a = left.select(key, C(value).alias(left_name))
    b = right.select(key, C(value).alias(right_name))
    return a.join(b, key, "full_outer").withColumn("matches", C(left_name).eqNullSafe(C(right_name)).cast("int"))

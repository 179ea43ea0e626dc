"""Leakage-safe splits. Random choices are seeded digests: the same rows land
in the same part on every run, engine and cluster size."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from panelwright.operators.ordering import global_row_number, hashed_row_number, join_null_safe

C = F.col


def holdout_groups(df: DataFrame, group: str, fraction: float, seed: int) -> DataFrame:
    """About ``fraction`` of the groups (at least one), chosen by digest order."""
    groups = df.select(group).distinct()
    total = groups.agg(F.count(F.lit(1)).alias("__n"))
    wanted = F.greatest(F.lit(1), F.round(C("__n") * F.lit(fraction)).cast("bigint"))
    ranked = hashed_row_number(groups, group, seed, name="__rn").crossJoin(F.broadcast(total))
    return ranked.where(C("__rn") <= wanted).select(group)


def group_shuffle_split(df: DataFrame, group: str, fraction: float, seed: int) -> DataFrame:
    """Mark rows ``train`` or ``test`` so that no group is on both sides."""
    held = holdout_groups(df, group, fraction, seed).withColumn("__held", F.lit(True))
    marked = join_null_safe(df, held, [group], "left")
    return marked.withColumn("split", F.when(C("__held"), F.lit("test")).otherwise(F.lit("train"))).drop("__held")


def stratified_split(df: DataFrame, label: str, tie: str, fraction: float, seed: int) -> DataFrame:
    """Hold out ``fraction`` of each class; rows without a label are a class. Classes are a handful."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    ranked = join_null_safe(hashed_row_number(df, tie, seed, [label], "__rn"), F.broadcast(sizes), [label])
    test = C("__rn") <= F.floor(C("__n") * F.lit(fraction))
    return ranked.withColumn("split", F.when(test, F.lit("test")).otherwise(F.lit("train"))).drop("__rn", "__n")


def stratified_kfold(df: DataFrame, label: str, tie: str, k: int, seed: int) -> DataFrame:
    """Folds 0..k-1 with the same class mix: deal each class out in digest order."""
    ranked = hashed_row_number(df, tie, seed, [label], "__rn")
    return ranked.withColumn("fold", ((C("__rn") - 1) % k).cast("int")).drop("__rn")


def group_kfold(df: DataFrame, group: str, k: int) -> DataFrame:
    """Folds 0..k-1 without splitting a group.

    Groups are ranked by size and dealt out in snake order (0..k-1, k-1..0, ...),
    which balances rows. Only (group, size) is ranked; rows get their fold by a
    join that AQE broadcasts when the group table is small. Rows with a null
    group form one group.
    """
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("__size"))
    ranked = global_row_number(sizes, [("__size", True)], group, "__rn")
    at = (C("__rn") - 1) % (2 * k)
    fold = F.when(at < k, at).otherwise(2 * k - 1 - at).cast("int")
    return join_null_safe(df, ranked.select(group, fold.alias("fold")), [group])


def client_holdout(
    df: DataFrame, group: str, label: str, tie: str, fraction: float = 0.2, seed: int = 42, min_groups: int = 5
) -> DataFrame:
    """Hold out whole clients; with too few clients, or one class missing on a
    side, fall back to a stratified row split. ``strategy`` tells which.

    The decision is read first (one row), then only the split it asks for is
    planned.
    """
    by_group = group_shuffle_split(df, group, fraction, seed)
    sides = by_group.groupBy("split").agg(F.count_distinct(label).alias("classes"))
    ok = sides.agg(((F.count(F.lit(1)) == 2) & (F.min("classes") == 2)).alias("__ok"))
    enough = df.agg((F.count_distinct(group) >= min_groups).alias("__enough"))
    if ok.crossJoin(F.broadcast(enough)).select(C("__ok") & C("__enough")).first()[0]:
        return by_group.withColumn("strategy", F.lit("client_holdout"))
    return stratified_split(df, label, tie, fraction, seed).withColumn("strategy", F.lit("stratified_row_holdout"))


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Balanced weights n / (classes * n_class); at most a handful of classes."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("__c"))
    total = sizes.agg(F.sum("__c").alias("__n"), F.count(F.lit(1)).alias("__k"))
    weights = sizes.crossJoin(F.broadcast(total)).select(label, (C("__n") / (C("__k") * C("__c"))).alias(name))
    return join_null_safe(df, F.broadcast(weights), [label])

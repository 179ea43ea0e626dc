"""Ranking and classification metrics over a score table.

A score table has columns (id, grp, label, model, score). Every metric is an
aggregation; several models are measured in one pass.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelwright.functions.cleaning import seeded_hash
from panelwright.operators.ordering import quantile_bins, rank_top, running_totals, union_all

C = F.col


def score_table(df: DataFrame, tie: str, group: str, label: str, models: dict[str, str]) -> DataFrame:
    """Wide score columns to long: one row per (id, model)."""
    wide = df.select(
        C(tie).alias("id"), C(group).alias("grp"), C(label).cast("int").alias("label"),
        *[C(column).cast("double").alias(name) for name, column in models.items()],
    )
    return wide.unpivot(["id", "grp", "label"], list(models), "model", "score")


def ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


# Fractions of a model's rows, from the best on, whose scores are tried as cuts.
CUT_FRACTIONS = [0.0002 * 1.5**i for i in range(21)]
SKETCH_ACCURACY = 10_000


def score_cuts(scores: DataFrame, k: int) -> DataFrame:
    """Per model a score ``cut`` that the k best rows reach, few others do, and a share ``tie_cut`` of the rows tied on it.

    A sketch per model, merged from the tasks, proposes scores; counts over them, one row per model again, say which
    is the highest one that k rows reach. Rows tied on it are asked for by digest, as ranks break ties: their
    share is chosen some deviations above what is wanted, which ``top_ranked`` checks. A model of fewer than k rows has no cut.
    """
    tried = F.percentile_approx("score", [1 - f for f in CUT_FRACTIONS], SKETCH_ACCURACY)
    cuts = scores.where(C("score").isNotNull()).groupBy("model").agg(tried.alias("__cuts"))
    met = scores.join(F.broadcast(cuts), "model")
    reach = [F.sum((C("score") >= C("__cuts")[i]).cast("int")).alias(f"__r{i}") for i in range(len(CUT_FRACTIONS))]
    over = [F.sum((C("score") > C("__cuts")[i]).cast("int")).alias(f"__o{i}") for i in range(len(CUT_FRACTIONS))]
    counts = met.groupBy("model").agg(F.first("__cuts").alias("__cuts"), *reach, *over)
    found = F.coalesce(*[
        F.when(C(f"__r{i}") >= k, F.struct(C("__cuts")[i].alias("cut"), C(f"__r{i}").alias("reach"), C(f"__o{i}").alias("over")))
        for i in range(len(CUT_FRACTIONS))])
    wanted, tied = F.lit(k) - C("f.over"), C("f.reach") - C("f.over")
    share = (wanted + 8 * F.sqrt(F.greatest(wanted, F.lit(0))) + 64) / tied
    return counts.select("model", found.alias("f")).select("model", C("f.cut").alias("cut"), F.least(share, F.lit(1.0)).alias("tie_cut"))


def top_candidates(scores: DataFrame, k: int) -> DataFrame:
    """Rows among which are the k best of each model; beyond them some by the steps between cuts, but no heavy tie."""
    cuts = F.broadcast(score_cuts(scores, k))                         # one row per model
    # Ties at a score that is no number, or infinite, are kept whole.
    plain = ~F.isnan("cut") & (F.abs("cut") != float("inf"))
    taken = (C("score") > C("cut")) | ((C("score") == C("cut")) & (~plain | (hex_fraction(F.md5(C("id").cast("string"))) <= C("tie_cut"))))
    return scores.join(cuts, "model", "left").where(C("cut").isNull() | taken).drop("cut", "tie_cut")


def top_ranked(scores: DataFrame, k: int) -> DataFrame:
    """The k best rows of each model with their rank.

    Only candidates are shuffled and sorted, see ``top_candidates``. Should the digests of tied rows leave fewer than k of
    a model that has more, the rank of its first row raises.
    """
    order = [C("score").desc(), F.md5(C("id").cast("string")), C("id")]
    rows = top_candidates(scores, k).withColumn("rank", F.row_number().over(Window.partitionBy("model").orderBy(*order)))
    rows = rows.where(C("rank") <= k)
    sizes = scores.groupBy("model").agg(F.count(F.lit(1)).alias("__n"))
    kept = rows.withColumn("__kept", F.count(F.lit(1)).over(Window.partitionBy("model"))).join(F.broadcast(sizes), "model")
    whole = C("__kept") >= F.least(C("__n"), F.lit(k))
    return kept.withColumn("rank", F.when(whole, C("rank")).otherwise(
        F.raise_error(F.lit("the digests of tied rows are not even")).cast("int"))).drop("__kept", "__n")


def base_rates(scores: DataFrame) -> DataFrame:
    return scores.groupBy("model").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("positives"), F.avg("label").alias("base_rate")
    )


def precision_curve(scores: DataFrame, ks: Sequence[int]) -> DataFrame:
    """Precision, lift and recall at each K, per model; min(K, n) rows count."""
    tops = top_ranked(scores, max(ks))
    cuts = F.explode(F.filter(F.array(*[F.lit(k) for k in ks]), lambda k: k >= C("rank")))
    hits = tops.select("model", "label", cuts.alias("k")).groupBy("model", "k").agg(
        F.count(F.lit(1)).alias("taken"), F.sum("label").alias("hits")
    )
    return hits.join(base_rates(scores), "model").select(
        "model", "k", "taken", "hits",
        ratio(C("hits"), C("taken")).alias("precision_at_k"),
        ratio(ratio(C("hits"), C("taken")), C("base_rate")).alias("lift_at_k"),
        ratio(C("hits"), C("positives")).alias("recall_at_k"),
    )


def score_curve(scores: DataFrame, by: Sequence[str]) -> DataFrame:
    """Running positives/negatives over distinct scores, best score first."""
    points = scores.groupBy(*by, "score").agg(
        F.sum("label").cast("bigint").alias("pos"),
        (F.count(F.lit(1)) - F.sum("label")).cast("bigint").alias("neg"),
    )
    return running_totals(points, "score", {"cum_pos": "pos", "cum_neg": "neg"}, by=by, descending=True)


def ranking_quality(scores: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """ROC AUC with half credit for ties, and step-wise average precision.

    Null where only one class is present.
    """
    by = list(by)
    c = score_curve(scores, by).groupBy(*by).agg(
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
        F.sum(C("pos") * (C("cum_neg") - C("neg") / 2)).alias("__wrong"),
        F.sum(C("pos") * C("cum_pos") / (C("cum_pos") + C("cum_neg"))).alias("__ap"),
    )
    both = (C("positives") > 0) & (C("negatives") > 0)
    area = 1 - C("__wrong") / (C("positives").cast("double") * C("negatives"))
    return c.select(
        *by, "positives", "negatives",
        F.when(both, area).alias("roc_auc"),
        F.when(both, C("__ap") / C("positives")).alias("average_precision"),
    )


def confusion(scores: DataFrame, threshold: float = 0.5, by: Sequence[str] = ("model",)) -> DataFrame:
    said = C("score") >= threshold
    yes = C("label") == 1
    return scores.groupBy(*by).agg(
        F.count_if(said & yes).alias("tp"), F.count_if(said & ~yes).alias("fp"),
        F.count_if(~said & yes).alias("fn"), F.count_if(~said & ~yes).alias("tn"),
    )


def threshold_metrics(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Accuracy, precision, recall, F1; an empty denominator counts as 0."""
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    tp, fp, fn, tn = C("tp"), C("fp"), C("fn"), C("tn")
    return confusion(scores, threshold).select(
        "model", "tp", "fp", "fn", "tn",
        zero(ratio(tp + tn, tp + fp + fn + tn)).alias("accuracy"),
        zero(ratio(tp, tp + fp)).alias("precision"),
        zero(ratio(tp, tp + fn)).alias("recall"),
        zero(ratio(2 * tp, 2 * tp + fp + fn)).alias("f1"),
    )


def classification_report(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per-class precision/recall/F1/support with macro and weighted averages."""
    c = confusion(scores, threshold)
    side = lambda cls, tp, fp, fn: c.select(
        "model", F.lit(cls).alias("class"), C(tp).alias("t"), C(fp).alias("p"), C(fn).alias("n")
    )
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    per = side("1", "tp", "fp", "fn").unionByName(side("0", "tn", "fn", "fp")).select(
        "model", "class",
        zero(ratio(C("t"), C("t") + C("p"))).alias("precision"),
        zero(ratio(C("t"), C("t") + C("n"))).alias("recall"),
        zero(ratio(2 * C("t"), 2 * C("t") + C("p") + C("n"))).alias("f1"),
        (C("t") + C("n")).alias("support"),
    )
    names = ["precision", "recall", "f1"]
    macro = per.groupBy("model").agg(
        F.lit("macro avg").alias("class"), *[F.avg(x).alias(x) for x in names], F.sum("support").alias("support")
    )
    weighted = per.groupBy("model").agg(
        F.lit("weighted avg").alias("class"),
        *[ratio(F.sum(C(x) * C("support")), F.sum("support")).alias(x) for x in names],
        F.sum("support").alias("support"),
    )
    return union_all([per, macro, weighted])


def metric_comparison(scores: DataFrame, ks: Sequence[int]) -> DataFrame:
    """One row per model: AUC, AP, P@K columns, number of distinct scores."""
    curve = precision_curve(scores, ks)
    at = curve.groupBy("model").agg(
        *[F.max(F.when(C("k") == k, C("precision_at_k"))).alias(f"p_at_{k}") for k in ks]
    )
    distinct = scores.groupBy("model").agg(F.count_distinct(F.round("score", 6)).alias("distinct_scores"))
    return (
        ranking_quality(scores).select("model", "roc_auc", "average_precision").join(at, "model").join(distinct, "model")
    )


def best_model(comparison: DataFrame, order: Sequence[str]) -> DataFrame:
    """Lexicographic maximum of the listed metrics."""
    return comparison.agg(F.max_by("model", F.struct(*[C(c) for c in order])).alias("best_model"))


def ndcg(scores: DataFrame, k: int) -> DataFrame:
    """Discounted gain of the top k against the best possible top k.

    The ideal order only depends on the number of positives, so its gain is a
    sum over min(k, positives) positions - no second ranking of the table.
    """
    gain = lambda rank: F.lit(1.0) / F.log2(rank + 1)
    got = top_ranked(scores, k).groupBy("model").agg(F.sum(C("label") * gain(C("rank"))).alias("dcg"))
    ideal = F.aggregate(
        F.sequence(F.lit(1), F.least(F.lit(k), C("positives")).cast("int")),
        F.lit(0.0), lambda acc, i: acc + gain(i),
    )
    best = base_rates(scores).select("model", F.when(C("positives") > 0, ideal).alias("idcg"))
    return got.join(best, "model").select(
        "model", F.lit(k).alias("k"), F.coalesce(F.try_divide("dcg", "idcg"), F.lit(0.0)).alias("ndcg_at_k")
    )


def per_group_quality(scores: DataFrame, min_rows: int) -> DataFrame:
    """AUC per group, for groups over the floor that hold both classes."""
    sizes = scores.groupBy("grp").agg(
        F.count(F.lit(1)).alias("pages"), F.avg("label").alias("decline_rate"),
        F.min("label").alias("__lo"), F.max("label").alias("__hi"),
    ).where((C("pages") >= min_rows) & (C("__lo") < C("__hi")))
    kept = scores.join(sizes.select("grp"), "grp", "left_semi")
    auc = ranking_quality(kept, ["grp"]).select("grp", C("roc_auc").alias("auc"))
    return sizes.select("grp", "pages", "decline_rate").join(auc, "grp")


def abstain_gate(per_group: DataFrame, min_auc: float = 0.60) -> DataFrame:
    return per_group.withColumn("gate", F.when(C("auc") >= min_auc, F.lit("serve")).otherwise(F.lit("ABSTAIN")))


def threshold_sweep(scores: DataFrame, cuts: Sequence[float]) -> DataFrame:
    """Rows captured, precision and recall at several cut-offs, in one pass; a cut-off may capture nothing."""
    hit = F.explode(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c <= C("score")))
    captured = scores.select("model", "label", hit.alias("cutoff")).groupBy("model", "cutoff").agg(
        F.count(F.lit(1)).alias("captured"), F.sum("label").alias("hits")
    )
    every = base_rates(scores).withColumn("cutoff", F.explode(F.array(*[F.lit(float(c)) for c in cuts])))
    zero = F.lit(0).cast("bigint")
    return every.join(captured, ["model", "cutoff"], "left").select(
        "model", "cutoff", F.coalesce("captured", zero).alias("captured"),
        ratio(C("hits"), C("captured")).alias("precision"),
        ratio(F.coalesce("hits", zero), C("positives")).alias("recall"),
    )


def top_concentration(df: DataFrame, score: str, tie: str, group: str, k: int) -> DataFrame:
    """Largest group's share of the top k and the number of groups in it."""
    counts = rank_top(df, [(score, True)], tie, k).groupBy(group).agg(F.count(F.lit(1)).alias("c"))
    return counts.agg(
        F.sum("c").alias("taken"),
        ratio(F.max("c"), F.sum("c")).alias("largest_share"),
        F.count(F.lit(1)).alias("groups"),
    )


def with_random_score(df: DataFrame, tie: str, seed: int, name: str = "random_score") -> DataFrame:
    """A score that knows nothing: the digest read as a number in [0, 1)."""
    return df.withColumn(name, hex_fraction(seeded_hash(tie, seed)))


def hex_fraction(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def inflation_gap(honest: DataFrame, optimistic: DataFrame, k: int) -> DataFrame:
    """How much better the same models look under the easier evaluation."""
    a = honest.select("model", C("roc_auc").alias("a_auc"), C(f"p_at_{k}").alias("__a"))
    b = optimistic.select("model", C("roc_auc").alias("b_auc"), C(f"p_at_{k}").alias("__b"))
    gap = (C("__b") - C("__a")).alias(f"p_at_{k}_gap")
    return a.join(b, "model").select("model", "a_auc", "b_auc", (C("b_auc") - C("a_auc")).alias("auc_gap"), gap)


def calibration(df: DataFrame, score: str, label: str, bins: int) -> DataFrame:
    """Predicted against observed rate per equal-count bin."""
    return quantile_bins(df, score, bins, "decile").groupBy("decile").agg(
        F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_predicted"), F.avg(label).alias("actual"),
        (F.avg(score) - F.avg(label)).alias("error"),
    )


def majority_baseline(df: DataFrame, label: str) -> DataFrame:
    rate = df.agg(F.avg(label).alias("__r"))
    return rate.select(
        (C("__r") > 0.5).cast("int").alias("majority_class"), F.greatest(C("__r"), 1 - C("__r")).alias("accuracy")
    )


def poisson_cdf() -> list[float]:
    """P(X <= i) of Poisson(1) for i = 0..7; the remaining mass is below 2e-6."""
    p, total, out = math.exp(-1), 0.0, []
    for i in range(8):
        total += p
        out.append(total)
        p /= i + 1
    return out


def poisson_weight(uniform: Column) -> Column:
    """Poisson(1) draw by inverse transform."""
    return sum((F.when(uniform >= F.lit(c), 1).otherwise(0) for c in poisson_cdf()), F.lit(0))


def bootstrap_prefix(k: int) -> int:
    """Ranks that hold k drawn rows in any replicate: a total of Poisson weights under k lies eight deviations away."""
    return k + math.ceil(8 * math.sqrt(k)) + 64


def bootstrap_precision_gaps(scores: DataFrame, models: tuple[str, str], k: int, replicates: int, seed: int) -> DataFrame:
    """Per replicate, the precision of the first model's top k minus that of the second's.

    A row draws one Poisson(1) weight per replicate from a digest of its id, shared by both models, so the comparison
    is paired. Each replicate has queues of its own: rows drawn several times take several places, rows not drawn leave,
    and lower ranks move up until k places are taken. Only a prefix of the ranking can be in a queue; should one not fill
    k places although the model has more rows, the query raises.
    """
    prefix = bootstrap_prefix(k)
    tops = top_ranked(scores.where(C("model").isin(*models)), prefix).select("model", "id", "label", "rank")
    rows = tops.withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), C("replicate").cast("string"), C("id").cast("string")))
    drawn = rows.withColumn("w", poisson_weight(hex_fraction(digest)))
    before = Window.partitionBy("replicate", "model").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    places = F.greatest(F.lit(0), F.least(C("w"), F.lit(k) - F.coalesce(F.sum("w").over(before), F.lit(0))))
    queues = drawn.withColumn("places", places).groupBy("replicate", "model").agg(
        ratio(F.sum(C("places") * C("label")), F.sum("places")).alias("precision"),
        F.sum("places").alias("filled"), F.max("rank").alias("ranks"))
    short = (C("filled") < k) & (C("ranks") >= prefix)
    precision = F.when(short, F.raise_error(F.lit("a replicate runs past the ranks kept")).cast("double")).otherwise(C("precision"))
    part = lambda m: F.max(F.when(C("model") == m, precision))
    return queues.groupBy("replicate").agg((part(models[0]) - part(models[1])).alias("gap"))


def bootstrap_metric_ci(
    scores: DataFrame, models: tuple[str, str], k: int, replicates: int = 1000, seed: int = 7
) -> DataFrame:
    """Mean and 95% interval of the difference of two models' precision at k, every replicate with queues of its own."""
    gaps = bootstrap_precision_gaps(scores, models, k, replicates, seed)
    return gaps.agg(                    # one value per replicate: a bounded histogram
        F.count(F.lit(1)).alias("replicates"), F.avg("gap").alias("mean_gap"),
        F.percentile("gap", F.lit(0.025)).alias("low"), F.percentile("gap", F.lit(0.975)).alias("high"),
    )

"""The two end-to-end jobs: page table to final queue, daily fact to review queue."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, functions as F

from panelwright.functions import rules
from panelwright.operators.metrics import best_model, metric_comparison, score_table, threshold_metrics
from panelwright.operators.models import Spec, fit, fit_all_score_all, in_parallel
from panelwright.operators.ordering import union_all
from panelwright.operators.splits import client_holdout
from panelwright.plans import scoring
from panelwright.plans.windows import Floors, Split, modeling_frame
from panelwright.session import scratch_path
from panelwright.sources.tables import materialize

C = F.col
CONTEXT = [
    "competition_level", "content_type", "main_intent", "age_tier", "freshness_tier", "word_count_tier",
    "impression_tier", "position_tier",
]
SELECTION_ORDER = ["p_at_50", "average_precision", "roc_auc"]


def review_queue_job(
    fact: DataFrame, dim: DataFrame, split: Split, floors: Floors = Floors(),
    visible_at: float = rules.VISIBLE_IMPRESSIONS,
) -> DataFrame:
    """Daily fact to ranked review queue by the frozen rule.

    The frame is written once (one row per item, the only heavy scan); scoring
    and ranking read it several times.
    """
    frame = materialize(modeling_frame(fact, dim, split, floors), scratch_path(fact.sparkSession, "frame"))
    scored = materialize(scoring.frozen_rule(frame, visible_at), scratch_path(fact.sparkSession, "scored"))
    return scoring.review_queue(scored)


HOLDOUT_KS = [20, 50, 100]
RULE = "rule_baseline"


def holdout_metrics(
    prepared: DataFrame, specs: Sequence[Spec], marked: DataFrame | None = None, baseline: DataFrame | None = None
) -> DataFrame:
    """Metrics of each model, and of the rule score if given, on the same rows of clients no model saw."""
    spark = prepared.sparkSession
    marked = marked if marked is not None else holdout(prepared)
    train, test = marked.where("split = 'train'"), marked.where("split = 'test'")
    scores = []
    for spec, fitted in zip(specs, in_parallel(spark, [partial(fit, train, spec) for spec in specs])):
        predicted = fitted.predict(test, "p", ["client_id", "is_declining_label"])
        scores.append(score_table(predicted, "content_id", "client_id", "is_declining_label", {spec.name: "p"}))
    if baseline is not None:
        held = baseline.join(test.select("content_id"), "content_id", "left_semi")
        scores.append(score_table(held, "content_id", "client_id", "is_declining_label", {RULE: "baseline_refresh_score"}))
    stored = materialize(union_all(scores), scratch_path(spark, "holdout-scores"))
    return metric_comparison(stored, HOLDOUT_KS).join(threshold_metrics(stored), "model")


def holdout(prepared: DataFrame) -> DataFrame:
    marked = client_holdout(prepared, "client_id", "is_declining_label", "content_id")
    return materialize(marked, scratch_path(prepared.sparkSession, "holdout"))


def refresh_queue_job(pages: DataFrame, specs: Sequence[Spec]) -> DataFrame:
    """Raw page table to ranked final queue.

    Clean, score by rule, choose the model on held-out clients, refit all
    models on every row, blend, code, band and rank. Every row says on which
    side of the split it was and which model was chosen.
    """
    spark = pages.sparkSession
    prepared = materialize(scoring.prepare_pages(pages), scratch_path(spark, "prepared"))
    baseline = materialize(scoring.with_baseline_codes(scoring.baseline_scores(prepared)), scratch_path(spark, "baseline"))
    marked = holdout(prepared)
    metrics = holdout_metrics(prepared, specs, marked, baseline)
    chosen = best_model(metrics.where(C("model") != RULE), SELECTION_ORDER).first()["best_model"]
    predictions = fit_all_score_all(prepared, specs).join(marked.select("content_id", "split"), "content_id")
    predictions = materialize(predictions, scratch_path(spark, "predictions"))
    predictions = predictions.withColumns(
        {"best_model_name": F.lit(chosen), "best_model_probability": C(f"prob_{chosen}")}
    )
    context = prepared.select("content_id", *CONTEXT)
    queue = scoring.final_queue(baseline.drop(*CONTEXT), predictions, context)
    return scoring.ranked_final_queue(materialize(queue, scratch_path(spark, "queue")))

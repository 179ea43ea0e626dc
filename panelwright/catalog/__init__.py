"""Catalog of runnable queries, one per inventory key, with their check SQL."""

from panelwright.catalog.registry import CASES, Case  # noqa: F401

from panelwright.catalog import sources_cases, cleaning_cases, join_cases, aggregate_cases, rank_cases, metric_cases, model_cases  # noqa: F401,E402

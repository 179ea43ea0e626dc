"""Reusable DataFrame operators: ordering, aggregation, joins, metrics, splits, models, audits."""

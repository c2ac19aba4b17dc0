"""Importing this package registers every query."""

from yieldloom.plans.queries import boosting, dashboard, final, metrics, models, profile, selectors, separation, sources, splits, trends  # noqa: F401

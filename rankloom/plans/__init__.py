"""Whole jobs: the star, its incremental load, the mart and its reports."""

from rankloom.plans.load import land_payload, load_deliveries, load_lines, load_payload, load_rows
from rankloom.plans.mart import analytics, analytics_distinct, mart_of_loads, refresh_analytics
from rankloom.plans.mart import replace_analytics
from rankloom.plans.reports import score_distribution, team_performance, trend_by_month
from rankloom.plans.star import Star, build_star

__all__ = [
    "Star",
    "analytics",
    "analytics_distinct",
    "build_star",
    "land_payload",
    "load_deliveries",
    "load_lines",
    "load_payload",
    "load_rows",
    "mart_of_loads",
    "refresh_analytics",
    "replace_analytics",
    "score_distribution",
    "team_performance",
    "trend_by_month",
]

"""Whole jobs put together from the operators."""

from clickloom.plans.ad_monitoring import AdMonitor, start_ad_monitor
from clickloom.plans.session_analysis import (
    analysed_sessions,
    run_session_analysis,
    session_statistics,
    top_categories_of_task,
)

__all__ = [
    "AdMonitor",
    "analysed_sessions",
    "run_session_analysis",
    "session_statistics",
    "start_ad_monitor",
    "top_categories_of_task",
]

"""Structured Streaming jobs over ad clicks."""

from clickloom.streaming.jobs import (
    AVAILABLE_NOW,
    start_ad_trend,
    start_click_copy,
    start_daily_counts,
    start_filtered_clicks,
    start_rejected_copy,
)
from clickloom.streaming.window import start_window_trend

__all__ = [
    "AVAILABLE_NOW",
    "start_ad_trend",
    "start_click_copy",
    "start_daily_counts",
    "start_filtered_clicks",
    "start_rejected_copy",
    "start_window_trend",
]

"""Ad monitoring: the streams over one source of log lines, and reads of their tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clickloom.schemas import (
    AD_BLACKLIST,
    AD_CLICK_TREND,
    AD_CLICK_WINDOW_TREND,
    AD_USER_CLICK_COUNT,
    BLACKLIST_THRESHOLD,
)
from clickloom.sinks import CROWDED, TotalsTable
from clickloom.sources.adlog import AHEAD, parse_ad_log, rejected_lines, valid_clicks
from clickloom.streaming.jobs import start_ad_trend, start_daily_counts, start_rejected_copy


@dataclass(frozen=True)
class AdMonitor:
    """The tables of one monitor below ``root``, a folder shared by all executors."""

    spark: SparkSession
    root: str

    @property
    def counts(self) -> TotalsTable:
        return click_count_store(self.spark, f"{self.root}/ad_user_click_count")

    @property
    def listed(self) -> TotalsTable:
        return blacklist_store(self.spark, f"{self.root}/ad_blacklist")

    @property
    def trend(self) -> TotalsTable:
        return trend_store(self.spark, f"{self.root}/ad_click_trend")

    @property
    def window_trend(self) -> TotalsTable:
        return window_trend_store(self.spark, f"{self.root}/ad_click_window_trend")

    @property
    def rejected_path(self) -> str:
        return f"{self.root}/rejected_lines"

    def checkpoint(self, job: str) -> str:
        return f"{self.root}/checkpoints/{job}"

    def user_click_counts(self, dates: list[str] | None = None) -> DataFrame:
        """Clicks per day, user and ad; with ``dates`` only their files are opened."""
        return self.counts.table(dates=dates)

    def blacklist(self) -> DataFrame:
        """Listed users."""
        return self.listed.table()

    def click_trend(self, dates: list[str] | None = None) -> DataFrame:
        """Clicks per minute and ad."""
        return self.trend.table(dates=dates)

    def click_window_trend(self, dates: list[str] | None = None) -> DataFrame:
        """Clicks per minute and ad in the last window by arrival that held one."""
        rows = self.window_trend.table(dates=dates)
        return rows.select("date", "hour", "minute", "ad_id", "latest.click_count")


def click_count_store(spark: SparkSession, path: str) -> TotalsTable:
    keys = ("date", "user_id", "ad_id")
    return TotalsTable(spark, path, AD_USER_CLICK_COUNT, keys, "click_count", "date")


def blacklist_store(spark: SparkSession, path: str) -> TotalsTable:
    return TotalsTable(spark, path, AD_BLACKLIST, ("user_id",))


def trend_store(spark: SparkSession, path: str) -> TotalsTable:
    keys = ("date", "hour", "minute", "ad_id")
    return TotalsTable(spark, path, AD_CLICK_TREND, keys, "click_count", "date")


def window_trend_store(spark: SparkSession, path: str) -> TotalsTable:
    keys = ("date", "hour", "minute", "ad_id")
    return TotalsTable(spark, path, AD_CLICK_WINDOW_TREND, keys, "latest", "date")


def start_ad_monitor(
    lines: DataFrame,
    root: str,
    threshold: int = BLACKLIST_THRESHOLD,
    ahead: str = AHEAD,
    arrival: str | None = None,
    trigger: dict | None = None,
    rewrite_every: int = CROWDED,
) -> list[StreamingQuery]:
    """Start the day counts with blacklist, the trend over all clicks, and the rejects.

    ``arrival`` and ``ahead`` bound a click's time, see :func:`parse_ad_log`.
    """
    monitor = AdMonitor(lines.sparkSession, root)
    parsed = parse_ad_log(lines, arrival=arrival, ahead=ahead)
    clicks = valid_clicks(parsed)
    return [
        start_daily_counts(
            clicks,
            monitor.counts,
            monitor.listed,
            monitor.checkpoint("daily_counts"),
            threshold,
            trigger,
            rewrite_every,
        ),
        start_ad_trend(
            clicks, monitor.trend, monitor.checkpoint("ad_trend"), trigger, rewrite_every
        ),
        start_rejected_copy(
            rejected_lines(parsed),
            monitor.rejected_path,
            monitor.checkpoint("rejected"),
            trigger,
        ),
    ]

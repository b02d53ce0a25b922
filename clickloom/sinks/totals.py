"""Tables of running totals: ordinary Parquet tables, appended to and merged when read.

Each row holds the total of its key as it was when the row was written. Totals only grow, so
of several rows of a key the greatest counts, and a row that is written again, by a batch that
runs twice for instance, changes nothing. Any reader gets the table by
``SELECT keys, max(value) ... GROUP BY keys``, or ``SELECT DISTINCT keys`` where there is no
value. For the same reason a date can be rewritten at any time with one row per key.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CROWDED = 64


@dataclass(frozen=True)
class TotalsTable:
    """``value`` is the greatest per key, or keys are kept once without it."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: Sequence[str] = ()
    value: str | None = None
    date: str | None = None

    @property
    def _by(self) -> list[str]:
        return [self.date] if self.date else []

    def add(self, rows: DataFrame) -> None:
        """Append totals; files get the size adaptive execution aims at."""
        rows = rows.select(*self.schema.names).hint("rebalance", *self._by)
        rows.write.mode("append").partitionBy(*self._by).parquet(self.path)

    def read(self, dates: list[str] | None = None) -> DataFrame:
        """The rows as they lie there; with ``dates`` only the files of these are opened."""
        empty = self.spark.createDataFrame([], self.schema)
        empty.write.mode("ignore").partitionBy(*self._by).parquet(self.path)
        rows = self.spark.read.schema(self.schema).parquet(self.path).select(*self.schema.names)
        return rows if dates is None else rows.where(F.col(self.date).isin(dates))

    def table(self, dates: list[str] | None = None) -> DataFrame:
        """One row per key."""
        rows = self.read(dates)
        if self.value is None:
            return rows.select(*self.keys).distinct()
        return rows.groupBy(*self.keys).agg(F.max(self.value).alias(self.value))

    def crowded_dates(self, files: int = CROWDED) -> list[str]:
        """Dates that lie in ``files`` files or more."""
        folder = f"/{self.date}="
        found = Counter(
            f.partition(folder)[2].partition("/")[0] for f in self.read().inputFiles() if folder in f
        )
        return sorted(date for date, n in found.items() if n >= files)

    def rewrite(self, dates: list[str]) -> None:
        """Replace the rows of ``dates`` by one per key, each date as a whole.

        What is appended meanwhile by another job could be lost: streams rewrite between their
        own batches. Readers that began before have to begin again.
        """
        if dates:
            rows = self.table(dates).select(*self.schema.names).hint("rebalance", *self._by)
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                *self._by
            ).parquet(self.path)

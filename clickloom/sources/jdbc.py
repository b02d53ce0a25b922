"""Tables in a relational database, for tasks and result tables kept there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, **extra: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, **extra}


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    split_by: tuple[str, int, int, int] | None = None,
    **extra: str,
) -> DataFrame:
    """A database table.

    ``split_by`` is (numeric column, lower, upper, number of partitions); without it
    the whole table comes through one connection, which suits only a task table.
    """
    options = jdbc_options(url, table, **extra)
    if split_by is not None:
        column, lower, upper, count = split_by
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(count),
        }
    return spark.read.format("jdbc").options(**options).load()

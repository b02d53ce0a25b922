"""Scans of the model tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scan_actions(
    actions: DataFrame, start_date: str | None = None, end_date: str | None = None
) -> DataFrame:
    """Actions with ``start_date <= date <= end_date``; a missing bound is open.

    ``date`` is ``yyyy-MM-dd`` text, so text order is date order. Keep the table
    partitioned by ``date``: the bounds then prune whole partitions.
    """
    if start_date is not None:
        actions = actions.where(F.col("date") >= start_date)
    if end_date is not None:
        actions = actions.where(F.col("date") <= end_date)
    return actions


def scan_users(users: DataFrame) -> DataFrame:
    """The user columns that sessions are joined with."""
    return users.select("user_id", "age", "professional", "city", "sex")


def scan_products(products: DataFrame) -> DataFrame:
    """Products with the status held in their JSON ``extend_info``."""
    return products.select(
        "product_id",
        "product_name",
        F.get_json_object("extend_info", "$.product_status")
        .try_cast("int")
        .alias("product_status"),
    )


def register_views(actions: DataFrame, users: DataFrame, products: DataFrame) -> None:
    """Make the tables available to SQL text under their model names."""
    actions.createOrReplaceTempView("user_visit_action")
    users.createOrReplaceTempView("user_info")
    products.createOrReplaceTempView("product_info")

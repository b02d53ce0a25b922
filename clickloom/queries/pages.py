"""Queries of the extensions: page one-step conversion and top products by area."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.operators import pages, products
from clickloom.queries import model
from clickloom.queries.model import ACTIONS_SQL, EVENTS_SQL, with_sql
from clickloom.queries.registry import query

# The flow whose conversion is asked for.
FLOW = (1, 2, 3, 4, 5, 6, 7)

_STEPS_SQL = """
visit AS (
  SELECT page_id, lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, page_id)
           AS next_page_id
  FROM user_visit_action
)"""

_FLOW_SQL = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(zip(FLOW, FLOW[1:]), 1))


@query(
    "page_steps",
    with_sql(EVENTS_SQL, ACTIONS_SQL, _STEPS_SQL)
    + "SELECT page_id, next_page_id, count(*) AS step_count FROM visit GROUP BY ALL",
)
def page_steps(spark: SparkSession, folder: str) -> DataFrame:
    return pages.page_steps(model.actions(spark, folder))


@query(
    "page_conversion",
    with_sql(EVENTS_SQL, ACTIONS_SQL, _STEPS_SQL)
    + f"""
SELECT CAST(step AS INTEGER) AS step, CAST(a AS BIGINT) AS page_id,
       CAST(b AS BIGINT) AS next_page_id,
       count(page_id) AS visit_count, count(*) FILTER (next_page_id = b) AS step_count,
       CASE WHEN count(page_id) > 0 THEN
         ((20000 * count(*) FILTER (next_page_id = b) + count(page_id))
          // (2 * count(page_id))) / 10000.0 END AS conversion
FROM (VALUES {_FLOW_SQL}) AS flow(step, a, b) LEFT JOIN visit ON page_id = a
GROUP BY step, a, b""",
)
def page_conversion(spark: SparkSession, folder: str) -> DataFrame:
    return pages.page_conversion(model.actions(spark, folder), FLOW)


@query(
    "top_area_products",
    with_sql(EVENTS_SQL, ACTIONS_SQL)
    + """,
clicked AS (
  SELECT r_name AS area, CAST(click_product_id AS BIGINT) AS product_id,
         count(*) AS click_count, string_agg(DISTINCT n_name, ',' ORDER BY n_name) AS cities
  FROM user_visit_action JOIN nation ON city_id = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  WHERE click_product_id <> '' GROUP BY ALL
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id)
                 AS INTEGER) AS place
  FROM clicked
)
SELECT area, place, product_id, p_name AS product_name,
       CAST(p_partkey % 2 AS INTEGER) AS product_status, click_count, cities
FROM ranked LEFT JOIN part ON p_partkey = product_id WHERE place <= 3""",
)
def top_area_products(spark: SparkSession, folder: str) -> DataFrame:
    """Nations stand for cities and their regions for areas."""
    nation, region = (model.table(spark, folder, name) for name in ("nation", "region"))
    cities = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("city_id"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("area"),
    )
    actions = model.actions(spark, folder)
    return products.top_area_products(actions, cities, model.products(spark, folder))

"""Top products by area, an extension: clicks per area and product with the cities they are from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def area_product_clicks(actions: DataFrame, cities: DataFrame) -> DataFrame:
    """``area, product_id, click_count, cities``: the names of the cities, sorted, each once.

    ``cities`` has ``city_id, city, area``, one row per city. Clicks are counted per city and
    product before anything is joined, so a hot product is one row per task and city, and a
    list holds no more names than the area has cities. Clicks of unknown cities are left out.
    """
    per_city = (
        actions.where(F.col("click_product_id") != "")
        .groupBy("city_id", F.col("click_product_id").cast("bigint").alias("product_id"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    placed = per_city.join(cities.select("city_id", "city", "area"), "city_id")
    return placed.groupBy("area", "product_id").agg(
        F.sum("n").alias("click_count"),
        F.concat_ws(",", F.array_sort(F.collect_set("city"))).alias("cities"),
    )


def top_area_products(
    actions: DataFrame, cities: DataFrame, products: DataFrame, most: int = 3
) -> DataFrame:
    """The ``most`` clicked products of each area, with name and status.

    ``area, place, product_id, product_name, product_status, click_count, cities``; equal
    counts are ordered by product. A product the product table does not know has neither name
    nor status. Each task keeps its ``most`` rows of an area before they are shuffled.
    """
    order = W.partitionBy("area").orderBy(F.desc("click_count"), "product_id")
    clicks = area_product_clicks(actions, cities)
    top = clicks.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)
    known = products.select(
        "product_id",
        "product_name",
        F.get_json_object("extend_info", "$.product_status").cast("int").alias("product_status"),
    )
    return top.join(known, "product_id", "left").select(
        "area", "place", "product_id", "product_name", "product_status", "click_count", "cities"
    )

"""Hottest products per area.

Clicks are joined to the city dimension, counted per (area, product) with the distinct
``city_id:city_name``
list, joined to the product dimension, and cut to the top k per area with
``row_number`` (map-side WindowGroupLimit before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlens.functions.columns import concat_long_string, group_concat_distinct, json_field
from visitlens.operators.joins import DEFAULT_MAX_BROADCAST_ROWS, broadcast_if_small

# Area names and their level, as the reference's CASE expression groups them.
AREA_LEVELS = [
    ("华北", "A level"),
    ("华东", "A level"),
    ("华南", "B level"),
    ("华中", "B level"),
    ("西北", "C level"),
    ("西南", "C level"),
]
OTHER_AREA_LEVEL = "D level"


def area_level(area: Column) -> Column:
    expr = None
    for name, level in AREA_LEVELS:
        cond = area == F.lit(name)
        expr = F.when(cond, F.lit(level)) if expr is None else expr.when(cond, F.lit(level))
    return expr.otherwise(F.lit(OTHER_AREA_LEVEL))


def product_status(extend_info: Column) -> Column:
    """'self' when the JSON's product_status is '0', else 'third party' (also when absent)."""
    return F.when(json_field(extend_info, "product_status") == F.lit("0"), F.lit("self")) \
        .otherwise(F.lit("third party"))


def area_click_basic(clicks: DataFrame, cities: DataFrame,
                     max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """(city_id, city_name, area, product_id) for each click in a known city.

    The city table may come from JDBC, which carries no size statistics, so its row
    count is checked (``broadcast_if_small``): broadcast when at most
    ``max_broadcast_rows`` rows, shuffle join otherwise.
    """
    c = broadcast_if_small(
        cities.select(F.col("city_id").cast("bigint").alias("city_id"), "city_name", "area"),
        max_broadcast_rows)
    return (clicks.select(F.col("city_id").cast("bigint").alias("city_id"), "product_id")
            .join(c, "city_id", "inner")
            .select("city_id", "city_name", "area", "product_id"))


def area_product_clicks(basic: DataFrame) -> DataFrame:
    """(area, product_id, click_count, city_infos): city_infos lists the distinct
    ``city_id:city_name`` pairs, sorted, comma separated."""
    return basic.groupBy("area", "product_id").agg(
        F.count(F.lit(1)).alias("click_count"),
        group_concat_distinct(concat_long_string(F.col("city_id"), F.col("city_name"), ":"))
        .alias("city_infos"))


def area_product_full(area_clicks: DataFrame, products: DataFrame) -> DataFrame:
    """Adds product_name and product_status (inner join on product_id).

    No broadcast hint: the product dimension grows with the catalogue; AQE broadcasts
    it at run time only when its measured size is below the threshold.
    """
    p = products.select("product_id", "product_name", product_status(F.col("extend_info")).alias("product_status"))
    return area_clicks.join(p, "product_id", "inner").select(
        "area", "product_id", "click_count", "city_infos", "product_name", "product_status")


def area_top_products(full: DataFrame, k: int = 3) -> DataFrame:
    """Top ``k`` products per area by click count (product id breaks ties), with level."""
    w = Window.partitionBy("area").orderBy(F.col("click_count").desc(), F.col("product_id"))
    return (full.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= F.lit(k))
            .select("area", area_level(F.col("area")).alias("area_level"), "product_id",
                    "click_count", "city_infos", "product_name", "product_status"))

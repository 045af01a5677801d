"""Summaries over the star schema.

Facts are reduced per foreign key before they meet a dimension. The partial
aggregate runs on the map side, so a restaurant or product that holds a large
share of the facts never lands in one join task, and the join only moves one row
per key. Where a dimension has several rows for a key the facts count once per
such row, as in a plain join: sums and counts are added again after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.metrics import percent, quotient, rounded

HIGH_RATING = 4
LOW_RATING = 2
MIN_RATINGS = 10


def _ratings_per_restaurant(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("restaurant_id").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count("rating_id").alias("_ids"),
        F.count("rating").alias("_rated"),
        F.sum("rating").alias("_rating_sum"),
        F.count_if(F.col("rating") >= HIGH_RATING).alias("_high"),
        F.count_if(F.col("rating") <= LOW_RATING).alias("_low"),
    )


def restaurant_summary(ratings: DataFrame, restaurants: DataFrame) -> DataFrame:
    attributes = ["restaurant_id", "restaurant_name", "cuisine_type", "city", "country"]
    joined = _ratings_per_restaurant(ratings).join(
        restaurants.select(*attributes), "restaurant_id")
    return joined.groupBy(*attributes).agg(
        F.sum("_ids").alias("total_ratings"),
        quotient(F.sum("_rating_sum"), F.sum("_rated")).alias("avg_rating"),
        F.sum("_high").alias("high_ratings_count"),
        F.sum("_low").alias("low_ratings_count"),
        percent(F.sum("_high"), F.sum("_ids")).alias("high_ratings_pct"),
        percent(F.sum("_low"), F.sum("_ids")).alias("low_ratings_pct"),
    )


def cuisine_summary(ratings: DataFrame, restaurants: DataFrame,
                    min_ratings: int = MIN_RATINGS) -> DataFrame:
    joined = _ratings_per_restaurant(ratings).join(
        restaurants.select("restaurant_id", "cuisine_type"), "restaurant_id")
    return joined.groupBy("cuisine_type").agg(
        F.count_distinct("restaurant_id").alias("restaurant_count"),
        F.sum("_ids").alias("total_ratings"),
        quotient(F.sum("_rating_sum"), F.sum("_rated")).alias("avg_rating"),
        percent(F.sum("_high"), F.sum("_ids")).alias("satisfaction_rate"),
    ).filter(F.col("total_ratings") >= min_ratings)


def product_summary(inventory: DataFrame, products: DataFrame) -> DataFrame:
    """Joined on the product alone, as defined, though stock is per restaurant and product."""
    attributes = ["product_id", "product_name", "product_type"]
    per_product = inventory.groupBy("product_id").agg(
        F.count_distinct("restaurant_id").alias("_restaurants"),
        F.sum("quantity_available").alias("_quantity"),
        F.count("quantity_available").alias("_stocked"),
        F.sum("inventory_value").alias("_value"),
    )
    joined = per_product.join(products.select(*attributes), "product_id")
    return joined.groupBy(*attributes).agg(
        F.max("_restaurants").alias("restaurants_offering"),
        F.sum("_quantity").alias("total_quantity"),
        rounded(F.sum("_value")).alias("total_inventory_value"),
        quotient(F.sum("_quantity"), F.sum("_stocked")).alias("avg_quantity_per_restaurant"),
    )


def restaurant_inventory(inventory: DataFrame, restaurants: DataFrame,
                         products: DataFrame) -> DataFrame:
    attributes = ["restaurant_id", "restaurant_name", "city", "country"]
    per_stock = inventory.groupBy("restaurant_id", "product_id").agg(
        F.sum("quantity_available").alias("_quantity"),
        F.sum("inventory_value").alias("_value"),
        F.count("inventory_value").alias("_valued"),
    )
    versions = products.groupBy("product_id").agg(F.count(F.lit(1)).alias("_versions"))
    per_restaurant = per_stock.join(versions, "product_id").groupBy("restaurant_id").agg(
        F.count("product_id").alias("_products"),
        F.sum(F.col("_quantity") * F.col("_versions")).alias("_quantity"),
        F.sum(F.col("_value") * F.col("_versions")).alias("_value"),
        F.sum(F.col("_valued") * F.col("_versions")).alias("_valued"),
    )
    joined = per_restaurant.join(restaurants.select(*attributes), "restaurant_id")
    return joined.groupBy(*attributes).agg(
        F.max("_products").alias("unique_products"),
        F.sum("_quantity").alias("total_items_in_stock"),
        rounded(F.sum("_value")).alias("total_inventory_value"),
        quotient(F.sum("_value"), F.sum("_valued")).alias("avg_product_value"),
    )


def city_summary(restaurants: DataFrame, ratings: DataFrame, inventory: DataFrame,
                 per_restaurant: bool = False) -> DataFrame:
    """Restaurants, ratings and stock per city.

    As defined, a restaurant's stock value weighs once per rating it has (once
    when it has none). ``per_restaurant`` weighs every restaurant once.
    """
    place = ["city", "country"]
    dims = restaurants.select("restaurant_id", *place)
    rated = _ratings_per_restaurant(ratings)
    stock = inventory.groupBy("restaurant_id").agg(F.sum("inventory_value").alias("_value"))
    joined = dims.join(rated, "restaurant_id", "left").join(stock, "restaurant_id", "left")
    weight: Column = F.lit(1) if per_restaurant else F.coalesce(F.col("_rows"), F.lit(1))
    figures = joined.groupBy(*place).agg(
        F.count_distinct("restaurant_id").alias("restaurant_count"),
        quotient(F.sum("_rating_sum"), F.sum("_rated")).alias("avg_rating"),
        quotient(
            F.sum(F.col("_value") * weight),
            F.sum(F.when(F.col("_value").isNotNull(), weight)),
        ).alias("avg_inventory_value_per_restaurant"),
    )
    # One rating id may occur at several restaurants of a city, so ids are
    # counted apart from the figures that add up.
    ids = ratings.select("restaurant_id", "rating_id").join(dims, "restaurant_id")
    counted = ids.groupBy(*place).agg(F.count_distinct("rating_id").alias("_ids")).select(
        F.col("city").alias("_city"), F.col("country").alias("_country"), "_ids")
    same_place = (F.col("city").eqNullSafe(F.col("_city"))
                  & F.col("country").eqNullSafe(F.col("_country")))
    return figures.join(counted, same_place, "left").select(
        *place, "restaurant_count",
        F.coalesce("_ids", F.lit(0)).alias("total_ratings"),
        "avg_rating", "avg_inventory_value_per_restaurant",
    )


def served(summary: DataFrame, by: str) -> DataFrame:
    """A summary in the order it is shown: largest first."""
    return summary.orderBy(F.col(by).desc_nulls_last())

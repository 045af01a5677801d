"""Dimensions and facts of the restaurant star schema.

No join carries a broadcast hint: dimensions can grow, and Spark broadcasts a
side only when its measured size is under the session's threshold, else it
shuffles and splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.operators.latest import latest_per_key

RESTAURANT_ATTRIBUTES = (
    "cnpj", "cuisine_type", "country", "city", "address", "phone_number", "opening_time",
    "closing_time", "average_rating", "num_reviews",
)
PRODUCT_ATTRIBUTES = (
    "product_type", "cuisine_type", "price", "unit_cost", "profit_margin", "calories",
    "prep_time_min", "is_vegetarian", "is_gluten_free",
)


def dim_restaurant(restaurants: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """Distinct attribute rows: two versions of a restaurant both stay."""
    columns = _present(restaurants, RESTAURANT_ATTRIBUTES)
    rows = restaurants.filter(F.col("restaurant_id").isNotNull()).select(
        "restaurant_id", F.col("name").alias("restaurant_name"), *columns)
    return _stamped(rows.distinct(), updated_at)


def dim_product(products: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """Distinct attribute rows: two versions of a product both stay."""
    columns = _present(products, PRODUCT_ATTRIBUTES)
    rows = products.filter(F.col("product_id").isNotNull()).select(
        "product_id", "restaurant_id", F.col("name").alias("product_name"), *columns)
    return _stamped(rows.distinct(), updated_at)


def dim_latest(dimension: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: what a type 1 dimension is meant to hold."""
    return latest_per_key(dimension, keys, order)


def duplicate_keys(dimension: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row; joining on them multiplies facts."""
    return dimension.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def fact_ratings(ratings: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Ratings with the restaurant id found by business key."""
    known = restaurants.filter(F.col("restaurant_id").isNotNull()).select("restaurant_id", "cnpj")
    rated = ratings.filter(F.col("rating").isNotNull())
    return rated.join(known, rated.restaurant_identifier == known.cnpj).select(
        "rating_id", "restaurant_id", "rating", "rating_timestamp",
        *_present(ratings, ["ingestion_timestamp"]))


def fact_inventory(inventory: DataFrame, products: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Stock valued at the restaurant's own product price, for known restaurants."""
    stock = inventory.filter(F.col("quantity_available") >= 0)
    priced = products.filter(F.col("price").isNotNull()).select(
        "restaurant_id", "product_id", "price")
    known = restaurants.filter(F.col("restaurant_id").isNotNull()).select("restaurant_id")
    return (
        stock.join(priced, ["restaurant_id", "product_id"])
        .join(known, "restaurant_id")
        .select(
            "stock_id", "restaurant_id", "product_id", "quantity_available",
            (F.col("quantity_available") * F.col("price")).alias("inventory_value"),
            "last_updated",
            *_present(inventory, ["ingestion_timestamp"]),
        )
    )


def _present(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [name for name in names if name in df.columns]


def _stamped(df: DataFrame, updated_at: Column | None) -> DataFrame:
    return df.withColumn("updated_at", F.current_timestamp() if updated_at is None else updated_at)

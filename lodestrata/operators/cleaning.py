"""Cleaned restaurant, rating, product and inventory rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lodestrata.functions.columns import normalised_key
from lodestrata.operators.expectations import Expectation, enforce

RESTAURANT_RULES = (
    Expectation("valid_restaurant_id", "restaurant_id IS NOT NULL"),
    Expectation("valid_name", "name IS NOT NULL"),
)
RATING_RULES = (
    Expectation("valid_rating_id", "rating_id IS NOT NULL"),
    Expectation("valid_rating_range", "rating BETWEEN 0 AND 5"),
)
PRODUCT_RULES = (
    Expectation("valid_product_id", "product_id IS NOT NULL"),
    Expectation("valid_price", "price > 0"),
)
INVENTORY_RULES = (
    Expectation("valid_stock_id", "stock_id IS NOT NULL"),
    Expectation("valid_quantity", "quantity_available >= 0"),
)

RESTAURANT_COLUMNS = (
    "restaurant_id", "name", "cnpj", "cuisine_type", "country", "city", "address",
    "phone_number", "opening_time", "closing_time", "average_rating", "num_reviews",
    "ingestion_timestamp",
)
RATING_COLUMNS = (
    "rating_id", "restaurant_identifier", "rating", "rating_timestamp", "ingestion_timestamp",
)
PRODUCT_COLUMNS = (
    "product_id", "restaurant_id", "name", "product_type", "cuisine_type", "price", "unit_cost",
    "profit_margin", "calories", "prep_time_min", "is_vegetarian", "is_gluten_free",
    "ingestion_timestamp",
)
INVENTORY_COLUMNS = (
    "stock_id", "restaurant_id", "product_id", "quantity_available", "last_updated",
    "ingestion_timestamp",
)


def clean_restaurants(raw: DataFrame, observation: Observation | str | None = None) -> DataFrame:
    valid = enforce(raw, RESTAURANT_RULES, observation)
    return _shaped(valid, RESTAURANT_COLUMNS, {
        "name": F.trim("name"),
        "cnpj": normalised_key(F.col("cnpj")),
    })


def clean_ratings(raw: DataFrame, observation: Observation | str | None = None) -> DataFrame:
    if "timestamp" in raw.columns:
        raw = raw.withColumnRenamed("timestamp", "rating_timestamp")
    valid = enforce(raw, RATING_RULES, observation)
    return _shaped(valid, RATING_COLUMNS, {
        "restaurant_identifier": normalised_key(F.col("restaurant_identifier")),
    })


def clean_products(raw: DataFrame, observation: Observation | str | None = None) -> DataFrame:
    valid = enforce(raw, PRODUCT_RULES, observation)
    return _shaped(valid, PRODUCT_COLUMNS, {
        "name": F.trim("name"),
        "profit_margin": F.col("price") - F.col("unit_cost"),
    })


def clean_inventory(raw: DataFrame, observation: Observation | str | None = None) -> DataFrame:
    return _shaped(enforce(raw, INVENTORY_RULES, observation), INVENTORY_COLUMNS, {})


def _shaped(df: DataFrame, columns: tuple[str, ...],
            computed: Mapping[str, Column]) -> DataFrame:
    """The given columns in order; those the source does not have are left out."""
    return df.select(*[
        computed[name].alias(name) if name in computed else F.col(name)
        for name in columns
        if name in computed or name in df.columns
    ])

"""Restaurants, ratings, products and stock to a star schema and its summaries."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from lodestrata.operators import cleaning, star, summaries
from lodestrata.plans import datasets
from lodestrata.plans.layers import MAX_BYTES, Layers
from lodestrata.sources.schemas import INVENTORY, PRODUCTS, RATINGS, RESTAURANTS

SOURCES = {
    "restaurants": (RESTAURANTS, cleaning.clean_restaurants),
    "ratings": (RATINGS, cleaning.clean_ratings),
    "products": (PRODUCTS, cleaning.clean_products),
    "inventory": (INVENTORY, cleaning.clean_inventory),
}


def run(spark: SparkSession, source: str, target: str, *,
        trigger: Mapping[str, object] | None = None, max_bytes: int = MAX_BYTES,
        database: str | None = None) -> Layers:
    """``source`` holds one folder per table."""
    layers = Layers(spark, target, trigger, max_bytes)
    for name, (schema, clean) in SOURCES.items():
        layers.append_lines(f"bronze_{name}", f"{source}/{name}/", schema)
        layers.append(f"silver_{name}", clean(layers.stream(f"bronze_{name}"), f"checked_{name}"))

    restaurants, products = layers.read("silver_restaurants"), layers.read("silver_products")
    layers.refresh("dim_restaurant", star.dim_restaurant(restaurants))
    layers.refresh("dim_product", star.dim_product(products))
    layers.refresh("fact_ratings", star.fact_ratings(
        layers.read("silver_ratings"), restaurants), cluster_by=["restaurant_id"])
    layers.refresh("fact_inventory", star.fact_inventory(
        layers.read("silver_inventory"), products, restaurants), cluster_by=["restaurant_id"])

    ratings, stock = layers.read("fact_ratings"), layers.read("fact_inventory")
    by_restaurant, by_product = layers.read("dim_restaurant"), layers.read("dim_product")
    layers.refresh("gold_restaurant_summary", summaries.restaurant_summary(ratings, by_restaurant))
    layers.refresh("gold_product_summary", summaries.product_summary(stock, by_product))
    layers.refresh("gold_cuisine_summary", summaries.cuisine_summary(ratings, by_restaurant))
    layers.refresh("gold_restaurant_inventory", summaries.restaurant_inventory(
        stock, by_restaurant, by_product))
    layers.refresh("gold_city_summary", summaries.city_summary(by_restaurant, ratings, stock))
    layers.register(database, datasets.RESTAURANTS)
    return layers

"""What the tables of each job hold."""

from __future__ import annotations

from lodestrata.sources.tables import Dataset


def _described(quality: str, name: str, comment: str, grain: str, **properties: str) -> Dataset:
    return Dataset(f"{quality}_{name}", comment, grain, {"quality": quality, **properties})


def _star(layer: str, name: str, comment: str, grain: str) -> Dataset:
    return Dataset(name, comment, grain, {"quality": "gold", "layer": layer})


DELIVERIES = (
    _described("bronze", "orders", "Order files as read", "order event"),
    _described("bronze", "status", "Status files as read", "status event"),
    _described("silver", "deliveries", "Orders with their statuses", "order and status event"),
    _described("gold", "kpis", "Rows and revenue per day and status", "day and status"),
)

REALTIME = (
    _described("bronze", "orders", "Order files as read", "order event", source="kafka"),
    _described("bronze", "status", "Status events, flattened", "status event", source="kafka"),
    _described("silver", "order_status", "Orders with statuses within two hours, classified",
               "order and status event"),
    _described("silver", "delayed_orders", "Late orders that can still be acted on",
               "order and status event", alert_level="high"),
    _described("gold", "restaurant_performance", "Performance of restaurants over time",
               "restaurant and ten-minute window"),
    _described("gold", "restaurant_windows", "Parts of the figures, sketches included, to merge to wider windows",
               "restaurant and ten-minute window"),
    _described("gold", "driver_performance", "Performance of drivers since the start", "driver"),
    _described("gold", "delivery_time_distribution", "Orders by delay", "delay bucket"),
    _described("gold", "platform_health", "Performance of the platform", "one row"),
)

RESTAURANTS = (
    *(_described("bronze", name, f"Files of {name} as read", f"{name} row")
      for name in ("restaurants", "ratings", "products", "inventory")),
    *(_described("silver", name, f"Valid rows of {name}", f"{name} row")
      for name in ("restaurants", "ratings", "products", "inventory")),
    _star("dimension", "dim_restaurant", "Attributes of restaurants", "restaurant version"),
    _star("dimension", "dim_product", "Attributes of products", "product version"),
    _star("fact", "fact_ratings", "Ratings with the restaurant's key", "rating"),
    _star("fact", "fact_inventory", "Stock and its value", "restaurant and product snapshot"),
    _described("gold", "restaurant_summary", "Ratings of restaurants", "restaurant"),
    _described("gold", "product_summary", "Stock of products", "product"),
    _described("gold", "cuisine_summary", "Ratings of cuisines", "cuisine"),
    _described("gold", "restaurant_inventory", "Stock of restaurants", "restaurant"),
    _described("gold", "city_summary", "Ratings and stock of cities", "city"),
)

USERS_BATCH = (
    _described("bronze", "delivery_users", "Snapshot of the delivery system", "user row"),
    _described("bronze", "profile_users", "Snapshot of the profile system", "user row"),
    _described("silver", "users_staging", "Users of both systems", "cpf"),
    _described("silver", "users_unified", "Current users", "cpf", scd_type="1"),
    _described("gold", "user_analytics", "Users by segment", "city and age group"),
)

USERS_STREAM = (
    _described("bronze", "mongo_users", "Change events of the delivery system", "event"),
    _described("bronze", "mssql_users", "Change events of the profile system", "event"),
    _described("silver", "users_staging", "Change events in one layout", "event"),
    _described("gold", "user_demographics", "Current users by city", "city"),
    _described("gold", "change_audit", "Versions of each user", "cpf"),
)

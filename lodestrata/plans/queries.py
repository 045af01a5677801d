"""Every query over the test tables, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.operators import (
    change_feed as cf, cleaning, deliveries as dl, expectations, order_status as os_,
    performance, snapshots, star, summaries, users,
)
from lodestrata.operators.skew import HotKeys
from lodestrata.plans.testviews import table, view
from lodestrata.session import work_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed clocks, so that results do not depend on when a query runs.
AS_OF = "2024-01-01"
FIRST_SNAPSHOT = "2024-02-01 00:00:00"
SECOND_SNAPSHOT = "2024-02-08 00:00:00"
FIRST_CUT_DELIVERY = "1998-01-01 00:00:00"
FIRST_CUT_PROFILE = "2024-01-15 00:00:00"


# How a type leaves a query, where the two engines would show it differently.
SHOWN = {T.TimestampType: "timestamp_ntz", T.DateType: "string", T.DecimalType: "double"}


def query(run: Query) -> Query:
    """Register a query under its function's name."""

    def shown(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = run(spark, sf_dir)
        return df.select(*[
            F.col(f.name).cast(SHOWN[type(f.dataType)]).alias(f.name)
            if type(f.dataType) in SHOWN else F.col(f.name)
            for f in df.schema.fields
        ])

    QUERIES[run.__name__] = shown
    return run


def moment(text: str):
    return F.lit(text).cast("timestamp")


def day():
    return F.lit(AS_OF).cast("date")


# Orders and statuses by day.

@query
def deliveries_join(spark, sf):
    joined = dl.deliveries(view(spark, sf, "kpi_orders"), view(spark, sf, "kpi_status"))
    return joined.withColumn("total_amount", F.round(F.col("total_amount").cast("double"), 2))


def _kpis(spark, sf, as_coded):
    joined = dl.deliveries(view(spark, sf, "kpi_orders"), view(spark, sf, "kpi_status"))
    kpis = dl.daily_kpis(joined, as_coded=as_coded)
    return kpis.withColumns({c: F.round(c, 2) for c in ("revenue", "avg_ticket")})


@query
def kpis_daily(spark, sf):
    return _kpis(spark, sf, False)


@query
def kpis_daily_as_coded(spark, sf):
    return _kpis(spark, sf, True)


# Orders with their statuses in time.

def statuses(spark, sf):
    return os_.order_status(view(spark, sf, "rt_orders"), view(spark, sf, "rt_status")).drop(
        "processed_timestamp")


def _rounded_delay(df):
    return df.withColumn("delivery_time_minutes", F.round("delivery_time_minutes", 4))


@query
def order_status_interval(spark, sf):
    return _rounded_delay(statuses(spark, sf))


@query
def order_latest_status(spark, sf):
    return _rounded_delay(os_.latest_status(statuses(spark, sf)).select(
        "order_id", "current_status", "status_event_time", "delivery_time_minutes",
        "event_severity"))


@query
def delayed_orders(spark, sf):
    alerts = os_.delayed_orders(
        statuses(spark, sf).withColumn("processed_timestamp", F.current_timestamp()))
    return _rounded_delay(alerts.drop("processed_timestamp"))


@query
def restaurant_perf_10min(spark, sf):
    return performance.restaurant_performance(statuses(spark, sf))


@query
def driver_perf(spark, sf):
    return performance.driver_performance(statuses(spark, sf))


@query
def driver_perf_approx(spark, sf):
    """Exact counts, and whether the approximate ones lie within three times their standard error."""
    counts = ("total_deliveries", "restaurants_served", "customers_served")
    exact = performance.driver_performance(statuses(spark, sf)).select("driver_key", *counts)
    near = performance.driver_performance(statuses(spark, sf), approximate=True).select(
        "driver_key", F.struct(*counts).alias("near"))
    within = [F.abs(F.col(f"near.{c}") - F.col(c)) <= F.greatest(F.lit(1.0), 0.15 * F.col(c)) for c in counts]
    return exact.join(near, "driver_key").select(
        "driver_key", *counts, (within[0] & within[1] & within[2]).alias("within_error"))


def checked_counts(streamed: DataFrame, exact: DataFrame, keys: list[str], counts) -> DataFrame:
    """``streamed`` with the exact counts, and whether its own lie within three times their standard error (5 %)."""
    wanted = exact.select(*keys, F.struct(*counts).alias("exact"))
    both = streamed.join(wanted, keys)
    within = F.lit(True)
    for c in counts:
        within = within & (F.abs(F.col(c) - F.col(f"exact.{c}")) <= F.greatest(F.lit(1.0), 0.05 * F.col(f"exact.{c}")))
    return both.withColumn("within_error", within).withColumns({c: F.col(f"exact.{c}") for c in counts}).drop("exact")


@query
def restaurant_perf_hour_merged(spark, sf):
    """Hours put together from stored windows of ten minutes, customers and drivers by their sketches."""
    path = work_dir(spark, "windows")
    performance.restaurant_windows(statuses(spark, sf)).write.parquet(path)
    hours = performance.widened(spark.read.parquet(path), "1 hour")
    return checked_counts(
        performance.restaurant_figures(performance.estimated(hours, performance.RESTAURANT_COUNTS)),
        performance.restaurant_performance(statuses(spark, sf), window="1 hour"),
        ["restaurant_key", "window_start"], performance.RESTAURANT_COUNTS)


@query
def driver_leaderboard(spark, sf):
    board = performance.driver_performance(statuses(spark, sf)).select(
        "driver_key", "total_order_value")
    return performance.leaderboard(board, "total_order_value", 10)


@query
def delivery_buckets(spark, sf):
    return performance.delivery_time_distribution(statuses(spark, sf))


@query
def platform_health(spark, sf):
    return performance.platform_health(statuses(spark, sf))


@query
def flatten_status(spark, sf):
    raw = view(spark, sf, "rt_status").withColumn("status", F.struct(
        "status_name",
        F.unix_millis(F.col("dt_current_timestamp").cast("timestamp")).alias("timestamp")))
    return os_.flatten_status(raw.drop("status_name", "status_timestamp")).drop("status")


# Restaurants.

@query
def clean_restaurants(spark, sf):
    return cleaning.clean_restaurants(view(spark, sf, "restaurants"))


@query
def clean_ratings(spark, sf):
    return cleaning.clean_ratings(view(spark, sf, "ratings"))


@query
def clean_products(spark, sf):
    cleaned = cleaning.clean_products(view(spark, sf, "products"))
    return cleaned.withColumns({c: F.round(c, 4) for c in ("price", "unit_cost", "profit_margin")})


@query
def clean_inventory(spark, sf):
    return cleaning.clean_inventory(view(spark, sf, "inventory"))


@query
def expectation_report(spark, sf):
    return expectations.expectation_report({
        "restaurants": (view(spark, sf, "restaurants"), cleaning.RESTAURANT_RULES),
        "ratings": (view(spark, sf, "ratings"), cleaning.RATING_RULES),
        "products": (view(spark, sf, "products"), cleaning.PRODUCT_RULES),
        "inventory": (view(spark, sf, "inventory"), cleaning.INVENTORY_RULES),
        "orders": (view(spark, sf, "rt_orders"), os_.ORDER_RULES),
    })


def _restaurants(spark, sf):
    return cleaning.clean_restaurants(view(spark, sf, "restaurants"))


def _products(spark, sf):
    return cleaning.clean_products(view(spark, sf, "products"))


def _dim_restaurant(spark, sf):
    return star.dim_restaurant(_restaurants(spark, sf)).drop("updated_at")


def _dim_product(spark, sf):
    return star.dim_product(_products(spark, sf)).drop("updated_at")


def _fact_ratings(spark, sf):
    return star.fact_ratings(
        cleaning.clean_ratings(view(spark, sf, "ratings")), _restaurants(spark, sf))


def _fact_inventory(spark, sf):
    return star.fact_inventory(
        cleaning.clean_inventory(view(spark, sf, "inventory")), _products(spark, sf),
        _restaurants(spark, sf))


@query
def dim_restaurant(spark, sf):
    return _dim_restaurant(spark, sf)


@query
def dim_product(spark, sf):
    return _dim_product(spark, sf).withColumns(
        {c: F.round(c, 4) for c in ("price", "unit_cost", "profit_margin")})


@query
def dim_product_latest(spark, sf):
    # Products that share a name serve as versions of it.
    latest = star.dim_latest(_dim_product(spark, sf), ["product_name"], [F.col("product_id").desc()])
    return latest.select("product_name", "product_id", "restaurant_id", "product_type")


@query
def fact_ratings(spark, sf):
    return _fact_ratings(spark, sf)


@query
def fact_inventory(spark, sf):
    return _fact_inventory(spark, sf).withColumn("inventory_value", F.round("inventory_value", 2))


@query
def restaurant_summary(spark, sf):
    return summaries.restaurant_summary(_fact_ratings(spark, sf), _dim_restaurant(spark, sf))


@query
def product_summary(spark, sf):
    return summaries.product_summary(_fact_inventory(spark, sf), _dim_product(spark, sf))


@query
def cuisine_summary(spark, sf):
    return summaries.served(
        summaries.cuisine_summary(_fact_ratings(spark, sf), _dim_restaurant(spark, sf)),
        "avg_rating")


@query
def restaurant_inventory(spark, sf):
    return summaries.restaurant_inventory(
        _fact_inventory(spark, sf), _dim_restaurant(spark, sf), _dim_product(spark, sf))


def _city(spark, sf, per_restaurant):
    return summaries.served(summaries.city_summary(
        _dim_restaurant(spark, sf), _fact_ratings(spark, sf), _fact_inventory(spark, sf),
        per_restaurant), "restaurant_count")


@query
def city_summary(spark, sf):
    return _city(spark, sf, False)


@query
def city_summary_per_restaurant(spark, sf):
    return _city(spark, sf, True)


# Users from snapshots.

ARRIVAL = "ingestion_order"
TRACKED_USER_COLUMNS = (
    "user_id", "email", "delivery_address", "city", "first_name", "last_name", "birthday", "job",
)


def _staging(spark, sf, first_snapshot=False):
    delivery, profile = view(spark, sf, "delivery_users"), view(spark, sf, "profile_users")
    if first_snapshot:
        delivery = delivery.filter(
            F.col("dt_current_timestamp") < F.lit(FIRST_CUT_DELIVERY).cast("timestamp_ntz"))
        profile = profile.filter(
            F.col("dt_current_timestamp") < F.lit(FIRST_CUT_PROFILE).cast("timestamp_ntz"))
    return users.unify_users(delivery, profile, ARRIVAL)


def _appended_history(spark, sf):
    first = snapshots.history_rows(_staging(spark, sf, True), moment(FIRST_SNAPSHOT))
    second = snapshots.history_rows(_staging(spark, sf), moment(SECOND_SNAPSHOT))
    return first.unionByName(second)


@query
def users_dedup(spark, sf):
    return users.newest_users(view(spark, sf, "delivery_users"), ARRIVAL)


@query
def users_staging(spark, sf):
    return _staging(spark, sf)


@query
def users_unified(spark, sf):
    return snapshots.current_state(_staging(spark, sf), moment(SECOND_SNAPSHOT))


@query
def users_history_append(spark, sf):
    return _appended_history(spark, sf)


@query
def users_history_diff(spark, sf):
    first = snapshots.open_history(_staging(spark, sf, True), moment(FIRST_SNAPSHOT))
    return snapshots.apply_snapshot(
        first, _staging(spark, sf), keys=["cpf"], tracked=TRACKED_USER_COLUMNS,
        at=moment(SECOND_SNAPSHOT))


@query
def user_segments(spark, sf):
    return users.segments(_staging(spark, sf), day()).withColumn("age", F.col("age").cast("double"))


@query
def change_metrics(spark, sf):
    return users.change_metrics(_appended_history(spark, sf), day())


@query
def user_analytics(spark, sf):
    return summaries.served(
        users.user_analytics(_staging(spark, sf), _appended_history(spark, sf), day(),
                             one_row_per_user=True), "user_count")


# Users from change events.

TRACKED_CHANGES = ("email", "delivery_address", "city", "first_name", "last_name", "job")
CHANGE_COLUMNS = ("cpf", "user_id", *TRACKED_CHANGES, "operation", "sequencenum",
                  "dt_current_timestamp")
CHANGE_RULES = cf.ChangeRules(
    keys=("cpf",), sequence="sequencenum", tracked=TRACKED_CHANGES,
    control=("operation", "sequencenum", "dt_current_timestamp"))


def changes(spark, sf):
    return cf.union_feeds(
        view(spark, sf, "delivery_changes"), view(spark, sf, "profile_changes"),
        columns=CHANGE_COLUMNS, keys=["cpf"], types={"user_id": "long", "sequencenum": "long"})


def end_as_double(history):
    """Integers with NULLs reach some clients as doubles: say so."""
    return history.withColumn(cf.END, F.col(cf.END).cast("double"))


@query
def cdc_union(spark, sf):
    return changes(spark, sf)


@query
def scd1_current(spark, sf):
    return cf.scd1(changes(spark, sf), CHANGE_RULES)


@query
def scd1_current_ignore_nulls(spark, sf):
    return cf.scd1(changes(spark, sf), CHANGE_RULES, ignore_nulls=True)


@query
def scd2_history(spark, sf):
    return end_as_double(cf.scd2(changes(spark, sf), CHANGE_RULES))


@query
def scd2_hot_keys(spark, sf):
    """The same history with every few events in a piece of their own."""
    return end_as_double(cf.scd2(changes(spark, sf), CHANGE_RULES, HotKeys(rows_per_piece=4)))


@query
def change_audit(spark, sf):
    events = cf.change_audit(changes(spark, sf), CHANGE_RULES)
    kept = cf.version_audit(cf.scd2(changes(spark, sf), CHANGE_RULES), ["cpf"])
    return events.join(kept, "cpf", "left")


@query
def user_demographics(spark, sf):
    current = cf.scd1(changes(spark, sf), CHANGE_RULES, ignore_nulls=True)
    return users.user_demographics(current, one_row_per_user=True)

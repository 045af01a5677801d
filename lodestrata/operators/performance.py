"""Delivery performance by restaurant and window, driver, delay bucket and platform.

Figures are put together from parts: counts, sums of whole cents and seconds, least
and greatest values, and sketches for distinct counts. Parts combine on the map side
and across tables in any order with the same result, so a stream can keep them as its
state, and windows can be merged to wider ones. Each figure is divided and rounded once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.columns import bucketed
from lodestrata.functions.metrics import amount, percent, rounded_ratio

# Bounds in minutes and their labels.
DELAY_BOUNDS = (15, 30, 45)
DELAY_LABELS = ("Very Fast", "Fast", "Normal", "Slow")
WINDOW = "10 minutes"

# Distinct counts by name, and what they count.
RESTAURANT_COUNTS = {"unique_customers": "customer_key", "unique_drivers": "driver_key"}
DRIVER_COUNTS = {
    "total_deliveries": "order_id", "restaurants_served": "restaurant_key", "customers_served": "customer_key"}


def parts() -> dict[str, Column]:
    """Aggregates of status rows that have one working value each."""
    cents = F.round(F.col("total_amount") * 100).cast("long")
    seconds = F.round(F.col("delivery_time_minutes") * 60).cast("long")
    return {
        "row_count": F.count(F.lit(1)),
        "delayed": F.count_if(F.col("is_delayed")),
        "delivered": F.count_if(F.col("is_delivered")),
        "pending": F.count_if(~F.col("is_delivered")),
        "cents": F.sum(cents), "priced": F.count(cents), "least_cents": F.min(cents), "most_cents": F.max(cents),
        "seconds": F.sum(seconds), "timed": F.count(seconds), "fastest": F.min(seconds), "slowest": F.max(seconds),
    }


_MERGE = {"least_cents": F.min, "most_cents": F.max, "fastest": F.min, "slowest": F.max}


def merged(distinct: Mapping[str, str] = {}) -> dict[str, Column]:
    """Aggregates that put parts of several rows together; those of sketches count a member of both once."""
    return {
        **{name: _MERGE.get(name, F.sum)(name) for name in parts()},
        **{name: F.hll_union_agg(name) for name in distinct}}


def sketches(distinct: Mapping[str, str]) -> dict[str, Column]:
    return {name: F.hll_sketch_agg(column) for name, column in distinct.items()}


def _exact(distinct: Mapping[str, str]) -> dict[str, Column]:
    return {name: F.count_distinct(column) for name, column in distinct.items()}


def estimated(rows: DataFrame, distinct: Mapping[str, str]) -> DataFrame:
    """Sketches replaced by the counts they stand for."""
    return rows.withColumns({name: F.hll_sketch_estimate(name) for name in distinct})


def _aggregates(distinct: Mapping[str, str], approximate: bool) -> list[Column]:
    counts = sketches(distinct) if approximate else _exact(distinct)
    return [c.alias(name) for name, c in {**parts(), **counts}.items()]


def _order_value() -> Column:
    return rounded_ratio(F.col("cents"), 100 * F.col("priced"))


def _minutes(seconds: str) -> Column:
    return rounded_ratio(F.col(seconds), F.lit(60))


def _delivery_time() -> Column:
    return rounded_ratio(F.col("seconds"), 60 * F.col("timed"))


def _on_time() -> Column:
    return percent(F.col("row_count") - F.col("delayed"), F.col("row_count"))


def restaurant_windows(
    statuses: DataFrame, *, time_col: str = "order_event_time", window: str = WINDOW, approximate: bool = True,
) -> DataFrame:
    """Parts per restaurant and tumbling window, with sketches of customers and drivers.

    ``order_event_time`` carries the watermark of the join, so a stream can emit
    closed windows in append mode; ``processed_timestamp`` gives windows of
    processing time, whose content depends on when the job runs.
    """
    grouped = statuses.groupBy("restaurant_key", F.window(time_col, window).alias("_window"))
    return _with_bounds(grouped.agg(*_aggregates(RESTAURANT_COUNTS, approximate)))


def widened(windows: DataFrame, window: str) -> DataFrame:
    """Stored windows put together to wider ones, a multiple of theirs."""
    grouped = windows.groupBy("restaurant_key", F.window("window_start", window).alias("_window"))
    return _with_bounds(grouped.agg(*[c.alias(name) for name, c in merged(RESTAURANT_COUNTS).items()]))


def _with_bounds(grouped: DataFrame) -> DataFrame:
    rest = [c for c in grouped.columns if c not in ("restaurant_key", "_window")]
    return grouped.select(
        "restaurant_key", F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), *rest)


def restaurant_figures(windows: DataFrame) -> DataFrame:
    """Metrics of windows whose distinct counts are numbers."""
    return windows.select(
        "restaurant_key", "window_start", "window_end", F.col("row_count").alias("order_count"),
        *RESTAURANT_COUNTS,
        amount("cents").alias("total_revenue"),
        _order_value().alias("avg_order_value"),
        _delivery_time().alias("avg_delivery_time"),
        _minutes("slowest").alias("max_delivery_time"),
        _minutes("fastest").alias("min_delivery_time"),
        F.col("delayed").alias("delayed_orders"),
        F.col("delivered").alias("completed_orders"),
        F.col("pending").alias("pending_orders"),
        _on_time().alias("on_time_rate_pct"),
        percent(F.col("delivered"), F.col("row_count")).alias("completion_rate_pct"),
    )


def restaurant_performance(
    statuses: DataFrame, *, time_col: str = "order_event_time", window: str = WINDOW, approximate: bool = False,
) -> DataFrame:
    """Metrics per restaurant and tumbling window; streams only allow approximate distinct counts."""
    windows = restaurant_windows(statuses, time_col=time_col, window=window, approximate=approximate)
    return restaurant_figures(estimated(windows, RESTAURANT_COUNTS) if approximate else windows)


def driver_parts() -> dict[str, Column]:
    """What a stream keeps of each driver."""
    return {**parts(), **sketches(DRIVER_COUNTS)}


def driver_figures(totals: DataFrame) -> DataFrame:
    """Metrics of drivers whose distinct counts are numbers."""
    return totals.select(
        "driver_key", *DRIVER_COUNTS,
        amount("cents").alias("total_order_value"),
        _order_value().alias("avg_order_value"),
        _delivery_time().alias("avg_delivery_time"),
        _minutes("fastest").alias("fastest_delivery"),
        _minutes("slowest").alias("slowest_delivery"),
        F.col("delayed").alias("delayed_deliveries"),
        F.col("delivered").alias("completed_deliveries"),
        _on_time().alias("on_time_rate_pct"),
    )


def driver_performance(statuses: DataFrame, *, approximate: bool = False) -> DataFrame:
    """Metrics per driver."""
    totals = statuses.groupBy("driver_key").agg(*_aggregates(DRIVER_COUNTS, approximate))
    return driver_figures(estimated(totals, DRIVER_COUNTS) if approximate else totals)


def time_bucket() -> Column:
    return bucketed(F.col("delivery_time_minutes"), DELAY_BOUNDS, DELAY_LABELS)


def with_delay(statuses: DataFrame) -> DataFrame:
    """Rows that have a delay; orders without a status are left out."""
    return statuses.filter(F.col("delivery_time_minutes").isNotNull())


def bucket_figures(totals: DataFrame) -> DataFrame:
    return totals.select(
        "time_bucket", F.col("row_count").alias("order_count"),
        _order_value().alias("avg_order_value"),
        amount("cents").alias("total_revenue"),
        amount("least_cents").alias("min_order_value"),
        amount("most_cents").alias("max_order_value"),
        _delivery_time().alias("avg_delivery_time"),
        _minutes("fastest").alias("min_delivery_time"),
        _minutes("slowest").alias("max_delivery_time"),
    )


def delivery_time_distribution(statuses: DataFrame) -> DataFrame:
    """Metrics per delay bucket."""
    return bucket_figures(with_delay(statuses).groupBy(time_bucket().alias("time_bucket")).agg(*_aggregates({}, False)))


def platform_health(statuses: DataFrame) -> DataFrame:
    """One row over the whole platform."""
    critical = F.count_if(F.col("event_severity") == "CRITICAL").alias("critical_events")
    return statuses.agg(critical, *_aggregates({}, False)).select(
        F.col("row_count").alias("order_status_rows"),
        F.col("timed").alias("rows_with_status"),
        amount("cents").alias("total_revenue"),
        _delivery_time().alias("avg_delivery_time"),
        F.col("delayed").alias("delayed_orders"),
        F.col("delivered").alias("completed_orders"),
        "critical_events",
        _on_time().alias("on_time_rate_pct"),
        percent(F.col("delivered"), F.col("row_count")).alias("completion_rate_pct"),
    )


def leaderboard(metrics: DataFrame, by: str, k: int) -> DataFrame:
    """The ``k`` best rows by a metric, equal ones by their other columns; Spark keeps only k per task."""
    rest = [c for c in metrics.columns if c != by]
    return metrics.orderBy(F.col(by).desc_nulls_last(), *rest).limit(k)

"""Queries that run whole jobs over files made from the test tables, and streams that are stopped and started again."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from lodestrata.operators import performance, summaries
from lodestrata.plans import deliveries, realtime, restaurants, users_batch, users_stream
from lodestrata.plans.queries import (
    CHANGE_COLUMNS, CHANGE_RULES, FIRST_CUT_DELIVERY, FIRST_CUT_PROFILE, FIRST_SNAPSHOT, SECOND_SNAPSHOT,
    TRACKED_USER_COLUMNS, checked_counts, day, moment, query, statuses, _staging,
)
from lodestrata.plans.oracle import build
from lodestrata.plans.snapshot_history import SnapshotHistory
from lodestrata.plans.stream_queries import FLUSH_USER, ORACLE, QUERIES, STREAMED as STREAMS, change_feed_stream
from lodestrata.plans.testviews import table, view
from lodestrata.session import work_dir
from lodestrata.sources.tables import append_stream, stream_table
from lodestrata.streaming.running import Running
from lodestrata.streaming.served import CurrentState

_BEFORE = frozenset(QUERIES)
# Rows of one file of lines: a compressed file is read by one task.
FILE_ROWS = 1_000_000


def served_by_name(spark: SparkSession, folder: str, name: str, run: Callable[[str], object]) -> DataFrame:
    """Run a job that registers its tables in a database of its own, and read one of them by its name."""
    database = f"lodestrata_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/catalog'")
    try:
        run(database)
        found = spark.table(f"{database}.{name}")
        # What was analysed stays readable when the entry is gone: the files are not the catalog's.
        found.schema  # noqa: B018
        return found
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def _as_files(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines in compressed files: as text they are several times the tables they come from."""
    rows.write.mode(mode).options(compression="gzip", maxRecordsPerFile=FILE_ROWS, **{"zlib.compress.level": "BEST_SPEED"}).json(path)


def _text(*columns: str):
    return {c: F.col(c).cast("string") for c in columns}


@query
def deliveries_job(spark, sf):
    """Files of orders and of nested statuses through the job to its daily figures."""
    folder = work_dir(spark, "deliveries-job")
    orders, status = view(spark, sf, "kpi_orders"), view(spark, sf, "kpi_status")
    _as_files(orders.withColumns(_text("order_id", "restaurant_key", "order_date")), f"{folder}/in/kafka_orders_1")
    _as_files(status.select(
        F.col("order_identifier").cast("string").alias("order_identifier"),
        F.struct("status_name").alias("status"),
        F.col("dt_current_timestamp").cast("string").alias("dt_current_timestamp")), f"{folder}/in/kafka_status_1")
    kpis = served_by_name(spark, folder, "gold_kpis", lambda database: deliveries.run(
        spark, f"{folder}/in", f"{folder}/out", database=database))
    return kpis.withColumns({c: F.round(c, 2) for c in ("revenue", "avg_ticket")})


@query
def restaurants_job(spark, sf):
    """Files of four tables through the job to the summary of restaurants."""
    folder = work_dir(spark, "restaurants-job")
    files = {name: view(spark, sf, name) for name in restaurants.SOURCES}
    files["ratings"] = files["ratings"].withColumnRenamed("rating_timestamp", "timestamp")
    files["inventory"] = files["inventory"].withColumn("quantity_available", F.col("quantity_available").cast("long"))
    for name, rows in files.items():
        _as_files(rows, f"{folder}/in/{name}")
    found = served_by_name(spark, folder, "gold_restaurant_summary", lambda database: restaurants.run(
        spark, f"{folder}/in", f"{folder}/out", database=database))
    return summaries.served(found, "total_ratings")


@query
def users_batch_job(spark, sf):
    """Two loads of snapshots, the last one repeated, through the job to the users by segment."""
    folder = work_dir(spark, "users-job")
    # The job knows no order of arrival: it goes into the times, below their resolution.
    delivery = view(spark, sf, "delivery_users").withColumn("dt_current_timestamp", F.timestamp_micros(
        F.unix_micros(F.col("dt_current_timestamp").cast("timestamp")) + F.col("ingestion_order")))
    profile = view(spark, sf, "profile_users")
    loads = (
        (1, FIRST_SNAPSHOT, FIRST_CUT_DELIVERY, FIRST_CUT_PROFILE), (2, SECOND_SNAPSHOT, None, None),
        (2, SECOND_SNAPSHOT, None, None))

    def run(database: str) -> None:
        for number, at, cut_delivery, cut_profile in loads:
            for name, rows, cut in (("mongo", delivery, cut_delivery), ("mssql", profile, cut_profile)):
                taken = rows.filter(F.col("dt_current_timestamp").cast("timestamp") < moment(cut)) if cut else rows
                _as_files(taken.drop("ingestion_order").withColumns(_text("dt_current_timestamp")), f"{folder}/in/{name}")
            users_batch.run(spark, f"{folder}/in", f"{folder}/out", snapshot=number,
                            at=datetime.fromisoformat(f"{at}+00:00"), as_of=day(), database=database)

    return summaries.served(served_by_name(spark, folder, "gold_user_analytics", run), "user_count")


@query
def realtime_job(spark, sf):
    """Files of orders and statuses through the job to its figures of drivers; a later pair lets the last rows go."""
    folder = work_dir(spark, "realtime-job")
    orders, status = view(spark, sf, "rt_orders"), view(spark, sf, "rt_status")
    end = view(spark, sf, "rt_status").agg((F.max("status_timestamp") + F.expr("INTERVAL 1 DAY")).alias("end"))

    def later(like: DataFrame, **given: Column) -> DataFrame:
        values = {f.name: F.col("end") if f.dataType == TimestampType() or f.dataType == TimestampNTZType()
                  else F.lit(FLUSH_USER).cast(f.dataType) for f in like.schema}
        return end.select(*[value.alias(c) for c, value in {**values, **given}.items()])

    def run(database: str) -> None:
        # The job only takes orders of an amount.
        pairs = (orders, status), (later(orders, total_amount=F.lit(1).cast("decimal(10,2)")),
                                   later(status, status_name=F.lit("Preparing")))
        for some_orders, some_status in pairs:
            _as_files(some_orders.withColumns(_text("order_id", "order_date", "dt_current_timestamp")),
                      f"{folder}/in/orders", "append")
            _as_files(some_status.select(
                "status_id", F.col("order_identifier").cast("string").alias("order_identifier"),
                F.struct("status_name", F.unix_millis(F.col("status_timestamp").cast("timestamp")).alias("timestamp"))
                .alias("status"), F.col("dt_current_timestamp").cast("string").alias("dt_current_timestamp")),
                f"{folder}/in/status", "append")
            realtime.run(spark, f"{folder}/in", f"{folder}/out", database=database)

    found = served_by_name(spark, folder, "gold_driver_performance", run).filter(F.col("driver_key") != FLUSH_USER)
    return checked_counts(found.drop("last_updated"), performance.driver_performance(statuses(spark, sf)),
                          ["driver_key"], performance.DRIVER_COUNTS)


@query
def users_stream_job(spark, sf):
    """Files of change events of two systems through the job, the newer half first, to the audit of versions."""
    folder = work_dir(spark, "users-stream-job")
    feeds = {"mongo": view(spark, sf, "delivery_changes"), "mssql": view(spark, sf, "profile_changes")}
    middle = table(spark, sf, "events").agg(F.avg("event_id")).first()[0]

    def run(database: str) -> None:
        for chosen in (F.col("sequencenum") > (middle or 0), F.col("sequencenum") <= (middle or 0)):
            for name, events in feeds.items():
                _as_files(events.filter(chosen).withColumns(_text("cpf", "dt_current_timestamp")).withColumnRenamed(
                    "sequencenum", "sequenceNum"), f"{folder}/in/{name}", "append")
            users_stream.run(spark, f"{folder}/in", f"{folder}/out", parts=8, database=database)

    return served_by_name(spark, folder, "gold_change_audit", run)


@query
def users_history_loads(spark, sf):
    """The history that two loads keep by fingerprints, the last one repeated."""
    kept = SnapshotHistory(spark, f"{work_dir(spark, 'users-history')}/history", ["cpf"], TRACKED_USER_COLUMNS)
    kept.apply(_staging(spark, sf, True), 1, moment(FIRST_SNAPSHOT))
    for _ in range(2):
        kept.apply(_staging(spark, sf), 2, moment(SECOND_SNAPSHOT))
    return kept.read()


@query
def scd1_continuous(spark, sf):
    """Two streams at the same time, one reading what the other writes, stopped in the middle and started again."""
    folder = work_dir(spark, "continuous")
    staging, soon = f"{folder}/staging", {"processingTime": "0 seconds"}
    events = change_feed_stream(spark, sf, folder, files=6)
    state = CurrentState(f"{folder}/current-checkpoint", CHANGE_RULES, CHANGE_COLUMNS)

    def start(running: Running) -> None:
        writer = running.add(append_stream(events, staging, f"{folder}/staging-checkpoint", trigger=soon))
        # The reader follows the writer's log, so there must be one.
        running.wait_until(lambda: writer.lastProgress is not None)
        running.add(state.maintain(stream_table(spark, staging, max_files=4), soon))

    with Running() as running:
        start(running)
        running.wait_until(lambda: all(query.recentProgress for query in running.queries))
    with Running() as running:
        start(running)
        running.catch_up()
    return state.read(spark)


ORACLE["deliveries_job"] = ORACLE["kpis_daily"]
ORACLE["restaurants_job"] = ORACLE["restaurant_summary"]
ORACLE["users_batch_job"] = ORACLE["user_analytics"]
ORACLE["realtime_job"] = ORACLE["driver_perf_stream"]
ORACLE["users_stream_job"] = build(["history"], """
    SELECT CAST(cpf AS VARCHAR) AS cpf, count(*) AS versions, count(*) FILTER (WHERE "__CURRENT") AS open_versions,
           max("__START_AT") AS last_change_at
    FROM history GROUP BY cpf""")
ORACLE["users_history_loads"] = ORACLE["users_history_diff"]
ORACLE["scd1_continuous"] = ORACLE["scd1_current"]

STREAMED = STREAMS | (frozenset(QUERIES) - _BEFORE)

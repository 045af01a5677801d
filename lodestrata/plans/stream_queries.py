"""Queries that run streams and loads over the test tables and return what they wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.operators import change_feed as cf, deliveries as dl, expectations, order_status as os_, performance
from lodestrata.plans.oracle import ORACLE, HISTORY, build
from lodestrata.plans.queries import (
    CHANGE_COLUMNS, CHANGE_RULES, QUERIES, checked_counts, end_as_double, query, statuses as batch_statuses,
)
from lodestrata.plans.testviews import VIEWS, table, view
from lodestrata.session import work_dir
from lodestrata.sources import alerts, copy_into as loading, evolution, json_files, quarantine
from lodestrata.sources.tables import append_stream, finish, read_table, stream_table
from lodestrata.streaming import progress
from lodestrata.streaming.change_tables import HistoryTable, maintain
from lodestrata.streaming.served import CurrentState, ServedState

FLUSH_USER = -1
# Events of one file of a feed that comes newest first.
FILE_EVENTS = 250_000
_BATCH = frozenset(QUERIES)


class EventStreams:
    """The events as order and status streams that can be flushed.

    A left row without a match leaves a stream join only when later events move
    the watermark on. After all events are read, one order and one status of a
    day later are appended; they are not part of the results.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, folder: str) -> None:
        self.spark, self.sf_dir, self.folder = spark, sf_dir, folder
        self.schema = table(spark, sf_dir, "events").schema
        self._append_later(0)

    def _append_later(self, copies: int) -> None:
        last = table(self.spark, self.sf_dir, "events").agg(F.max("ts").alias("last"))
        types = F.array(*[F.lit(t) for t in ("purchase", "view")[:copies]]).cast("array<string>")
        last.select(
            F.lit(FLUSH_USER).cast("long").alias("event_id"),
            (F.col("last") + F.expr("INTERVAL 1 DAY")).alias("ts"),
            F.lit(FLUSH_USER).cast("long").alias("user_id"),
            F.explode(types).alias("event_type"),
            F.lit(1.0).alias("value"),
            F.lit(None).cast("string").alias("props"),
        ).write.mode("append").parquet(f"{self.folder}/later")

    def inputs(self) -> tuple[DataFrame, DataFrame]:
        reader = self.spark.readStream.schema(self.schema)
        both = reader.parquet(f"{self.sf_dir}/events*.parquet").unionByName(
            reader.parquet(f"{self.folder}/later"))
        return (self.spark.sql(VIEWS["rt_orders"], events=both),
                self.spark.sql(VIEWS["rt_status"], events=both))

    def statuses(self) -> DataFrame:
        orders, status = self.inputs()
        return os_.order_status(orders, status, watermark=os_.WATERMARK)

    def run(self, result, path: str) -> DataFrame:
        """Run to the end of the events, then once more with the later ones."""
        checkpoint = f"{path}-checkpoint"
        finish(append_stream(result(), path, checkpoint))
        self._append_later(2)
        finish(append_stream(result(), path, checkpoint))
        return read_table(self.spark, path)


def _silver(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """The order status table, written by its stream."""
    path = f"{folder}/order_status"
    streams = EventStreams(spark, sf_dir, folder)
    streams.run(streams.statuses, path)
    return path


def _real(statuses: DataFrame) -> DataFrame:
    return statuses.filter(F.col("order_id") != FLUSH_USER)


# Orders with their statuses in time.

@query
def order_status_stream(spark, sf):
    path = _silver(spark, sf, work_dir(spark, "order-status"))
    rows = _real(read_table(spark, path)).drop("processed_timestamp")
    return rows.withColumn("delivery_time_minutes", F.round("delivery_time_minutes", 4))


@query
def restaurant_perf_10min_stream(spark, sf):
    """Join and windows in one stream; its sketches are compared with exact counts."""
    folder = work_dir(spark, "restaurant-windows")
    streams = EventStreams(spark, sf, folder)
    rows = streams.run(
        lambda: performance.restaurant_windows(streams.statuses()), f"{folder}/windows")
    windows = performance.estimated(rows.filter(F.col("restaurant_key") >= 0), performance.RESTAURANT_COUNTS)
    return checked_counts(
        performance.restaurant_figures(windows), performance.restaurant_performance(batch_statuses(spark, sf)),
        ["restaurant_key", "window_start"], performance.RESTAURANT_COUNTS)


def _served(spark, sf, label, keys, parts, rows=lambda rows: rows):
    """The state of a stream over the order status table."""
    folder = work_dir(spark, label)
    source = stream_table(spark, _silver(spark, sf, folder))
    state = ServedState(f"{folder}/{label}-checkpoint", keys, parts)
    finish(state.maintain(rows(_real(source))))
    return state.read(spark)


@query
def driver_perf_stream(spark, sf):
    """Running totals in the stream's state; its sketches are compared with exact counts."""
    totals = _served(spark, sf, "driver-totals", {"driver_key": F.col("driver_key")}, performance.driver_parts())
    return checked_counts(
        performance.driver_figures(performance.estimated(totals, performance.DRIVER_COUNTS)),
        performance.driver_performance(batch_statuses(spark, sf)), ["driver_key"], performance.DRIVER_COUNTS)


@query
def delivery_buckets_stream(spark, sf):
    return performance.bucket_figures(_served(
        spark, sf, "delay-buckets", {"time_bucket": performance.time_bucket()}, performance.parts(),
        performance.with_delay))


@query
def order_latest_status_stream(spark, sf):
    newest = F.struct("status_event_time", "order_event_time", "current_status", "delivery_time_minutes", "event_severity")
    found = _served(spark, sf, "latest-status", {"order_id": F.col("order_id")}, {"newest": F.max(newest)})
    return found.select(
        "order_id", "newest.current_status", "newest.status_event_time",
        F.round("newest.delivery_time_minutes", 4).alias("delivery_time_minutes"), "newest.event_severity")


@query
def alert_messages(spark, sf):
    folder = work_dir(spark, "alerts")
    source = stream_table(spark, _silver(spark, sf, folder))
    messages = alerts.payload(os_.delayed_orders(_real(source)))
    finish(alerts.send(messages, f"{folder}/alerts-checkpoint", path=f"{folder}/alerts"))
    sent = spark.read.schema("key STRING, value STRING").json(f"{folder}/alerts")
    body = F.from_json("value", "current_status STRING, total_amount DECIMAL(10,2)")
    return sent.select("key", body.alias("_body")).select("key", "_body.*")


@query
def deliveries_bounded_stream(spark, sf):
    """Orders with their statuses of the next two hours, as a stream join that lets its state go."""
    folder = work_dir(spark, "deliveries-bounded")
    orders, status = EventStreams(spark, sf, folder).inputs()
    joined = dl.deliveries(orders, status, amount_type="decimal(10,2)", within_seconds=os_.MATCH_SECONDS,
                           watermark=os_.WATERMARK)
    finish(append_stream(joined, f"{folder}/deliveries", f"{folder}/checkpoint"))
    return read_table(spark, f"{folder}/deliveries")


# Users from change events.

def change_feed_stream(spark, sf, folder, files=2, newest_first=False):
    """The change events as a stream of several files, which a stream reads in the order of their writing.

    ``newest_first`` makes the oldest of ``files`` equal ranges of event numbers come last. Of many events a
    range has several files, written and read by as many tasks, and a micro-batch takes those of one range.
    """
    events, each = table(spark, sf, "events"), 1
    if newest_first:
        least, greatest, count = events.agg(F.min("event_id"), F.max("event_id"), F.count(F.lit(1))).first()
        piece = F.floor((F.col("event_id") - least) * files / F.lit((greatest or 0) - (least or 0) + 1))
        each = max(1, -(-count // (files * FILE_EVENTS)))
        for k in reversed(range(files)):
            part = events.filter(piece == k)
            dealt = part.repartition(each, "event_id") if each > 1 else part.coalesce(1)
            dealt.write.mode("append").parquet(f"{folder}/events")
    else:
        events.repartitionByRange(files, "event_id").write.parquet(f"{folder}/events")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", each).parquet(
        f"{folder}/events")
    feeds = [spark.sql(VIEWS[name], events=stream)
             for name in ("delivery_changes", "profile_changes")]
    return cf.union_feeds(*feeds, columns=CHANGE_COLUMNS, keys=["cpf"])


@query
def scd1_stream(spark, sf):
    folder = work_dir(spark, "scd1")
    current = CurrentState(f"{folder}/checkpoint", CHANGE_RULES, CHANGE_COLUMNS)
    finish(current.maintain(change_feed_stream(spark, sf, folder)))
    return current.read(spark)


@query
def scd2_stream(spark, sf):
    folder = work_dir(spark, "scd2")
    history = HistoryTable(f"{folder}/history", CHANGE_RULES, parts=8)
    finish(maintain(change_feed_stream(spark, sf, folder), history, f"{folder}/checkpoint"))
    return end_as_double(history.read(spark))


@query
def scd2_stream_late(spark, sf):
    """The same history from files in reverse order: nearly every key has late events."""
    folder = work_dir(spark, "scd2-late")
    history = HistoryTable(f"{folder}/history", CHANGE_RULES, parts=8)
    feed = change_feed_stream(spark, sf, folder, files=3, newest_first=True)
    finish(maintain(feed, history, f"{folder}/checkpoint"))
    return end_as_double(history.read(spark))


# Loading files.

@query
def ingest_json_stream(spark, sf):
    folder = work_dir(spark, "ingest")
    orders = view(spark, sf, "rt_orders").withColumns(
        {c: F.col(c).cast("string") for c in ("order_date", "dt_current_timestamp")})
    orders.write.json(f"{folder}/orders")
    raw = json_files.stream_json(
        spark, f"{folder}/orders/*.json", max_bytes=5 * 1024**3,
        hints="order_date TIMESTAMP, dt_current_timestamp TIMESTAMP, total_amount DECIMAL(10,2)")
    finish(append_stream(raw, f"{folder}/bronze", f"{folder}/checkpoint"))
    return read_table(spark, f"{folder}/bronze").select(*orders.columns)


@query
def copy_into_twice(spark, sf):
    """All columns of the events, in two folders' worth of files; one field comes with the second."""
    folder = work_dir(spark, "copy-into")
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("string"))
    purchase = F.col("event_type") == "purchase"
    source, target = f"{folder}/files", f"{folder}/table"
    events.filter(purchase).drop("event_type").write.json(source)
    loading.copy_into(spark, source, target)
    loading.copy_into(spark, source, target)
    events.filter(~purchase).write.mode("append").json(source)
    loading.copy_into(spark, source, target)
    return loading.loaded(spark, target).withColumn("value", F.col("value").cast("double"))


def _event_lines(events: DataFrame, value) -> DataFrame:
    return events.select(F.to_json(F.struct(
        "event_id", "user_id", value.alias("value"), "event_type")).alias("value"))


def _cut_off(event_type: str):
    """The line, of one event type only up to its value."""
    return F.when(F.col("value").contains(f'"event_type":"{event_type}"'),
                  F.substring_index("value", ',"value"', 1)).otherwise(F.col("value")).alias("value")


EVENT_FIELDS = "event_id BIGINT, user_id BIGINT, value DOUBLE"


@query
def rescue_columns(spark, sf):
    """One field is unknown to the schema, some values are of another type, some lines are cut off."""
    folder = work_dir(spark, "rescue")
    broken = F.when(F.col("event_type") == "error", "broken").otherwise(
        F.col("value").cast("string"))
    number = F.col("event_type") != "error"
    events = table(spark, sf, "events")
    _event_lines(events.filter(number), F.col("value")).unionByName(
        _event_lines(events.filter(~number), broken)).select(_cut_off("signup")).write.text(f"{folder}/lines")
    lines = evolution.read_lines(spark, f"{folder}/lines", stream=True)
    finish(append_stream(evolution.parse_rescuing(lines, EVENT_FIELDS), f"{folder}/bronze",
                         f"{folder}/checkpoint"))
    return read_table(spark, f"{folder}/bronze").drop("source_file").withColumns(
        {c: F.col(c).cast("double") for c in ("event_id", "user_id")})


@query
def quarantine_bad_records(spark, sf):
    """The lines of one event type are cut off."""
    folder = work_dir(spark, "quarantine")
    lines = _event_lines(table(spark, sf, "events"), F.col("value")).select(_cut_off("error"))
    lines.write.text(f"{folder}/lines")
    read = evolution.read_lines(spark, f"{folder}/lines", stream=True)
    finish(append_stream(quarantine.marked(read, EVENT_FIELDS), f"{folder}/bronze",
                         f"{folder}/checkpoint", partition_by=[quarantine.BAD]))
    good = quarantine.good_rows(spark, f"{folder}/bronze").drop("source_file")
    bad = quarantine.bad_lines(spark, f"{folder}/bronze").select(
        F.col(quarantine.LINE).alias("bad_line"))
    return good.unionByName(bad, allowMissingColumns=True).withColumns(
        {c: F.col(c).cast("double") for c in ("event_id", "user_id")})


VALUE_RULES = [
    expectations.Expectation("small_value", "value <= 100", "warn"),
    expectations.Expectation("no_error", "event_type <> 'error'", "drop"),
]


@query
def stream_drop_counts(spark, sf):
    """What a stream observed: the events, then one type of them once more, which come late but for the last minutes."""
    folder = work_dir(spark, "drop-counts")
    events = table(spark, sf, "events")
    parts = {"first": events, "again": events.filter("event_type = 'signup'")}

    def run():
        # The same stream in two runs: the second goes on from the watermark of the first.
        rows = spark.readStream.schema(events.schema).parquet(f"{folder}/in/*").withColumn("ts", F.col("ts").cast("timestamp"))
        kept = expectations.enforce(rows, VALUE_RULES, "checked").withWatermark("ts", "10 minutes")
        finish(kept.dropDuplicates(["event_id", "ts"]).writeStream.queryName("drop_counts").format("parquet").option(
            "checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start(f"{folder}/out"))

    with progress.ProgressLog(spark, f"{folder}/progress"):
        for name, part in parts.items():
            part.write.parquet(f"{folder}/in/{name}")
            run()
    return progress.counted(spark, f"{folder}/progress").filter("query = 'drop_counts'").select("metric", "value")


STATUS_LINES = "status_id BIGINT, order_identifier BIGINT, status STRUCT<status_name: STRING, timestamp: BIGINT>"


@query
def rescue_nested_statuses(spark, sf):
    """Statuses as nested objects: a field inside is unknown to the schema, some times inside are text."""
    folder = work_dir(spark, "rescue-nested")
    status = view(spark, sf, "rt_status")
    millis = F.unix_seconds(F.col("dt_current_timestamp").cast("timestamp")) * 1000
    late = F.col("status_name") == "Preparing"

    def lines(rows, moment):
        return rows.select(F.to_json(F.struct(
            "status_id", "order_identifier",
            F.struct("status_name", moment.alias("timestamp"), F.col("status_id").alias("courier")).alias("status"),
            F.col("status_name").alias("note"))).alias("value"))

    lines(status.filter(~late), millis).unionByName(
        lines(status.filter(late), F.concat(F.lit("at "), F.col("status_name")))).write.text(f"{folder}/lines")
    read = evolution.read_lines(spark, f"{folder}/lines", stream=True)
    finish(append_stream(evolution.parse_rescuing(read, STATUS_LINES), f"{folder}/bronze", f"{folder}/checkpoint"))
    return read_table(spark, f"{folder}/bronze").select(
        "status_id", "order_identifier", "status.status_name", "status.timestamp", evolution.RESCUED)


STREAMED = frozenset(QUERIES) - _BATCH


def _outer(columns: str, text: str) -> str:
    return f"SELECT {columns} FROM ({text})"


ORACLE["order_status_stream"] = ORACLE["order_status_interval"]
ORACLE["deliveries_bounded_stream"] = build(["rt_orders", "rt_status"], f"""
    SELECT o.order_id, o.order_date, o.restaurant_key, CAST(o.total_amount AS DOUBLE) AS total_amount, s.status_name
    FROM rt_orders o JOIN rt_status s ON s.order_identifier = o.order_id
    WHERE s.dt_current_timestamp - o.dt_current_timestamp BETWEEN INTERVAL 0 SECOND
          AND INTERVAL {os_.MATCH_SECONDS} SECOND""")
ORACLE["restaurant_perf_10min_stream"] = _outer("*, true AS within_error", ORACLE["restaurant_perf_10min"])
ORACLE["driver_perf_stream"] = _outer("*, true AS within_error", ORACLE["driver_perf"])
ORACLE["delivery_buckets_stream"] = ORACLE["delivery_buckets"]
ORACLE["order_latest_status_stream"] = ORACLE["order_latest_status"]
ORACLE["alert_messages"] = _outer(
    "CAST(order_id AS VARCHAR) AS key, current_status, total_amount", ORACLE["delayed_orders"])
ORACLE["scd1_stream"] = ORACLE["scd1_current"]
ORACLE["scd2_stream"] = ORACLE["scd2_stream_late"] = HISTORY
ORACLE["ingest_json_stream"] = build(["rt_orders"], """
    SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount) FROM rt_orders""")
ORACLE["copy_into_twice"] = """
    SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, value, props,
           CASE WHEN event_type <> 'purchase' THEN event_type END AS event_type
    FROM events"""
ORACLE["stream_drop_counts"] = """
    WITH sent AS (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_type = 'signup')
    SELECT 'checked.rows' AS metric, count(*) AS value FROM sent
    UNION ALL SELECT 'checked.small_value', count(*) FILTER (WHERE coalesce(value > 100, true)) FROM sent
    UNION ALL SELECT 'checked.no_error', count(*) FILTER (WHERE coalesce(event_type = 'error', true)) FROM sent
    UNION ALL SELECT 'late_rows', count(*) FROM events WHERE event_type = 'signup'
        AND ts <= (SELECT max(ts) FROM events WHERE event_type <> 'error') - INTERVAL 10 MINUTE"""
ORACLE["rescue_nested_statuses"] = build(["rt_status"], """
    SELECT status_id, order_identifier, status_name,
           CASE WHEN status_name <> 'Preparing' THEN CAST(floor(epoch(dt_current_timestamp)) AS BIGINT) * 1000 END AS timestamp,
           concat('{"status":{', CASE WHEN status_name = 'Preparing' THEN '"timestamp":"at Preparing",' ELSE '' END,
                  '"courier":', status_id, '},"note":"', status_name, '"}') AS _rescued_data
    FROM rt_status""")
ORACLE["rescue_columns"] = """
    SELECT CASE WHEN event_type <> 'signup' THEN CAST(event_id AS DOUBLE) END AS event_id,
           CASE WHEN event_type <> 'signup' THEN CAST(user_id AS DOUBLE) END AS user_id,
           CASE WHEN event_type NOT IN ('error', 'signup') THEN value END AS value,
           CASE event_type WHEN 'error' THEN '{"value":"broken","event_type":"error"}'
                WHEN 'signup' THEN concat('{"event_id":', event_id, ',"user_id":', user_id)
                ELSE concat('{"event_type":"', event_type, '"}') END AS _rescued_data
    FROM events"""
ORACLE["quarantine_bad_records"] = """
    SELECT CASE WHEN event_type <> 'error' THEN CAST(event_id AS DOUBLE) END AS event_id,
           CASE WHEN event_type <> 'error' THEN CAST(user_id AS DOUBLE) END AS user_id,
           CASE WHEN event_type <> 'error' THEN value END AS value,
           CASE WHEN event_type = 'error'
                THEN concat('{"event_id":', event_id, ',"user_id":', user_id) END AS bad_line
    FROM events"""

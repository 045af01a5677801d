import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodestrata.operators import change_feed as cf, order_status as os_, performance
from lodestrata.plans import stream_queries
from lodestrata.sources.tables import append_stream, finish, read_table
from lodestrata.streaming.change_tables import EventLog, HistoryTable, maintain
from lodestrata.streaming.keyed_table import KeyedTable
from lodestrata.streaming.served import CurrentState, ServedState
from tests.test_change_feed import RULES, SCHEMA, random_events
from tests.test_order_status import ORDER, START, STATUS

VERSION = ("k", "v", "u", cf.START, cf.END, cf.CURRENT)


def add_file(spark, data, schema, path):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(path)


def stream(spark, schema, path):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_join_over_micro_batches_equals_batch_and_drops_late_rows(spark, rows, tmp_path):
    orders_dir, status_dir, out = (f"{tmp_path}/{n}" for n in ("orders", "status", "out"))
    rng = random.Random(3)
    orders, statuses = [], []
    for i in range(40):
        at = START + timedelta(minutes=10 * i)
        key = f"o{i % 7}"
        orders.append((key, at, "r", "d", "u", Decimal("5.00"), at))
        then = at + timedelta(seconds=rng.randint(0, 9000))
        statuses.append((key, "In Transit", then, then))
    statuses.sort(key=lambda s: s[3])
    far = START + timedelta(days=9)
    flush = (("end", far, "r", "d", "u", Decimal("5.00"), far), ("end", "x", far, far))

    def run():
        joined = os_.order_status(stream(spark, ORDER, orders_dir),
                                  stream(spark, STATUS, status_dir), watermark="10 minutes")
        finish(append_stream(joined, out, f"{tmp_path}/cp"))

    # Files follow event time; each run goes on from the checkpoint of the last.
    for i in range(3):
        edge = START + timedelta(minutes=10 * 14 * (i + 1)), START + timedelta(minutes=140 * i)
        add_file(spark, [o for o in orders if edge[1] <= o[6] < edge[0]], ORDER, orders_dir)
        last = edge[0] if i < 2 else far
        add_file(spark, [s for s in statuses if edge[1] <= s[3] < last], STATUS, status_dir)
        run()
    add_file(spark, [flush[0]], ORDER, orders_dir)
    add_file(spark, [flush[1]], STATUS, status_dir)
    run()
    wanted = os_.order_status(spark.createDataFrame(orders, ORDER),
                              spark.createDataFrame(statuses, STATUS))
    shown = ("order_id", "order_event_time", "status_event_time", "is_delayed")
    settled = read_table(spark, out).filter("order_id <> 'end'")
    assert rows(settled, *shown) == rows(wanted, *shown)

    late = ("late", START, "r", "d", "u", Decimal("5.00"), START)
    add_file(spark, [late], ORDER, orders_dir)
    add_file(spark, [("end", "y", far + timedelta(days=1), far + timedelta(days=1))],
             STATUS, status_dir)
    run()
    assert read_table(spark, out).filter("order_id = 'late'").isEmpty()


def test_running_totals_are_read_from_the_state(spark, rows, tmp_path):
    schema = ("driver_key string, order_id string, restaurant_key string, customer_key string, "
              "total_amount decimal(10,2), delivery_time_minutes double, is_delayed boolean, "
              "is_delivered boolean")
    src = f"{tmp_path}/src"
    state = ServedState(f"{tmp_path}/cp", {"driver_key": F.col("driver_key")}, performance.driver_parts())
    data = [(None if i == 7 else f"d{i % 5}", f"o{i}", "r", "c", None if i % 9 == 0 else Decimal(f"{i}.25"), i / 3,
             i % 2 == 0, None) for i in range(30)]

    def figures(batch=None):
        totals = state.read(spark, batch)
        return performance.driver_figures(performance.estimated(totals, performance.DRIVER_COUNTS))

    assert state.read(spark) is None
    for i in range(3):
        add_file(spark, data[10 * i:10 * i + 10], schema, src)
        finish(state.maintain(stream(spark, schema, src)))
        # Small sketches are exact.
        assert rows(figures()) == rows(performance.driver_performance(spark.createDataFrame(data[:10 * i + 10], schema)))
    assert rows(figures(0)) == rows(performance.driver_performance(spark.createDataFrame(data[:10], schema)))
    wide = ServedState(f"{tmp_path}/cp", state.keys, {"n": F.count(F.lit(1))})
    with pytest.raises(ValueError, match="one for each"):
        wide.read(spark)


def test_windows_merge_to_wider_ones(spark, rows):
    schema = ("restaurant_key string, driver_key string, customer_key string, total_amount decimal(10,2), "
              "delivery_time_minutes double, is_delayed boolean, is_delivered boolean, order_event_time timestamp")
    rng = random.Random(2)
    data = [(f"r{i % 3}", f"d{rng.randrange(9)}", f"c{rng.randrange(40)}", Decimal(rng.randrange(9999)) / 100,
             rng.randrange(9000) / 60, rng.random() < .3, None if i % 5 == 0 else i % 2 == 0,
             START + timedelta(minutes=rng.randrange(600))) for i in range(500)]
    statuses = spark.createDataFrame(data, schema)
    merged = performance.widened(performance.restaurant_windows(statuses), "1 hour")
    figures = performance.restaurant_figures(performance.estimated(merged, performance.RESTAURANT_COUNTS))
    assert rows(figures) == rows(performance.restaurant_performance(statuses, window="1 hour"))


def test_change_tables_over_batches_equal_batch(spark, rows, tmp_path):
    events = random_events(5, {"hot": 60, "b": 20, "c": 3, "d": 1})
    rng = random.Random(1)
    events.sort(key=lambda e: e[1] + rng.random() * 120)
    src = f"{tmp_path}/src"
    names = spark.createDataFrame([], SCHEMA).columns
    current = CurrentState(f"{tmp_path}/cp-c", RULES, names)
    history = HistoryTable(f"{tmp_path}/history", RULES, parts=3, width=50, hot=None)
    size = len(events) // 4 + 1
    for i in range(4):
        add_file(spark, events[i * size:(i + 1) * size], SCHEMA, src)
        finish(maintain(stream(spark, SCHEMA, src), history, f"{tmp_path}/cp-h"))
        finish(current.maintain(stream(spark, SCHEMA, src)))
        so_far = spark.createDataFrame(events[:(i + 1) * size], SCHEMA)
        assert rows(history.read(spark), *VERSION) == rows(cf.scd2(so_far, RULES, None), *VERSION)
        assert rows(current.read(spark), "k", "v", "u") == rows(cf.scd1(so_far, RULES),
                                                                "k", "v", "u")
    assert rows(current.read(spark, 1), "k", "v") == rows(
        cf.scd1(spark.createDataFrame(events[:2 * size], SCHEMA), RULES), "k", "v")


def test_batch_cut_off_after_staging_is_put_in_place_again(spark, rows, tmp_path, monkeypatch):
    table = HistoryTable(f"{tmp_path}/t", RULES, parts=2, hot=None)
    first = spark.createDataFrame([("a", 1, "A", 1, "U", 0), ("b", 1, "B", 1, "U", 0)], SCHEMA)
    second = spark.createDataFrame([("a", 2, "A2", 2, "U", 0)], SCHEMA)
    before, after = [("A", 1, None), ("B", 1, None)], [("A", 1, 2), ("A2", 2, None), ("B", 1, None)]
    shown = ("v", cf.START, cf.END)

    table.update(first, 0)
    # Staging of batch 1 is complete, but the table lost the folders it was replacing.
    writer = type(spark.range(1).write)
    real = writer.parquet

    def broken(self, path, *args, **kwargs):
        if path.endswith("/rows"):
            raise RuntimeError("driver lost")
        return real(self, path, *args, **kwargs)

    monkeypatch.setattr(writer, "parquet", broken)
    with pytest.raises(RuntimeError):
        table.update(second, 1)
    monkeypatch.undo()
    assert rows(table.read(spark), *shown) == before
    table.update(second, 1)
    table.update(second, 1)
    assert rows(table.read(spark), *shown) == after


def test_only_parts_with_late_keys_are_read_again(spark, rows, tmp_path, monkeypatch):
    table = HistoryTable(f"{tmp_path}/t", RULES, parts=8, width=10, hot=None)
    keys = "abcdefgh"
    events = [[(k, n, f"{k}{n}", n, "U", 0) for k in keys for n in (5, 25, 45)],
              # One key is late, the others go on; its part's ranges before the event stay unread.
              [("a", 30, "late", 3, "U", 0), *((k, 65, f"{k}65", 65, "U", 0) for k in keys[1:])]]
    log, ended = [], []
    read_log, read_runs = EventLog.read, KeyedTable.read
    monkeypatch.setattr(EventLog, "read", lambda self, s, bounds: log.append(bounds) or read_log(self, s, bounds))

    def runs(self, s, parts=None, bounds=None):
        found = read_runs(self, s, parts, bounds)
        if found is not None and bounds:
            ended.append(found.select("key_part", "range_part").distinct().collect())
        return found

    monkeypatch.setattr(KeyedTable, "read", runs)
    for i, batch in enumerate(events):
        table.update(spark.createDataFrame(batch, SCHEMA), i)
    part = spark.createDataFrame([("a",)], "k string").select(F.pmod(F.hash("k"), F.lit(8))).first()[0]
    # The late event lies in a run from 25 to 45.
    assert log == [{part: 2}]
    assert {(p, r) for p, r in ended[0] if r >= 0} == {(part, 4)}
    monkeypatch.undo()
    together = spark.createDataFrame(sum(events, []), SCHEMA)
    assert rows(table.read(spark), *VERSION) == rows(cf.scd2(together, RULES, None), *VERSION)


def test_folder_that_becomes_empty_holds_no_old_rows(spark, rows, tmp_path):
    table = HistoryTable(f"{tmp_path}/t", RULES, parts=1, width=2, hot=None)
    table.update(spark.createDataFrame(
        [("a", 1, "A", 1, "U", 0), ("a", 3, "B", 1, "U", 0), ("a", 5, "C", 1, "U", 0)],
        SCHEMA), 0)
    table.update(spark.createDataFrame([("a", 2, "B", 1, "U", 0)], SCHEMA), 1)
    assert rows(table.read(spark), "v", cf.START, cf.END) == [
        ("A", 1, 2), ("B", 2, 5), ("C", 5, None)]


def test_feed_that_comes_newest_first_has_files_for_several_tasks(spark, tmp_path, monkeypatch):
    """Each range was one file, written by one task and read by as few as it had row groups."""
    rows = [(k, datetime(2024, 1, 1), k % 5, "signup", 1.0, "{}") for k in range(90)]
    spark.createDataFrame(
        rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string",
    ).write.parquet(f"{tmp_path}/sf/events.parquet")
    monkeypatch.setattr(stream_queries, "FILE_EVENTS", 10)
    feed = stream_queries.change_feed_stream(spark, f"{tmp_path}/sf", f"{tmp_path}/w", files=3, newest_first=True)
    assert len(list((tmp_path / "w/events").glob("part-*"))) == 9
    seen = []
    feed.writeStream.foreachBatch(lambda batch, _: seen.append(sorted(r[0] for r in batch.select("user_id").collect()))).option(
        "checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    assert seen == [list(range(60, 90)), list(range(30, 60)), list(range(30))]

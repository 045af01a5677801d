"""The five jobs on small files, and the shape of physical plans."""

import gzip
import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from lodestrata.operators.snapshots import FINGERPRINT, changed_keys, fingerprint
from lodestrata.plans import datasets, deliveries, job_queries, realtime, restaurants, users_batch, users_stream
from lodestrata.plans.snapshot_history import SnapshotHistory

SF_DIR = "/root/testdata/sf0.001"


def put(folder, name, *records):
    folder.mkdir(exist_ok=True, parents=True)
    (folder / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n")


def order(key, at, amount=30.0):
    return {"order_id": key, "order_date": at, "restaurant_key": "r1", "driver_key": "d1",
            "user_key": "u1", "total_amount": amount, "dt_current_timestamp": at}


def status(number, key, at, name):
    millis = int(datetime.fromisoformat(at).timestamp() * 1000)
    return {"status_id": number, "order_identifier": key,
            "status": {"status_name": name, "timestamp": millis}, "dt_current_timestamp": at}


def test_deliveries_job(spark, rows, tmp_path):
    put(tmp_path / "in", "kafka_orders_1", order("a", "2024-01-01T10:00:00"))
    put(tmp_path / "in", "kafka_status_1", status(1, "a", "2024-01-01T10:10:00", "New"),
        status(2, "a", "2024-01-01T10:20:00", "New"))
    layers = deliveries.run(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    put(tmp_path / "in", "kafka_status_2", status(3, "a", "2024-01-01T11:10:00", "Done"))
    deliveries.run(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    assert rows(layers.read("gold_kpis"), "order_date", "status_name", "total_orders",
                "revenue") == [(date(2024, 1, 1), "Done", 1, 30.0),
                               (date(2024, 1, 1), "New", 2, 60.0)]


def test_realtime_job(spark, rows, tmp_path):
    put(tmp_path / "in/orders", "1.json", order("a", "2024-01-01T10:00:00"),
        order("b", "2024-01-01T10:01:00"), order("c", "2024-01-01T10:02:00"))
    put(tmp_path / "in/status", "1.json", status(1, "a", "2024-01-01T10:50:00", "In Transit"),
        status(2, "b", "2024-01-01T10:11:00", "Order Delivered"))
    put(tmp_path / "in/status", "cut.json", "{cut off", "")
    layers = realtime.run(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    # Input lines are good or bad, blank ones neither.
    assert rows(layers.quarantined("bronze_status"), "_bad_line") == [("{cut off",)]
    assert layers.read("bronze_status").count() == 2 and layers.quarantined("bronze_orders").isEmpty()
    put(tmp_path / "in/orders", "2.json", order("z", "2024-01-03T10:00:00"))
    put(tmp_path / "in/status", "2.json", status(9, "z", "2024-01-03T10:00:00", "Preparing"))
    realtime.run(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    silver = layers.read("silver_order_status")
    assert rows(silver, "order_id", "event_severity") == [
        ("a", "CRITICAL"), ("b", "INFO"), ("c", "NORMAL"), ("z", "NORMAL")]
    assert rows(layers.read("silver_delayed_orders"), "order_id") == [("a",)]
    assert spark.read.json(layers.path("alerts")).count() == 1
    windows = rows(layers.read("gold_restaurant_performance"), "window_start", "order_count",
                   "delayed_orders")
    assert windows == [(datetime(2024, 1, 1, 10), 3, 1)]
    drivers = layers.read("gold_driver_performance")
    assert rows(drivers, "driver_key", "total_deliveries", "delayed_deliveries") == [("d1", 4, 1)]
    assert all(r.last_updated is not None for r in drivers.collect())
    assert rows(layers.read("gold_delivery_time_distribution"), "time_bucket", "order_count") == [
        ("Slow", 1), ("Very Fast", 2)]
    assert layers.read("gold_platform_health").first().order_status_rows == 4


def test_realtime_job_reads_compressed_and_plain_files(spark, rows, tmp_path):
    put(tmp_path / "in/status", "1.json", status(1, "a", "2024-01-01T10:50:00", "In Transit"))
    put(tmp_path / "in/orders", "other.csv", "order_id,total_amount", "y,1")
    (tmp_path / "in/orders/1.json.gz").write_bytes(gzip.compress(json.dumps(order("a", "2024-01-01T10:00:00")).encode()))
    layers = realtime.run(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    assert rows(layers.read("bronze_orders"), "order_id") == [("a",)]
    put(tmp_path / "in/orders", "2.json", order("b", "2024-01-01T10:01:00"))
    (tmp_path / "in/orders/3.json.gz").write_bytes(gzip.compress(json.dumps(order("c", "2024-01-01T10:02:00")).encode()))
    realtime.run(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    assert rows(layers.read("bronze_orders"), "order_id") == [("a",), ("b",), ("c",)]
    assert layers.quarantined("bronze_orders").isEmpty()


def test_restaurants_job(spark, rows, tmp_path):
    put(tmp_path / "in/restaurants", "1.json",
        {"restaurant_id": 1, "name": " One ", "cnpj": "ab1", "cuisine_type": "x", "city": "c",
         "country": "z"}, {"restaurant_id": None, "name": "none"})
    put(tmp_path / "in/ratings", "1.json", *[
        {"rating_id": i, "restaurant_identifier": " AB1", "rating": r,
         "timestamp": "2024-01-01T00:00:00"} for i, r in enumerate([5, 4, 1, 9])])
    put(tmp_path / "in/products", "1.json",
        {"product_id": 1, "restaurant_id": 1, "name": "p", "price": 2.0, "unit_cost": 0.5})
    put(tmp_path / "in/inventory", "1.json",
        {"stock_id": 1, "restaurant_id": 1, "product_id": 1, "quantity_available": 3,
         "last_updated": "2024-01-01T00:00:00"})
    layers = restaurants.run(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    assert rows(layers.read("silver_products"), "profit_margin") == [(1.5,)]
    assert rows(layers.read("gold_restaurant_summary"), "restaurant_name", "total_ratings",
                "avg_rating", "high_ratings_pct") == [("One", 3, 3.33, 66.67)]
    assert rows(layers.read("gold_product_summary"), "total_inventory_value") == [(6.0,)]
    assert rows(layers.read("gold_restaurant_inventory"), "unique_products") == [(1,)]
    assert rows(layers.read("gold_city_summary"), "total_ratings") == [(3,)]
    assert layers.read("gold_cuisine_summary").isEmpty()

    spark.sql(f"CREATE DATABASE lodestrata_test LOCATION '{tmp_path}/catalog'")
    try:
        layers.register("lodestrata_test", datasets.RESTAURANTS)
        # A second run adds rows, and registers the tables again.
        put(tmp_path / "in/products", "2.json", "{cut off",
            {"product_id": 2, "restaurant_id": 1, "name": "q", "price": 3.0, "unit_cost": 0.5})
        restaurants.run(spark, f"{tmp_path}/in", f"{tmp_path}/out", database="lodestrata_test")
        for name, count in (("fact_inventory", 1), ("silver_products", 2), ("bronze_products", 2)):
            assert spark.table(f"lodestrata_test.{name}").count() == count
        assert "_bad_line" not in spark.table("lodestrata_test.bronze_products").columns
        found = {t.name: t.description for t in spark.catalog.listTables("lodestrata_test")}
        assert found == {d.name: d.comment for d in datasets.RESTAURANTS}
        for dataset in datasets.RESTAURANTS:
            kept = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES lodestrata_test.{dataset.name}").collect()}
            assert kept["quality"] == dataset.properties["quality"] and kept["grain"] == dataset.grain
        spark.read.parquet(layers.path("dim_product")).withColumn("more", F.lit(1)).write.parquet(f"{tmp_path}/wider")
        datasets.Dataset("lodestrata_test.dim_product", "wider").register(spark, f"{tmp_path}/wider")
        assert "more" in spark.table("lodestrata_test.dim_product").columns
        assert layers.read("dim_product").count() == 2
    finally:
        spark.sql("DROP DATABASE lodestrata_test CASCADE")


def test_realtime_job_running_all_at_once(spark, rows, tmp_path):
    def put_orders(number, day):
        put(tmp_path / "in/orders", f"{number}.json", order(f"o{number}", f"2024-01-0{day}T10:00:00"))
        put(tmp_path / "in/status", f"{number}.json",
            status(number, f"o{number}", f"2024-01-0{day}T10:50:00", "In Transit"))

    def continuous():
        return realtime.run(spark, f"{tmp_path}/in", f"{tmp_path}/out", trigger={"processingTime": "0 seconds"})

    put_orders(1, 1)
    realtime.run(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    put_orders(2, 2)
    layers = continuous()
    assert len(layers.running.queries) == 8
    # Stopped while rows are on their way, and started again with more.
    layers.running.stop()
    put_orders(3, 3)
    layers = continuous()
    try:
        layers.running.catch_up()
        realtime.serve(layers)
    finally:
        layers.running.stop()
    assert rows(layers.read("silver_order_status"), "order_id", "current_status") == [
        (f"o{n}", "In Transit") for n in (1, 2, 3)]
    assert rows(layers.read("silver_delayed_orders"), "order_id") == [("o1",), ("o2",), ("o3",)]
    assert rows(layers.read("gold_driver_performance"), "total_deliveries") == [(3,)]
    assert spark.read.json(layers.path("alerts")).count() == 3


def test_users_batch_job(spark, rows, tmp_path):
    def mongo(cpf, city):
        return {"cpf": cpf, "user_id": "1", "city": city, "email": "e",
                "dt_current_timestamp": "2024-01-01 00:00:00"}

    put(tmp_path / "in/mongo", "1.json", mongo("a", "X"), mongo("b", "X"))
    put(tmp_path / "in/mssql", "1.json", {"cpf": "a", "first_name": "Ana", "job": "Gerente"})

    def run(number):
        return users_batch.run(spark, f"{tmp_path}/in", f"{tmp_path}/out", snapshot=number,
                               at=datetime(2024, 1, number), as_of=F.lit(date(2024, 2, 1)))

    run(1)
    put(tmp_path / "in/mongo", "1.json", mongo("a", "Y"), mongo("c", "X"))
    run(2)
    layers = run(2)
    found = rows(users_batch.history(layers), "cpf", "city", "is_current")
    assert found == [("a", "X", False), ("a", "Y", True), ("b", "X", False), ("c", "X", True)]
    assert layers.read("silver_users_appended").count() == 4
    analytics = rows(layers.read("gold_user_analytics"), "city", "user_count",
                     "avg_changes_per_user", "top_job_category")
    assert analytics == [("X", 1, 0.0, "Unknown"), ("Y", 1, 1.0, "Leadership")]


def test_users_batch_load_repeated_with_other_input(spark, rows, tmp_path):
    def load(number, *cities):
        put(tmp_path / "in/mongo", "1.json", *[
            {"cpf": cpf, "user_id": "x1", "city": city, "dt_current_timestamp": "not a time"} for cpf, city in cities])
        put(tmp_path / "in/mssql", "1.json", {"cpf": "a", "birthday": "31/12/1990"})
        return users_batch.run(spark, f"{tmp_path}/in", f"{tmp_path}/out", snapshot=number,
                               at=datetime(2024, 1, number), as_of=F.lit(date(2024, 2, 1)))

    load(1, ("a", "X"), ("b", "X"))
    load(2, ("a", "Y"), ("b", "Z"))
    layers = load(2, ("a", "X"), ("b", "X"))
    found = rows(users_batch.history(layers), "cpf", "city", "is_current", "user_id", "birthday")
    assert found == [("a", "X", True, None, None), ("b", "X", True, None, None)]
    with pytest.raises(ValueError):
        load(1, ("a", "X"))


def test_history_by_fingerprints(spark, rows, tmp_path):
    kept = SnapshotHistory(spark, f"{tmp_path}/history", ["k"], ["a", "t"])

    def load(number, *found, tracked="k INT, a STRING, t TIMESTAMP, other INT"):
        kept.apply(spark.createDataFrame(found, tracked), number, F.lit(datetime(2024, 1, number)))

    def versions():
        return rows(kept.read(), "k", "a", "other", F.day("start_date"), F.day("end_date"))

    moment = datetime(2024, 1, 1, 0, 0, 0, 1)
    assert kept.read() is None
    load(1, (1, None, moment, 1), (2, "", moment, 1), (3, "x", moment, 1), (4, "x", None, 1))
    # Only what is tracked counts; NULL is not empty; one microsecond is a change.
    load(2, (1, "", moment, 2), (2, "", moment, 2), (3, "x", moment.replace(microsecond=2), 2))
    expected = [(1, "", 2, 2, None), (1, None, 1, 1, 2), (2, "", 1, 1, None), (3, "x", 1, 1, 2),
                (3, "x", 2, 2, None), (4, "x", 1, 1, 2)]
    assert versions() == expected
    # A load writes only what it changed: three rows here, none where nothing did.
    assert spark.read.parquet(f"{tmp_path}/history/versions/snapshot=2").count() == 2
    load(3, (1, "", moment, 3), (2, "", moment, 3), (3, "x", moment.replace(microsecond=2), 3))
    assert versions() == expected
    assert spark.read.parquet(f"{tmp_path}/history/versions/snapshot=3").isEmpty()
    load(4, (4, "x", None, 4))
    assert versions()[-1] == (4, "x", 4, 4, None) and len(versions()) == 7
    # Repeated with other rows; unfinished loads are not read; earlier ones can't be repeated.
    load(4, (2, "", moment, 4))
    assert [v[0] for v in versions() if v[-1] is None] == [2]
    kept._mark(4, False)
    assert versions() == expected
    with pytest.raises(ValueError):
        load(2)


def test_unchanged_snapshot_rows_are_not_shuffled(spark, tmp_path):
    kept = SnapshotHistory(spark, f"{tmp_path}/history", ["k"], ["a"])
    users = spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("a"), F.lit("wide").alias("other"))
    kept.apply(users, 1, F.lit(datetime(2024, 1, 1)))
    changed = changed_keys(kept.open_keys([1]), users.select("k", fingerprint(users, ["a"]).alias(FINGERPRINT)), ["k"])
    text = plan(changed)
    assert "versions" not in text and "wide" not in text and changed.isEmpty()


def test_users_stream_job(spark, rows, tmp_path):
    def change(cpf, number, operation="UPDATE", **fields):
        return {"cpf": cpf, "user_id": 1, "operation": operation, "sequenceNum": number,
                "dt_current_timestamp": "2024-01-01T00:00:00", **fields}

    put(tmp_path / "in/mongo", "1.json", change("a", 1, city="X", unknown="u"),
        change("b", 2, city="X"))
    put(tmp_path / "in/mssql", "1.json", change("a", 3, first_name="Ana"))

    def run():
        return users_stream.run(spark, f"{tmp_path}/in", f"{tmp_path}/out", parts=2, width=10)

    layers = run()
    put(tmp_path / "in/mongo", "2.json", change("b", 5, "DELETE"), change("a", 4, city="Y"))
    run()
    assert rows(users_stream.current(layers).read(spark), "cpf", "city") == [("a", "Y")]
    assert rows(layers.read("gold_user_demographics"), "city", "total_users") == [("Y", 1)]
    assert rows(layers.read("gold_change_audit"), "cpf", "versions", "open_versions") == [
        ("a", 3, 1), ("b", 1, 0)]
    rescued = layers.read("bronze_mongo_users").filter("_rescued_data IS NOT NULL")
    assert rows(rescued, "_rescued_data") == [('{"unknown":"u"}',)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_row_is_limited_before_the_shuffle(spark):
    text = plan(queries()["users_dedup"](spark, SF_DIR))
    assert text.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("name", ["restaurant_summary", "user_analytics", "scd2_history",
                                  "order_status_interval", "scd1_current"])
def test_no_python_in_plans(spark, name):
    text = plan(queries()[name](spark, SF_DIR))
    assert "Python" not in text and "CartesianProduct" not in text \
        and "NestedLoop" not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(queries()["delayed_orders"](spark, SF_DIR))
    assert "EqualTo(event_type,purchase)" in text
    assert "props" not in text


def test_input_files_of_jobs_are_compressed(spark, tmp_path, monkeypatch):
    """Plain lines were two thirds of all that restaurants_job wrote and shuffled."""
    monkeypatch.setattr(job_queries, "FILE_ROWS", 400)
    rows = spark.range(1000, numPartitions=1).selectExpr("id", "concat('supplier#', id % 7) AS name")
    job_queries._as_files(rows, f"{tmp_path}/in")
    files = list(tmp_path.glob("in/part-*"))
    assert len(files) == 3 and all(f.name.endswith(".json.gz") for f in files)
    assert sum(f.stat().st_size for f in files) < 10_000
    job_queries._as_files(rows, f"{tmp_path}/in", "append")
    assert sorted(spark.read.json(f"{tmp_path}/in").collect()) == sorted(rows.unionAll(rows).collect())

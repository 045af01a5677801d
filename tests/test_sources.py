import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodestrata.sources import alerts, copy_into as loading, evolution, json_files, quarantine
from lodestrata.sources import schemas
from lodestrata.sources.tables import (
    Dataset, append_stream, append_to_table, finish, read_table, refresh, stream_table,
)


def put(folder, name, *records):
    folder.mkdir(exist_ok=True)
    text = "\n".join(r if isinstance(r, str) else json.dumps(r) for r in records)
    (folder / name).write_text(text + "\n")


def test_hints_and_lineage(spark, tmp_path):
    put(tmp_path / "orders", "a.json", {"order_id": "1", "total_amount": 1.5,
                                        "order_date": "2024-01-01T10:00:00Z"})
    put(tmp_path / "orders", "b.txt", {"order_id": "ignored"})
    df = json_files.read_json(spark, f"{tmp_path}/orders/*.json", hints=schemas.ORDER_HINTS)
    row = df.first()
    assert row.total_amount == Decimal("1.50")
    assert row.order_date == datetime(2024, 1, 1, 10)
    assert row.dt_current_timestamp is None
    assert row.source_file.endswith("a.json") and row.ingestion_timestamp is not None
    assert df.count() == 1


def test_timestamp_format(spark, tmp_path):
    put(tmp_path / "o", "a.json", {"order_id": "1", "order_date": "2024-01-01T10:00:00Z"})
    df = json_files.read_json(spark, f"{tmp_path}/o", schema=schemas.ORDER_EVENTS,
                              options={"timestampFormat": json_files.ORDER_TIME_FORMAT})
    assert df.first().order_date == datetime(2024, 1, 1, 10)


def test_stream_reads_each_file_once(spark, rows, tmp_path):
    source, out = tmp_path / "in", f"{tmp_path}/out"

    def run():
        raw = json_files.stream_json(spark, f"{source}/*.json", schema="id long", max_files=1,
                                     max_bytes=None)
        finish(append_stream(raw, out, f"{tmp_path}/cp"))

    put(source, "a.json", {"id": 1})
    put(source, "b.json", {"id": 2})
    run()
    run()
    put(source, "c.json", {"id": 3})
    run()
    assert rows(read_table(spark, out), "id") == [(1,), (2,), (3,)]


def test_schema_store(spark, tmp_path):
    store = schemas.SchemaStore(spark, f"{tmp_path}/schema")
    assert store.load() is None
    kept = schemas.as_struct("a long, b struct<c: string>")
    store.save(kept, "2024-01-01T00:00:00")
    assert store.load() == (kept, "2024-01-01T00:00:00")


def test_evolution_modes(spark, tmp_path):
    source = tmp_path / "in"
    put(source, "a.json", {"id": 1})

    def resolve(mode, name):
        store = schemas.SchemaStore(spark, f"{tmp_path}/schema-{name}")
        return evolution.resolve_schema(spark, str(source), store, mode).fieldNames()

    for mode in evolution.MODES:
        assert resolve(mode, mode) == ["id"]
    put(source, "b.json", {"id": 2, "extra": "x"})
    assert resolve("none", "none") == ["id"]
    assert resolve("rescue", "rescue") == ["id"]
    assert resolve("add", "add") == ["id", "extra"]
    assert resolve("add", "add") == ["id", "extra"]
    with pytest.raises(evolution.NewColumnsError, match="extra"):
        resolve("fail", "fail")
    with pytest.raises(ValueError):
        resolve("other", "other")


def test_rescue(spark, rows, tmp_path):
    put(tmp_path / "in", "a.json", {"id": 1}, {"id": 2, "extra": "x"}, {"id": "text"})
    lines = evolution.read_lines(spark, f"{tmp_path}/in")
    got = rows(evolution.parse_rescuing(lines, "id long"), "id", evolution.RESCUED)
    assert got == [(1, None), (2, '{"extra":"x"}'), (None, '{"id":"text"}')]


def test_quarantine(spark, rows, tmp_path):
    put(tmp_path / "in", "a.json", {"id": 1}, "{bad", {"id": 2})
    lines = evolution.read_lines(spark, f"{tmp_path}/in", stream=True)
    finish(append_stream(quarantine.marked(lines, "id long"), f"{tmp_path}/out",
                         f"{tmp_path}/cp", partition_by=[quarantine.BAD]))
    assert rows(quarantine.good_rows(spark, f"{tmp_path}/out"), "id") == [(1,), (2,)]
    assert rows(quarantine.bad_lines(spark, f"{tmp_path}/out"), quarantine.LINE) == [("{bad",)]


def test_copy_into(spark, rows, tmp_path):
    source, target = tmp_path / "in", f"{tmp_path}/table"
    put(source, "a.json", {"id": 1})
    loading.copy_into(spark, str(source), target)
    loading.copy_into(spark, str(source), target)
    put(source, "b.json", {"id": 2, "extra": "x"})
    loading.copy_into(spark, str(source), target)
    assert rows(loading.loaded(spark, target)) == [(1, None), (2, "x")]


def test_refresh_and_stream_of_table(spark, rows, tmp_path):
    path = f"{tmp_path}/t"
    refresh(spark.range(10), path)
    refresh(spark.range(5).withColumn("k", F.col("id") % 2), path, cluster_by=["k"])
    assert read_table(spark, path).count() == 5
    finish(append_stream(stream_table(spark, path), f"{tmp_path}/o", f"{tmp_path}/cp"))
    assert rows(read_table(spark, f"{tmp_path}/o"), "id") == [(i,) for i in range(5)]


def test_described_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    refresh(spark.range(3), path)
    data = Dataset("described_rows", "It's a table", "one row per id", {"quality": "gold"})
    data.register(spark, path)
    try:
        assert spark.table("described_rows").count() == 3
        properties = dict(tuple(r) for r in spark.sql("SHOW TBLPROPERTIES described_rows").collect())
        assert properties["quality"] == "gold" and properties["grain"] == "one row per id"
    finally:
        spark.sql("DROP TABLE described_rows")


def test_stream_into_catalog_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    refresh(spark.range(3), path)
    spark.sql(f"CREATE TABLE streamed_rows (id BIGINT) USING parquet LOCATION '{tmp_path}/c'")
    try:
        finish(append_to_table(stream_table(spark, path), "streamed_rows", f"{tmp_path}/cp"))
        assert spark.table("streamed_rows").count() == 3
    finally:
        spark.sql("DROP TABLE streamed_rows")


def test_alerts_are_sent(spark, tmp_path):
    path = f"{tmp_path}/t"
    refresh(spark.createDataFrame([("o1", 50.0)], "order_id string, delay double"), path)
    finish(alerts.send(alerts.payload(stream_table(spark, path)), f"{tmp_path}/cp",
                       path=f"{tmp_path}/out"))
    sent = spark.read.json(f"{tmp_path}/out").first()
    assert sent.key == "o1" and json.loads(sent.value) == {"order_id": "o1", "delay": 50.0}


def test_truncated_lines_are_rescued(spark, rows):
    lines = spark.createDataFrame([('{"a":1}',), ('{"a":2,"b":',), ("[1]",), ("",), (None,)], "value string")
    found = evolution.parse_rescuing(lines, "a BIGINT, b STRING")
    assert rows(found) == sorted([(1, None, None), (None, None, '{"a":2,"b":'), (None, None, "[1]"),
                                  (None, None, ""), (None, None, None)], key=str)


def test_stored_types_do_not_lose_values(spark, tmp_path):
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    spark.createDataFrame([('{"v":7}',)], "value string").write.text(source)
    loading.copy_into(spark, source, target)
    spark.createDataFrame([('{"v":7.25}',)], "value string").write.mode("append").text(source)
    with pytest.raises(schemas.ChangedTypeError):
        loading.copy_into(spark, source, target)
    assert [r.v for r in loading.loaded(spark, target).collect()] == [7]


def test_nested_fields_are_rescued(spark, rows):
    schema = ("a BIGINT, s STRUCT<x: BIGINT, t: STRUCT<y: STRING>>, l ARRAY<STRUCT<z: BIGINT>>, n ARRAY<BIGINT>, "
              "m MAP<STRING, BIGINT>")
    cases = {
        '{"a":1,"s":{"x":1,"extra":"y"}}': '{"s":{"extra":"y"}}',
        '{"s":{"x":"bad"}}': '{"s":{"x":"bad"}}',
        '{"s":{"x":2,"t":{"y":"k","q":[1,{"r":null}]}},"u":{"v":1.5}}': '{"s":{"t":{"q":[1,{"r":null}]}},"u":{"v":1.5}}',
        '{"s":"text","a":null}': '{"s":"text"}',
        '{"s":null,"l":null,"a":3}': None,
        '{"l":[{"z":1},{"z":3,"w":2}]}': '{"l":{"1":{"w":2}}}',
        # One bad element makes the whole array unreadable, so all of it is left.
        '{"l":[{"z":1},{"z":"no","w":2},7]}': '{"l":{"0":{"z":1},"1":{"z":"no","w":2},"2":7}}',
        '{"l":{"z":1}}': '{"l":{"z":1}}',
        '{"n":[1,2],"m":{"k":1}}': None,
        '{"n":"x"}': '{"n":"x"}',
        '{"q\\"uote":1}': '{"q\\"uote":1}',
        '{"a":1,"a":2}': '{"a":1,"a":2}',
        '{}': None, '[1]': '[1]', '3': '3', '{"a":1': '{"a":1', '': '',
    }
    lines = spark.createDataFrame([(k,) for k in cases], "value string").withColumn("line", F.col("value"))
    found = {r.line: r[evolution.RESCUED] for r in evolution.parse_rescuing(lines, schema).collect()}
    assert found == cases
    kept = evolution.parse_rescuing(lines, schema).filter("s.x = 2").first()
    assert kept.s.t.y == "k"


def test_schema_is_the_same_for_any_order_of_lines(spark, tmp_path):
    lines = ['{"a":1,"s":{"x":1}}', '{"a":2.5,"s":{"x":2,"y":[{"z":true}]}}', '{"b":"t","a":null,"n":null}', "{broken",
             '{"b":7,"o`d":1,"e":{}}']
    wanted = schemas.as_struct(
        "a DOUBLE, b STRING, e STRING, n STRING, `o``d` BIGINT, s STRUCT<x: BIGINT, y: ARRAY<STRUCT<z: BOOLEAN>>>")
    for k, order in enumerate((lines, lines[::-1])):
        for n, line in enumerate(order):
            put(tmp_path / f"in{k}", f"{n}.json", line)
        assert json_files.infer_schema(spark, f"{tmp_path}/in{k}") == wanted
    (tmp_path / "none").mkdir()
    put(tmp_path / "none", "a.json", "[1]")
    assert json_files.infer_schema(spark, f"{tmp_path}/none", hints="k DATE") == schemas.as_struct("k DATE")


def test_file_that_arrives_while_a_load_runs_keeps_its_columns(spark, rows, tmp_path, monkeypatch):
    source, target = tmp_path / "in", f"{tmp_path}/table"
    put(source, "a.json", {"id": 1})
    real = loading._load

    def slow(batch, batch_id, *rest):
        # The first batch has its list of files; this one comes with the next.
        if batch_id == 0:
            put(source, "b.json", {"id": 2, "late": "x"})
        real(batch, batch_id, *rest)

    monkeypatch.setattr(loading, "_load", slow)
    loading.copy_into(spark, str(source), target)
    loading.copy_into(spark, str(source), target)
    assert rows(loading.loaded(spark, target)) == [(1, None), (2, "x")]


def test_repeated_batch_replaces_what_it_wrote(spark, rows, tmp_path, monkeypatch):
    source, target = tmp_path / "in", f"{tmp_path}/table"
    put(source, "a.json", {"id": 1})
    real = loading._load

    def broken(batch, batch_id, *rest):
        real(batch, batch_id, *rest)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(loading, "_load", broken)
    with pytest.raises(RuntimeError, match="driver lost"):
        loading.copy_into(spark, str(source), target)
    monkeypatch.undo()
    loading.copy_into(spark, str(source), target)
    assert rows(loading.loaded(spark, target)) == [(1,)]

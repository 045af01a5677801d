import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestrata.operators import change_feed as cf
from lodestrata.operators.skew import HotKeys
from lodestrata.streaming.change_tables import HistoryTable

SCHEMA = "k string, seq long, v string, u int, op string, tie int"
RULES = cf.ChangeRules(keys=["k"], sequence="seq", deletes="op = 'D'", tracked=["v"],
                       control=["op", "seq", "tie"], tie_break="tie")
VERSION = ("k", "v", "u", cf.START, cf.END)


def one_by_one(events):
    """Versions by going through each key's events in order."""
    out = []
    for key in {e[0] for e in events}:
        best = {}
        for e in events:
            if e[0] == key and (e[1] not in best or e[5] > best[e[1]][5]):
                best[e[1]] = e
        current = None
        for seq in sorted(best):
            _, _, value, untracked, op, _ = best[seq]
            if op == "D":
                if current:
                    out.append((*current[:4], seq))
                current = None
            elif current and current[1] == value:
                current[2] = untracked
            else:
                if current:
                    out.append((*current[:4], seq))
                current = [key, value, untracked, seq]
        if current:
            out.append((*current, None))
    return sorted(out, key=str)


def random_events(seed, sizes):
    rng = random.Random(seed)
    events = []
    for key, n in sizes.items():
        for seq in rng.sample(range(10 * n), n):
            for tie in range(1 + (rng.random() < 0.1)):
                events.append((key, seq, rng.choice(["A", "B", None]), rng.randint(0, 9),
                               rng.choice("UUUUUD"), tie))
    rng.shuffle(events)
    return events


def versions(spark, rows, events, hot=None):
    return rows(cf.scd2(spark.createDataFrame(events, SCHEMA), RULES, hot), *VERSION)


@pytest.mark.parametrize("hot", [
    None, HotKeys(), HotKeys(rows_per_piece=20),
    HotKeys(rows_per_piece=2), HotKeys(rows_per_piece=1, max_cuts=50)])
def test_versions_equal_brute_force(spark, rows, hot):
    events = random_events(7, {"hot": 900, "warm": 120, "b": 5, "c": 1})
    assert versions(spark, rows, events, hot) == one_by_one(events)


event = st.tuples(st.sampled_from("ab"), st.integers(0, 8), st.sampled_from(["A", "B", None]),
                  st.integers(0, 3), st.sampled_from("UUD"), st.just(0))


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events=st.lists(event, min_size=1, max_size=16, unique_by=lambda e: (e[0], e[1])),
       order=st.randoms())
def test_any_order_gives_the_same_disjoint_versions(spark, rows, events, order):
    found = versions(spark, rows, events)
    assert found == one_by_one(events)
    shuffled = list(events)
    order.shuffle(shuffled)
    current = rows(cf.scd1(spark.createDataFrame(shuffled, SCHEMA), RULES), "k", "v", "u")
    assert current == sorted(((k, v, u) for k, v, u, _, end in found if end is None), key=str)
    for key in "ab":
        spans = sorted((s, e) for k, _, _, s, e in found if k == key)
        assert all(e is not None and e <= nxt for (_, e), (nxt, _) in zip(spans, spans[1:]))


def scd1(spark, rows, events, **options):
    return rows(cf.scd1(spark.createDataFrame(events, SCHEMA), RULES, **options), "k", "v", "u")


def test_newest_sequence_wins(spark, rows):
    events = [("a", 1, "A", 1, "U", 0), ("a", 3, "C", 3, "U", 0), ("a", 2, "B", 2, "U", 0)]
    assert scd1(spark, rows, events) == [("a", "C", 3)]


def test_late_update_does_not_undo_delete(spark, rows):
    assert scd1(spark, rows, [("a", 6, None, None, "D", 0), ("a", 5, "A", 1, "U", 0)]) == []


def test_partial_rows(spark, rows):
    events = [("a", 1, "A", None, "U", 0), ("a", 2, None, 2, "U", 0)]
    assert scd1(spark, rows, events) == [("a", None, 2)]
    assert scd1(spark, rows, events, ignore_nulls=True) == [("a", "A", 2)]
    after = events + [("a", 3, None, None, "D", 0), ("a", 4, None, 4, "U", 0)]
    assert scd1(spark, rows, after, ignore_nulls=True) == [("a", None, 4)]


def test_tie_break(spark, rows):
    events = [("a", 1, "low", 1, "U", 0), ("a", 1, "high", 2, "U", 1)]
    assert scd1(spark, rows, events) == [("a", "high", 2)]
    assert versions(spark, rows, events) == [("a", "high", 2, 1, None)]


def test_untracked_change_updates_in_place(spark, rows):
    events = [("a", 1, "A", 1, "U", 0), ("a", 2, "A", 9, "U", 0)]
    assert versions(spark, rows, events) == [("a", "A", 9, 1, None)]


def test_late_event_splits(spark, rows):
    events = [("a", 1, "A", 1, "U", 0), ("a", 3, "C", 3, "U", 0), ("a", 2, "B", 2, "U", 0)]
    assert versions(spark, rows, events) == [
        ("a", "A", 1, 1, 2), ("a", "B", 2, 2, 3), ("a", "C", 3, 3, None)]


def test_insert_after_delete_opens_a_version(spark, rows):
    events = [("a", 1, "A", 1, "U", 0), ("a", 2, "A", 1, "D", 0), ("a", 3, "A", 1, "U", 0)]
    assert versions(spark, rows, events) == [("a", "A", 1, 1, 2), ("a", "A", 1, 3, None)]


def test_union_pads_and_matches_by_name(spark, rows):
    one = spark.createDataFrame([("1", "e", 5)], "cpf string, email string, n int")
    two = spark.createDataFrame([(6, "Ana", "2"), (7, "x", None)],
                                "n int, first_name string, cpf string")
    got = cf.union_feeds(one, two, columns=["cpf", "email", "first_name", "n"], keys=["cpf"],
                         types={"n": "long"})
    assert rows(got) == [("1", "e", None, 5), ("2", None, "Ana", 6)]
    assert got.schema["n"].dataType.simpleString() == "bigint"


def test_equal_sequences_give_one_definite_row(spark, rows):
    events = spark.createDataFrame([("a", 1, "X"), ("a", 1, "Y")], "cpf string, n long, city string")
    rules = cf.ChangeRules(keys=["cpf"], sequence="n", deletes="false", tracked=["city"])
    for order in (events, events.orderBy("city"), events.orderBy(F.desc("city")).coalesce(1)):
        assert rows(cf.scd1(order, rules), "city") == [("Y",)]
        assert rows(cf.scd2(order, rules), "city") == [("Y",)]


@pytest.mark.parametrize("first", [1_700_000_000_000_000_000, -5_000_000])
def test_history_table_with_any_sequence(spark, rows, tmp_path, first):
    """Nanoseconds and negative numbers."""
    rules = cf.ChangeRules(keys=["cpf"], sequence="n", deletes="false", tracked=["city"])
    table = HistoryTable(f"{tmp_path}/t", rules, parts=2)
    for batch, (n, city) in enumerate([(first, "X"), (first + 4_000_000, "Y"), (first + 9_000_000, "Z")]):
        table.update(spark.createDataFrame([("a", n, city)], "cpf string, n long, city string"), batch)
    found = rows(table.read(spark), "city", cf.START, cf.END)
    assert found == sorted([("X", first, first + 4_000_000), ("Y", first + 4_000_000, first + 9_000_000),
                            ("Z", first + 9_000_000, None)], key=str)

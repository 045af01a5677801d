from datetime import date, datetime

from pyspark.sql import functions as F

from lodestrata.functions import columns as fc
from lodestrata.operators import snapshots, users

DELIVERY = ("cpf string, user_id string, email string, city string, "
            "dt_current_timestamp string, ingestion_timestamp timestamp")
PROFILE = ("cpf string, user_id string, first_name string, birthday string, "
           "dt_current_timestamp string, ingestion_timestamp timestamp")
NOW = datetime(2024, 1, 1)


def test_unify_prefers_delivery_and_newest(spark, rows):
    delivery = spark.createDataFrame([
        ("1", "10", "old@x", "A", "2024-01-01 00:00:00", NOW),
        ("1", "11", "new@x", "B", "2024-01-02 00:00:00", NOW),
        ("1", "12", "undated@x", "C", None, NOW),
        ("3", "30", "c@x", "C", None, NOW),
        (None, "9", "n@x", "N", None, NOW)], DELIVERY)
    profile = spark.createDataFrame([
        ("1", "99", "Ana", "1990-05-06", "2024-01-03 00:00:00", NOW),
        ("2", "20", "Bob", None, "2024-01-01 00:00:00", NOW),
        ("3", "31", "Cy", None, None, NOW)], PROFILE)
    got = rows(users.unify_users(delivery, profile))
    assert got == [
        ("1", 11, "new@x", "B", "Ana", date(1990, 5, 6), datetime(2024, 1, 3)),
        ("2", 20, None, None, "Bob", None, datetime(2024, 1, 1)),
        ("3", 30, "c@x", "C", "Cy", None, datetime(1900, 1, 1)),
    ]


def test_age_groups(spark, rows):
    ages = [17, 18, 25, 26, 35, 36, 50, 51, 65, 66, None]
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    got = [r[0] for r in df.select(
        fc.in_ranges(F.col("age"), users.AGE_GROUPS, users.UNKNOWN)).collect()]
    short = [g.split(" ")[0] for g in got]
    assert short == ["Unknown", "18-25", "18-25", "26-35", "26-35", "36-50", "36-50", "51-65",
                     "51-65", "65+", "Unknown"]


def test_age_of_day(spark):
    row = spark.sql("SELECT DATE '2000-01-01' AS b, DATE '2018-01-01' AS d").select(
        fc.age_on(F.col("b"), F.col("d")).alias("a")).first()
    assert row.a == 18


def test_job_categories(spark):
    jobs = ["Gerente", "Analista Junior", "Piloto", None]
    df = spark.createDataFrame([(j,) for j in jobs], "job string")
    got = [r[0] for r in df.select(
        fc.keyword_category(F.col("job"), users.JOB_CATEGORIES, "Other", "Unknown")).collect()]
    assert got == ["Leadership", "Professional", "Other", "Unknown"]


def test_grades(spark):
    df = spark.createDataFrame([(v,) for v in (90.0, 89.9, 75.0, 50.0, 49.9)], "v double")
    got = [r[0] for r in df.select(fc.graded(F.col("v"), users.GRADES, "Poor")).collect()]
    assert got == ["Excellent", "Good", "Good", "Fair", "Poor"]


def full_users(spark, *data):
    columns = ["cpf", "city", "email", "first_name", "last_name", "birthday", "job",
               "delivery_address"]
    return spark.createDataFrame(
        [tuple(d.get(c) for c in columns) for d in data],
        ", ".join(f"{c} {'date' if c == 'birthday' else 'string'}" for c in columns))


def test_analytics_with_repeated_users_counts_distinct(spark, rows):
    people = full_users(spark, {"cpf": "1", "email": "e"}, {"cpf": "1", "email": "e"},
                        {"cpf": "2", "job": "Gerente"})
    history = spark.createDataFrame([("1", NOW), ("1", NOW)], "cpf string, start_date timestamp")
    row = users.user_analytics(people, history, F.lit(date(2024, 1, 1))).first()
    assert (row.city, row.age_group, row.user_count, row.users_with_email) == \
        ("Unknown", "Unknown", 2, 1)
    assert row.profile_completeness_pct == 20.0 and row.data_quality_grade == "Poor"
    assert row.avg_changes_per_user == 0.7


def test_mode_tie_takes_smallest(spark):
    people = full_users(spark, {"cpf": "1", "job": "Gerente"}, {"cpf": "2", "job": "Designer"})
    history = spark.createDataFrame([], "cpf string, start_date timestamp")
    row = users.user_analytics(people, history, one_row_per_user=True).first()
    assert row.top_job_category == "Leadership"


def test_snapshot_diff(spark, rows):
    first = spark.createDataFrame([("same", "A"), ("change", "A"), ("gone", None)],
                                  "cpf string, city string")
    second = spark.createDataFrame([("same", "A"), ("change", "B"), ("new", "N")],
                                   "cpf string, city string")
    at1, at2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    history = snapshots.open_history(first, F.lit(at1))
    history = snapshots.apply_snapshot(history, second, keys=["cpf"], tracked=["city"],
                                       at=F.lit(at2))
    assert rows(history) == sorted([
        ("same", "A", at1, None, True), ("change", "A", at1, at2, False),
        ("change", "B", at2, None, True), ("gone", None, at1, at2, False),
        ("new", "N", at2, None, True)], key=str)
    third = snapshots.apply_snapshot(history, second, keys=["cpf"], tracked=["city"],
                                     at=F.lit(datetime(2024, 1, 3)))
    assert rows(third) == rows(history)

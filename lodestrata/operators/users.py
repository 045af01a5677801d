"""Unified users from two systems and the figures over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.columns import (
    age_on, all_present, graded, in_ranges, keyword_category,
)
from lodestrata.functions.metrics import percent, rounded
from lodestrata.operators.latest import latest_per_key, newest_first

# Age groups, job keywords, grades and the default time.
AGE_GROUPS = (
    (18, 25, "18-25 (Young Adults)"),
    (26, 35, "26-35 (Millennials)"),
    (36, 50, "36-50 (Gen X)"),
    (51, 65, "51-65 (Boomers)"),
    (66, None, "65+ (Seniors)"),
)
JOB_CATEGORIES = {
    "Leadership": ("Executivo", "Diretor", "Gerente"),
    "Management": ("Coordenador", "Supervisor", "Especialista"),
    "Professional": ("Analista", "Consultor", "Desenvolvedor"),
    "Entry-Level": ("Assistente", "Associado", "Junior"),
    "Technical": ("Designer", "Arquiteto", "Engenheiro"),
}
GRADES = ((90, "Excellent"), (75, "Good"), (50, "Fair"))
NO_TIME = "1900-01-01 00:00:00"
UNKNOWN = "Unknown"
HIGH_ACTIVITY_CHANGES = 5

DELIVERY_ONLY = ("email", "delivery_address", "city")
PROFILE_ONLY = ("first_name", "last_name", "birthday", "job", "company_name")
SHARED = ("user_id", "uuid", "phone_number", "country")


def newest_users(users: DataFrame, arrival: str = "ingestion_timestamp") -> DataFrame:
    """The latest row per cpf by event time, then by arrival."""
    return latest_per_key(users, ["cpf"], [
        newest_first("dt_current_timestamp"), newest_first(arrival, None)])


def unify_users(delivery: DataFrame, profile: DataFrame,
                arrival: str = "ingestion_timestamp") -> DataFrame:
    """Full outer join on cpf of the latest rows of both systems.

    Both sides leave their ranking partitioned by cpf, so the join adds no
    shuffle. Shared columns prefer the delivery system. Columns that neither
    source has are left out.
    """
    left = newest_users(delivery, arrival).alias("d")
    right = newest_users(profile, arrival).alias("p")
    here, there = set(delivery.columns), set(profile.columns)

    def shared(name: str) -> Column | None:
        sides = ([F.col(f"d.{name}")] if name in here else []) + \
                ([F.col(f"p.{name}")] if name in there else [])
        return F.coalesce(*sides) if sides else None

    columns = [F.coalesce("d.cpf", "p.cpf").alias("cpf")]
    for name in SHARED:
        value = shared(name)
        if value is not None:
            columns.append((value.try_cast("long") if name == "user_id" else value).alias(name))
    columns += [F.col(f"d.{name}").alias(name) for name in DELIVERY_ONLY if name in here]
    columns += [
        (F.col(f"p.{name}").try_cast("date") if name == "birthday" else F.col(f"p.{name}")).alias(name)
        for name in PROFILE_ONLY if name in there
    ]
    # Times are cast before they are compared: as text they would sort as text.
    default = F.lit(NO_TIME).cast("timestamp")
    newest = F.greatest(*[
        F.coalesce(F.col(f"{side}.dt_current_timestamp").try_cast("timestamp"), default)
        for side in ("d", "p")
    ])
    columns.append(newest.alias("dt_current_timestamp"))
    return left.join(right, F.col("d.cpf") == F.col("p.cpf"), "full").select(*columns)


def segments(users: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Age, age group, job category and completeness of each user."""
    day = F.current_date() if as_of is None else as_of
    known = users.filter(F.col("cpf").isNotNull()).withColumn("age", age_on(F.col("birthday"), day))
    return known.select(
        "cpf", "city", "email", "first_name", "last_name", "birthday", "job", "delivery_address",
        "age",
        in_ranges(F.col("age"), AGE_GROUPS, UNKNOWN).alias("age_group"),
        keyword_category(F.col("job"), JOB_CATEGORIES, "Other", UNKNOWN).alias("job_category"),
        all_present(*[F.col(c) for c in (
            "email", "first_name", "last_name", "birthday", "delivery_address", "job")])
        .alias("is_complete_profile"),
    )


def change_metrics(history: DataFrame, as_of: Column | None = None) -> DataFrame:
    """How often and when each user last changed."""
    day = F.current_date() if as_of is None else as_of
    return history.filter(F.col("cpf").isNotNull()).groupBy("cpf").agg(
        (F.count(F.lit(1)) - 1).alias("total_changes"),
        F.max("start_date").alias("last_change_date"),
    ).withColumn("days_since_last_change", F.datediff(day, F.col("last_change_date")))


def _users_with(column: str, one_row_per_user: bool) -> Column:
    present = F.col(column).isNotNull()
    if one_row_per_user:
        return F.count_if(present)
    return F.count_distinct(F.when(present, F.col("cpf")))


def user_analytics(
    users: DataFrame,
    history: DataFrame,
    as_of: Column | None = None,
    one_row_per_user: bool = False,
) -> DataFrame:
    """Figures per city and age group.

    Set ``one_row_per_user`` when ``users`` holds each cpf once, as a unified
    table does: distinct counts then are plain conditional counts, which spares
    an expansion of every row by the number of distinct expressions.
    """
    changes = change_metrics(history, as_of).select("cpf", "total_changes", "last_change_date")
    rows = segments(users, as_of).join(changes, "cpf", "left")
    times_changed = F.coalesce(F.col("total_changes"), F.lit(0))
    fields = {
        "users_with_email": "email",
        "users_with_name": "first_name",
        "users_with_birthday": "birthday",
        "users_with_job": "job",
        "users_with_address": "delivery_address",
    }
    grouped = rows.groupBy(F.coalesce("city", F.lit(UNKNOWN)).alias("city"), "age_group").agg(
        _users_with("cpf", one_row_per_user).alias("user_count"),
        rounded(F.avg("age"), 1).alias("avg_age"),
        *[_users_with(column, one_row_per_user).alias(name) for name, column in fields.items()],
        F.sum("is_complete_profile").alias("complete_profiles"),
        F.mode("job_category", True).alias("top_job_category"),
        rounded(F.avg(times_changed), 1).alias("avg_changes_per_user"),
        F.count_if(times_changed > HIGH_ACTIVITY_CHANGES).alias("high_activity_users"),
        F.max("last_change_date").alias("most_recent_change"),
    )
    filled = sum((F.col(name) for name in fields), F.lit(0))
    complete = percent(filled, F.col("user_count") * len(fields), 1)
    return grouped.withColumn("profile_completeness_pct", complete).withColumn(
        "data_quality_grade", graded(F.col("profile_completeness_pct"), GRADES, "Poor"))


def user_demographics(users: DataFrame, one_row_per_user: bool = False) -> DataFrame:
    """Users and filled fields per city of the current state."""
    return users.groupBy("city").agg(
        _users_with("cpf", one_row_per_user).alias("total_users"),
        _users_with("email", one_row_per_user).alias("users_with_email"),
        _users_with("delivery_address", one_row_per_user).alias("users_with_address"),
        _users_with("first_name", one_row_per_user).alias("users_with_profile"),
    )

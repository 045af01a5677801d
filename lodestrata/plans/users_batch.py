"""Users of two systems from full snapshots."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.operators import snapshots, users
from lodestrata.plans import datasets
from lodestrata.plans.layers import Layers
from lodestrata.plans.snapshot_history import LOAD, SnapshotHistory
from lodestrata.sources.evolution import read_lines
from lodestrata.sources.quarantine import BAD, marked
from lodestrata.sources.schemas import DELIVERY_USERS, PROFILE_USERS

TRACKED = (*users.SHARED, *users.DELIVERY_ONLY, *users.PROFILE_ONLY)


def run(spark: SparkSession, source: str, target: str, *, snapshot: int, at: datetime,
        as_of: Column | None = None, database: str | None = None) -> Layers:
    """Take in the snapshots in the folders mongo and mssql.

    ``snapshot`` numbers the load and ``at`` is its time. A load that is repeated
    replaces what it wrote before; only the last load can be repeated.
    """
    layers = Layers(spark, target)
    versions = _versions(layers)
    versions.refuse_if_later(snapshot)
    now = F.lit(at)
    for name, folder, schema in (("bronze_delivery_users", "mongo", DELIVERY_USERS),
                                 ("bronze_profile_users", "mssql", PROFILE_USERS)):
        lines = read_lines(spark, f"{source}/{folder}/*").filter(F.trim("value") != "")
        layers.refresh(name, marked(lines, schema).withColumn("ingestion_timestamp", now), partition_by=[BAD])
    layers.refresh("silver_users_staging", users.unify_users(
        layers.read("bronze_delivery_users"), layers.read("bronze_profile_users")))

    staging = layers.read("silver_users_staging")
    layers.refresh("silver_users_unified", snapshots.current_state(staging, now))
    # Replaces all that this load wrote before.
    layers.refresh(f"silver_users_appended/{LOAD}={snapshot}", snapshots.history_rows(staging, now))
    versions.apply(staging, snapshot, now)
    layers.refresh("gold_user_analytics", users.user_analytics(
        layers.read("silver_users_unified"), layers.read("silver_users_appended"), as_of,
        one_row_per_user=True))
    layers.register(database, datasets.USERS_BATCH)
    return layers


def history(layers: Layers) -> DataFrame:
    """All versions of all users after the last load."""
    return _versions(layers).read()


def _versions(layers: Layers) -> SnapshotHistory:
    return SnapshotHistory(layers.spark, layers.path("silver_users_history"), ["cpf"], TRACKED)

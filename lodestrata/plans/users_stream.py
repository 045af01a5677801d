"""Users of two systems from change events."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lodestrata.operators import change_feed as cf, users
from lodestrata.plans import datasets
from lodestrata.plans.layers import MAX_BYTES, Layers
from lodestrata.sources.evolution import parse_rescuing, read_lines
from lodestrata.sources.schemas import DELIVERY_CHANGES, PROFILE_CHANGES
from lodestrata.sources.tables import AVAILABLE_NOW
from lodestrata.streaming.change_tables import HistoryTable, maintain
from lodestrata.streaming.served import CurrentState

TRACKED = ("email", "delivery_address", "city", "first_name", "last_name", "job")
CONTROL = ("operation", "sequenceNum", "dt_current_timestamp", "source_rank")
COLUMNS = ("cpf", "user_id", *TRACKED, *CONTROL)
# Both systems share one sequence: on a tie the profile system counts.
RULES = cf.ChangeRules(keys=("cpf",), sequence="sequenceNum", tracked=TRACKED, control=CONTROL,
                       tie_break="source_rank")
FEEDS = {"mongo": DELIVERY_CHANGES, "mssql": PROFILE_CHANGES}


def run(spark: SparkSession, source: str, target: str, *,
        trigger: Mapping[str, object] | None = None, max_bytes: int = MAX_BYTES, parts: int = 64,
        width: int = 1_000_000,
        database: str | None = None) -> Layers:
    """``source`` holds the folders mongo and mssql."""
    layers = Layers(spark, target, trigger, max_bytes)
    for name, schema in FEEDS.items():
        lines = read_lines(spark, f"{source}/{name}/", stream=True, max_bytes=max_bytes)
        rows = parse_rescuing(lines, schema)
        layers.append(f"bronze_{name}_users",
                      rows.withColumn("ingestion_timestamp", F.current_timestamp()))
    feeds = [layers.stream(f"bronze_{name}_users").withColumn("source_rank", F.lit(rank))
             for rank, name in enumerate(FEEDS)]
    layers.append("silver_users_staging", cf.union_feeds(*feeds, columns=COLUMNS, keys=["cpf"]))

    staging, held = layers.stream("silver_users_staging"), current(layers)
    layers.settle(held.maintain(staging, trigger or AVAILABLE_NOW))
    history = HistoryTable(layers.path("silver_users_history"), RULES, parts=parts, width=width)
    layers.settle(maintain(staging, history, layers.checkpoint("silver_users_history"), trigger or AVAILABLE_NOW))
    users_now, versions = held.read(spark), history.read(spark)
    if users_now is not None:
        layers.refresh("gold_user_demographics", users.user_demographics(users_now, one_row_per_user=True))
    if versions is not None:
        layers.refresh("gold_change_audit", cf.version_audit(versions, ["cpf"]))
    layers.register(database, datasets.USERS_STREAM)
    return layers


def current(layers: Layers) -> CurrentState:
    """The current users: the state of their stream."""
    return CurrentState(layers.checkpoint("silver_users_current"), RULES, COLUMNS)

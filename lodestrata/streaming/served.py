"""Running aggregates and current rows, read from the state that Spark keeps for a stream.

The stream writes no table: its checkpoint is the only copy, changed groups are all
that a micro-batch uploads, and a read sees the state after one whole micro-batch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lodestrata.operators import change_feed as cf
from lodestrata.sources.tables import AVAILABLE_NOW

# What Spark says of a checkpoint without a finished micro-batch.
_NO_STATE_YET = ("STDS_COMMITTED_BATCH_UNAVAILABLE", "STDS_OFFSET_LOG_UNAVAILABLE")


class ServedState:
    """The groups of an unbounded streaming aggregation.

    The state holds what aggregates work on, not their results. So ``parts`` must be
    aggregates whose working value is one field, as counts, sums of whole numbers,
    least and greatest values (also of structs) and sketches are; averages and ratios are
    put together when the state is read. Groups are never evicted.
    """

    def __init__(self, checkpoint: str, keys: Mapping[str, Column], parts: Mapping[str, Column]) -> None:
        self.checkpoint = checkpoint
        self.keys = dict(keys)
        self.parts = dict(parts)

    def maintain(self, rows: DataFrame, trigger: Mapping[str, object] = AVAILABLE_NOW) -> StreamingQuery:
        totals = rows.groupBy(*[c.alias(name) for name, c in self.keys.items()]).agg(
            *[c.alias(name) for name, c in self.parts.items()])
        return totals.writeStream.outputMode("update").format("noop").option(
            "checkpointLocation", self.checkpoint).trigger(**trigger).start()

    def read(self, spark: SparkSession, batch: int | None = None) -> DataFrame | None:
        """Keys and parts after the last micro-batch, or after an earlier one; None before the first."""
        reader = spark.read.format("statestore")
        if batch is not None:
            reader = reader.option("batchId", batch)
        try:
            state = reader.load(self.checkpoint)
        except PySparkException as error:
            if any(reason in str(error) for reason in _NO_STATE_YET):
                return None
            raise
        return state.select(_named(state, "key", self.keys), _named(state, "value", self.parts)).select(
            "key.*", "value.*")


def _named(state: DataFrame, column: str, names: Mapping[str, Column]) -> Column:
    """A struct of the state with names of its own: Spark calls fields by their aggregate, several of them alike."""
    fields = state.schema[column].dataType.fields
    if len(fields) != len(names):
        raise ValueError(f"the state has {len(fields)} fields in {column}, not one for each of {list(names)}")
    # A cast goes by position.
    renamed = T.StructType([T.StructField(name, f.dataType) for name, f in zip(names, fields)])
    return F.col(column).cast(renamed).alias(column)


class CurrentState:
    """The winning event of each key of a change feed. Deletes stay in the state, so late events cannot undo them."""

    def __init__(self, checkpoint: str, rules: cf.ChangeRules, columns: Sequence[str]) -> None:
        self.rules = rules
        self.columns = list(columns)
        # The order ends with all other columns, so the greatest order is the whole winner.
        order = rules.order(self.columns)
        self.state = ServedState(
            checkpoint, {k: F.col(k) for k in rules.keys}, {"_event": F.max(F.struct(*order))})

    def maintain(self, events: DataFrame, trigger: Mapping[str, object] = AVAILABLE_NOW) -> StreamingQuery:
        return self.state.maintain(events.filter(F.col(self.rules.sequence).isNotNull()), trigger)

    def winners(self, spark: SparkSession, batch: int | None = None) -> DataFrame | None:
        found = self.state.read(spark, batch)
        return None if found is None else found.select(*self.rules.keys, "_event.*").select(*self.columns)

    def read(self, spark: SparkSession, batch: int | None = None) -> DataFrame | None:
        winners = self.winners(spark, batch)
        return None if winners is None else cf.current_rows(winners, self.rules)

"""History kept up to date by a stream of change events."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestrata.operators import change_feed as cf
from lodestrata.operators.skew import HotKeys
from lodestrata.sources.tables import AVAILABLE_NOW
from lodestrata.streaming.keyed_table import OPEN, PART, RANGE, KeyedTable, within

BATCH = "batch_part"


def least_ranges(ranges: DataFrame) -> dict[int, int]:
    """The least range of each part: one row per part, whatever the input."""
    return dict(ranges.groupBy(PART).agg(F.min(RANGE)).collect())


class EventLog:
    """All events, in folders by part, range and micro-batch. They are only ever added."""

    def __init__(self, path: str) -> None:
        self.path = path

    def append(self, placed: DataFrame, batch_id: int) -> None:
        """Add a batch. A batch that is repeated replaces its own folders."""
        placed.withColumn(BATCH, F.lit(batch_id)).hint("rebalance", PART, RANGE).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(PART, RANGE, BATCH).parquet(self.path)

    def read(self, spark: SparkSession, bounds: Mapping[int, int]) -> DataFrame:
        """The events of some parts, of each from a range on. Of events with one sequence number all are there."""
        return spark.read.parquet(self.path).filter(within(bounds)).drop(BATCH, PART, RANGE)


class HistoryTable:
    """All versions of each key.

    Runs are stored by the range in which they end, those still open apart. New
    events of a key mostly follow its open run: then only that run is needed. The
    event log and the ended runs are only read for keys with late events: of their
    parts, each from the range of its earliest late event on.
    """

    def __init__(self, path: str, rules: cf.ChangeRules, *, parts: int = 64,
                 width: int = 1_000_000, hot: HotKeys | None = HotKeys()) -> None:
        self.rules = rules
        self.hot = hot
        self.log = EventLog(f"{path}/log")
        self.runs = KeyedTable(f"{path}/runs", rules.keys, parts=parts,
                               ordered_by="_end", width=width)

    def read(self, spark: SparkSession) -> DataFrame | None:
        found = self.runs.rows(spark)
        return None if found is None else cf.versions(found, self.rules)

    def update(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        events = batch.filter(F.col(self.rules.sequence).isNotNull())
        parts = events.agg(self.runs.touched_parts()).first()[0]
        if not parts:
            return
        self.log.append(self._placed(events, F.col(self.rules.sequence)), batch_id)
        held: list[DataFrame] = []
        try:
            self.runs.replace(spark, batch_id, lambda: self._content(events, parts, held))
        finally:
            for df in held:
                df.unpersist()

    def _placed(self, df: DataFrame, value: Column) -> DataFrame:
        return df.withColumns({PART: self.runs.part_of(), RANGE: self.runs.range_of(value)})

    def _content(self, events: DataFrame, parts: list[int],
                 held: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
        """All rows of the folders that change, and those folders.

        What is held is as large as the batch and the runs it reopens.
        """

        def hold(df: DataFrame) -> DataFrame:
            held.append(df.persist())
            return df

        rules, spark = self.rules, events.sparkSession
        keys = list(rules.keys)
        opened = self.runs.read(spark, parts, {})
        if opened is None:
            rows = hold(self.runs.placed(cf.runs(events, rules, self.hot)))
            return rows, rows.select(PART, RANGE)

        known = opened.select(*keys, F.col("_last").alias("_known_to"))
        touched = hold(
            events.groupBy(*keys).agg(F.min(rules.sequence).alias("_from"))
            .join(known, keys, "left")
            .withColumn("_late", F.coalesce(F.col("_known_to") >= F.col("_from"), F.lit(False))))

        in_order = touched.filter(~F.col("_late")).select(*keys)
        # The open run goes on as one event at its start.
        base = opened.join(in_order, keys, "left_semi").withColumn(
            rules.sequence, F.col("_start")).drop("_start", "_end", "_deleted", PART, RANGE)
        following = events.join(in_order, keys, "left_semi")
        to_run = base.unionByName(following, allowMissingColumns=True)

        # Late keys go back to the start of the run that holds their first event. It ends after that.
        late = touched.filter("_late").select(*keys, "_from")
        late_from = least_ranges(self._placed(late, F.col("_from")))
        near = self.runs.read(spark, parts, late_from)
        holding = near.join(late, keys).filter(
            (F.col("_start") <= F.col("_from"))
            & (F.col("_end").isNull() | (F.col("_end") > F.col("_from")))
        ).select(*keys, F.col("_start").alias("_held_from"))
        low = hold(late.join(holding, keys, "left").select(
            *keys, F.coalesce("_held_from", "_from").alias("_low")))
        if late_from:
            logged = self.log.read(spark, least_ranges(self._placed(low, F.col("_low"))))
            again = logged.join(low, keys).filter(
                F.col(rules.sequence) >= F.col("_low")).drop("_low")
            to_run = to_run.unionByName(again, allowMissingColumns=True)

        new = hold(self.runs.placed(cf.runs(hold(to_run), rules, self.hot)))
        # Of a late key all runs from there on are old, of others the open one.
        decided = touched.select(*keys, "_late").join(low, keys, "left")

        def marked(rows: DataFrame) -> DataFrame:
            return rows.join(decided, keys, "left").withColumn("_old", F.coalesce(
                F.when(F.col("_late"), F.col("_start") >= F.col("_low"))
                .when(~F.col("_late"), F.col(RANGE) == OPEN), F.lit(False)))

        folders = hold(marked(near).filter("_old").select(PART, RANGE).unionByName(
            new.select(PART, RANGE)).distinct())
        # Folders that runs end in now hold other keys' runs as well.
        beside = self.runs.read(spark, parts, least_ranges(folders.filter(F.col(RANGE) != OPEN)))
        kept = marked(beside.join(folders, [PART, RANGE], "left_semi")).filter(~F.col("_old")).select(*near.columns)
        return kept.unionByName(new.select(*near.columns)), folders


def maintain(events: DataFrame, table: HistoryTable, checkpoint: str,
             trigger: Mapping[str, object] = AVAILABLE_NOW) -> StreamingQuery:
    """Apply a stream of change events to a table."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                table.update(batch, batch_id)
        finally:
            batch.unpersist()

    return events.writeStream.foreachBatch(apply).option(
        "checkpointLocation", checkpoint).trigger(**trigger).start()

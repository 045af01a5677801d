"""History of a table of which only full snapshots come."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestrata.operators.snapshots import FINGERPRINT, changed_keys, fingerprint

LOAD = "snapshot"


class SnapshotHistory:
    """Each version is written once, by the load that opened it; a load writes only what it changed.

    ``versions`` holds the rows that a load opened, ``changes`` the keys that it changed with the
    fingerprint of what is tracked (NULL where a key is gone), ``loads`` whether it is finished.
    The last change of a key tells its open version, so a load reads keys and fingerprints
    alone, and the end of a version is the time of the next change of its key. What an
    unfinished load wrote is not read. Only the last load can be repeated: later ones build
    on it. Keys must be unique in a snapshot and not NULL.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], tracked: Sequence[str]) -> None:
        self.spark, self.path = spark, path
        self.keys, self.tracked = list(keys), list(tracked)

    def loads(self) -> list[int]:
        """Numbers of the finished loads, ascending."""
        try:
            marks = self.spark.read.parquet(f"{self.path}/loads")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted(row[0] for row in marks.filter("finished").select(LOAD).collect())

    def refuse_if_later(self, load: int) -> None:
        later = [n for n in self.loads() if n > load]
        if later:
            raise ValueError(f"load {load} can't be repeated after load {later[-1]}")

    def apply(self, rows: DataFrame, load: int, at: Column) -> None:
        """Take in the snapshot ``rows``; a load that is repeated replaces what it wrote before."""
        self.refuse_if_later(load)
        before = [n for n in self.loads() if n < load]
        self._mark(load, False)
        now = rows.select(*self.keys, fingerprint(rows, self.tracked).alias(FINGERPRINT))
        changed = changed_keys(self.open_keys(before), now, self.keys) if before else now
        changed.withColumn("at", at).write.mode("overwrite").parquet(f"{self.path}/changes/{LOAD}={load}")
        opened = rows.withColumn("start_date", at)
        if before:
            # Few keys change as a rule: then Spark broadcasts them, and no whole row is shuffled.
            opened = opened.join(
                self._changes([load]).filter(F.col(FINGERPRINT).isNotNull()).select(*self.keys), self.keys, "left_semi")
        opened.write.mode("overwrite").parquet(f"{self.path}/versions/{LOAD}={load}")
        self._mark(load, True)

    def open_keys(self, loads: Sequence[int]) -> DataFrame:
        """(keys, fingerprint) of the versions that are open after some loads; no version is read."""
        last = self._changes(loads).groupBy(*self.keys).agg(
            F.max_by(F.struct(FINGERPRINT), LOAD)[FINGERPRINT].alias(FINGERPRINT))
        return last.filter(F.col(FINGERPRINT).isNotNull())

    def read(self) -> DataFrame | None:
        """All versions after the finished loads, with start_date, end_date and is_current."""
        loads = self.loads()
        if not loads:
            return None
        following = Window.partitionBy(*self.keys).orderBy(LOAD)
        spans = self._changes(loads).withColumn("end_date", F.lead("at").over(following)).filter(
            F.col(FINGERPRINT).isNotNull()).select(*self.keys, LOAD, "end_date")
        versions = self._table("versions", loads)
        columns = [c for c in versions.columns if c != LOAD]
        return versions.join(spans, [*self.keys, LOAD]).select(
            *columns, "end_date", F.col("end_date").isNull().alias("is_current"))

    def _changes(self, loads: Sequence[int]) -> DataFrame:
        return self._table("changes", loads)

    def _table(self, name: str, loads: Sequence[int]) -> DataFrame:
        """The folders of some loads; others are not read."""
        return self.spark.read.parquet(f"{self.path}/{name}").filter(F.col(LOAD).isin(list(loads)))

    def _mark(self, load: int, finished: bool) -> None:
        self.spark.range(1).select(F.lit(finished).alias("finished")).write.mode("overwrite").parquet(
            f"{self.path}/loads/{LOAD}={load}")

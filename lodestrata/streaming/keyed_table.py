"""A Parquet table that a stream updates by key.

Rows lie in folders by a hash of the key and, if wanted, by ranges of an ordering
number. A micro-batch reads and rewrites only the folders it touches. New
content is staged first and then put in place, so a batch that was cut off can be
repeated: if its staging is complete it is put in place again, otherwise it is
computed again from the untouched table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PART, RANGE = "key_part", "range_part"
# The range of rows that have no ordering number yet; no 64-bit number over a width lies there.
OPEN = -(1 << 62)
_EMPTY = "_empty"


def within(bounds: Mapping[int, int]) -> Column:
    """Whether a folder belongs to one of the parts and lies in its range or a later one."""
    return reduce(or_, ((F.col(PART) == part) & (F.col(RANGE) >= least) for part, least in sorted(bounds.items())),
                  F.lit(False))


class KeyedTable:
    def __init__(self, path: str, keys: Sequence[str], *, parts: int = 64,
                 ordered_by: str | None = None, width: int = 1_000_000) -> None:
        self.path = path
        self.keys = list(keys)
        self.parts = parts
        self.ordered_by = ordered_by
        self.width = width

    def placed(self, df: DataFrame) -> DataFrame:
        """Add the folder columns."""
        return df.withColumns({
            PART: self.part_of(),
            RANGE: self.range_of(F.col(self.ordered_by)) if self.ordered_by else F.lit(0).cast("long"),
        })

    def part_of(self) -> Column:
        return F.pmod(F.hash(*self.keys), F.lit(self.parts))

    def range_of(self, value: Column) -> Column:
        number = F.floor(value.cast("double") / F.lit(self.width)).cast("long")
        return F.coalesce(number, F.lit(OPEN))

    def read(self, spark: SparkSession, parts: Sequence[int] | None = None,
             bounds: Mapping[int, int] | None = None) -> DataFrame | None:
        """The rows, or those of the given parts.

        With ``bounds`` these are the rows without an ordering number, and of each part
        in ``bounds`` those from a range on. The result has the folder columns; it is
        None before the first batch. Other folders are not read.
        """
        try:
            rows = spark.read.parquet(f"{self.path}/rows")
        except AnalysisException:
            return None
        rows = rows.filter(~F.col(_EMPTY)).drop(_EMPTY)
        if parts is not None:
            rows = rows.filter(F.col(PART).isin(*parts))
        if bounds is not None:
            rows = rows.filter((F.col(RANGE) == OPEN) | within(bounds))
        return rows

    def rows(self, spark: SparkSession) -> DataFrame | None:
        found = self.read(spark)
        return None if found is None else found.drop(PART, RANGE)

    def touched_parts(self) -> Column:
        """Aggregate of a batch: at most ``parts`` numbers, whatever its size."""
        return F.collect_set(self.part_of())

    def replace(self, spark: SparkSession, batch_id: int,
                content: Callable[[], tuple[DataFrame, DataFrame]]) -> None:
        """Put new content in place for one micro-batch.

        ``content`` gives all rows of the touched folders and the folders, which
        may have become empty.
        """
        if self._staged(spark) != batch_id:
            rows, folders = content()
            empty = folders.select(PART, RANGE).distinct().withColumn(_EMPTY, F.lit(True))
            staged = rows.withColumn(_EMPTY, F.lit(False)).unionByName(
                empty, allowMissingColumns=True)
            staged.hint("rebalance", PART, RANGE).write.mode("overwrite").partitionBy(
                PART, RANGE).parquet(f"{self.path}/staged")
            spark.range(1, numPartitions=1).select(F.lit(batch_id).alias("batch")).write.mode(
                "overwrite").parquet(f"{self.path}/staged_batch")
        spark.read.parquet(f"{self.path}/staged").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(PART, RANGE).parquet(
                f"{self.path}/rows")

    def _staged(self, spark: SparkSession) -> int | None:
        try:
            row = spark.read.parquet(f"{self.path}/staged_batch").first()
        except AnalysisException:
            return None
        return None if row is None else row[0]

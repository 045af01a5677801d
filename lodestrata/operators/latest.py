"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in ``order``; keys with a NULL are left out.

    The rank filter sits right on the window, so Spark keeps at most one row per
    key and map task before the shuffle: a key with very many rows costs no more
    than others.
    """
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def newest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key with the highest order, NULLs lowest.

    A maximum, so results of parts can be combined in any order: a table of
    latest rows can be kept from a stream this way.
    """
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("_newest")
    ).select(*keys, "_newest.*")


def newest_first(column: str, as_type: str | None = "timestamp") -> Column:
    """Descending order with NULLs last, on the cast value."""
    value = F.col(column) if as_type is None else F.col(column).try_cast(as_type)
    return value.desc_nulls_last()

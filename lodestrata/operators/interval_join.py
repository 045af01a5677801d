"""Time-bounded join of two event tables or streams."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.columns import epoch_seconds


def with_event_time(df: DataFrame, column: str, watermark: str | None = None) -> DataFrame:
    """Cast the event-time column and, for streams, declare how late it may be."""
    df = df.withColumn(column, F.col(column).try_cast("timestamp"))
    return df.withWatermark(column, watermark) if watermark else df


def interval_join(
    left: DataFrame,
    right: DataFrame,
    *,
    left_key: str,
    right_key: str,
    left_time: str,
    right_time: str,
    within_seconds: int,
    how: str = "left",
    sliced: bool = True,
    slice_seconds: int | None = None,
) -> DataFrame:
    """Rows of ``right`` at most ``within_seconds`` after a row of ``left`` with the same key.

    The same call serves batch and watermarked streams; in a stream the time
    bound also tells Spark when state may go. Column names of the two sides must
    differ.

    With ``sliced`` the join key also carries a slice of time, by default as long
    as the bound. A match lies in the slice of the left row or in the next one, so
    each right row is offered to two slices and each left row stays single, which
    keeps outer rows right. A key that holds a large share of all rows is thereby
    spread over its slices, and only neighbours in time are compared. Finer slices
    spread it more and copy right rows more often. Without slices each right row
    is shuffled once, which suits keys that are known to be small.
    """
    after = F.col(right_time) >= F.col(left_time)
    before = F.col(right_time) <= F.col(left_time) + F.expr(
        f"INTERVAL '{within_seconds}' SECOND")
    condition: Column = (F.col(left_key) == F.col(right_key)) & after & before
    if not sliced:
        return left.join(right, condition, how)

    width = slice_seconds or within_seconds
    back = math.ceil(within_seconds / width)
    left = left.withColumn("_left_slice", _slice(left_time, width))
    latest = _slice(right_time, width)
    right = right.withColumn(
        "_right_slice", F.explode(F.array(*[latest - i for i in range(back + 1)])))
    condition = condition & (F.col("_left_slice") == F.col("_right_slice"))
    return left.join(right, condition, how).drop("_left_slice", "_right_slice")


def _slice(column: str, seconds: int) -> Column:
    return F.floor(epoch_seconds(F.col(column)) / F.lit(seconds))

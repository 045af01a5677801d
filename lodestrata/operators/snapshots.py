"""Current state and history from full snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def current_state(snapshot: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """The snapshot itself, stamped: it replaces the table at every refresh."""
    return snapshot.withColumn(
        "updated_at", F.current_timestamp() if updated_at is None else updated_at)


def history_rows(snapshot: DataFrame, start: Column | None = None) -> DataFrame:
    """Rows to append to the history for one snapshot, each marked as current."""
    return snapshot.withColumn(
        "start_date", F.current_timestamp() if start is None else start
    ).withColumn("is_current", F.lit(True))


def open_history(snapshot: DataFrame, start: Column) -> DataFrame:
    """A history that begins with this snapshot."""
    return (
        snapshot.withColumn("start_date", start)
        .withColumn("end_date", F.lit(None).cast("timestamp"))
        .withColumn("is_current", F.lit(True))
    )


def apply_snapshot(history: DataFrame, snapshot: DataFrame, *, keys: Sequence[str],
                   tracked: Sequence[str], at: Column) -> DataFrame:
    """The history after one more snapshot.

    A changed key closes its version and opens one, a missing key closes, a new
    key opens, an unchanged key stays. Closed versions are only passed through:
    kept apart by ``is_current`` on disk, they are not shuffled. Keys must be
    unique among the current versions and in the snapshot.
    """
    columns = history.columns
    closed = history.filter(~F.col("is_current"))
    version = F.struct(*[F.col(c) for c in columns])
    before = history.filter("is_current").select(*keys, version.alias("_old"))
    after = open_history(snapshot, at).select(
        *keys, F.struct(*[F.col(c) for c in columns]).alias("_new"))
    pairs = before.join(after, list(keys), "full")

    def fields(side: str) -> Column:
        return F.struct(*[F.col(f"{side}.{name}") for name in tracked])

    same = (F.col("_old").isNotNull() & F.col("_new").isNotNull()
            & fields("_old").eqNullSafe(fields("_new")))
    ended = F.col("_old").withField("end_date", at).withField("is_current", F.lit(False))
    rows = F.array_compact(F.array(
        F.when(same, F.col("_old")).when(F.col("_old").isNotNull(), ended),
        F.when(~same & F.col("_new").isNotNull(), F.col("_new")),
    ))
    return closed.unionByName(pairs.select(F.inline(rows)).select(*columns))


FINGERPRINT = "_fingerprint"


def fingerprint(rows: DataFrame, columns: Sequence[str]) -> Column:
    """128 bits of the values of some columns, as 16 bytes.

    NULLs, empty texts and the borders between values are told apart. A value counts
    by its text, a timestamp by its microseconds, whatever the session's time zone.
    """
    def marked(name: str) -> Column:
        value = F.unix_micros(name) if isinstance(rows.schema[name].dataType, T.TimestampType) else F.col(name)
        text = value.cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.md5(F.concat(*[marked(c) for c in columns])))


def changed_keys(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose fingerprints differ between two tables of keys and fingerprints, with the one after: NULL if it ended.

    Only keys and 16 bytes a row are shuffled. Keys must be unique on each side.
    """
    now = after.select(*keys, F.col(FINGERPRINT).alias("_now"))
    pairs = before.select(*keys, FINGERPRINT).join(now, list(keys), "full")
    return pairs.filter(~F.col(FINGERPRINT).eqNullSafe(F.col("_now"))).select(*keys, F.col("_now").alias(FINGERPRINT))

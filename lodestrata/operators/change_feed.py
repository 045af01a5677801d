"""Current state and full history from change events.

Events of one key are ordered by a sequence, not by arrival. Of events with the
same key and sequence the one with the highest tie-break counts. A table holds
any number of events per key; no step keeps a key's events in one place at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.functions.columns import is_true
from lodestrata.operators.skew import HotKeys, cut_points, piece_of

START, END, CURRENT = "__START_AT", "__END_AT", "__CURRENT"


@dataclass(frozen=True)
class ChangeRules:
    """How events are keyed, ordered and read.

    ``deletes`` is a condition on an event. ``tracked`` columns open a new
    version when they change; others are updated in place. ``control`` columns
    do not reach the target. ``tie_break`` is a column, highest wins.
    """

    keys: Sequence[str]
    sequence: str
    deletes: str = "operation = 'DELETE'"
    tracked: Sequence[str] = ()
    control: Sequence[str] = ()
    tie_break: str | None = None

    def order(self, columns: Sequence[str] = ()) -> list[str]:
        """Sequence, tie-break, then the given columns, so that equal events are the only ties."""
        first = [self.sequence] + ([self.tie_break] if self.tie_break else [])
        return first + [c for c in columns if c not in first and c not in self.keys]

    def is_delete(self) -> Column:
        return is_true(F.expr(self.deletes))

    def kept(self, columns: Sequence[str]) -> list[str]:
        return [c for c in columns if c not in self.control]


def union_feeds(*feeds: DataFrame, columns: Sequence[str], keys: Sequence[str],
                types: dict[str, str] | None = None) -> DataFrame:
    """Events of several systems in one layout.

    Columns a system does not have are NULL; matching is by name. Events with a
    NULL key are left out. Works on batches and on streams.
    """
    types = types or {}
    known = {f.name: f.dataType for feed in reversed(feeds) for f in feed.schema.fields}

    def aligned(feed: DataFrame) -> DataFrame:
        values = []
        for name in columns:
            data_type = types.get(name, known[name])
            value = F.col(name) if name in feed.columns else F.lit(None)
            values.append(value.cast(data_type).alias(name))
        rows = feed.select(*values)
        for key in keys:
            rows = rows.filter(F.col(key).isNotNull())
        return rows

    first, *rest = [aligned(feed) for feed in feeds]
    for other in rest:
        first = first.unionByName(other)
    return first


def last_events(events: DataFrame, rules: ChangeRules) -> DataFrame:
    """The winning event of each key, deletes included, with its control columns.

    A maximum combines on the map side, so the size of a key does not matter,
    and any order of arrival or grouping gives the same row.
    """
    events = _ordered(events, rules)
    rest = [c for c in events.columns if c not in rules.keys]
    newest = F.max_by(F.struct(*rest), F.struct(*rules.order(events.columns)))
    return events.groupBy(*rules.keys).agg(newest.alias("_event")).select(
        *rules.keys, "_event.*").select(*events.columns)


def _ordered(events: DataFrame, rules: ChangeRules) -> DataFrame:
    """Events without a sequence have no place in the order and are left out."""
    return events.filter(F.col(rules.sequence).isNotNull())


def current_rows(winners: DataFrame, rules: ChangeRules) -> DataFrame:
    """Winning events as target rows: deletes and control columns removed."""
    return winners.filter(~rules.is_delete()).select(*rules.kept(winners.columns))


def scd1(events: DataFrame, rules: ChangeRules, ignore_nulls: bool = False) -> DataFrame:
    """The current row of each key.

    The newest event replaces the whole row, so columns its system does not send
    become NULL. With ``ignore_nulls`` each column keeps its newest value since
    the last delete.
    """
    if not ignore_nulls:
        return current_rows(last_events(events, rules), rules)
    events = _ordered(events, rules)
    order = F.struct(*rules.order(events.columns))
    deleted = rules.is_delete()
    values = [c for c in rules.kept(events.columns) if c not in rules.keys]
    newest = [
        # A delete takes part with NULL, so older values do not come back.
        F.max_by(F.when(~deleted, F.col(c)),
                 F.when(deleted | F.col(c).isNotNull(), order)).alias(c)
        for c in values
    ]
    merged = events.groupBy(*rules.keys).agg(F.max_by(deleted, order).alias("_deleted"), *newest)
    return merged.filter(~F.col("_deleted")).select(*rules.kept(events.columns))


def scd2(events: DataFrame, rules: ChangeRules, hot: HotKeys | None = HotKeys()) -> DataFrame:
    """All versions of each key with their start and end in the sequence.

    A version ends where the next version or a delete begins; the row after a
    delete always opens one.
    """
    return versions(runs(events, rules, hot), rules)


def versions(found: DataFrame, rules: ChangeRules) -> DataFrame:
    """Runs as target rows: runs of deletes only end the version before them."""
    columns = [c for c in rules.kept(found.columns) if not c.startswith("_")]
    return found.filter(~F.col("_deleted")).select(
        *columns,
        F.col("_start").alias(START),
        F.col("_end").alias(END),
        F.col("_end").isNull().alias(CURRENT),
    )


def runs(events: DataFrame, rules: ChangeRules, hot: HotKeys | None = HotKeys()) -> DataFrame:
    """Runs of equal tracked values, one row per run with its last event.

    Adds ``_start`` and ``_end`` (start of the next run), ``_last`` (sequence of
    the last event) and ``_deleted``. Keys are cut along the sequence, large ones
    in many pieces and most in one. Runs are found per piece with one shuffle and
    one sort; of keys with cuts, the first and last run of each piece are then
    compared across pieces.
    """
    events = _ordered(events, rules).withColumn("_deleted", rules.is_delete())
    keys = list(rules.keys)
    if hot is None:
        return _finished(_event_runs(events, rules, keys))
    placed = events.join(F.broadcast(cut_points(events, keys, rules.sequence, hot)), keys, "left")
    # Keys without cuts, mostly all, are sorted once; the pieces of the others are looked at twice.
    whole = _event_runs(placed.filter(F.col("_cuts").isNull()).drop("_cuts"), rules, keys)
    piece = piece_of(F.col(rules.sequence), F.col("_cuts"), hot.max_cuts * 4)
    pieces = _event_runs(
        placed.filter(F.col("_cuts").isNotNull()).withColumn("_piece", piece).drop("_cuts"), rules, [*keys, "_piece"])
    at_edge = F.col("_first") | F.col("_end").isNull()
    edges = _joined_edges(pieces.filter(at_edge), rules)
    return _finished(whole).unionByName(_finished(pieces.filter(~at_edge))).unionByName(_finished(edges))


def _event_runs(events: DataFrame, rules: ChangeRules, by: list[str]) -> DataFrame:
    order = [F.col(c) for c in rules.order([c for c in events.columns if not c.startswith("_")])]
    ordered = Window.partitionBy(*by).orderBy(*order)
    carried = "_last" in events.columns  # a stored run that goes on as one event
    # Of events with one sequence number only the last in tie-break order stays.
    following = F.lead(rules.sequence).over(ordered)
    single = events.withColumn("_following", following).filter(
        F.col("_following").isNull() | (F.col("_following") > F.col(rules.sequence))
    ).drop("_following")
    before = F.lag(F.struct(*_compared(rules))).over(ordered)
    marked = single.select(
        "*",
        (~before.eqNullSafe(F.struct(*_compared(rules)))).alias("_opens"),
        F.col(rules.sequence).alias("_start"),
        (F.coalesce("_last", rules.sequence) if carried else F.col(rules.sequence)).alias("_to"),
    ).drop("_last").withColumnRenamed("_to", "_last")
    return _last_of_run(marked, ordered)


def _joined_edges(edges: DataFrame, rules: ChangeRules) -> DataFrame:
    """Join runs that continue in the next piece of the same key."""
    ordered = Window.partitionBy(*rules.keys).orderBy("_start")
    before = F.lag(F.struct("_piece", *_compared(rules))).over(ordered)
    other_piece = F.col("_before._piece") != F.col("_piece")
    same_values = F.struct(*[F.col(f"_before.{c}") for c in _compared(rules)]).eqNullSafe(
        F.struct(*_compared(rules)))
    marked = (
        edges.withColumn("_known_end", F.col("_end"))
        .withColumn("_before", before)
        .withColumn("_opens", ~is_true(other_piece & same_values))
    )
    found = _last_of_run(marked.drop("_end"), ordered)
    return found.withColumn("_end", F.coalesce("_known_end", "_end")).drop("_known_end", "_before")


def _last_of_run(marked: DataFrame, ordered) -> DataFrame:
    """Keep the last row of each run, with the run's start and the next one's."""
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opened = F.max(F.when(F.col("_opens"), F.col("_start"))).over(so_far)
    return (
        marked.withColumns({
            "_end": F.lead("_start").over(ordered),
            "_next_opens": F.lead("_opens").over(ordered),
            "_opened": opened,
            "_first": opened == F.min("_start").over(so_far),
        })
        .filter(F.coalesce("_next_opens", F.lit(True)))
        .withColumn("_start", F.col("_opened"))
        .drop("_opened", "_next_opens", "_opens")
    )


def _compared(rules: ChangeRules) -> list[str]:
    return ["_deleted", *rules.tracked]


def _finished(found: DataFrame) -> DataFrame:
    return found.drop("_first", "_piece")


def change_audit(events: DataFrame, rules: ChangeRules) -> DataFrame:
    """Events, deletes and the last change of each key."""
    deleted = rules.is_delete()
    return events.groupBy(*rules.keys).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(deleted).alias("deletes"),
        F.min(rules.sequence).alias("first_sequence"),
        F.max(rules.sequence).alias("last_sequence"),
    )


def version_audit(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Versions of each key and when the last one began."""
    return history.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("versions"),
        F.count_if(F.col(CURRENT)).alias("open_versions"),
        F.max(START).alias("last_change_at"),
    )

"""Cutting the events of a key in pieces that fit a task, however many there are."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class HotKeys:
    """How many rows a piece has.

    A key gets about one cut for every ``rows_per_piece`` of its rows, so the
    number of its pieces follows from its size alone, and a small key mostly has
    none. ``max_cuts`` bounds the cuts of all keys together, about: for tables with
    more than ``max_cuts * rows_per_piece`` rows pieces get larger. The table of
    cuts is broadcast, and this is its bound.
    """

    rows_per_piece: int = 1_000_000
    max_cuts: int = 1_000_000

    def __post_init__(self) -> None:
        if self.rows_per_piece < 1 or self.max_cuts < 1:
            raise ValueError("rows_per_piece and max_cuts must be positive")


def cut_points(df: DataFrame, keys: Sequence[str], order: str, rule: HotKeys) -> DataFrame:
    """The values of ``order`` that cut a key, sorted in ``_cuts``; keys without any are left out.

    A value cuts where a hash of key and value is a multiple of the rows of a piece,
    so cuts lie evenly among the rows and no key has to be counted or sorted first.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    rows = F.greatest(F.lit(rule.rows_per_piece).cast("long"), F.floor(total / F.lit(rule.max_cuts)))
    chosen = F.pmod(F.xxhash64(*keys, order), rows) == 0
    return df.filter(chosen).groupBy(*keys).agg(F.sort_array(F.collect_set(order)).alias("_cuts"))


def piece_of(value: Column, cuts: Column, most: int = 1 << 30) -> Column:
    """Number of cut points at or below ``value``, by halving steps; 0 without cuts."""
    steps = [1 << k for k in range(most.bit_length() - 1, -1, -1)]
    found = F.aggregate(
        F.array(*[F.lit(step) for step in steps]),
        F.lit(0),
        lambda low, width: low + F.when(
            (low <= F.size(cuts) - width) & (F.get(cuts, low + width - 1) <= value), width).otherwise(0),
    )
    return F.when(cuts.isNull(), 0).otherwise(found)

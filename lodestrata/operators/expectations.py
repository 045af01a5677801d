"""Row-validity expectations that warn, drop or fail.

A condition that is NULL counts as violated, like in a filter.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lodestrata.functions.columns import is_true

ACTIONS = ("warn", "drop", "fail")


@dataclass(frozen=True)
class Expectation:
    name: str
    condition: str
    action: str = "drop"

    def __post_init__(self) -> None:
        if self.action not in ACTIONS:
            raise ValueError(f"unknown action {self.action!r}")

    def holds(self) -> Column:
        return F.expr(self.condition)

    def violated(self) -> Column:
        return ~is_true(self.holds())


def enforce(df: DataFrame, rules: Sequence[Expectation],
            observation: Observation | str | None = None) -> DataFrame:
    """Apply the rules in the pass that computes ``df``.

    Without an observation the drop rules are plain filters, which Spark pushes
    into the scan. With one, row and violation counts are collected on the way,
    in a batch write as well as in every micro-batch of a stream.
    """
    if observation is not None:
        df = df.observe(
            observation,
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(rule.violated()).alias(rule.name) for rule in rules],
        )
    for rule in rules:
        if rule.action == "drop":
            df = df.filter(rule.holds())
        elif rule.action == "fail":
            checked = F.assert_true(is_true(rule.holds()), F.lit(f"violated: {rule.name}"))
            df = df.filter(checked.isNull())
    return df


def with_violations(df: DataFrame, rules: Sequence[Expectation],
                    column: str = "violations") -> DataFrame:
    """Add the names of the rules each row violates."""
    names = [F.when(rule.violated(), F.lit(rule.name)) for rule in rules]
    return df.withColumn(column, F.array_compact(F.array(*names)))


def expectation_report(checked: Mapping[str, tuple[DataFrame, Sequence[Expectation]]]) -> DataFrame:
    """One row per dataset and rule with checked and violating rows.

    Every dataset is read once however many rules it has.
    """
    parts = []
    for dataset, (df, rules) in checked.items():
        counts = df.agg(
            F.count(F.lit(1)).alias("checked_rows"),
            *[F.count_if(rule.violated()).alias(f"_{i}") for i, rule in enumerate(rules)],
        )
        entries = F.array(*[
            F.struct(F.lit(rule.name).alias("expectation"), F.lit(rule.action).alias("action"),
                     F.col(f"_{i}").alias("violations"))
            for i, rule in enumerate(rules)
        ])
        parts.append(
            counts.select(F.lit(dataset).alias("dataset"), "checked_rows", F.inline(entries))
            .select("dataset", "expectation", "action", "checked_rows", "violations")
        )
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report

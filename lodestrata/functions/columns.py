"""Row-level column expressions. All are built-in functions, so they stay in codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalised_key(text: Column) -> Column:
    """Business keys compare trimmed and in upper case."""
    return F.upper(F.trim(text))


def from_epoch_millis(millis: Column) -> Column:
    """Epoch milliseconds to a timestamp of whole seconds."""
    return F.date_trunc("second", F.timestamp_millis(millis))


def epoch_seconds(moment: Column) -> Column:
    """Whole seconds since the epoch, for TIMESTAMP and TIMESTAMP_NTZ alike."""
    return moment.cast("timestamp").cast("long")


def minutes_between(start: Column, end: Column) -> Column:
    """Distance in minutes from whole seconds; NULL when either side is."""
    return F.abs(epoch_seconds(end) - epoch_seconds(start)) / F.lit(60)


def age_on(birthday: Column, day: Column) -> Column:
    """Completed years on ``day``, with years of 365.25 days."""
    return F.floor(F.datediff(day, birthday) / F.lit(365.25))


def bucketed(value: Column, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the first half-open range below its bound; the last label takes the rest.

    NULL falls to the last label too: filter it before if it should not.
    """
    if len(labels) != len(bounds) + 1:
        raise ValueError("one label more than bounds is needed")
    expr = F.when(value < bounds[0], labels[0])
    for bound, label in zip(bounds[1:], labels[1:-1]):
        expr = expr.when(value < bound, label)
    return expr.otherwise(labels[-1])


def in_ranges(value: Column, ranges: Sequence[tuple[float, float | None, str]],
              otherwise: str) -> Column:
    """Label of the closed range that holds ``value``; an open end is None."""
    expr = None
    for low, high, label in ranges:
        inside = value >= low if high is None else value.between(low, high)
        expr = F.when(inside, label) if expr is None else expr.when(inside, label)
    return expr.otherwise(otherwise)


def keyword_category(text: Column, rules: Mapping[str, Sequence[str]],
                     other: str, missing: str) -> Column:
    """First category one of whose keywords occurs in ``text``."""
    expr = F.when(text.isNull(), missing)
    for category, words in rules.items():
        found = text.contains(words[0])
        for word in words[1:]:
            found = found | text.contains(word)
        expr = expr.when(found, category)
    return expr.otherwise(other)


def graded(value: Column, floors: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first floor that ``value`` reaches."""
    expr = F.when(value >= floors[0][0], floors[0][1])
    for floor, label in floors[1:]:
        expr = expr.when(value >= floor, label)
    return expr.otherwise(otherwise)


def all_present(*columns: Column) -> Column:
    """1 when no column is NULL, else 0."""
    present = columns[0].isNotNull()
    for column in columns[1:]:
        present = present & column.isNotNull()
    return present.cast("int")


def typed_null(data_type: str) -> Column:
    return F.lit(None).cast(data_type)


def is_true(condition: Column) -> Column:
    """Two-valued form of a condition: NULL counts as false."""
    return F.coalesce(condition, F.lit(False))

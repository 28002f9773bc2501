"""Aggregates that can be computed in two steps: over rows, then over partial results.

Sliding windows and sessions first shrink the rows to one per key and time slot and then combine those, so
they need to know how a measure combines.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    name: str
    column: str | None
    over_rows: Callable[[Column], Column]
    over_partials: Callable[[Column], Column]

    @property
    def start(self) -> Column:
        rows = F.lit(1) if self.column is None else F.col(self.column)
        return self.over_rows(rows).alias(self.name)

    @property
    def merge(self) -> Column:
        return self.over_partials(F.col(self.name)).alias(self.name)


def total(column: str, name: str) -> Measure:
    return Measure(name, column, F.sum, F.sum)


def row_count(name: str) -> Measure:
    return Measure(name, None, F.count, F.sum)


def value_count(column: str, name: str) -> Measure:
    """Rows in which ``column`` is not null."""
    return Measure(name, column, F.count, F.sum)


def lowest(column: str, name: str) -> Measure:
    return Measure(name, column, F.min, F.min)


def highest(column: str, name: str) -> Measure:
    return Measure(name, column, F.max, F.max)

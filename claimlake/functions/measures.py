"""Measures of a group, stated once and used by every aggregated table.

A measure says what is measured, how it is put together and which rows count.  Totals and means add up decimals, so
they do not depend on how the rows are dealt out; an average adds up doubles.  ``Rollup`` groups by its keys and takes its measures in one aggregation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bands import money_avg, money_sum

_WAYS = {
    "number": F.count,
    "total": money_sum,
    "mean": money_avg,
    "average": F.avg,
    "largest": F.max,
    "kinds": F.count_distinct,
}


@dataclass(frozen=True)
class Measure:
    way: str
    of: str
    where: str | None = None

    def column(self) -> Column:
        if self.where is None:
            return _WAYS[self.way](F.expr(self.of))
        if self.way == "number":  # rows that meet the condition; those without an answer do not
            return F.count_if(F.coalesce(F.expr(self.where), F.lit(False)))
        return _WAYS[self.way](F.when(F.expr(self.where), F.expr(self.of)).otherwise(0))


def number(of: str = "*", where: str | None = None) -> Measure:
    return Measure("number", of, where)


def total(of: str, where: str | None = None) -> Measure:
    return Measure("total", of, where)


def mean(of: str) -> Measure:
    return Measure("mean", of)


def average(of: str) -> Measure:
    """Mean of doubles, added up as doubles: for scores whose mean is rounded again as SQL's AVG gives it."""
    return Measure("average", of)


def largest(of: str) -> Measure:
    return Measure("largest", of)


def kinds(of: str) -> Measure:
    return Measure("kinds", of)


@dataclass(frozen=True)
class Rollup:
    """Group keys (name → expression), measures, and columns computed from both afterwards."""

    keys: Mapping[str, str] | Sequence[str]
    measures: Mapping[str, Measure]
    then: Mapping[str, str] = field(default_factory=dict)

    def of(self, rows: DataFrame) -> DataFrame:
        keys = self.keys if isinstance(self.keys, Mapping) else {k: k for k in self.keys}
        out = rows.groupBy(*[F.expr(e).alias(k) for k, e in keys.items()]).agg(
            *[m.column().alias(name) for name, m in self.measures.items()])
        return out.withColumns({name: F.expr(e) for name, e in self.then.items()}) if self.then else out

"""Measures of a group, declared once and aggregated in one or several steps.

A ``Measure`` names what is taken of which column. ``columns`` gives the plain
aggregates of a frame; ``parts`` and ``wholes`` split the same measures over two
aggregations (partial results per finer group, then their combination), so
that a finer grouping can be passed through without reading the rows again.
Distinct counts are not additive and are left to the caller's finer grouping.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    """``kind``: count (non-null values), sum, max, min, mean or distinct; ``equals`` restricts a count to one value."""

    name: str
    kind: str
    column: str
    equals: str | None = None

    def whole(self, exact: bool) -> Column:
        c = F.col(self.column)
        if self.kind == "distinct":
            return F.count_distinct(c) if exact else F.approx_count_distinct(c)
        if self.kind == "count":
            return F.count(c) if self.equals is None else F.count_if(c == self.equals)
        return {"sum": F.sum, "max": F.max, "min": F.min, "mean": F.avg}[self.kind](c)


def columns(measures, exact: bool = False) -> list:
    return [m.whole(exact).alias(m.name) for m in measures]


def _steps(m: Measure) -> list:
    """The additive parts a measure is made of."""
    if m.kind == "mean":
        return [Measure(f"_{m.name}_sum", "sum", m.column), Measure(f"_{m.name}_n", "count", m.column)]
    return [m]


def parts(measures) -> list:
    """Partial aggregates per finer group."""
    return [p.whole(True).alias(p.name) for m in measures for p in _steps(m)]


def wholes(measures) -> list:
    """Combination of the partial aggregates per group."""
    fold = {"count": F.sum, "sum": F.sum, "max": F.max, "min": F.min}
    return [fold[p.kind](p.name).alias(p.name) for m in measures for p in _steps(m)]


def finished(df: DataFrame, measures) -> dict:
    """name -> column of every measure over the result of ``wholes``."""
    types = dict(df.dtypes)
    out = {}
    for m in measures:
        out[m.name] = F.col(m.name) if m.kind != "mean" else _mean(f"_{m.name}_sum", f"_{m.name}_n", types)
    return out


def _mean(total: str, n: str, types: dict) -> Column:
    t = F.col(total)
    if types[total].startswith("decimal"):
        t = t.cast("decimal(38,12)")  # the quotient keeps twelve places, as avg does
    return F.when(F.col(n) > 0, t / F.col(n))

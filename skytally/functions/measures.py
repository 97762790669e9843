"""Window measures: what to compute per key and window.

Every measure is algebraic. It is described by *parts* (counts, sums, minima, maxima) that can be
computed over slices of the rows and merged, so the window operators may pre-aggregate before they
shuffle and share slices between overlapping windows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS = "*"
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class Part:
    kind: str  # count | sum | wide_sum | min | max
    column: str
    tag: str = ""  # tells apart parts of the same kind over different rows

    @property
    def name(self) -> str:
        return ("__rows" if self.column == ROWS else f"__{self.kind}_{self.column}") + self.tag

    def over_rows(self) -> Column:
        """Aggregate of raw rows."""
        source = F.lit(1) if self.column == ROWS else F.col(f"`{self.column}`")
        if self.kind == "wide_sum":
            return F.sum(source.cast("decimal(20,0)"))
        return getattr(F, self.kind)(source)

    def over_parts(self, partial: Column) -> Column:
        """Aggregate of partial results, usable as a grouped or a windowed aggregate."""
        return getattr(F, self.kind)(partial) if self.kind in ("min", "max") else F.sum(partial)

    def merge(self, left: Column, right: Column) -> Column:
        """Two partial results, either of which may be null for an empty slice."""
        if self.kind == "min":
            return F.least(left, right)
        if self.kind == "max":
            return F.greatest(left, right)
        return F.coalesce(left + right, left, right)


ALL_ROWS = Part("count", ROWS)


@dataclass(frozen=True)
class Measure:
    alias: str
    kind: str  # count | sum | min | max | mean | long_mean | whole_mean | key_count
    column: str

    def parts(self) -> list[Part]:
        if self.kind == "key_count":
            return [ALL_ROWS]
        if self.kind == "long_mean":
            return [Part("wide_sum", self.column), Part("count", self.column)]
        if self.kind in ("mean", "whole_mean"):
            return [Part("sum", self.column), Part("count", self.column)]
        return [Part(self.kind, self.column)]

    def value(self, part: Callable[[Part], Column]) -> Column:
        """The finished measure, given how to obtain each part."""
        got = [part(p) for p in self.parts()]
        if self.kind in ("mean", "long_mean"):
            got = [got[0].cast("double") / F.nullif(got[1], F.lit(0))]
        elif self.kind == "whole_mean":
            got = [F.call_function("div", got[0], F.nullif(got[1], F.lit(0)))]
        elif self.kind == "key_count":
            got = [F.when(F.col(f"`{self.column}`").isNotNull(), got[0]).otherwise(F.lit(0).cast("bigint"))]
        return got[0].alias(self.alias)


def count(column: str, alias: str) -> Measure:
    """Rows whose ``column`` is not null."""
    return Measure(alias, "count", column)


def count_rows(alias: str) -> Measure:
    return Measure(alias, "count", ROWS)


def total(column: str, alias: str) -> Measure:
    return Measure(alias, "sum", column)


def smallest(column: str, alias: str) -> Measure:
    return Measure(alias, "min", column)


def largest(column: str, alias: str) -> Measure:
    return Measure(alias, "max", column)


def mean(column: str, alias: str, mode: str = "whole") -> Measure:
    """Average. ``whole`` cuts towards zero and yields BIGINT (integral columns); ``double`` does not cut."""
    kinds = {"whole": "whole_mean", "double": "mean"}
    if mode not in kinds:
        raise ValueError(f"mode must be one of {sorted(kinds)}, got {mode!r}")
    return Measure(alias, kinds[mode], column)


def for_keys(measures: Iterable[Measure], keys: Iterable[str]) -> list[Measure]:
    """The same measures, with counts of a grouping key taken from the row count."""
    return [
        Measure(m.alias, "key_count", m.column) if m.kind == "count" and m.column in keys else m
        for m in measures
    ]


def for_types(measures: Iterable[Measure], schema: T.StructType) -> list[Measure]:
    """The same measures; a plain average of BIGINTs adds up decimals, whose sum cannot overflow."""
    return [
        Measure(m.alias, "long_mean", m.column)
        if m.kind == "mean" and isinstance(schema[m.column].dataType, T.LongType)
        else m
        for m in measures
    ]


def check_types(measures: Iterable[Measure], schema: T.StructType) -> None:
    for m in measures:
        if m.kind == "whole_mean" and not isinstance(schema[m.column].dataType, INTEGRAL):
            raise TypeError(f"{m.alias}: a whole mean needs an integral column; use mode='double'")


def distinct_parts(measures: Iterable[Measure]) -> list[Part]:
    """The parts the measures need, each once, always with the row count."""
    return list(dict.fromkeys([ALL_ROWS, *(p for m in measures for p in m.parts())]))

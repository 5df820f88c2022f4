"""Rollup reports with labelled totals."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from starmill.functions.numbers import MONEY, half_up_ratio, truncated_ratio


@dataclass(frozen=True)
class Measure:
    """A result built from sums, so that leaf groups can be added up to totals."""

    name: str
    kind: str  # "average_money", "average_whole" or "count"
    column: str

    def partials(self) -> list[Column]:
        count = F.count(self.column).alias(f"__n_{self.name}")
        if self.kind == "count":
            return [count]
        typed = F.col(self.column).cast(MONEY if self.kind == "average_money" else "long")
        return [count, F.sum(typed).alias(f"__sum_{self.name}")]

    def result(self) -> Column:
        n = F.sum(f"__n_{self.name}")
        if self.kind == "count":
            return n.alias(self.name)
        total = F.sum(f"__sum_{self.name}")
        ratio = half_up_ratio if self.kind == "average_money" else truncated_ratio
        return ratio(total, n).alias(self.name)


def average_money(name: str, column: str) -> Measure:
    return Measure(name, "average_money", column)


def average_whole(name: str, column: str) -> Measure:
    return Measure(name, "average_whole", column)


def count_of(name: str, column: str) -> Measure:
    return Measure(name, "count", column)


def labelled_rollup(
    df: DataFrame, keys: Sequence[str], measures: Sequence[Measure], label: str = "ALL"
) -> DataFrame:
    """``keys`` rolled up from the right, with ``label`` in place of a rolled-up key.

    The table is grouped to its leaf groups first: a rollup copies every input row once per
    level, and after this step it copies groups instead of table rows. A group whose key is
    really NULL stays apart from the total.
    """
    leaves = df.groupBy(*keys).agg(*[p for m in measures for p in m.partials()])
    marked = leaves.rollup(*keys).agg(
        *[m.result() for m in measures], *[F.grouping(k).alias(f"__total_{k}") for k in keys]
    )
    labelled = [
        F.when(F.col(f"__total_{k}") == 1, F.lit(label)).otherwise(F.col(k)).alias(k) for k in keys
    ]
    return marked.select(*labelled, *[m.name for m in measures])

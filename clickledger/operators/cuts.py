"""Supervised cuts of numbers: recursive entropy splits that stop by minimum description length."""

from __future__ import annotations

import math
from dataclasses import astuple, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .quantiles import running_totals

_INFINITY = float("inf")


@dataclass(frozen=True)
class Split:
    """A cut of an interval: rows and positive rows in all and up to the cut."""

    cut: float
    n: int
    positive: int
    left: int
    left_positive: int

    def pays(self) -> bool:
        """Whether the gain passes the cost of telling the cut and the classes on its sides."""
        right, right_positive = self.n - self.left, self.positive - self.left_positive
        whole, one, two = (
            entropy(self.positive, self.n),
            entropy(self.left_positive, self.left),
            entropy(right_positive, right),
        )
        gain = whole - (self.left * one + right * two) / self.n
        kinds = [
            1 + (0 < positive < n)
            for positive, n in ((self.positive, self.n), (self.left_positive, self.left), (right_positive, right))
        ]
        told = math.log2(3 ** kinds[0] - 2) - (kinds[0] * whole - kinds[1] * one - kinds[2] * two)
        return gain > (math.log2(self.n - 1) + told) / self.n


def entropy(positive: int, n: int) -> float:
    """Bits of a label that is 1 in `positive` of `n` rows."""
    return -sum(p * math.log2(p) for p in (positive / n, 1 - positive / n) if 0 < p < 1)


def _entropy(positive: Column, n: Column) -> Column:
    p = positive / n
    part = lambda q: F.when((q > 0) & (q < 1), -q * F.log2(q)).otherwise(0.0)
    return part(p) + part(1 - p)


@dataclass(frozen=True)
class Interval:
    """Values (low, high] of a feature; rows and positive rows in it, and before it."""

    feature: str
    low: float
    high: float
    n: int
    positive: int
    before: int
    before_positive: int


def best_splits(totals: DataFrame, intervals: list[Interval]) -> list[tuple[Interval, Split]]:
    """The cut of least entropy of each interval; ties go to the smallest value.

    `totals`: running totals by feature and value. They tell the totals within any interval, too, so a pass over the distinct
    values needs no order and ends in one row for each interval.
    """
    spark = totals.sparkSession
    rows = [(k, *astuple(i)) for k, i in enumerate(intervals)]
    asked = spark.createDataFrame(
        rows, "number int, feature string, low double, high double, n long, positive long, before long, before_positive long"
    )
    here = (
        totals.select("feature", "value", "n_upto", "positive_upto")
        .join(F.broadcast(asked), "feature")
        .filter("value > low AND value <= high")
    )
    left, left_positive = F.col("n_upto") - F.col("before"), F.col("positive_upto") - F.col("before_positive")
    right, right_positive = F.col("n") - left, F.col("positive") - left_positive
    mixed = left * _entropy(left_positive, left) + right * _entropy(right_positive, right)
    found = (
        here.filter(left < F.col("n"))
        # rounded, so that equal cuts tie
        .withColumn("_order", F.struct(F.round(mixed / F.col("n"), 10), "value"))
        .groupBy("number")
        .agg(F.min_by(F.struct(F.col("value").alias("cut"), left.alias("a"), left_positive.alias("p")), "_order").alias("b"))
        .select("number", "b.*")
    )
    out = []
    for r in found.collect():
        i = intervals[r["number"]]
        out.append((i, Split(r["cut"], i.n, i.positive, r["a"], r["p"])))
    return out


def supervised_cuts(rows: DataFrame, label: str, columns: list[str]) -> tuple[dict[str, list[float]], DataFrame]:
    """Cuts of each column, in order, and the counts (feature, value, n, positive, ...) they come from.

    A value up to a cut lies left of it. `label` is 0 or 1; neither it nor the columns may be NULL. What is gathered is one
    row for each interval that is still open, of which a cut that pays makes two.
    """
    counts = (
        rows.select(F.col(label).alias("label"), *[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot(["label"], columns, "feature", "value")
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1).alias("positive"))
    )
    totals = written(running_totals(counts, ["feature"], "value", ["n", "positive"]), "value-totals")
    wholes = totals.groupBy("feature").agg(F.first("n_all").alias("n"), F.first("positive_all").alias("positive")).collect()
    cuts: dict[str, list[float]] = {c: [] for c in columns}
    waiting = [Interval(r["feature"], -_INFINITY, _INFINITY, r["n"], r["positive"], 0, 0) for r in wholes]
    while waiting:
        paying = [(i, s) for i, s in best_splits(totals, waiting) if s.pays()]
        waiting = []
        for i, s in paying:
            cuts[i.feature].append(s.cut)
            waiting += [
                Interval(i.feature, i.low, s.cut, s.left, s.left_positive, i.before, i.before_positive),
                Interval(
                    i.feature, s.cut, i.high, s.n - s.left, s.positive - s.left_positive,
                    i.before + s.left, i.before_positive + s.left_positive,
                ),
            ]
    return {c: sorted(found) for c, found in cuts.items()}, totals

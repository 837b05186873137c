"""Running totals and exact quantiles of big groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Spec = dict[str, tuple[Column, float]]


def _value_band(value: Column) -> Column:
    """A coarse whole number that never falls when the value rises: 1024 bands per doubling."""
    return F.floor(F.signum(value) * F.log2(1 + F.abs(value)) * 1024).cast("long")


def running_totals(
    counts: DataFrame, group: list[str], value: str, totals: list[str], following: str | None = None
) -> DataFrame:
    """Adds `{t}_upto`, the sum of t over the group's values up to the row's, and `{t}_all`, the group's sum.

    `following` names a column for the group's next value, NULL at its last.

    `counts` has one row per group and value (a number). Sums of value bands are taken first, so each window holds the values
    of one band, or the bands of one group; no group meets in one task.
    """
    banded = counts.withColumn("_band", _value_band(F.col(value)))
    bands = banded.groupBy(*group, "_band").agg(*[F.sum(t).alias(t) for t in totals], F.min(value).alias("_least"))
    per_group = Window.partitionBy(*group)
    in_order = per_group.orderBy("_band")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    keys = [*group, "_band"]
    bands = bands.select(
        *[F.col(k).alias(f"_of{k}") for k in keys],
        *[F.coalesce(F.sum(t).over(before), F.lit(0)).alias(f"_before_{t}") for t in totals],
        *[F.sum(t).over(per_group).alias(f"{t}_all") for t in totals],
        *([F.lead("_least").over(in_order).alias("_least_after")] if following else []),
    )
    # a NULL group is a group, too
    placed = banded.join(bands, [F.col(k).eqNullSafe(F.col(f"_of{k}")) for k in keys])
    by_value = Window.partitionBy(*keys).orderBy(value)
    inside = by_value.rowsBetween(Window.unboundedPreceding, 0)
    after = [F.coalesce(F.lead(value).over(by_value), F.col("_least_after")).alias(following)] if following else []
    return placed.select(
        *counts.columns,
        *[(F.col(f"_before_{t}") + F.sum(t).over(inside)).alias(f"{t}_upto") for t in totals],
        *[f"{t}_all" for t in totals],
        *after,
    )


def group_quantiles(df: DataFrame, keys: list[str], spec: Spec) -> DataFrame:
    """Exact quantiles per group with linear interpolation; NULL values do not count.

    `spec` maps each output column to (value, probability). Spark's own `percentile` keeps all distinct
    values of a group in one buffer. Here equal values are counted first and numbered by `running_totals`; each
    value then tells which of the positions asked for it holds.
    """
    sources = {str(v): v for v, _ in spec.values()}
    number = {text: i for i, text in enumerate(sources)}
    cells = F.array(
        *[
            F.struct(F.lit(number[text]).alias("m"), v.cast("double").alias("v"))
            for text, v in sources.items()
        ]
    )
    counts = (
        df.select(*keys, F.explode(cells).alias("_cell"))
        .select(*keys, F.col("_cell.m").alias("_m"), F.col("_cell.v").alias("_v"))
        .filter(F.col("_v").isNotNull())
        .groupBy(*keys, "_m", "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    placed = running_totals(counts, [*keys, "_m"], "_v", ["_n"])
    asked = F.array(
        *[
            F.struct(F.lit(number[str(v)]).alias("m"), F.lit(i).alias("id"), F.lit(float(p)).alias("p"))
            for i, (v, p) in enumerate(spec.values())
        ]
    )
    end, start = F.col("_n_upto"), F.col("_n_upto") - F.col("_n")
    last = F.col("_n_all") - 1

    def held(rank: Column) -> Column:
        return (start <= rank) & (rank < end)

    hits = F.filter(
        asked,
        lambda a: (a["m"] == F.col("_m")) & (start <= F.ceil(last * a["p"])) & (F.floor(last * a["p"]) < end),
    )
    position = last * F.col("_a.p")
    found = (
        placed.withColumn("_a", F.explode(hits))
        .groupBy(*keys, F.col("_a.id").alias("_id"))
        .agg(
            F.max(F.when(held(F.floor(position)), F.col("_v"))).alias("_low"),
            F.max(F.when(held(F.ceil(position)), F.col("_v"))).alias("_high"),
            F.max(position - F.floor(position)).alias("_weight"),
        )
    )
    low, high, weight = F.col("_low"), F.col("_high"), F.col("_weight")
    # equal neighbours give their own value, untouched by rounding
    value = F.when((weight == 0) | (low == high), low).otherwise((1 - weight) * low + weight * high)
    results = [F.max(F.when(F.col("_id") == i, value)).alias(name) for i, name in enumerate(spec)]
    return found.groupBy(*keys).agg(*results) if keys else found.agg(*results)

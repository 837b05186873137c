"""Ordered windows over keys too big for one task.

`chunk` names columns that cut the rows of a key into ordered pieces. Each piece gets its own window;
one summary row per piece is combined per key and joined back. With an empty chunk the functions are
the plain Spark window. All summaries are partial aggregates with one row per piece. Rows are written
before they are summed and joined to their own sums, so a chain of steps grows by a step each, not
twofold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written


def _orders(columns: list[str], backward: bool) -> list[Column]:
    return [F.col(c).desc() if backward else F.col(c).asc() for c in columns]


def running_count(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    chunk: list[str],
    name: str,
    weight: str | None = None,
    aside: bool = True,
) -> DataFrame:
    """Position of each row within its key, from 1; a row counts `weight` times and takes its last place.

    Without `aside` the rows are not written first: for those that little more than a scan makes, which may run twice.
    """
    inside = Window.partitionBy(*keys, *chunk).orderBy(*_orders(order, False))
    if weight:
        near = F.sum(weight).over(inside.rowsBetween(Window.unboundedPreceding, 0))
        size = F.sum(weight)
    else:
        near, size = F.row_number().over(inside), F.count(F.lit(1))
    if not chunk:
        return df.withColumn(name, near)
    df = written(df, "pieces") if aside else df
    ahead = Window.partitionBy(*keys).orderBy(*_orders(chunk, False))
    offsets = (
        df.groupBy(*keys, *chunk)
        .agg(size.alias("_n"))
        .select(
            *keys,
            *chunk,
            F.coalesce(
                F.sum("_n").over(ahead.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("_ahead"),
        )
    )
    return (
        df.join(offsets, [*keys, *chunk])
        .withColumn(name, (near + F.col("_ahead")).cast("long"))
        .drop("_ahead")
    )


def carried_last(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    chunk: list[str],
    value: Column,
    name: str,
    include_current: bool,
    backward: bool = False,
) -> DataFrame:
    """The last non-null `value` at or before each row (before it if not `include_current`).

    `backward` walks the order from its end, so it finds the next value instead.
    """
    edge = 0 if include_current else -1
    inside = Window.partitionBy(*keys, *chunk).orderBy(*_orders(order, backward))
    near = F.last(value, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, edge))
    if not chunk:
        return df.withColumn(name, near)
    df = written(df, "pieces")
    position = F.when(value.isNotNull(), F.struct(*order))
    pick = F.min_by if backward else F.max_by
    across = Window.partitionBy(*keys).orderBy(*_orders(chunk, backward))
    carried = (
        df.groupBy(*keys, *chunk)
        .agg(pick(value, position).alias("_tail"))
        .select(
            *keys,
            *chunk,
            F.last("_tail", ignorenulls=True)
            .over(across.rowsBetween(Window.unboundedPreceding, -1))
            .alias("_carried"),
        )
    )
    return (
        df.join(carried, [*keys, *chunk])
        .withColumn(name, F.coalesce(near, F.col("_carried")))
        .drop("_carried")
    )


def group_totals(
    df: DataFrame, keys: list[str], chunk: list[str], totals: dict[str, Column]
) -> DataFrame:
    """Sums over all rows of a key, attached to each of its rows."""
    if not chunk:
        whole = Window.partitionBy(*keys)
        return df.withColumns({name: F.sum(c).over(whole) for name, c in totals.items()})
    df = written(df, "pieces")
    whole = Window.partitionBy(*keys)
    sums = (
        df.groupBy(*keys, *chunk)
        .agg(*[F.sum(c).alias(name) for name, c in totals.items()])
        .withColumns({name: F.sum(name).over(whole) for name in totals})
    )
    return df.join(sums, [*keys, *chunk])

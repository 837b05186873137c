"""Keys that hold too many rows for one task.

A window sends all rows of a key to one task. Where a key can grow with the data, the plans look for
keys with too many rows and cut those by row count into ordered slices; all other rows keep the plain
window. The search runs at every size of the input, and its answer never changes a result, only how the
work is spread. Joins need none of this: adaptive execution splits the rows of a skewed key.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written


@dataclass(frozen=True)
class HotKeyRule:
    """A key is hot beyond `max_rows`, which is also about the size of its slices."""

    max_rows: int = 5_000_000


DEFAULT_RULE = HotKeyRule()


def hot_keys(
    df: DataFrame, keys: list[str], ts: str, rule: HotKeyRule = DEFAULT_RULE
) -> DataFrame | None:
    """The hot keys of `df` with the times (microseconds) at which their slices begin, or None.

    The times are quantiles, so slices are even in rows however the rows lie in time. Keys are counted
    by partial sums; only the rows of hot keys are looked at for their quantiles. The table stays in
    the shared folder.
    """
    counts = (
        df.select(*keys)
        .dropna()
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > rule.max_rows)
    )
    counts = written(counts, "hot_counts")
    most = counts.agg(F.max("_n")).first()[0]
    if most is None:
        return None
    pieces = -(-most // rule.max_rows)
    shares = [i / pieces for i in range(1, pieces)]
    at = F.unix_micros(ts)
    bounds = (
        df.join(counts, keys)
        .groupBy(*keys)
        .agg(F.percentile_approx(at, shares, 10 * pieces).alias("_bounds"))
        .withColumn("_bounds", F.array_distinct("_bounds"))
    )
    return written(bounds, "hot_keys")


def with_slices(df: DataFrame, keys: list[str], ts: str, hot: DataFrame | None) -> DataFrame:
    """Add `slice`: 0 for rows of ordinary keys, a rising number from 1 for rows of hot keys."""
    if hot is None:
        return df.withColumn("slice", F.lit(0).cast("long"))
    at = F.unix_micros(F.col(ts))
    number = F.size(F.filter("_bounds", lambda b: b < at)) + 1
    return (
        df.join(hot, keys, "left")
        .withColumn("slice", F.when(F.col("_bounds").isNull(), 0).otherwise(number).cast("long"))
        .drop("_bounds")
    )


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def per_heat(df: DataFrame, hot: DataFrame | None, step) -> DataFrame:
    """Run `step(rows, chunk)` plainly for ordinary rows and with chunk=['slice'] for hot ones."""
    if hot is None:
        return step(df.drop("slice"), [])
    df = written(df, "sliced")
    ordinary = df.filter(F.col("slice") == 0).drop("slice")
    sliced = df.filter(F.col("slice") > 0)
    return union_all([step(ordinary, []), step(sliced, ["slice"]).drop("slice")])


def spread_nulls(key: Column, by: Column) -> Column:
    """A join key in which NULLs (which match nothing) are spread evenly, by a unique column."""
    filler = F.concat(F.lit("\u0000"), F.xxhash64(by).cast("string"))
    return F.coalesce(key, filler)


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join `rows` to a table that has each key once: left, inner, left_semi or left_anti.

    Whether the table is sent to all tasks, and how a key that holds most of the rows (or none, NULL)
    is split, is decided by adaptive execution from the sizes it sees.
    """
    return rows.join(table, keys, how)

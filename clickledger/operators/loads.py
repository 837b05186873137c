"""Incremental load patterns as functions from DataFrames to the target's new content."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import berlin_day_start
from .skew import lookup

EPOCH = datetime(1970, 1, 1)


def upsert_by_key(
    target: DataFrame, stage: DataFrame, key: str
) -> DataFrame:
    """Drop target rows whose key is staged, then append the stage."""
    keys = stage.select(key).dropna().distinct()
    kept = lookup(target, keys, [key], "left_anti")
    return kept.unionByName(stage, allowMissingColumns=True)


def replace_tail(target: DataFrame, stage: DataFrame, ts: str) -> DataFrame:
    """Replace everything from the stage's first timestamp on; an empty stage changes nothing."""
    cut = stage.select(F.min(ts)).scalar()
    kept = target.filter(cut.isNull() | (F.col(ts) < cut))
    return kept.unionByName(stage, allowMissingColumns=True)


def replace_slice(
    target: DataFrame,
    stage: DataFrame,
    column: str,
    value: str,
    since: str | None = None,
) -> DataFrame:
    """Replace the rows with column = value, all of them or those from MIN(stage.since) on."""
    in_slice = F.col(column) == value
    if since:
        # an empty stage has no minimum and then nothing is replaced
        first = stage.select(F.min(since)).scalar()
        in_slice = in_slice & F.coalesce(F.col(since) >= first, F.lit(False))
    kept = target.filter(~F.coalesce(in_slice, F.lit(False)))
    return kept.unionByName(stage, allowMissingColumns=True)


def append_unseen(
    target: DataFrame, stage: DataFrame, key: str
) -> DataFrame:
    """Append stage rows whose key the target lacks. NULL keys in the target match nothing."""
    new = unseen(stage, target, key)
    return target.unionByName(new, allowMissingColumns=True)


def unseen(
    stage: DataFrame, target: DataFrame, key: str
) -> DataFrame:
    """Stage rows with a key the target lacks; rows without a key are left out."""
    known = target.select(key).dropna().distinct()
    return lookup(stage.filter(F.col(key).isNotNull()), known, [key], "left_anti")


def window_bounds(target: DataFrame, ts: str, load_log: DataFrame, job: str) -> tuple[Column, Column]:
    """Start and end of an incremental run, as scalar subqueries.

    Start: midnight of the last loaded day, read as Berlin time (the epoch for an empty target).
    End: the last time the load log has for the job.
    """
    start = target.select(
        berlin_day_start(F.coalesce(F.max(ts), F.lit(EPOCH))).alias("start_at")
    ).scalar()
    end = load_log.filter(F.col("job_title") == job).select(F.max("logged_at")).scalar()
    return start, end


def changed_keys(
    feeds: list[tuple[DataFrame, str, str]], loaded: DataFrame, loaded_at: str, overlap: str
) -> DataFrame:
    """Keys of all feeds touched since the last load minus an overlap, duplicates kept out."""
    since = loaded.select((F.max(loaded_at) - F.expr(f"INTERVAL {overlap}")).alias("since")).scalar()
    parts = [
        feed.filter(F.col(ts) > since).select(F.col(key).try_cast("long").alias("lead_id"))
        for feed, key, ts in feeds
    ]
    keys = parts[0]
    for part in parts[1:]:
        keys = keys.unionByName(part)
    return keys.dropna().distinct()


def partial_insert(target: DataFrame, stage: DataFrame) -> DataFrame:
    """Append rows that lack some of the target's columns; those become NULL."""
    return target.unionByName(stage, allowMissingColumns=True)


def repair_columns(df: DataFrame, where: Column, values: dict[str, Column]) -> DataFrame:
    """Set columns where the condition holds, keep them elsewhere."""
    where = F.coalesce(where, F.lit(False))
    known = set(df.columns)
    return df.withColumns(
        {
            name: F.when(where, value).otherwise(F.col(name) if name in known else F.lit(None))
            for name, value in values.items()
        }
    )

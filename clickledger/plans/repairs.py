"""Repairs of tracked and raw columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    int_string_to_timestamp,
    lenient_timestamp,
    prep_dis_sum,
    query_param,
    value_from_key,
)
from ..operators.loads import repair_columns
from ..rules.ladder import part

# From when on the tracker's gaps are repaired, and the parameter behind each column.
URL_REPAIR_FROM = datetime(2017, 5, 17)
UTM_REPAIR_FROM = datetime(2017, 6, 12)
UTM_PARAMETERS = {
    "mkt_medium": "utm_medium",
    "mkt_source": "utm_source",
    "mkt_campaign": "utm_campaign",
    "mkt_term": "utm_term",
    "mkt_content": "utm_content",
    "mkt_clickid": "gclid",
}


def url_parts(url: Column) -> dict[str, Column]:
    """Scheme, host, path, query and fragment the way the tracker stores them."""
    fragment = part(url, 2, "#")
    return {
        "page_urlscheme": F.nullif(F.regexp_extract(url, "^((http[s]?|ftp):)", 0), F.lit("")),
        "page_urlhost": part(F.regexp_extract(url, r"([^:\/\s]+)((\/\w+)*\/)", 0), 1, "/"),
        "page_urlpath": F.concat(F.lit("/"), part(part(part(url, 2, ".com/"), 1, "?"), 1, "#")),
        "page_urlquery": part(part(url, 2, "?"), 1, "#"),
        "page_urlfragment": F.when(fragment != "", F.concat(F.lit("#"), fragment)),
    }


def url_repair(events: DataFrame, since: datetime = URL_REPAIR_FROM) -> DataFrame:
    """Fill the URL columns of events that came without a scheme."""
    missing = F.col("page_urlscheme").isNull() & (F.col("collector_tstamp") > F.lit(since))
    return repair_columns(events, missing, url_parts(F.col("page_url")))


def utm_backfill(events: DataFrame, since: datetime = UTM_REPAIR_FROM) -> DataFrame:
    """Fill the marketing columns of events without a source from their URL's query."""
    missing = (
        F.col("mkt_source").isNull()
        & F.col("page_url").like("%?%")
        & (F.col("collector_tstamp") > F.lit(since))
    )
    values = {c: query_param(F.col("page_url"), p) for c, p in UTM_PARAMETERS.items()}
    return repair_columns(events, missing, values)


def timestamp_normalise(raw: DataFrame, column: str) -> DataFrame:
    """Readings of a raw time column: as date or epoch number, and as any accepted text."""
    text = F.col(column)
    return raw.withColumns(
        {"as_number_or_date": int_string_to_timestamp(text), "as_text": lenient_timestamp(text)}
    )


def props_extract(raw: DataFrame, column: str, key: str, name: str) -> DataFrame:
    return raw.withColumn(name, value_from_key(key, F.col(column)))


def distinct_sum(df: DataFrame, groups: list[str], value: str, key: str) -> DataFrame:
    """Sum of a value that joins have repeated, counting each key once.

    Rows shrink to one per (group, key) before they are summed.
    """
    once = df.groupBy(*groups, key).agg(F.max(value).alias("_value"))
    return once.groupBy(*groups).agg(F.sum("_value").alias("total"))


def hashed_distinct_sum(df: DataFrame, groups: list[str], value: str, key: str) -> DataFrame:
    """The same sum by the hash method: difference of two distinct sums."""
    keyed = df.select(
        *groups,
        prep_dis_sum(F.col(value), F.col(key)).alias("_both"),
        prep_dis_sum(F.lit(0.0), F.col(key)).alias("_key"),
    ).distinct()
    sums = keyed.groupBy(*groups).agg(F.sum("_both").alias("b"), F.sum("_key").alias("k"))
    return sums.select(*groups, ((F.col("b") - F.col("k")).cast("double") / 1_000_000).alias("total"))

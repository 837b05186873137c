from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BERLIN = "Europe/Berlin"

# Text forms accepted besides what Spark's own cast reads. Dotted and slashed dates are
# read month first, as lenient parsers do, and day first where that gives no date.
TIMESTAMP_FORMS = (
    "yyyyMMdd",
    "yyyyMMdd'T'HHmmss",
    "yyyy/M/d",
    "yyyy/M/d H:mm:ss",
    "M/d/yyyy",
    "M/d/yyyy H:mm",
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy h:mm a",
    "M/d/yyyy h:mm:ss a",
    "M.d.yyyy",
    "M.d.yyyy H:mm",
    "M.d.yyyy H:mm:ss",
    "d/M/yyyy",
    "d/M/yyyy H:mm",
    "d/M/yyyy H:mm:ss",
    "d.M.yyyy",
    "d.M.yyyy H:mm",
    "d.M.yyyy H:mm:ss",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "MMM d yyyy",
    "MMMM d yyyy",
    "d MMM yyyy",
    "d MMMM yyyy",
    "d MMM yyyy H:mm:ss",
    "d MMM yyyy H:mm:ss xx",
    "d MMM yyyy H:mm:ss zzz",
)


def berlin_local(ts: Column) -> Column:
    """UTC timestamp -> wall clock in Berlin, summer time included."""
    return F.from_utc_timestamp(ts, BERLIN)


def berlin_day_start(ts: Column) -> Column:
    """Midnight of the timestamp's own day, read as Berlin wall clock, in UTC."""
    return F.to_utc_timestamp(F.date_trunc("day", ts), BERLIN)


def to_did(ts: Column) -> Column:
    """Whole days since 1970-01-01."""
    return F.unix_date(F.to_date(ts))


def from_did(did: Column) -> Column:
    return F.date_from_unix_date(did.cast("int"))


def int_string_to_timestamp(text: Column) -> Column:
    """An ISO date, or a number whose first ten digits are epoch seconds."""
    return F.when(text.like("____-__-__"), text.try_cast("timestamp")).otherwise(
        F.timestamp_seconds(F.substring(text, 1, 10).try_cast("long"))
    )


def lenient_timestamp(text: Column) -> Column:
    """The first accepted reading of a timestamp text, else NULL."""
    # the day of the week before a date says nothing new
    bare = F.regexp_replace(F.trim(text), r"(?i)^(mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+", "")
    readings = [text.try_cast("timestamp")]
    readings += [F.try_to_timestamp(bare, F.lit(form)) for form in TIMESTAMP_FORMS]
    return F.coalesce(*readings)

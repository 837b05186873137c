from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(value: Column, digits: int) -> Column:
    return F.bround(value, digits)


def ratio(part: Column, whole: Column, digits: int = 2) -> Column:
    """part / whole rounded half to even; NULL where the whole is 0."""
    return round_half_even(F.try_divide(part.cast("double"), whole.cast("double")), digits)

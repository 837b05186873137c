"""Column expressions shared by the jobs; all of them run inside the JVM."""

from .dates import (
    BERLIN,
    berlin_day_start,
    berlin_local,
    from_did,
    int_string_to_timestamp,
    lenient_timestamp,
    to_did,
)
from .text import (
    decode_url,
    lower_not_null,
    md5_or_null,
    prep_dis_sum,
    query_map,
    query_param,
    strip_special,
    to_int_code,
    value_from_key,
)
from .numbers import ratio, round_half_even

__all__ = [
    "BERLIN",
    "berlin_day_start",
    "berlin_local",
    "decode_url",
    "from_did",
    "int_string_to_timestamp",
    "lenient_timestamp",
    "lower_not_null",
    "md5_or_null",
    "prep_dis_sum",
    "query_map",
    "query_param",
    "ratio",
    "round_half_even",
    "strip_special",
    "to_did",
    "to_int_code",
    "value_from_key",
]

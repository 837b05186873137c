from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lower_not_null(text: Column) -> Column:
    return F.coalesce(F.lower(text), F.lit(""))


def md5_or_null(*parts: Column) -> Column:
    """MD5 of the joined parts; a NULL part makes the key NULL."""
    return F.md5(F.concat(*parts))


def strip_special(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, "[^A-Za-z0-9]", ""))


def to_int_code(word: Column, depth: int | None = None) -> Column:
    """Number made of the first letters and digits of a word, each weighted by a power of 36."""
    depth = depth or 3
    letters = strip_special(word)
    # ascii('') is 0, so positions behind the end add nothing and NULL stays NULL
    terms = [F.ascii(F.substring(letters, i + 1, 1)).cast("long") * (36**i) for i in range(depth)]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def decode_url(text: Column) -> Column:
    """Percent decoding that keeps '+' and every '%' that starts no escape."""
    return F.try_url_decode(F.replace(_whole_escapes(text), F.lit("+"), F.lit("%2B")))


def _whole_escapes(text: Column) -> Column:
    return F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25")


def _query(url: Column) -> Column:
    return F.regexp_extract(url, r"\?([^#]*)", 1)


def _decode_part(text: Column) -> Column:
    return F.try_url_decode(_whole_escapes(text))


def query_param(url: Column, name: str) -> Column:
    """One query parameter of a URL: the last non-blank value, decoded, else NULL."""
    # the greedy prefix makes the last occurrence win; blank values cannot match
    found = F.regexp_extract(_query(url), rf"^(?:.*[&;])?{name}=([^&;]+)", 1)
    return F.when(found != "", _decode_part(found))


def query_map(url: Column) -> Column:
    """All non-blank query parameters of a URL as a map; the last duplicate wins."""
    pairs = F.filter(F.split(_query(url), "[&;]"), lambda p: p.rlike("^[^=]+=.+"))
    empty = F.create_map().cast("map<string,string>")

    def put(found: Column, pair: Column) -> Column:
        key = _decode_part(F.substring_index(pair, "=", 1))
        value = _decode_part(F.regexp_extract(pair, "=(.*)$", 1))
        return F.map_concat(F.map_filter(found, lambda k, _: k != key), F.create_map(key, value))

    return F.aggregate(pairs, empty, put)


# a quoted string, perhaps marked as unicode text
_STRING = r"""(?s:u?'(?:[^'\\]|\\.)*'|u?"(?:[^"\\]|\\.)*")"""


def value_from_key(key: str, literal: Column) -> Column:
    """The value of one key in a JSON object or a Python dict literal (u'...' strings, True, None).

    The text is parted into strings and what is between them; only there words are literals.
    """
    parts = F.regexp_extract_all(literal, F.lit(f"({_STRING}|(?:(?!{_STRING}).)+)"), F.lit(1))

    def plain(part: Column) -> Column:
        between = F.regexp_replace(part, r"\bNone\b", "null")
        between = F.regexp_replace(between, r"\b(True|False)\b", '"$1"')
        return F.when(part.rlike(f"^{_STRING}$"), F.regexp_replace(part, "^u", "")).otherwise(between)

    text = F.array_join(F.transform(parts, plain), "")
    return F.from_json(text, "map<string,string>")[key]


def prep_dis_sum(value: Column, key: Column) -> Column:
    """A number holding the value and a hash of its key, so that a distinct sum counts each key once.

    SUM(DISTINCT f(value, key)) - SUM(DISTINCT f(0, key)), divided by 10^6, is the fan-out-safe sum.
    """
    digest = F.md5(F.coalesce(key, F.lit("")))

    def part(hex15: Column) -> Column:
        return F.conv(hex15, 16, 10).cast("decimal(19,0)")

    scaled = F.round(F.coalesce(value, F.lit(0.0)) * 1_000_000).cast("decimal(38,0)")
    high = part(F.left(digest, F.lit(15))) * F.lit(100_000_000).cast("decimal(9,0)")
    return (scaled + high + part(F.right(digest, F.lit(15)))).cast("decimal(38,0)")

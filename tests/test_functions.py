from datetime import date

from pyspark.sql import functions as F

from clickledger import functions as fn

from .conftest import ts


def one(spark, column, **given):
    kinds = {str: "string", int: "long", float: "double", bool: "boolean", date: "date"}
    names = list(given)
    schema = ", ".join(f"{n} {kinds.get(type(given[n]), 'timestamp' if given[n] else 'string')}" for n in names)
    return spark.createDataFrame([tuple(given.values())], schema).select(column).first()[0]


def test_to_int_code(spark):
    code = fn.to_int_code(F.col("w"), 4)
    assert one(spark, code, w="Painting") == 5271844
    assert one(spark, code, w="p-a i_nt!") == 5271844
    assert one(spark, code, w="") == 0
    assert one(spark, code, w=None) is None
    assert one(spark, fn.to_int_code(F.col("w"), 0), w="abcd") == 97 + 98 * 36 + 99 * 1296
    assert one(spark, code, w="b") == 98


def test_berlin_days_at_both_clock_changes(spark):
    local, start = fn.berlin_local(F.col("t")), fn.berlin_day_start(F.col("t"))
    assert one(spark, local, t=ts("2024-03-31 00:59:59")) == ts("2024-03-31 01:59:59")
    assert one(spark, local, t=ts("2024-03-31 01:00:00")) == ts("2024-03-31 03:00:00")
    assert one(spark, local, t=ts("2024-10-27 01:00:00")) == ts("2024-10-27 02:00:00")
    assert one(spark, start, t=ts("2024-03-31 12:00:00")) == ts("2024-03-30 23:00:00")
    assert one(spark, start, t=ts("2024-04-01 12:00:00")) == ts("2024-03-31 22:00:00")
    # the day is the input's own: 23:30 UTC is already tomorrow in Berlin
    assert one(spark, start, t=ts("2024-01-05 23:30:00")) == ts("2024-01-04 23:00:00")


def test_day_numbers(spark):
    assert one(spark, fn.to_did(F.col("t")), t=ts("2017-01-01 13:00:00")) == 17167
    assert one(spark, fn.from_did(F.col("n")), n=17167) == date(2017, 1, 1)
    assert one(spark, fn.to_did(F.col("t")), t=ts("1969-12-31 23:00:00")) == -1


def test_decode_url(spark):
    decoded = fn.decode_url(F.col("x"))
    assert one(spark, decoded, x="k%C3%BCche+a%2Bb") == "küche+a+b"
    assert one(spark, decoded, x="100%_x") == "100%_x"
    assert one(spark, decoded, x="k%C3%BCche%") == "küche%" and one(spark, decoded, x="%zz%41") == "%zzA"
    assert one(spark, decoded, x=None) is None


def test_query_parameters(spark):
    url = "https://a.com/p?x=1&utm_source=a&utm_source=b%20c+d&utm_source=&y=#utm_source=z"
    assert one(spark, fn.query_param(F.col("u"), "utm_source"), u=url) == "b c d"
    assert one(spark, fn.query_param(F.col("u"), "y"), u=url) is None
    assert one(spark, fn.query_param(F.col("u"), "source"), u=url) is None
    assert one(spark, fn.query_map(F.col("u")), u=url) == {"x": "1", "utm_source": "b c d"}
    assert one(spark, fn.query_map(F.col("u")), u="https://a.com/") == {}
    assert one(spark, fn.query_param(F.col("u"), "a"), u="https://a.com/?a=k%C3%BCche%+b") == "küche% b"


def test_value_from_key(spark):
    assert one(spark, fn.value_from_key("a", F.col("x")), x="{'a': 'v', 'b': None}") == "v"
    assert one(spark, fn.value_from_key("b", F.col("x")), x="{'a': 'v', 'b': None}") is None
    assert one(spark, fn.value_from_key("b", F.col("x")), x="{'a': 1, 'b': True}") == "True"
    assert one(spark, fn.value_from_key("c", F.col("x")), x='{"a": 1}') is None
    assert one(spark, fn.value_from_key("k", F.col("x")), x="{u'k': u'v', u'n': None}") == "v"
    assert one(spark, fn.value_from_key("k", F.col("x")), x="{'k': 'so: True story', 'u': False}") == "so: True story"
    assert one(spark, fn.value_from_key("u", F.col("x")), x="{'k': 'so: None', 'u': False}") == "False"


def test_timestamps(spark):
    number, text = fn.int_string_to_timestamp(F.col("x")), fn.lenient_timestamp(F.col("x"))
    assert one(spark, number, x="2018-03-04") == ts("2018-03-04 00:00:00")
    assert one(spark, number, x="1522800000123") == ts("2018-04-04 00:00:00")
    assert one(spark, number, x="nonsense") is None
    assert one(spark, text, x="2018-03-04T05:06:07Z") == ts("2018-03-04 05:06:07")
    assert one(spark, text, x="04/05/2018") == ts("2018-04-05 00:00:00")
    assert one(spark, text, x="Mar 4, 2018") == ts("2018-03-04 00:00:00")
    assert one(spark, text, x="nonsense") is None
    for form in ["25/12/2018", "25.12.2018", "2018/12/25", "25 December 2018", "December 25, 2018", "Tue, 25 Dec 2018 00:00:00 +0000",
                 "Tue, 25 Dec 2018 00:00:00 GMT", "12/25/2018 12:00:00 AM", "25/12/2018 0:00"]:
        assert one(spark, text, x=form) == ts("2018-12-25 00:00:00"), form


def test_small_text_and_numbers(spark):
    assert one(spark, fn.lower_not_null(F.col("x")), x=None) == ""
    assert one(spark, fn.strip_special(F.col("x")), x=" 10-A b!") == "10ab"
    assert one(spark, fn.ratio(F.col("a"), F.col("b")), a=1, b=0) is None
    assert one(spark, fn.ratio(F.col("a"), F.col("b")), a=1, b=8) == 0.12
    assert one(spark, fn.ratio(F.col("a"), F.col("b")), a=3, b=8) == 0.38

import hashlib
from datetime import date, datetime

from pyspark.sql import functions as F

from probelake.functions import casts, nested, paths


def test_malformed_dates_are_null(values):
    data = ["2020-01-05", "2020-1-5", "not a date", "2020-13-01", "", None]
    assert values(data, casts.to_date) == [date(2020, 1, 5), date(2020, 1, 5), None, None, None, None]


def test_malformed_timestamps_are_null(values):
    data = ["2020-01-05 10:00:01.5", "x", None]
    assert values(data, casts.to_timestamp) == [datetime(2020, 1, 5, 10, 0, 1, 500000), None, None]


def test_row_key(spark):
    rows = spark.createDataFrame(
        [("a", "2020-01-01 00:00:00.120", "u"), (None, "2020-01-01 00:00:00", "u"), ("a", None, "u")],
        "id string, t string, input string",
    ).withColumn("t", F.col("t").try_cast("timestamp"))
    keys = [r.k for r in rows.select(casts.row_key(F.col("id"), F.col("t"), F.col("input")).alias("k")).collect()]
    assert keys == [hashlib.md5(b"a2020-01-01 00:00:00.12u").hexdigest(), None, None]


def test_parts_have_no_separator(spark):
    rows = spark.sql("SELECT 'ab' a, 'c' b, 'a' c, 'bc' d")
    one, two = rows.select(casts.row_key(F.col("a"), F.col("b")), casts.row_key(F.col("c"), F.col("d"))).first()
    assert one == two


def test_first_element(values):
    assert values([["x", "y"], [], None], nested.first_element, "array<string>") == ["x", None, None]


REQUESTS = "array<struct<response struct<body string>>>"


def test_first_body(values):
    data = [[{"response": {"body": "b"}}, {"response": {"body": "c"}}], [{"response": {"body": None}}],
            [{"response": None}], [None], [], None]
    assert values(data, nested.first_body, REQUESTS) == ["b", "", "", "", "", ""]


def test_addresses_of_answers(values):
    data = [[{"ipv4": "1.1.1.1"}, {"ipv4": None}, None, {"ipv4": "2.2.2.2"}], [], None]
    kind = "array<struct<ipv4 string>>"
    full = lambda c: nested.field_of_each(c, "ipv4")
    assert values(data, full, kind) == [["1.1.1.1", None, None, "2.2.2.2"], [], None]
    assert values(data, lambda c: nested.drop_nulls(full(c)), kind) == [["1.1.1.1", "2.2.2.2"], [], None]


def test_only_missing_inner_arrays_go(values):
    data = [[[{"ipv4": "1.1.1.1"}, {"ipv4": None}], None]]
    result = values(
        data,
        lambda c: nested.drop_nulls(nested.field_of_each(c, "ipv4", inner=True)),
        "array<array<struct<ipv4 string>>>",
    )
    assert result == [[["1.1.1.1", None]]]


def test_strip_scheme():
    assert [paths.strip_scheme(p) for p in ("file:/a/b/", "file:///a/b", "/a/b", "s3://bucket/x")] == [
        "/a/b", "/a/b", "/a/b", "bucket/x",
    ]


def test_relative_key(values):
    data = ["file:/r+/a/r+/b.json", "file:/other/a"]
    assert values(data, lambda c: paths.relative_key(c, "file:///r+")) == ["a/r+/b.json", ""]


def test_key_parts(values):
    assert values(["a-b", "a-b-c"], lambda c: paths.key_part(c, 2, "-")) == [None, "c"]


def test_mib(values):
    assert values([1048576, 314573, None], paths.to_mib, "bigint") == [1.0, 314573 / 1048576, None]

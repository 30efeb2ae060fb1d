from __future__ import annotations

import hashlib
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import text, values


def one(spark, column, **cols):
    row = spark.createDataFrame([tuple(cols.values()) or (1,)], list(cols) or ["_"])
    return row.select(column.alias("v")).first()[0]


@pytest.mark.parametrize(
    "stored, expected",
    [
        ("2022-02-07 16:01:27.420368+00:00", "2022-02-07 16:01:27.420368"),
        ("2022-02-07 16:01:27.420368+0000", "2022-02-07 16:01:27.420368"),
        ("2022-02-07 16:01:27.420368Z", "2022-02-07 16:01:27.420368"),
        ("2022-02-07 18:01:27+0200", "2022-02-07 16:01:27"),
        ("2022-02-07 16:01:27", "2022-02-07 16:01:27"),
        ("2022-02-07 16:01:27.5", "2022-02-07 16:01:27.5"),
        ("2022-02-07", "2022-02-07 00:00:00"),
        ("1", "1970-01-01 00:00:00"),
        ("not a date", "1970-01-01 00:00:00"),
        (None, None),
    ],
)
def test_watermark_text_is_parsed_with_fallbacks(spark, stored, expected):
    parsed = text.parse_datetime(F.lit(stored).cast("string")).cast("string")
    assert one(spark, parsed) == expected


def test_datetimes_as_text_keep_microseconds_and_offset(spark):
    df = spark.sql("SELECT timestamp'2024-01-05 10:11:12.000345' t, timestamp_ntz'2024-01-05 10:11:12' n, date'2024-01-05' d, 1 i")
    row = values.dates_to_strings(df).first()
    assert tuple(row) == ("2024-01-05 10:11:12.000345+0000", "2024-01-05 10:11:12.000000", "2024-01-05", 1)


def test_formatted_watermark_reads_back(spark):
    df = spark.sql("SELECT timestamp'2024-01-05 10:11:12.000345' t")
    back = df.select(text.parse_datetime(text.datetime_text("t", T.TimestampType())) == F.col("t"))
    assert back.first()[0] is True


def test_nan_becomes_null_and_other_values_stay(spark):
    df = spark.createDataFrame([(1.5, 1), (float("nan"), 2), (None, 3)], "x double, i int")
    assert [r.x for r in values.nan_to_null(df).orderBy("i").collect()] == [1.5, None, None]


def test_string_maps_become_spaced_json(spark):
    df = spark.createDataFrame([('a "b"\n', 1), ("", 2), ("", 3)], "v string, i int").select(
        "i",
        F.when(F.col("i") == 1, F.create_map(F.lit("k"), "v", F.lit("n"), F.lit(None).cast("string")))
        .when(F.col("i") == 2, F.create_map().cast("map<string,string>"))
        .alias("m"),
    ).orderBy("i")
    got = [r.v for r in df.select(text.json_text("m", df.schema["m"].dataType).alias("v")).collect()]
    assert got == ['{"k": "a \\"b\\"\\n", "n": null}', "{}", None]


def test_row_key_hashes_the_joined_text(spark):
    df = spark.createDataFrame([(1, 4, None, True, 12345678.9)], "a int, b int, c string, d boolean, e double")
    expected = hashlib.md5("1-4-None-True-12345678.9".encode()).hexdigest()
    assert df.select(text.md5_key(df)).first()[0] == expected
    assert df.select(text.md5_key(df, ["b", "a"])).first()[0] == hashlib.md5(b"4-1").hexdigest()


def test_number_text_equals_shortest_repr(spark):
    numbers = [0.0, -0.0, 1.0, -2.5, 1e-3, 9.99e-4, 1e-4, 9.9e-5, 1e7, 12345678.9, 1e15, 9.9e15]
    numbers += [1e16, 1.5e16, -1e22, 1.7976931348623157e308, 0.1 + 0.2, 1 / 3, 100153.45 * 1e12]
    numbers += [float("inf"), float("-inf"), float("nan")]
    df = spark.createDataFrame(list(enumerate(numbers)), "i int, x double")
    got = [r.t for r in df.orderBy("i").select(text.number_text(F.col("x")).alias("t")).collect()]
    assert got == [repr(n) for n in numbers]


@pytest.mark.parametrize(
    "url, parts",
    [
        ("abfss://container@account.dfs.example.net/Files/a/b.csv", ("container", "account", "/Files/a/b.csv")),
        ("https://container@account.dfs.example.net/Files", ("container", "account", "/Files")),
        ("https://host.example.net/x?q=1#top", ("host.example.net", None, "/x")),
    ],
)
def test_storage_url_parts(spark, url, parts):
    assert tuple(one(spark, text.storage_url_parts(F.lit(url)))) == parts


def test_base_name(spark):
    assert one(spark, text.base_name(F.lit("Files/a/Tanks.png"))) == "Tanks.png"
    assert one(spark, text.base_name(F.lit("Tanks.png"))) == "Tanks.png"


def test_nested_values_become_text_scalars_do_not(spark):
    df = spark.createDataFrame([(["a"], {"k": "v"}, "s", None)], "a array<string>, m map<string,string>, s string, n string")
    assert tuple(values.nested_to_text(df).first()) == ('["a"]', '{"k": "v"}', "s", None)


@pytest.mark.parametrize(
    "value, dtype, expected",
    [
        ("7", T.LongType(), 7),
        ("x", T.LongType(), "none"),
        (None, T.LongType(), "none"),
        ("None", T.TimestampType(), "none"),
        ("b", T.StringType(), "b"),
    ],
)
def test_watermarks_take_the_column_type(spark, value, dtype, expected):
    literal = values.typed_watermark(value, dtype)
    assert literal is None if expected == "none" else one(spark, literal) == expected


def test_typed_watermark_accepts_datetimes(spark):
    moment = datetime(2024, 1, 5, tzinfo=timezone.utc)
    column = values.typed_watermark(moment, T.TimestampNTZType())
    assert one(spark, column.cast("string")) == "2024-01-05 00:00:00"

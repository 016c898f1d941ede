from datetime import date, datetime

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadpulse.functions.times import (
    default_range,
    month_span,
    normalize_ts,
    parse_bound,
    shard_keys,
    shard_names,
    shard_name,
    shard_months,
)


def test_shard_names_cross_the_year():
    assert shard_names("2016-11-01T00:00", "2017-02-01T00:00") == [
        "detail_record_2016_11",
        "detail_record_2016_12",
        "detail_record_2017_01",
        "detail_record_2017_02",
    ]


def test_reversed_range_has_no_shards():
    assert shard_names("2017-02-01", "2017-01-31") == []


@given(st.datetimes(datetime(1990, 1, 1), datetime(2050, 1, 1)), st.integers(0, 4000))
def test_shards_are_the_months_of_the_days(start, days):
    end = datetime.fromordinal(start.toordinal() + days)
    months = {
        date.fromordinal(d).strftime("%Y_%m") for d in range(start.toordinal(), end.toordinal() + 1)
    }
    assert shard_keys(start, end) == sorted(months)


def test_shard_names_in_columns_equal_the_list(spark):
    spans = [("2016-11-05", "2017-02-01"), ("2017-02-01", "2017-01-31"), ("2020-05-09", "2020-05-01")]
    df = spark.createDataFrame(spans, "a string, b string")
    months = shard_months(F.col("a").cast("date"), F.col("b").cast("date"))
    got = df.select("a", "b", F.explode(months).alias("m")).select("a", "b", shard_name(F.col("m")))
    assert [tuple(r) for r in got.collect()] == [(a, b, n) for a, b in spans for n in shard_names(a, b)]


@pytest.mark.parametrize(
    ("raw", "normal"),
    [
        ("2017-01-08T10:30", "2017-01-08 10:30:00"),
        ("2017-01-08T10:30:05", "2017-01-08 10:30:05"),
        ("2017-01-08 10:30", "2017-01-08 10:30:00"),
        ("2017-01-08", "2017-01-08"),
        ("", ""),
        (None, None),
    ],
)
def test_normalize_ts(spark, raw, normal):
    df = spark.createDataFrame([(raw,)], "t string").select(normalize_ts(F.col("t")))
    assert df.first()[0] == normal


@pytest.mark.parametrize("bad", ["", None, "yesterday", "2017-13-01", "2017-01-01T00:00Z", 5])
def test_bad_bounds_are_value_errors(bad):
    with pytest.raises(ValueError):
        parse_bound(bad)


def test_default_range_is_the_last_week():
    assert default_range(datetime(2017, 1, 8, 10, 30, 59)) == ("2017-01-01T10:30", "2017-01-08T10:30")


def test_month_span():
    assert month_span("2016_12") == (datetime(2016, 12, 1), datetime(2017, 1, 1))
    assert month_span("2017_02") == (datetime(2017, 2, 1), datetime(2017, 3, 1))

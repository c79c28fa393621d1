"""Casts, rounding and aggregates on literal rows."""

from __future__ import annotations

import datetime
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pedalstrata.functions import aggregates as agg
from pedalstrata.functions import casting, labels, udaf
from pedalstrata.operators.rollup import Measure, rollup
from pedalstrata.plans.lineitem_feed import hour_dirty

NAN = float("nan")


def column(spark, values, dtype):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")


def apply(spark, values, dtype, f):
    df = column(spark, values, dtype)
    return [r.out for r in df.select("i", f(F.col("v"), df.schema["v"].dataType).alias("out")).orderBy("i").collect()]


def test_safe_int_from_text(spark):
    values = ["7", " 7 ", "abc", "1.5", "1e3", "9223372036854775808", "", "+7", "-7", "0007", None, "12abc", "1-2"]
    want = [7, 7, None, None, None, None, None, 7, -7, 7, None, None, None]
    assert apply(spark, values, "string", casting.safe_int) == want


def test_safe_int_from_double(spark):
    assert apply(spark, [1.9, 2.5, -2.5, 1e30, NAN, None], "double", casting.safe_int) == [2, 3, -3, None, None, None]


def test_safe_double(spark):
    values = ["0.24", "NaN", "", "1e3", "1d", "1.0f", "0x1p3", ".5", "5.", "abc", "inf", "2011-01-01", " 3 ", None]
    want = [0.24, None, None, 1000.0, None, None, None, 0.5, 5.0, None, math.inf, None, 3.0, None]
    assert apply(spark, values, "string", casting.safe_double) == want
    assert apply(spark, [NAN, 1.5, None], "double", casting.safe_double) == [None, 1.5, None]


CELLS = st.lists(st.text(alphabet="0123456789+-. eE\tainf", max_size=6), min_size=200, max_size=200)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(CELLS)
def test_pattern_guards_lose_no_number(spark, cells):
    """The tests before the casts let exactly the castable texts through."""
    df = column(spark, cells, "string")
    c, dtype = F.col("v"), T.StringType()
    pairs = {
        "bigint": casting.safe_int(c, dtype),
        "double": casting.safe_double(c, dtype),
    }
    for target, guarded in pairs.items():
        plain = casting.nan_to_null(c.try_cast("double")) if target == "double" else c.try_cast(target)
        off = df.where(~guarded.eqNullSafe(plain) & ~c.rlike(r"[0-9.]f\s*$"))
        assert off.collect() == []


def test_parse_date(spark):
    values = ["2011-01-01", "2011-1-1", "2011-02-30", "bad", "2011-01-03 04:00:00", None]
    day = datetime.date(2011, 1, 1)
    assert apply(spark, values, "string", casting.parse_date) == [day, day, None, None, datetime.date(2011, 1, 3), None]

    odd = ["2011-01-01 garbage", "2011-01-01Tfoo", "99999-01-01", "2011-01-01T10:00", "20110101", "20111301", "2011", "1/1/2011", ""]
    assert apply(spark, odd, "string", casting.parse_date) == [None, None, None, day, day, None, None, None, None]
    assert apply(spark, [20110101, 5, None], "long", casting.parse_date) == [day, None, None]
    assert apply(spark, [1.5], "double", casting.parse_date) == [None]

    def strict(c, dtype):
        return casting.parse_date(c, dtype, "yyyy-MM-dd")

    assert apply(spark, ["2011-01-01", "2011-01-03 04:00:00", "bad"], "string", strict) == [day, None, None]


def test_na_tokens(spark):
    values = ["", "NA", "N/A", "n/a", "NaN", "null", "None", "#N/A", "-", "0"]
    df = casting.normalise_na_columns(column(spark, values, "string"))
    assert [r.v for r in df.orderBy("i").collect()] == [None] * 8 + ["-", "0"]


def test_literal_kind(spark):
    values = ["7", "-12", "1.5", "1e3", "True", "FALSE", "yes", "9223372036854775808", None, "2011-01-01"]
    df = column(spark, values, "string").select("i", casting.literal_kind("v").alias("k"))
    assert [r.k for r in df.orderBy("i").collect()] == [1, 1, 2, 2, 3, 3, 4, 4, None, 4]


def test_eight_digits_that_are_no_date_do_not_reach_the_date_parser(spark):
    values = ["20110101", " 20111231 ", "20111301", "20110100", "20110132", "99999999", "20110230", "00000000"]
    df = column(spark, values, "string")
    assert apply(spark, values, "string", casting.parse_date)[:6] == [datetime.date(2011, 1, 1), datetime.date(2011, 12, 31), None, None, None, None]
    matched = df.where(F.col("v").rlike(casting._COMPACT_DATE)).orderBy("i").collect()
    assert [r.v for r in matched] == ["20110101", " 20111231 ", "20110230"]


def test_rounding(spark):
    out = apply(spark, [0.5000005, 0.5000015, -0.5000005], "double", lambda c, t: casting.round_half_even(c, 6))
    assert out == [0.5, 0.500002, -0.5]
    assert apply(spark, [1.9, -1.9, -0.7, NAN], "double", lambda c, t: casting.int_truncate(c)) == [1, -1, 0, None]


def test_is_missing(spark):
    assert apply(spark, [NAN, None, 0.0], "double", casting.is_missing) == [True, True, False]
    assert apply(spark, ["", None], "string", casting.is_missing) == [False, True]


@pytest.mark.parametrize(
    ("values", "want"), [([1, 2], 2), ([2, 3], 3), ([1, 1, 2], 1), ([None, None], None), ([None, 4], 4)]
)
def test_half_up_mean(spark, values, want):
    df = column(spark, values, "int")
    assert df.agg(agg.half_up_mean(F.col("v"), T.IntegerType()).alias("m")).first().m == want


def test_half_up_mean_strict(spark):
    df = column(spark, [None, None], "int")
    with pytest.raises(Exception, match="group without values"):
        df.agg(agg.half_up_mean(F.col("v"), T.IntegerType(), strict=True)).collect()


def test_first_non_null(spark):
    df = spark.createDataFrame([(3, 2.0), (2, NAN), (1, None), (4, 9.0)], "id long, v double")
    assert df.agg(agg.first_non_null(F.col("v"), T.DoubleType(), F.col("id")).alias("f")).first().f == 2.0
    df = spark.createDataFrame([(None, 5), (None, None)], "id long, v int")
    assert df.agg(agg.first_non_null(F.col("v"), T.IntegerType(), F.col("id")).alias("f")).first().f == 5


@pytest.mark.parametrize("partitions", [1, 7, 13])
def test_first_non_null_of_repeated_orders(spark, sf_dir, partitions):
    """Ties in the record number are broken by the other columns, however rows are dealt out."""
    hours = hour_dirty(spark, sf_dir).repartition(partitions)
    names = ("hr", "temp", "cnt")
    order = F.col("instant").try_cast("bigint")
    rest = [F.col(c) for c in hours.columns if c != "dteday"]
    firsts = [agg.first_non_null(F.col(n), hours.schema[n].dataType, order, rest).alias(n) for n in names]
    got = {r.dteday: tuple(r)[1:] for r in hours.groupBy("dteday").agg(*firsts).collect()}
    key = lambda r: [int(r.instant) if r.instant != "bad" else 2**63 - 1, *[(v is not None, v != v, v) for c, v in r.asDict().items() if c != "dteday"]]
    want = {}
    for r in sorted(hours.collect(), key=key):
        day = want.setdefault(r.dteday, dict.fromkeys(names))
        for n in names:
            if day[n] is None and r[n] is not None and r[n] == r[n]:
                day[n] = r[n]
    assert got == {d: tuple(v.values()) for d, v in want.items()}


def test_mean_and_sum_skip_nan(spark):
    df = column(spark, [1.0, NAN, None, 2.0], "double")
    row = df.agg(
        agg.mean_rounded(F.col("v"), T.DoubleType()).alias("m"), agg.sum_or_zero(F.col("v"), T.DoubleType()).alias("s")
    ).first()
    assert (row.m, row.s) == (1.5, 3.0)
    empty = column(spark, [None, None], "bigint")
    assert empty.agg(agg.sum_or_zero(F.col("v"), T.LongType()).alias("s")).first().s == 0


def test_null_key_forms_no_group(spark):
    df = spark.createDataFrame([(None, 1, 5), ("a", 2, 6)], "k string, instant int, v int")
    assert [tuple(r) for r in rollup(df, "k", [Measure("v", "sum")]).collect()] == [("a", 6)]


def test_rollup_takes_any_aggregate(spark):
    df = spark.createDataFrame([("a", 5), ("a", 7), ("b", 1)], "k string, v int")
    out = rollup(df, "k", [Measure("v", lambda c: F.max(c) - F.min(c))])
    assert sorted(tuple(r) for r in out.collect()) == [("a", 2), ("b", 0)]


def test_rollup_orders_by_any_column(spark):
    df = spark.createDataFrame([("a", "10", 5), ("a", "9", 7), ("a", "8", None)], "k string, seq string, v int")
    assert [tuple(r) for r in rollup(df, "k", [Measure("v", "first")], order_by="seq").collect()] == [("a", 7)]
    with pytest.raises(ValueError, match="unknown aggregate"):
        rollup(df, "k", [Measure("v", "median")])


def test_labels(spark):
    seasons = apply(spark, [1, 2, 3, 4, 9, None], "int", lambda c, t: labels.season_label(c))
    assert seasons == ["spring", "summer", "fall", "winter", None, None]
    assert apply(spark, [0, 1], "bigint", lambda c, t: labels.calendar_year(c)) == [2011, 2012]
    assert apply(spark, [0.5], "double", lambda c, t: labels.celsius(c)) == [20.5]
    weather = apply(spark, [1, 2, 3, 4], "int", lambda c, t: labels.weather_label(c))
    assert weather == ["good", "cloudy", "rain", "storm"]


def test_calendar_season(spark):
    edges = [(3, 20), (3, 21), (6, 20), (6, 21), (9, 22), (9, 23), (12, 20), (12, 21)]
    days = [datetime.date(2011, *md) for md in edges]
    assert apply(spark, days, "date", lambda c, t: labels.calendar_season(c)) == [4, 1, 1, 2, 2, 3, 3, 4]


ROWS = st.lists(st.tuples(st.sampled_from("abc"), st.one_of(st.none(), st.integers(0, 9))), min_size=1, max_size=60)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS)
def test_python_aggregate_equals_built_in(spark, rows):
    df = spark.createDataFrame(rows, "k string, v int")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {tuple(r) for r in udaf.aggregate_with(df, "k", "v", udaf.HALF_UP_MEAN).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    built_in = df.groupBy("k").agg(agg.half_up_mean(F.col("v"), T.IntegerType()).alias("v"))
    assert got == {tuple(r) for r in built_in.collect()}


def test_python_aggregate_user_defined(spark):
    spread = udaf.MergeableUdaf(
        state={"low": ("double", "min"), "high": ("double", "max")},
        reduce=lambda g: g.agg(low="min", high="max").astype("float64"),
        finish=lambda s: s["high"] - s["low"],
    )
    df = spark.createDataFrame([("a", 1.0), ("a", 4.5), ("b", 2.0), (None, 3.0)], "k string, v double")
    got = udaf.aggregate_with(df.repartition(3), "k", "v", spread, "spread")
    assert sorted(tuple(r) for r in got.collect()) == [("a", 3.5), ("b", 0.0)]

import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from helpers import near, rows
from wattloom.functions import scalars as S


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr.alias("y")).collect()[0][0]


@pytest.mark.parametrize("raw, want", [
    ("2026年2月", date(2026, 2, 15)), ("2026年12月", date(2026, 12, 15)), ("2026年2月3日", date(2026, 2, 3)),
    ("2026-02-03", date(2026, 2, 3)), ("合计", None), (None, None),
])
def test_cn_month(spark, raw, want):
    assert one(spark, S.parse_cn_month("x"), raw) == want


@pytest.mark.parametrize("raw, want", [
    ("1,234.5\t", 1234.5), ("--", None), ("-", None), ("…", None), ("", None), ("abc", None), (" 7 ", 7.0), ("-3", -3.0),
])
def test_dirty_number(spark, raw, want):
    assert one(spark, S.parse_dirty_number("x"), raw) == want


def test_to_double_never_nan(spark):
    assert [one(spark, S.to_double("x"), v) for v in ("NaN", "1e3", "x", None)] == [None, 1000.0, None, None]


def test_parse_ts_drops_bad_rows(spark):
    df = spark.createDataFrame([("2020-01-05",), ("2020/3/4",), ("bad",), (None,)], "d string")
    assert [r[0] for r in rows(S.parse_ts(df, "d"), "d")] == [date(2020, 1, 5), date(2020, 3, 4)]


def test_header_rows_keep_null(spark):
    df = spark.createDataFrame([("date",), ("x",), (None,)], "d string")
    assert {r[0] for r in S.drop_header_rows(df, "d", "date").collect()} == {"x", None}


def test_clip_and_sums_keep_null(spark):
    df = spark.createDataFrame([(-1.0, None), (None, None), (5.0, 2.0)], "a double, b double")
    got = rows(df.select(S.clip("a", 0.0, 3.0), S.row_sum(["a", "b"]), S.row_sum(["a", "b"], 1), S.row_sum(["a", "b"], 2)))
    assert got == [(0.0, -1.0, -1.0, None), (None, 0.0, None, None), (3.0, 7.0, 7.0, 7.0)]


def test_ratio_is_never_infinite(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (1.0, 4.0), (None, 1.0)], "a double, b double")
    assert rows(df.select(S.safe_ratio("a", "b"), S.safe_ratio("a", "b", 0.0))) == [(None, 0.0), (None, 0.0), (0.25, 0.25), (None, 0.0)]


def test_bins_are_right_closed(spark):
    df = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 0.95, 0.96, 1.05, 1.06, None)], "r double")
    got = [r[0] for r in df.select(S.bin_labels("r", S.BALANCE_EDGES, S.BALANCE_LABELS)).collect()]
    assert got == [None, None, "undersupply", "balanced", "balanced", "oversupply", None]


@pytest.mark.parametrize("raw, want", [
    ("chn_11", "CN-11"), (" cn.5 ", "CN-05"), ("CN11", "CN-11"), ("CHN-110000", "CN-11"), ("7", "CN-07"), ("44", "CN-44"),
    ("cn5", "CN5"), ("somewhere", "SOMEWHERE"), ("", ""), (None, ""),
])
def test_region_key(spark, raw, want):
    assert one(spark, S.normalize_region_key("x"), raw) == want


@pytest.mark.parametrize("value, hint, want", [
    (0.38, 400.0, 380.0), (384.5, 400.0, 384.5), (38456.0, 400.0, 38.456), (300.0, 50.0, 0.3 * 1000), (1999.0, 50.0, 1999.0),
    (3.0, 50.0, 3.0), (None, 400.0, None), (2400.0, 50.0, 2400.0),
])
def test_unit_repair(spark, value, hint, want):
    got = one(spark, S.normalize_unit("x", hint), value, "double")
    assert got == want or abs(got - want) < 1e-9


def test_unit_hint_is_upper_median(spark):
    df = spark.createDataFrame([(0.5, 300.0), (None, 3.0), (300.0, None), (-0.5, 200.0)], "a double, b double")
    near([r[0] for r in df.select(S.row_unit_hint(["a", "b"])).collect()], [500.0, 400.0, 300.0, 200.0])


def test_year_rounds_half_to_even(spark):
    assert [one(spark, S.parse_year("x"), v) for v in ("2010", "2010,5", "2011.5", "n/a")] == [2010, 2010, 2012, None]


def test_schema_guards(spark):
    df = spark.createDataFrame([(1, 2.0)], "`﻿ Year ` int, Price double")
    roles = {"year": "year", "date": "year", "price": "price"}
    assert S.validate_headers(df, roles).columns == ["year", "price"]
    for bad in ("year int, other int", "year int, date int", "price int"):
        with pytest.raises(ValueError):
            S.validate_headers(spark.createDataFrame([], bad), roles)
    with pytest.raises(ValueError):
        S.require_columns(df, ["absent"])
    assert S.ensure_columns(df, ["z"]).dtypes[-1] == ("z", "double")
    wide = spark.createDataFrame([], "d date, a_yoy double, a double, b_share double")
    assert S.select_by_pattern(wide, ["d"], ["_yoy", "_share"]).columns == ["d", "a_yoy", "b_share"]
    assert S.select_available(wide, ["a", "nope"]).columns == ["a"]
    assert S.first_columns(wide, 2).columns == ["d", "a_yoy"]


def test_year_filter_reaches_the_scan(spark, tmp_path):
    spark.sql("select timestamp_ntz'2020-05-01 00:00:00' as ts, 1 as v").write.parquet(str(tmp_path / "t"))
    plan = S.filter_years(spark.read.parquet(str(tmp_path / "t")), "ts", 2019, 2021)._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: ")[1].split("\n")[0]
    assert "GreaterThanOrEqual" in pushed and "LessThan" in pushed


def test_cyclic_month(spark):
    df = spark.createDataFrame([(date(2020, 3, 1),)], "ts date")
    got = S.calendar_features(df, "ts").collect()[0]
    assert (got.year, got.month, got.quarter) == (2020, 3, 1)
    assert math.isclose(got.month_sin, 1.0) and abs(got.month_cos) < 1e-12

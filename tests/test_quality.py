from datetime import date

import pytest
from pyspark.sql import functions as F

from helpers import month, near, rows, series
from wattloom import Family
from wattloom.operators import quality as Q
from wattloom.sources import sinks

FAM = Family("t", ("a", "b"))


def as_dict(df):
    return {(r.check, r.metric): (r.value, r.status) for r in df.collect()}


def test_identity(spark):
    df = series(spark, [(10.0, 5.0, 5.0), (10.0, 5.0, 4.0), (0.0, 0.0, 0.0)], "t double, a double, b double")
    got = as_dict(Q.check_identity(df, FAM, "generation", 0.02))
    assert got["generation", "max_deviation"] == (1.0, "WARN") and got["generation", "abnormal_count"][0] == 1.0
    near([got["generation", "mean_deviation_pct"][0]], [5.0])
    assert as_dict(Q.check_identity(df, FAM, "demand", 0.10, 0.02))["demand", "abnormal_count"] == (0.0, "PASS")


def test_temporal_rule_counts_thirty_days(spark):
    df = series(spark, [1.0] * 192)
    got = as_dict(Q.check_temporal(df, ["k"], "ts"))
    assert got["temporal", "expected_months"][0] == 194.0 and got["temporal", "actual_months"][0] == 192.0
    near([got["temporal", "completeness_pct"][0]], [192 / 194 * 100])
    assert got["temporal", "gaps_over_month"] == (0.0, "PASS")


def test_range_counts_unknown_rows(spark):
    df = series(spark, [0.2, 0.7, None, None])
    got = as_dict(Q.check_range(df, "v"))
    assert got["balance", "normal_range_pct"][0] == 25.0 and got["balance", "severe_imbalance_count"] == (1.0, "WARN")


def test_growth_and_shares(spark):
    df = series(spark, [(4.0, 0.1, 0.5, 0.5), (0.1, -3.5, 0.6, 0.5), (None, 0.0, 0.0, 0.0)], "x_yoy double, y_yoy double, p double, q double")
    got = as_dict(Q.check_growth(df, ["x_yoy", "y_yoy", "z_yoy"]))
    assert got["growth", "extreme_growth_column_count"] == (2.0, "WARN")
    shares = as_dict(Q.check_shares(df, {"supply": ["p", "q"], "demand": ["absent"]}))
    near([shares["shares", "supply_max_deviation"][0]], [0.1])
    assert shares["shares", "supply_max_deviation"][1] == "WARN" and len(shares) == 1


def test_absent_columns_are_skipped(spark):
    df = series(spark, [1.0])
    checks = Q.run_checks(df, [Q.identity_check(df, FAM, "demand", 0.1), Q.growth_check(df, ["none"]), Q.temporal_check("ts")], ["k"], "ts")
    got = as_dict(checks)
    assert got["demand", "columns"] == (None, "SKIPPED") and got["growth", "columns"] == (None, "SKIPPED")
    assert [tuple(r) for r in Q.summarize_checks(checks).collect()] == [(1, 1, 0)]


def test_alignment_stats(spark):
    a = spark.createDataFrame([("r", date(2020, 1, 15), 100.0), ("r", date(2020, 1, 20), 10.0), ("r", date(2020, 2, 1), 5.0), ("r", date(2020, 4, 1), 1.0), ("r", None, 3.0)],
                              "k string, ts date, s double")
    b = spark.createDataFrame([("r", date(2020, 1, 1), 10.0), ("r", date(2020, 2, 1), 50.0), ("r", date(2020, 3, 1), 1.0)], "k string, ts date, d double")
    r = Q.alignment_stats(a, b, ["k"], "ts", "s", "d").collect()[0]
    assert (r.raw_rows_a, r.raw_rows_b, r.months_a, r.months_b, r.common_months, r.dropped_months, r.dropped_list, r.final_months) == (5, 3, 3, 3, 2, 1, "2020-02", 1)
    assert (r.common_start, r.common_end) == ("2020-01", "2020-02")


def test_report_and_nonzero(spark, tmp_path):
    df = series(spark, [0.0, 1.0, None])
    assert Q.count_nonzero(df, "v").collect()[0].non_zero == 1
    with pytest.raises(ValueError):
        Q.count_nonzero(df, "w")
    edges = spark.createDataFrame([(1.0, 2.0)], "first_mean double, last_mean double")
    table = Q.report_table(Q.check_range(df, "v"), df, {"all": ["v"]}, edges)
    sinks.write_report(table, str(tmp_path / "report"))
    assert {r.check for r in spark.read.parquet(str(tmp_path / "report")).collect()} == {"balance", "volatility all", "forecast"}

"""Windows, alignment, statistics, imputation and indicators on literal rows."""

from datetime import date

import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import month, near, rows, series
from wattloom import Family
from wattloom.operators import align as J
from wattloom.operators import impute as I
from wattloom.operators import indicators as K
from wattloom.operators import stats as A
from wattloom.operators import windows as W
from wattloom.plans import flows

FAM = Family("t", ("a", "b"))


def test_pct_change_pads_forward(spark):
    out = W.pct_change(series(spark, [1.0, None, 3.0, 0.0, 5.0]), ["k"], "ts", "v", 1, out="c")
    # pad gives 1, 1, 3, 0, 5; the last change is over zero.
    assert [r[-1] for r in rows(out, "ts")] == [None, 0.0, 2.0, -1.0, None]


def test_rolling_needs_a_full_window(spark):
    out = W.rolling_mean(series(spark, [1.0, 2.0, 3.0, None, 5.0, 6.0, 7.0]), ["k"], "ts", "v", 3, out="m")
    assert [r[-1] for r in rows(out, "ts")] == [None, None, 2.0, None, None, None, 6.0]
    shifted = W.rolling_mean(series(spark, [1.0, 2.0, 3.0, 4.0]), ["k"], "ts", "v", 3, shift=1, out="m")
    assert [r[-1] for r in rows(shifted, "ts")] == [None, None, None, 2.0]


def test_interpolation_ends(spark):
    out = W.interpolate_linear(series(spark, [None, 1.0, None, None, 4.0, None]), ["k"], "ts", "v")
    near([r[-1] for r in rows(out, "ts")], [None, 1.0, 2.0, 3.0, 4.0, 4.0])


def test_interpolation_equals_pandas(spark):
    values = [None if i % 7 in (2, 3) or i % 11 == 0 else float((i * 37) % 101) for i in range(193)]
    got = [r[-1] for r in rows(W.interpolate_linear(series(spark, values), ["k"], "ts", "v"), "ts")]
    want = pd.Series(values, dtype=float).interpolate().tolist()
    near(got[1:], want[1:])
    assert got[0] is None


def test_densify_and_gaps(spark):
    df = series(spark, [1.0, 2.0, 3.0, 4.0]).filter(F.col("v") != 2)
    assert [r[2] for r in rows(W.day_gap(df, ["k"], "ts", "g").select("k", "ts", "g"), "ts")] == [None, 59, 31]
    full = W.densify_months(df, ["k"], "ts")
    assert [r.v for r in full.orderBy("ts").collect()] == [1.0, None, 3.0, 4.0]


def test_weights_fall_back(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 0.0), ("c", None)], "g string, v double")
    assert [r[-1] for r in rows(W.group_weight(df, ["g"], "v", out="w"), "g", "v")] == [0.25, 0.75, 1 / 12, 1 / 12]


def test_outer_join_with_an_absent_side(spark):
    a = series(spark, [1.0, 2.0])
    assert J.outer_on_month(a, None, ["k"]) is a
    with pytest.raises(ValueError):
        J.outer_on_month(None, None, ["k"])


def test_dedup_and_ids(spark):
    df = spark.createDataFrame([
        ("a", date(2022, 1, 1), 1, 10.0), ("a", date(2022, 1, 9), 2, 20.0), ("a", date(2022, 1, 9), 3, None), ("a", date(2022, 2, 1), 4, 5.0),
    ], "k string, day date, n int, v double")
    last = J.dedup_by(df, ["k"], "day", "last", ["n"], month="ts")
    assert [(r.n, r.v, r.ts) for r in last.orderBy("ts").collect()] == [(3, None, date(2022, 1, 1)), (4, 5.0, date(2022, 2, 1))]
    assert [r.n for r in J.dedup_by(df, ["k"], "day", "first", ["n"], month="ts").orderBy("ts").collect()] == [1, 4]
    assert [r.id for r in J.with_ids(df, ["day", "n"]).orderBy("n").collect()] == [0, 1, 2, 3]


def test_global_ids_match_sorted_order_over_many_partitions(spark):
    df = spark.range(0, 5000, numPartitions=16).select((F.col("id") * 7919 % 5000).alias("x"), F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 17).alias("k"))
    got = [(r.x, r.id) for r in J.with_ids(df, ["x"]).collect()]
    assert all(x == i for x, i in got) and len(got) == 5000
    per_key = J.with_ids(df, ["x"], ["k"], large_groups=True)
    assert J.with_ids(df, ["x"], ["k"]).exceptAll(per_key).count() == 0 and per_key.count() == 5000


def test_outlier_rule_keeps_unknown(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 100.0), (None, 1.0), (1.0, 0.0), (9.0, 1.0)], "s double, d double")
    assert rows(J.drop_ratio_outliers(df, "s", "d")) == [(1.0, 1.0), (None, 1.0), (1.0, 0.0)]


def test_scenarios_are_checked(spark):
    df = series(spark, [1.0])
    assert J.scenario_grid(df, {"a": [1, 2], "b": [1, 2, 3]}).select("scenario_id").distinct().count() == 6
    assert J.scenario_grid(df, {"a": range(1000), "b": range(200)}).agg({"scenario_id": "max"}).first()[0] == 199_999
    with pytest.raises(ValueError):
        J.scenario_grid(df, {"a": []})


def test_describe_equals_pandas(spark):
    values = [3.0, 1.0, None, 8.0, 5.5, 2.0, 2.0]
    got = A.describe_cols(series(spark, values), ["v"]).collect()[0]
    want = pd.Series(values, dtype=float).describe()
    near([float(got.n), got.mean, got.std, got.min, got.q25, got.q50, got.q75, got.max], want.tolist())
    rough = A.quantiles(series(spark, values), ["v"], [0.5], approx=True).collect()[0]
    assert rough.value in (2.0, 3.0)


def test_volatility_takes_the_first_of_equals(spark):
    df = series(spark, [(1.0, 1.0), (3.0, 3.0), (2.0, 2.0)], "p double, q double")
    assert A.volatility_top(df, {"g": ["p", "q"]}).collect()[0].column == "p"


def test_accounting_fill(spark):
    df = spark.createDataFrame([(None, 1.0, 2.0), (5.0, None, 2.0), (5.0, 1.0, None), (None, None, 2.0), (9.0, 4.0, 4.0)], "t double, a double, b double")
    once = I.fill_by_accounting(df, FAM)
    want = [(3.0, 1.0, 2.0), (5.0, 3.0, 2.0), (5.0, 1.0, 4.0), (None, None, 2.0), (9.0, 4.0, 4.0)]
    assert rows(once) == want
    assert rows(I.fill_by_accounting(once, FAM)) == want


def test_total_fallback_and_scaling(spark):
    df = spark.createDataFrame([(None, 1.0, None), (None, None, None), (10.0, 1.0, 4.0), (10.0, -1.0, 0.0)], "t double, a double, b double")
    assert [r.t for r in I.total_from_parts(df, FAM).collect()] == [1.0, None, 10.0, 10.0]
    got = rows(I.scale_parts(df, FAM).select("a", "b"))
    assert got[2:] == [(2.0, 8.0), (-1.0, 0.0)]
    assert rows(I.non_negative(df, ["a"]).select("a")) == [(1.0,), (None,), (1.0,), (0.0,)]


def test_temp_fill_of_a_leading_gap(spark):
    values = [None, None] + [float(i) for i in range(2, 26)]
    got = [r[-1] for r in rows(I.temp_fill(series(spark, values), ["k"], "ts", ["v"]), "ts")]
    # January is known in years two and three, February in year two only.
    near(got[:2], [(12.0 + 24.0) / 2, (13.0 + 25.0) / 2])


def test_short_series_take_the_month_mean(spark):
    values = [1.0, 2.0] + [None] * 10 + [None, None]
    got = [r.v for r in I.fill_month_mean(series(spark, values), ["k"], "ts", "v").orderBy("ts").collect()]
    assert got[12:] == [1.0, 2.0] and got[5] == 1.5


def test_winsorize_needs_enough_values(spark):
    long = [float(i) for i in range(100)] + [None]
    got = [r.v for r in I.winsorize(series(spark, long), ["k"], ["v"]).orderBy("ts").collect()]
    near([got[0], got[50], got[99]], [0.99, 50.0, 98.01])
    assert got[100] is None
    short = [float(i) for i in range(23)]
    assert [r.v for r in I.winsorize(series(spark, short), ["k"], ["v"]).orderBy("ts").collect()] == short


def test_clean_flows_close_every_gap(spark):
    def value(i):
        a, b = 50.0 + i % 12, 30.0 + (i * 5) % 12
        t = None if i % 9 == 0 else a + b
        return (t, None if i % 7 == 0 else a, None if i % 14 == 0 else b)

    raw = series(spark, [value(i) for i in range(60)], "t double, a double, b double").unionByName(
        series(spark, [value(i) if i % 6 == 0 else (None, None, None) for i in range(30)], "t double, a double, b double", key="few"))
    out = flows.clean_demand(raw, ["k"], "ts", FAM, trees=5).toPandas()
    assert len(out) == 90 and not out[["t", "a", "b"]].isna().any().any()
    assert ((out["a"] + out["b"] - out["t"]).abs() < 1e-9 * out["t"]).all()
    again = flows.clean_demand(raw, ["k"], "ts", FAM, trees=5).toPandas()
    order = ["k", "ts"]
    pd.testing.assert_frame_equal(out.sort_values(order, ignore_index=True), again.sort_values(order, ignore_index=True))
    supply = flows.clean_supply(raw.unionByName(raw.limit(3)), ["k"], "ts", FAM, trees=5).toPandas()
    assert len(supply) == 90 and (supply[["t", "a", "b"]] >= 0).all().all()


def test_load_demand(spark):
    raw = spark.createDataFrame([("date", "total", "x", "y"), ("2010-01-01", "3,5", "1", "2"), ("2009-01-01", "1", "1", "1"), ("bad", "1", "1", "1"),
                                 ("2025-12-01", "7", None, "z")], "ts string, t string, a string, b string")
    assert rows(flows.load_demand(raw, "ts", FAM), "ts") == [(date(2010, 1, 1), None, 1.0, 2.0), (date(2025, 12, 1), 7.0, None, None)]


def test_shares_sum_to_one(spark):
    df = series(spark, [(5.0, 3.0, 2.0), (5.0, -3.0, 2.0), (0.0, 0.0, None)], "t double, a double, b double")
    assert [tuple(r) for r in K.shares(df, FAM).orderBy("ts").select("a_share", "b_share").collect()] == [(0.6, 0.4), (0.0, 1.0), (0.0, 0.0)]
    assert K.shares(df, FAM, of_total=True).orderBy("ts").first().a_share == 0.6


def test_growth_covers_numeric_columns_once(spark):
    df = series(spark, [(float(i + 1), float(2 * i + 1)) for i in range(30)], "x double, y double")
    out = K.growth(df, ["k"], "ts", limit_outliers=False)
    assert [c for c in out.columns if c.startswith("x_")] == ["x_yoy", "x_mom", "x_yoy_ma3"]
    last = out.orderBy(F.desc("ts")).first()
    near([last.x_yoy, last.x_mom], [30 / 18 - 1, 30 / 29 - 1])


def test_indicator_flow_uses_one_exchange_on_the_series(spark):
    values = [(float(100 + i), 60.0, 40.0 + i, float(90 + i), 50.0, 40.0 + i) for i in range(36)]
    df = series(spark, values, "d double, d1 double, d2 double, s double, s1 double, s2 double").repartition(4)
    out = K.indicators(df, ["k"], "ts", Family("d", ("d1", "d2")), Family("s", ("s1", "s2")), ["s2"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(k") == 1 and "SinglePartition" not in plan
    assert out.count() == 36 and "s2_share_yoy_ma3" in out.columns and "d_seasonal_strength" in out.columns
    assert "d_seasonal_yoy" not in out.columns


def test_large_quantiles_equal_numpy_on_a_skewed_key(spark):
    # One key holds two thirds of the rows, with many ties.
    df = spark.range(0, 9000, numPartitions=12).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5)).alias("k"), (F.col("id") * 7919 % 211).cast("double").alias("v"))
    got = {(r.k, r.prob): r.value for r in A.large_quantiles(df, "v", [0.01, 0.5, 0.99], ["k"]).collect()}
    for k, g in df.toPandas().groupby("k"):
        near([got[k, p] for p in (0.01, 0.5, 0.99)], [float(g["v"].quantile(p)) for p in (0.01, 0.5, 0.99)])
    whole = A.large_quantiles(df, "v", [0.5]).collect()[0]
    near([whole.value], [float(df.toPandas()["v"].median())])


def test_a_value_that_most_rows_hold_is_one_row(spark):
    """Nine tenths of the rows hold one value of one group; groups include null."""
    df = spark.range(0, 40_000, numPartitions=16).select(
        F.when(F.col("id") % 50 > 0, "hot").when(F.col("id") % 100 > 0, "cold").alias("k"),
        F.when(F.col("id") % 10 > 0, 7.0).when(F.col("id") % 400 > 0, F.col("id") * 7919 % 20011 / 10.0).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = A.ranked_values(df, "v", ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows_ = ranked.collect()
    assert len(rows_) == df.filter("v is not null").select("k", "v").distinct().count()
    for k in {r.k for r in rows_}:
        own = sorted((r["__first"], r["__rows"], r["__v"]) for r in rows_ if r.k == k)
        assert [f for f, _, _ in own] == [sum(n for _, n, _ in own[:i]) for i in range(len(own))] and [v for *_, v in own] == sorted(v for *_, v in own)
    spread = [r["count"] for r in spark.read.parquet(_written_by(ranked)).groupBy("__part").count().collect()]
    assert len(spread) >= 6 and max(spread) <= 3 * sum(spread) / len(spread)
    got = {(r.k, r.prob): r.value for r in A.large_quantiles(df, "v", [0.0, 0.03, 0.5, 0.999, 1.0], ["k"]).collect()}
    for k, g in df.toPandas().groupby("k", dropna=False):
        key = k if isinstance(k, str) else None
        near([got[key, p] for p in (0.0, 0.03, 0.5, 0.999, 1.0)], [float(g["v"].quantile(p)) for p in (0.0, 0.03, 0.5, 0.999, 1.0)])


def _written_by(df):
    """The first written table that ``df`` reads."""
    return df.inputFiles()[0].rsplit("/", 1)[0]


def test_both_panels_come_from_one_scan(spark, monkeypatch):
    from wattloom.catalog import QUERIES
    from wattloom.plans import shapes

    sf, written, write = "/root/testdata/sf0.001", [], shapes.materialize
    monkeypatch.setattr(shapes, "materialize", lambda df: written.append(df._jdf.queryExecution().optimizedPlan().toString()) or write(df))
    annual, monthly = shapes.annual_and_monthly(spark, sf)
    same = lambda a, b: a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert same(annual, shapes.panel_annual(spark, sf)) and same(monthly, shapes.parent_monthly(spark, sf))
    for name in ("f5_entity_shares", "f9_disaggregate", "f10_build_panel"):
        written.clear()
        out = QUERIES[name](spark, sf)
        assert len(written) == 1 and written[0].count("o_totalprice#") > 0 and written[0].count("Relation [o_orderkey") == 1
        assert not any("orders.parquet" in f for f in out.inputFiles())


def test_windows_insist_on_a_series_key(spark):
    df = series(spark, [1.0])
    for call in (lambda: W.lags(df, [], "ts", "v", [1]), lambda: W.pct_change(df, [], "ts", "v", 1), lambda: I.winsorize(df, [], ["v"])):
        with pytest.raises(ValueError):
            call()

"""Whole panels of random gappy series against pandas, series by series."""

import numpy as np
import pandas as pd
import pytest

from helpers import month
from wattloom.operators import forecast as FC
from wattloom.operators import impute as I
from wattloom.operators import indicators as K
from wattloom.operators import windows as W

SERIES, MONTHS = 60, 90


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(7)
    out = []
    for k in range(SERIES):
        n = int(rng.integers(1, MONTHS))
        v = np.round(rng.normal(100, 40, n), 3)
        v[rng.random(n) < rng.random() * 0.6] = np.nan
        v[rng.random(n) < 0.03] = 0.0
        out.append(pd.DataFrame({"k": f"s{k}", "ts": [month(i) for i in range(n)], "v": v}))
    return pd.concat(out, ignore_index=True)


@pytest.fixture(scope="module")
def panel(spark, frame):
    return spark.createDataFrame(
        [(r.k, r.ts, None if np.isnan(r.v) else float(r.v)) for r in frame.itertuples()], "k string, ts date, v double").repartition(6)


def check(df, frame, want, col):
    """``want`` maps one pandas series to the expected one; infinities count as unknown."""
    got = df.toPandas().sort_values(["k", "ts"])[col].astype(float).to_numpy()
    expected = frame.sort_values(["k", "ts"]).groupby("k", group_keys=False)[["ts", "v"]].apply(want)
    expected = expected.replace([np.inf, -np.inf], np.nan).to_numpy(dtype=float)
    np.testing.assert_allclose(got, expected, rtol=1e-9, atol=1e-9)


def test_pct_change(panel, frame):
    for n in (1, 12):
        check(W.pct_change(panel, ["k"], "ts", "v", n, out="c"), frame, lambda g: g["v"].ffill().pct_change(n, fill_method=None), "c")


def test_interpolate(panel, frame):
    check(W.interpolate_linear(panel, ["k"], "ts", "v"), frame, lambda g: g["v"].interpolate(), "v_interp")


def test_rolling_and_lag(panel, frame):
    check(W.rolling_mean(panel, ["k"], "ts", "v", 3, shift=1, out="r"), frame, lambda g: g["v"].shift(1).rolling(3).mean(), "r")
    check(W.lags(panel, ["k"], "ts", "v", [6]), frame, lambda g: g["v"].shift(6), "v_lag_6")


def test_temp_fill(panel, frame):
    def want(g):
        by_month = g["v"].groupby(pd.to_datetime(g["ts"]).dt.month).transform("mean")
        return g["v"].interpolate().fillna(by_month).fillna(g["v"].median())

    check(I.temp_fill(panel, ["k"], "ts", ["v"]), frame, want, "v_temp")


def test_winsorize(panel, frame):
    def want(g):
        known = g["v"].dropna()
        return g["v"] if len(known) < 24 else g["v"].clip(known.quantile(0.01), known.quantile(0.99))

    check(I.winsorize(panel, ["k"], ["v"], suffix="_w"), frame, want, "v_w")


def test_seasonal(panel, frame):
    def index(g):
        return g["v"] / g["v"].groupby(pd.to_datetime(g["ts"]).dt.year).transform("mean")

    def strength(g):
        s = index(g).replace([np.inf, -np.inf], np.nan)
        return s / s.groupby(pd.to_datetime(g["ts"]).dt.month).transform("mean")

    out = K.seasonal_strength(K.seasonal_index(panel, ["k"], "ts", ["v"]), ["k"], "ts", ["v"])
    check(out, frame, index, "v_seasonal")
    check(out, frame, strength, "v_seasonal_strength")


def test_trend(panel, frame, spark):
    from pyspark.sql import functions as F

    rows = panel.withColumn("x", F.months_between("ts", F.lit("2010-01-01")).cast("int"))
    got = {r.k: r.prediction for r in FC.trend_predict(rows, ["k"], "x", "v", [120]).collect()}
    for k, g in frame.groupby("k"):
        known = g.assign(x=range(len(g))).dropna()
        if len(known) == 0:
            want = 0.0
        elif len(known) < 4:
            want = known["v"].iloc[-1]
        else:
            slope, level = np.polyfit(known["x"], known["v"], 1)
            want = slope * 120 + level
        assert abs(got[k] - want) <= 1e-6 * max(1, abs(want)), k

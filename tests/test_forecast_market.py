import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import month, near, rows, series
from wattloom.operators import forecast as FC
from wattloom.operators import market as M
from wattloom.plans import flows


def test_naive_repeats_the_season_with_drift(spark):
    values = [float(i % 12) + (i // 12) * 2 for i in range(36)]
    got = [r.forecast for r in FC.forecast_seasonal_naive(series(spark, values), ["k"], "ts", "v", 30).orderBy("ts").collect()]
    near(got, [float(i % 12) + (i // 12) * 2 for i in range(36, 66)])
    short = FC.forecast_seasonal_naive(series(spark, [1.0, 2.0, None]), ["k"], "ts", "v", 5).orderBy("ts").collect()
    assert [r.forecast for r in short] == [1.0, 2.0, 1.0, 2.0, 1.0] and short[0].ts == month(2)


def test_naive_twins_agree(spark):
    rng = np.random.default_rng(3)
    for n in (5, 12, 20, 40):
        y = rng.normal(100, 5, n)
        got = [r.forecast for r in FC.forecast_seasonal_naive(series(spark, [float(v) for v in y]), ["k"], "ts", "v", 40).orderBy("ts").collect()]
        near(got, FC._naive_path(y, 40).tolist())


def test_sarima_follows_trend_and_season(spark):
    t = np.arange(120)
    rng = np.random.default_rng(0)
    y = 1000 + 5 * t + 80 * np.sin(2 * np.pi * t / 12) + rng.normal(0, 5, 120)
    known = [float(v) for v in y[:96]]
    both = series(spark, known).unionByName(series(spark, known[:20], key="short")).unionByName(series(spark, [5.0] * 80, key="flat"))
    out = FC.forecast_sarima(both, ["k"], "ts", "v", 24)
    got = out.filter("k = 'a'").orderBy("ts").collect()
    assert got[0].ts == month(96) and {r.method for r in got} == {"sarima"}
    error = np.abs(np.array([r.forecast for r in got]) - y[96:]) / y[96:]
    assert error.mean() < 0.03
    assert {r.method for r in out.filter("k <> 'a'").collect()} == {"seasonal_naive"}
    assert {r.forecast for r in out.filter("k = 'flat'").collect()} == {5.0}
    again = FC.forecast_sarima(both, ["k"], "ts", "v", 24).filter("k = 'a'").orderBy("ts").collect()
    assert [r.forecast for r in again] == [r.forecast for r in got]


def _dense(w, coefs):
    """Log-likelihood after the start and the expected next changes, from the covariance of all months at once."""
    n, r, ahead = len(w), FC.STATES, 5
    past, shock = FC._model(np.array(coefs))
    move = np.eye(r, k=1)
    move[:, 0] += past
    loads = np.zeros((n + ahead, r + n + ahead))  # months by first state and shocks
    state = np.concatenate([np.eye(r), np.zeros((r, n + ahead))], axis=1)
    for t in range(n + ahead):
        if t:
            state = move @ state
            state[:, r + t] += shock
        loads[t] = state[0]
    size = np.r_[np.full(r, FC.DIFFUSE), np.ones(n + ahead)]
    cov = loads * size @ loads.T
    ahead_of = cov[n:, :n] @ np.linalg.solve(cov[:n, :n], w)
    errors = np.linalg.solve(low := np.linalg.cholesky(cov[:n, :n]), w)[r:]
    var = (errors ** 2).mean()
    return -0.5 * (len(errors) * (np.log(2 * np.pi * var) + 1) + 2 * np.log(np.diag(low)[r:]).sum()), ahead_of


def test_filter_equals_the_joint_distribution():
    rng = np.random.default_rng(4)
    lengths = np.array([40, 26, 33])
    w = np.zeros((3, 40))
    for i, n in enumerate(lengths):
        w[i, -n:] = rng.normal(size=n)
    coefs = rng.uniform(-0.9, 0.9, (3, 4, 4))
    fit, state = FC.kalman(w, lengths, coefs)
    assert np.allclose(FC.likelihood(w, lengths, coefs), fit, atol=1e-3)
    for i, n in enumerate(lengths):
        for j in range(4):
            want, ahead = _dense(w[i, -n:], coefs[i, j])
            assert abs(fit[i, j] - want) < 1e-3
            past, _ = FC._model(coefs[i, j])
            a, got = state[i, j], []
            for _ in range(5):
                got.append(a[0])
                a = past * a[0] + np.append(a[1:], 0.0)
            assert np.allclose(got, ahead, atol=1e-4)


def test_fit_is_the_largest_likelihood_and_says_whether_it_converged():
    rng = np.random.default_rng(6)
    series_ = [np.cumsum(rng.normal(size=n)) + 9 * np.sin(np.arange(n) * np.pi / 6) + rng.normal(size=n) for n in (90, 70, 120, 34)]
    for y, found in zip(series_, FC._forecast(series_, 12, None)):
        w = np.diff(y)[12:] - np.diff(y)[:-12]
        tried = FC.likelihood(w[None], np.array([len(w)]), rng.uniform(-0.99, 0.99, (1, 400, 4)))[0]
        assert found["method"] == "sarima" and found["converged"] and found["loglik"] >= tried.max() - 1e-6
        assert np.abs(found["coefs"]).max() < 1 or len(y) < 40
    w, n = rng.normal(size=(1, 60)), np.array([60])
    assert not FC.fit_sarima(w, n, iterations=1)[1].all()
    assert [r["method"] for r in FC._forecast([np.arange(31.0) ** 2, np.ones(80)], 3, None)] == ["seasonal_naive"] * 2


def test_series_are_forecast_alike_alone_and_side_by_side(spark):
    rng = np.random.default_rng(8)
    parts = [series(spark, [float(v) for v in 50 + rng.normal(size=n).cumsum()], key=f"k{n}") for n in (60, 75)]
    one = {(r.k, r.ts): r.forecast for p in parts for r in FC.forecast_sarima(p, ["k"], "ts", "v", 6).collect()}
    both = FC.forecast_sarima(parts[0].unionByName(parts[1]), ["k"], "ts", "v", 6).collect()
    assert len(both) == 12 and all(abs(one[r.k, r.ts] - r.forecast) < 1e-3 for r in both)
    assert FC.forecast_sarima(parts[0].limit(0), ["k"], "ts", "v", 6).collect() == []


def test_trend_fallbacks(spark):
    df = spark.createDataFrame(
        [("none", 2015, None)] + [("one", 2015, 7.0)] + [("few", 2015, 1.0), ("few", 2016, 4.0), ("few", 2017, None)]
        + [("line", 2015 + i, 2.0 + 3.0 * i) for i in range(5)], "e string, year int, y double")
    got = {(r.e, r.year): r.prediction for r in FC.trend_predict(df, ["e"], "year", "y", [2020, 2022]).collect()}
    near([got["none", 2020], got["one", 2020], got["few", 2022], got["line", 2020], got["line", 2022]], [0.0, 7.0, 4.0, 17.0, 23.0])


def _panel(spark):
    annual = [("r", f"e{e}", 2010 + y, float((e + 1) * (10 + y)), float(e * 3 + y), 0.0) for e in range(3) for y in range(10)]
    months = [("r", month(i), 100.0 + i % 12 + i, 40.0 + i % 12, 10.0 + (i % 12) / 2) for i in range(132)]
    return (spark.createDataFrame(annual, "g string, e string, year int, t_annual double, p_annual double, q_annual double"),
            spark.createDataFrame(months, "g string, ts date, t double, p double, q double"))


def test_entity_values_add_up_to_the_parent(spark):
    annual, months = _panel(spark)
    fc = FC.forecast_seasonal_naive(months, ["g"], "ts", "t", 48)
    out = flows.build_panel(annual, months, fc, ["g"], "e", "ts", "t", ["p", "q"], 2019, 2024, clim_years=(2012, 2018)).toPandas()
    assert len(out) == 3 * 15 * 12 and out["ts"].min() == month(0)
    assert set(out["data_flag"]) == {FC.HISTORICAL, FC.PROJECTED}
    parent = months.toPandas().set_index("ts")
    summed = out[out.year <= 2020].groupby("ts")[["t", "p"]].sum()
    near(summed["t"].tolist(), parent["t"].tolist(), 1e-6)
    near(summed["p"].tolist(), parent["p"].tolist(), 1e-6)
    # No entity ever had a share of q: history splits to 0, the future evenly.
    assert (out[out.year <= 2019]["q"] == 0).all() and (out[out.year > 2020].groupby("ts")["q"].nunique() == 1).all()
    codes = spark.createDataFrame([("e0", "CN-10"), ("e1", "CN-11")], "e string, code string")
    coded = flows.build_panel(annual, months, fc, ["g"], "e", "ts", "t", ["p", "q"], 2019, 2024, clim_years=(2012, 2018), codes=codes)
    assert {(r.e, r.code) for r in coded.select("e", "code").distinct().collect()} == {("e0", "CN-10"), ("e1", "CN-11")}


def test_known_months_of_a_part_year_stay(spark):
    df = lambda rows: spark.createDataFrame(rows, "g string, ts date, t double")
    hist = df([("a", month(i), float(i)) for i in range(15)] + [("b", month(i), float(i)) for i in range(12)])
    fc = df([(g, month(i), -1.0) for g in "ab" for i in range(36)])
    out = FC.splice(hist, fc, ["g"], "ts", 2011).toPandas()
    assert out.groupby("g").size().to_dict() == {"a": 24, "b": 24}
    assert out[out["t"] >= 0].groupby("g").size().to_dict() == {"a": 15, "b": 12}


def test_climatology_sums_to_one(spark):
    _, months = _panel(spark)
    clim = FC.climatology(months, ["g"], "ts", ["p"], (2010, 2019)).toPandas()
    assert len(clim) == 12 and abs(clim["w_p"].sum() - 1) < 1e-12


MONTH = [("r", month(i), 100.0 + i, 60.0, 20.0, 10.0, 5.0, 5.0 + i) for i in range(24)]
COLS = "k string, ts date, demand double, thermal double, hydro double, nuclear double, wind double, solar double"


def test_policy_keeps_total_supply(spark):
    df = spark.createDataFrame(MONTH, COLS).withColumns({"tax": F.lit(200.0), "subsidy": F.lit(0.5), "old": sum(F.col(t) for t in M.TECHS)})
    out = M.policy_reallocate(df).withColumn("new", sum(F.col(t) for t in M.TECHS)).toPandas()
    assert ((out["old"] - out["new"]).abs() < 1e-9).all() and (out["thermal"] < 60).all() and (out["wind"] > 5).all()
    idle = df.withColumns({t: F.lit(0.0) for t in M.TECHS})
    assert M.policy_reallocate(idle).select(sum(F.col(t) for t in M.TECHS)).first()[0] == 0.0


def test_prices_and_bids(spark):
    df = spark.createDataFrame([(120.0, 60.0), (50.0, 100.0), (10.0, 0.0)], "demand double, supply double")
    near([r.price for r in M.clear_market(df).collect()], [200.0, 100.0, 1e7])
    bids = M.bid_price(spark.createDataFrame([("thermal", 100.0, 2.0), ("wind", 100.0, 2.0)], "tech string, tax double, priority double"), M.technology_table(spark))
    got = {r.tech: r.bid_price for r in bids.collect()}
    near([got["thermal"], got["wind"]], [0.35 * 1.12 + 80.0, 0.2 * 1.05 * 0.9])


def test_mix_is_a_distribution(spark):
    df = spark.range(1, 121).select(F.col("id").alias("step"), F.lit(300.0).alias("tax"), F.lit(2.0).alias("priority"), F.lit(500.0).alias("anchor"))
    out = M.anchor_supply(M.forecast_mix(df, 120)).toPandas()
    assert ((out[[f"share_{t}" for t in M.TECHS]].sum(axis=1) - 1).abs() < 1e-12).all()
    assert ((out["supply"] - 500).abs() < 1e-9).all()
    held = M.anchor_supply(M.forecast_mix(df.withColumn("supply_factor", F.lit(0.8)), 120)).first()
    near([held.supply], [0.35 * 500 + 0.65 * 400])


def test_sector_weights_default_when_idle(spark):
    hist = spark.createDataFrame([("x", month(0), 1.0, 3.0), ("x", month(1), 1.0, 1.0), ("y", month(0), 0.0, None)], "k string, ts date, p double, q double")
    got = {r.k: (r.weight_p, r.weight_q) for r in M.sector_weights(hist, ["k"], "ts", ["p", "q"], (0.3, 0.7)).collect()}
    assert got == {"x": (0.5, 0.5), "y": (0.3, 0.7)}


def test_calibration_finds_the_scale(spark):
    df = spark.createDataFrame([(r[0], r[1], r[2] * 2, 50.0) for r in MONTH], "k string, ts date, demand double, supply double")
    obs = M.clear_market(df.withColumn("scale", F.lit(1.7))).select("k", "ts", F.col("price").alias("observed"))
    axes = {"tax": [300, 0], "subsidy": [1, 0.5], "scale": [0.05, 1, 2, 3, 5]}
    coarse = M.calibrate_grid(df, obs, ["k"], "ts", axes).collect()[0]
    assert (coarse.tax, coarse.subsidy, coarse.scale, coarse.pairs) == (0.0, 0.5, 2.0, 24)
    fine = M.calibrate_grid(df, obs, ["k"], "ts", axes, rounds=5).collect()[0]
    assert abs(fine.scale - 1.7) < 0.01 and fine.sse < coarse.sse
    yearly = obs.groupBy("k", F.year("ts").alias("year")).agg(F.avg("observed").alias("observed"))
    assert M.calibrate_grid(df, yearly, ["k"], "ts", axes, mode="annual").collect()[0].pairs == 2


@pytest.mark.parametrize("mode", ["monthly", "annual"])
def test_calibration_errors_equal_every_month_cleared_under_every_parameter(spark, mode):
    """Unknown and negative demand, unknown supply, prices at the floor, equal months, a series without observations."""
    rng = np.random.default_rng(11)
    rows_ = [("a", month(i), float(d), 50.0) for i, d in enumerate(rng.uniform(5, 300, 30))]
    rows_ += [("a", month(30), None, 50.0), ("a", month(31), 60.0, None), ("a", month(32), -4.0, 50.0), ("a", month(33), 60.0, 50.0), ("a", month(34), 60.0, 50.0)]
    rows_ += [("b", month(i), 70.0, 50.0) for i in range(3)]
    df = spark.createDataFrame(rows_, "k string, ts date, demand double, supply double").withColumn("sensitivity", F.lit(1.1))
    seen = F.when(F.col("k") == "a", 130.0 + 7 * F.month("ts"))
    obs = df.filter(F.month("ts") != 4).select("k", "ts", seen.alias("observed"))
    if mode == "annual":
        obs = obs.groupBy("k", F.year("ts").alias("year")).agg(F.avg("observed").alias("observed"))
    axes = {"tax": [5, 3], "price_factor": [0.5, 2.0, 1.0], "scale": [0.1, 0.7, 1.0, 2.0, 4.0]}
    every = M.calibration_error(M.clear_market(M.scenario_grid(df, axes)), obs, ["k"], "ts", mode, by=["price_factor", "scale"])
    want = {}
    for r in every.collect():
        order = (round(r.sse / 1e5, 8), r.price_factor, r.scale)
        if r.k not in want or order < want[r.k][0]:
            want[r.k] = order, r
    for r in M.calibrate_grid(df, obs, ["k"], "ts", axes, mode).collect():
        order, best = want[r.k]
        # the grid held every row once for each tax
        assert (r.tax, r.price_factor, r.scale, r.pairs) == (3.0, best.price_factor, best.scale, best.pairs // (1 if mode == "annual" else 2))
        near([r.sse], [best.sse / (1 if mode == "annual" else 2)], 1e-6)
    exact = {r.k: r for r in M.calibrate_exact(df.drop("sensitivity"), obs, ["k"], "ts", 0.05, 5.0, mode).collect()}
    fine = {"scale": [0.05 + 0.01 * i for i in range(496)]}
    on_grid = {r.k: r for r in M.calibrate_grid(df.drop("sensitivity"), obs, ["k"], "ts", fine, mode).collect()}
    assert exact["a"].sse <= on_grid["a"].sse + 1e-6 and abs(exact["a"].scale - on_grid["a"].scale) < 0.011
    assert (exact["b"].scale, exact["b"].sse, exact["b"].pairs) == (0.05, 0.0, 0)


def test_calibration_refuses_unknown_and_negative_axes(spark):
    df = spark.createDataFrame([("a", month(0), 1.0, 1.0)], "k string, ts date, demand double, supply double")
    obs = spark.createDataFrame([("a", month(0), 100.0)], "k string, ts date, observed double")
    for axes in ({"scale": [1], "colour": [2]}, {"scale": [-1, 1]}):
        with pytest.raises(ValueError):
            M.calibrate_grid(df, obs, ["k"], "ts", axes)


def test_classes(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (5.0,), (None,)], "v double")
    assert [r["class"] for r in M.class_breaks(df, "v").collect()] == [0, 13, 7, None]
    assert [r["class"] for r in M.class_breaks(spark.createDataFrame([(3.0,), (3.0,)], "v double"), "v").collect()] == [7, 7]


def test_proxy_only_where_nothing_matched(spark):
    df = spark.createDataFrame([("a", 300.0, 100.0, None), ("b", 300.0, 100.0, None), ("b", 1.0, 1.0, 7.0)], "k string, demand double, supply double, observed double")
    assert sorted((r.k, r.observed or -1) for r in M.scarcity_proxy(df, ["k"]).collect()) == [("a", 300.0), ("b", -1), ("b", 7.0)]
    assert M.scarcity_proxy(df, ["k"], annual_anchor=True) is df


def test_unknown_demand_gives_no_share_and_no_price(spark):
    from wattloom.operators import market

    df = spark.createDataFrame([("a", 1, None, None, None, *[10.0] * 5)], "k string, ts int, demand double, supply double, observed double, "
                               + ", ".join(f"{t} double" for t in market.TECHS))
    assert all(r.market_share is None for r in market.market_share(df, ["k", "ts"]).collect())
    assert market.scarcity_proxy(df, ["k"]).collect()[0].observed is None

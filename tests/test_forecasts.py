"""Autoregressions, trend and boosted forecasts against dense solutions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadstream.operators import arima, forecast, metrics, trend
from roadstream.operators.regression import products, solve

START = "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 15 * i) AS timestamp"


def panel(spark, series):
    rows = [(s, i, None if v is None else float(v)) for s, vs in series.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "segment_id string, i int, speed_kmh double")
    return df.repartition(3).selectExpr("segment_id", START, "speed_kmh")


def by_segment(df):
    out = {}
    for row in df.orderBy("segment_id", "timestamp").collect():
        out.setdefault(row.segment_id, []).append(row.forecast)
    return out


def autoregressive(rng, weights, n, level=50.0):
    values = list(rng.normal(level, 1, len(weights)))
    while len(values) < n:
        before = np.array(values[-len(weights) :][::-1]) - level
        values.append(level + float(before @ weights) + rng.normal())
    return values


@pytest.fixture(scope="module")
def series():
    rng = np.random.default_rng(1)
    return {
        "A": autoregressive(rng, [0.8], 300),
        "B": autoregressive(rng, [0.2, 0.0, 0.6], 300),
        "C": rng.normal(40, 3, 200),
        "D": [30.0] * 100,
        "E": autoregressive(rng, [0.5, -0.3], 5),
    }


def test_order_equals_a_solve_of_every_order(spark, series):
    history = forecast.split_history(panel(spark, series), 5)
    found = {r.segment_id: r for r in arima.ar_orders(history, 5).collect()}
    for name, values in series.items():
        y = np.array(values[: int(len(values) * 0.8)])
        n, d = len(y), y - y.mean()
        c = [float(d[k:] @ d[: n - k]) / n if k < n else 0.0 for k in range(6)]
        row = found[name]
        assert row.n == n and row.mean == pytest.approx(y.mean())
        if c[0] == 0:
            assert row.ar_order == 0
            continue
        best = (n * np.log(c[0]), [], c[0])
        for m in range(1, 6):
            phi = np.linalg.solve([[c[abs(i - j)] for j in range(m)] for i in range(m)], c[1 : m + 1])
            left = c[0] - float(phi @ c[1 : m + 1])
            if n * np.log(left) + 2 * m < best[0]:
                best = (n * np.log(left) + 2 * m, phi, left)
        assert row.ar_order == len(best[1])
        assert row.phi == pytest.approx(list(best[1]), abs=1e-8)
        assert row.variance == pytest.approx(best[2])
    assert found["A"].ar_order >= 1 and found["B"].ar_order >= 3


def test_own_orders_forecast(spark, series):
    history = forecast.split_history(panel(spark, series), 5)
    orders = {r.segment_id: r for r in arima.ar_orders(history, 5).collect()}
    for name, found in by_segment(arima.ar_auto(history, 5)).items():
        y, row = series[name], orders[name]
        cut = int(len(y) * 0.8)
        want = [
            row.mean + sum(f * (y[t - 1 - j] - row.mean) for j, f in enumerate(row.phi))
            for t in range(cut, len(y))
        ]
        assert found == pytest.approx(want)


def test_moving_average_model_against_dense_steps(spark):
    rng = np.random.default_rng(2)
    series = {}
    for name, n in (("A", 150), ("B", 90), ("C", 61)):
        e, d = rng.normal(size=n), np.zeros(n)
        for t in range(2, n):
            d[t] = 0.4 * d[t - 1] + e[t] + 0.6 * e[t - 1]
        series[name] = (50 + np.cumsum(d)).tolist()
    series["short"] = [1.0, 2.0, 3.0]
    found = by_segment(arima.arma_span(panel(spark, series), ar=2, ma=1, long=4))

    def rows(build):
        return np.vstack([build(np.diff(v), int(len(v) * 0.8)) for v in series.values()])

    def long_rows(d, cut):
        own = [[1, *d[t - 4 : t][::-1], d[t]] for t in range(4, cut - 1)]
        return np.array(own).reshape(-1, 6)

    x = rows(long_rows)
    long = np.linalg.lstsq(x[:, :-1], x[:, -1], rcond=None)[0]
    error = lambda d, t: d[t] - long @ [1, *d[t - 4 : t][::-1]]

    def short_rows(d, cut):
        own = [[1, d[t - 1], d[t - 2], error(d, t - 1), d[t]] for t in range(5, cut - 1)]
        return np.array(own).reshape(-1, 5)

    x = rows(short_rows)
    c, a1, a2, b = np.linalg.lstsq(x[:, :-1], x[:, -1], rcond=None)[0]
    for name in ("A", "B", "C"):
        y = series[name]
        cut, d = int(len(y) * 0.8), np.diff(y)
        last, one, two, e = y[cut - 1], d[cut - 2], d[cut - 3], error(d, cut - 2)
        want = []
        for _ in range(cut, len(y)):
            one, two, e = c + a1 * one + a2 * two + b * e, one, 0.0
            last += one
            want.append(last)
        assert found[name] == pytest.approx(want, rel=1e-8)
    assert found["short"] == [None]


def test_arma_with_missing_readings_and_no_rows(spark):
    values = [None if i % 40 == 7 else 50 + (i * i) % 7 for i in range(300)]
    found = by_segment(arima.arma_span(panel(spark, {"A": values})))
    assert all(v is not None and np.isfinite(v) for v in found["A"])
    assert arima.arma_span(panel(spark, {"A": values}).limit(0)).count() == 0


def test_trend_equals_a_dense_ridge(spark):
    rng = np.random.default_rng(3)
    t = np.arange(400)
    series = {
        name: np.exp(3 + level + 0.002 * np.maximum(t - 150, 0) + 0.2 * np.sin(2 * np.pi * t / 96)
                     + rng.normal(0, 0.05, 400))
        for name, level in (("A", 0.0), ("B", 0.4))
    }
    readings = panel(spark, series)
    found = by_segment(trend.trend_seasonal(readings, {24: 2}, changepoints=4))
    cut, share = 320, t / 319
    hours = t / 4
    cuts = [0.8 * (k + 1) / 5 for k in range(4)]
    columns = [share, *[np.maximum(share - s, 0) for s in cuts]]
    columns += [f(2 * np.pi * k * (hours % 168) / 24) for k in (1, 2) for f in (np.sin, np.cos)]
    one = np.stack(columns, 1)
    x = np.vstack([one[:cut] - one[:cut].mean(axis=0)] * 2)
    logs = {name: np.log(v) for name, v in series.items()}
    y = np.concatenate([v[:cut] - v[:cut].mean() for v in logs.values()])
    plain = np.linalg.lstsq(x, y, rcond=None)[0]
    noise = ((y - x @ plain) ** 2).sum() / (len(y) - x.shape[1])
    scales = np.array([5.0] + [0.05] * 4 + [10.0] * 4)
    beta = np.linalg.solve(x.T @ x + np.diag(noise / scales**2), x.T @ y)
    for name, v in logs.items():
        want = np.exp(v[:cut].mean() + (one[cut:] - one[:cut].mean(axis=0)) @ beta)
        assert found[name] == pytest.approx(want.tolist(), rel=1e-6)
    assert trend.trend_seasonal(readings.limit(0)).count() == 0


def test_trend_is_no_worse_than_the_straight_line(traffic):
    bent, straight = (
        metrics.forecast_metrics(make(traffic.readings, plan=traffic.plan)).first().rmse
        for make in (trend.trend_seasonal, forecast.fourier_seasonal)
    )
    assert bent <= straight * 1.02


def test_boosted_steps_beat_lines_on_a_bent_map(spark):
    def values(x, n=400):
        out = [x]
        while len(out) < n:
            out.append(3.9 * out[-1] * (1 - out[-1]))
        return 50 * np.array(out)

    readings = panel(spark, {"A": values(0.2), "B": values(0.37)})
    sizes = {"lookback": 3, "horizon": 2}
    fitted = {}
    boosted = forecast.boosted_multi_horizon(readings, rounds=15, depth=4, rate=0.3, fitted=fitted, **sizes)
    lines = forecast.direct_multi_horizon(readings, **sizes)
    errors = [{r.step: r.rmse for r in metrics.forecast_metrics(d, ["step"]).collect()} for d in (boosted, lines)]
    assert errors[0][1] < 0.5 * errors[1][1] and errors[0][2] < errors[1][2]
    assert set(fitted) == {"boosted_1", "boosted_2"}
    stages = [fitted[name].stages[-1] for name in sorted(fitted)]
    assert all(1 <= model.getNumTrees <= 15 for model in stages)
    keys = ["segment_id", "timestamp", "step", "actual"]
    assert boosted.select(keys).exceptAll(lines.select(keys)).isEmpty()


def test_boosting_stops_early_on_noise(spark):
    rng = np.random.default_rng(5)
    fitted = {}
    readings = panel(spark, {"A": rng.normal(50, 5, 400)})
    forecast.boosted_multi_horizon(readings, 3, 1, rounds=30, depth=4, rate=0.3, fitted=fitted)
    assert fitted["boosted_1"].stages[-1].getNumTrees < 30


def test_products_and_solve(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(500, 4))
    rows = [(*map(float, r),) for r in x] + [(1.0, None, 2.0, 3.0), (1.0, float("nan"), 2.0, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(4)
    sums = products(df, ["a", "b", "c", "d"])
    full = np.hstack([np.ones((500, 1)), x])
    assert np.allclose(sums, full.T @ full)
    found, rest = solve(sums)
    assert np.allclose(found[:, 0], np.linalg.lstsq(full[:, :4], x[:, 3], rcond=None)[0])
    assert rest[0] == pytest.approx(((x[:, 3] - full[:, :4] @ found[:, 0]) ** 2).sum())
    assert not products(df.filter(F.lit(False)), ["a", "b"]).any()

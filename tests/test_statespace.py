"""Seasonal state-space models against a plain recursion, and what they must add up to."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparklab.operators import statespace as sp

DAY = dt.date(2020, 1, 6)


def plain_errors(y, x, level, slope, season, effects, alpha, beta, gamma, damping):
    """One-step errors by the equations, one point at a time."""
    season, out = list(season), []
    for t, v in enumerate(y):
        trend = level + damping * slope
        e = 0.0 if np.isnan(v) else v - trend - season[t % len(season)] - float(np.dot(x[t], effects))
        out.append(e)
        level, slope = trend + alpha * e, damping * slope + beta * e
        season[t % len(season)] += gamma * e
    return np.array(out)


@pytest.mark.parametrize("structure", sp.STRUCTURES)
def test_recursion_equals_equations_and_least_squares(structure):
    rng = np.random.default_rng(1)
    m, n = 4, 40
    y = rng.normal(size=(2, n)).cumsum(axis=1)
    y[0, 7] = y[1, 20:] = np.nan
    length = np.array([n, 20])
    x = (rng.random((2, n, 2)) < 0.2).astype(float)
    raw = rng.normal(size=(2, 3, 4))
    cross = sp.recursion(y, x, length, structure, m, raw)
    sse, coef = sp.solved(cross)
    for s in range(2):
        for k in range(3):
            parameters = [float(a) for a in sp.smoothing(structure, raw[s, k])]
            n_states = coef.shape[-1] - 2

            def errors(c):
                slope = c[1] if structure[0] != "none" else 0.0
                at = 1 + (structure[0] != "none")
                season = np.append(c[at : at + m - 1], -c[at : at + m - 1].sum()) if structure[1] else [0.0]
                return plain_errors(y[s, : length[s]], x[s], c[0], slope, season, c[n_states:], *parameters)

            base = errors(np.zeros(coef.shape[-1]))
            columns = np.stack([errors(u) - base for u in np.eye(coef.shape[-1])], axis=1)
            want = np.linalg.lstsq(columns, -base, rcond=None)[0]
            assert np.allclose((errors(want) ** 2).sum(), sse[s, k], rtol=1e-6)
            assert np.allclose((errors(coef[s, k]) ** 2).sum(), sse[s, k], rtol=1e-6)
            c = rng.normal(size=coef.shape[-1])
            whole = np.append(1.0, c)
            assert np.allclose(whole @ cross[s, k] @ whole, (errors(c) ** 2).sum())


def seasonal(n=120, seed=0, holiday=()):
    rng = np.random.default_rng(seed)
    season = np.array([5.0, -3, 0, 8, -6, -6, 2])
    y = 50 + 0.3 * np.arange(n) + season[np.arange(n) % 7] + rng.normal(scale=1.0, size=n)
    y[list(holiday)] += 30
    return y


@pytest.fixture(scope="module")
def fitted(spark):
    marks = [10, 45, 80]
    rows = [("season", DAY + dt.timedelta(days=k), float(v)) for k, v in enumerate(seasonal(holiday=marks))]
    rows = [(i, d, None if k in (30, 31) else v) for k, (i, d, v) in enumerate(rows)]
    rows += [("flat", DAY + dt.timedelta(days=k), float(v)) for k, v in enumerate(np.random.default_rng(2).normal(10, 1, 60))]
    rows += [("two", DAY, 1.0), ("two", DAY + dt.timedelta(days=1), 2.0), ("nan", DAY, None), ("inf", DAY, float("inf")), (None, DAY, 1.0)]
    rows += [("constant", DAY + dt.timedelta(days=k), 4.0) for k in range(30)]
    cal = spark.createDataFrame([(DAY + dt.timedelta(days=k), "feast") for k in [*marks, 122]], "ts date, holiday string")
    model = sp.fit(spark.createDataFrame(rows, "series_id string, ts date, y double"), "series_id", 7, cal).cache()
    return model, cal


def test_fit_finds_structure_and_holiday(fitted):
    model, _ = fitted
    got = {r["series_id"]: r for r in model.collect()}
    assert {k: r["status"] for k, r in got.items()} == {"season": "ok", "flat": "ok", "two": "failed", "nan": "failed", "inf": "failed", None: "failed", "constant": "ok"}
    assert got["season"]["structure"].endswith("+season") and got["season"]["holiday_effects"]["feast"] == pytest.approx(30, abs=2.5)
    assert got["flat"]["structure"] == "level" and got["flat"]["alpha"] < 0.2 and got["flat"]["level"] == pytest.approx(10, abs=0.6)
    assert got["constant"]["level"] == pytest.approx(4, abs=1e-6)
    best = {k: min(r["candidates"], key=lambda c: c["aic"]) for k, r in got.items() if r["status"] == "ok"}
    assert all(b["structure"] == got[k]["structure"] and b["aic"] == got[k]["aic"] for k, b in best.items())


def test_forecast_components_add_up_and_match_simulation(fitted, spark):
    model, cal = fitted
    rows = sp.forecast(model, "series_id", 14, "1 day", cal).collect()
    assert sum(r["status"] == "failed" for r in rows) == 4
    mine = sorted((r for r in rows if r["series_id"] == "season"), key=lambda r: r["horizon"])
    assert [r["forecast_timestamp"].date() for r in mine] == [DAY + dt.timedelta(days=120 + k) for k in range(14)]
    for r in mine:
        assert r["forecast_value"] == pytest.approx(r["trend"] + r["seasonal"] + r["holiday_effect"])
        assert (r["holiday_effect"] != 0) == (r["horizon"] == 3)
        assert r["prediction_interval_lower_bound"] < r["forecast_value"] < r["prediction_interval_upper_bound"]
    m = next(r for r in model.collect() if r["series_id"] == "season")
    # with errors of zero the equations walk through the forecasts; the variance is that of a simulation
    rng = np.random.default_rng(0)
    ends = []
    for turn in range(4001):
        level, slope, season = m["level"], m["slope"], list(m["season"])
        path = []
        for h in range(14):
            e = 0.0 if turn == 0 else rng.normal() * m["variance"] ** 0.5
            trend = level + m["damping"] * slope
            path.append(trend + season[h % 7] + e)
            level, slope = trend + m["alpha"] * e, m["damping"] * slope + m["beta"] * e
            season[h % 7] += m["gamma"] * e
        ends.append(path)
    assert np.allclose(ends[0], [r["trend"] + r["seasonal"] for r in mine])
    assert np.allclose(np.std(ends[1:], axis=0), [r["standard_error"] for r in mine], rtol=0.06)


def test_explained_rows_add_up(fitted, spark):
    model, cal = fitted
    raw = model.where("series_id = 'season'").select("series_id", F.explode("history").alias("p")).select("series_id", F.timestamp_micros("p.at").alias("ts"), (F.col("p.y") + F.when(F.timestamp_micros("p.at").cast("date") == F.lit(DAY), 9.0).otherwise(0.0)).alias("raw"))
    rows = sp.explain(model, "series_id", 5, "1 day", cal, raw).where("series_id = 'season'").collect()
    assert len(rows) == 125
    for r in rows:
        parts = r["trend"] + r["seasonal"] + r["holiday_effect"]
        if r["time_series_type"] == "forecast":
            assert r["residual"] is None and r["spikes_and_dips"] is None and r["time_series_data"] == pytest.approx(parts)
        elif r["time_series_data"] is not None:
            assert r["time_series_data"] == pytest.approx(parts + r["spikes_and_dips"] + r["residual"])
    assert [r["spikes_and_dips"] for r in rows if r["spikes_and_dips"]] == [9.0]


def test_forecast_beats_seasonal_naive(spark):
    """On a fixture with trend, season and noise, over eight origins."""
    rows, last = [], {}
    for k in range(8):
        y = seasonal(154, seed=10 + k)
        rows += [(f"s{k}", DAY + dt.timedelta(days=t), float(v)) for t, v in enumerate(y[:140])]
        last[f"s{k}"] = y
    model = sp.fit(spark.createDataFrame(rows, "series_id string, ts date, y double"), "series_id", 7)
    own, naive = [], []
    for r in sp.forecast(model, "series_id", 14).collect():
        y = last[r["series_id"]]
        own.append(abs(r["forecast_value"] - y[139 + r["horizon"]]))
        naive.append(abs(y[133 + (r["horizon"] - 1) % 7] - y[139 + r["horizon"]]))
    assert len(own) == 8 * 14 and np.mean(own) < 0.7 * np.mean(naive)


def test_anomalies_of_the_model(spark):
    y = seasonal(140, seed=3)
    y[100] += 25
    model = sp.fit(spark.createDataFrame([("s", DAY + dt.timedelta(days=t), float(v)) for t, v in enumerate(y)], "series_id string, ts date, y double"), "series_id", 7)
    found = sp.anomalies(model, "series_id", 0.999).collect()
    assert len(found) == 140 and {r["ts"].date() for r in found if r["is_anomaly"]} == {DAY + dt.timedelta(days=100)}
    assert all((r["anomaly_probability"] > 0.999) == r["is_anomaly"] for r in found)


def test_monthly_steps(spark):
    months = [dt.date(2018 + k // 12, 1 + k % 12, 1) for k in range(48)]
    model = sp.fit(spark.createDataFrame([("s", d, 100.0 + 10 * (d.month == 12) + k) for k, d in enumerate(months)], "series_id string, ts date, y double"), "series_id", 12)
    got = sorted(sp.forecast(model, "series_id", 14, "1 month").collect(), key=lambda r: r["horizon"])
    assert [r["forecast_timestamp"].date() for r in got] == [dt.date(2022 + k // 12, 1 + k % 12, 1) for k in range(14)]
    assert got[11]["forecast_value"] == pytest.approx(100 + 10 + 59, abs=1)

"""Seasonal state-space forecasting: one model per series, many series per Arrow batch.

A series is explained by a level, an optional (damped) slope, an optional season and the effects of named holidays, in
innovations form (e is the one-step error):

    y[t]     = level[t-1] + damping * slope[t-1] + season[t-m] + holidays[t] + e[t]
    level[t] = level[t-1] + damping * slope[t-1] + alpha * e[t]
    slope[t] = damping * slope[t-1] + beta * e[t]
    season[t] = season[t-m] + gamma * e[t]

The errors are linear in the first states and the holiday effects, so those are solved exactly, by least squares, for any
smoothing parameters: the recursion runs over the observations, over each unit first state and over each holiday, side
by side for all series and parameter sets of a batch, and only the cross products of their errors are kept.  The
smoothing parameters are searched on a coarse grid, then by steps that halve.  Structures (slope: none, yes, damped;
season: none, yes) are compared by AIC of the concentrated likelihood; all of them stay in the model row.

``fit`` gives one row per series, a table that can be stored; ``forecast``, ``explain``, ``evaluate`` and ``anomalies``
are column expressions over it, without Python.  The points of a series meet in one row: a series is as long as its
time grid.  Missing observations move the states on without correcting them.  A series that cannot be fitted is a row
with ``status`` 'failed'.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Points of a series at least, and seasons that a seasonal structure needs.
MIN_POINTS, MIN_SEASONS = 3, 2
#: First values of the search: level, slope (a share of the level's), season (a share of the rest) and damping.
GRID = {"alpha": (0.05, 0.2, 0.5, 0.8), "beta": (0.02, 0.2), "gamma": (0.02, 0.15), "damping": (0.9,)}
#: Rounds of the search after the grid; its step, in units of the logit, halves in each.
ROUNDS, STEP = 5, 1.2
#: Numbers that the recursion of a group of series keeps at most.
GROUP = 1 << 21
STRUCTURES = [(slope, season) for season in (False, True) for slope in ("none", "slope", "damped")]

MODEL = """status string, message string, n_points int, n_observed int, structure string, season_length int, alpha double, beta double, gamma double, damping double,
    log_likelihood double, aic double, variance double, level double, slope double, season array<double>, holiday_effects map<string, double>,
    candidates array<struct<structure: string, n_parameters: int, log_likelihood: double, aic: double, variance: double>>,
    history array<struct<at: long, y: double, trend: double, seasonal: double, holiday: double>>"""


def smoothing(structure: tuple[str, bool], raw: np.ndarray) -> tuple[np.ndarray, ...]:
    """alpha, beta, gamma and damping from the logits searched (last axis: the four)."""
    x = 1 / (1 + np.exp(-raw))
    slope, season = structure
    alpha = x[..., 0]
    return alpha, alpha * x[..., 1] if slope != "none" else 0 * alpha, (1 - alpha) * x[..., 2] if season else 0 * alpha, 0.7 + 0.29 * x[..., 3] if slope == "damped" else 0 * alpha + 1


def recursion(y: np.ndarray, x: np.ndarray, length: np.ndarray, structure: tuple[str, bool], m: int, raw: np.ndarray) -> np.ndarray:
    """Cross products (series x sets x columns x columns) of the errors of the observations (first column), of the unit
    first states and of the holidays.  ``y``: series x time, missing as NaN; ``x``: series x time x holidays."""
    alpha, beta, gamma, damping = (a[:, :, None] for a in smoothing(structure, raw))
    n_states = 1 + (structure[0] != "none") + (m - 1 if structure[1] else 0)
    s, k = raw.shape[:2]
    p = 1 + n_states + x.shape[2]
    level, slope = np.zeros((s, k, p)), np.zeros((s, k, p))
    level[:, :, 1] = 1
    at = 2
    if structure[0] != "none":
        slope[:, :, at] = 1
        at += 1
    season = np.zeros((m if structure[1] else 1, s, k, p))
    if structure[1]:  # the first season sums to zero
        for j in range(m - 1):
            season[j, :, :, at + j], season[m - 1, :, :, at + j] = 1, -1
    out = np.zeros((s, k, p, p))
    seen = np.zeros((s, 1, p))
    for t in range(y.shape[1]):
        alive = (t < length)[:, None, None]
        known = ~np.isnan(y[:, t])[:, None, None] & alive
        seen[:, 0, 0] = y[:, t]
        seen[:, 0, 1 + n_states :] = -x[:, t]
        phase = t % len(season)
        trend = level + damping * slope
        e = np.where(known, seen - trend - season[phase], 0.0)
        out += e[..., :, None] * e[..., None, :]
        level = np.where(alive, trend + alpha * e, level)
        slope = np.where(alive, damping * slope + beta * e, slope)
        season[phase] += gamma * e
    return out


def solved(cross: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least sum of squared errors, and the first states and holiday effects that give it."""
    a, b = cross[..., 1:, 1:], cross[..., 1:, :1]
    scale = np.sqrt(np.maximum(np.diagonal(a, axis1=-2, axis2=-1), 1e-300))
    coef = -(np.linalg.pinv(a / scale[..., :, None] / scale[..., None, :], rcond=1e-10, hermitian=True) @ (b / scale[..., :, None]))[..., 0] / scale
    return np.maximum(cross[..., 0, 0] + (b[..., 0] * coef).sum(-1), 0.0), coef


def search(y: np.ndarray, x: np.ndarray, length: np.ndarray, structure: tuple[str, bool], m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per series: the best parameters (logits), their sum of squared errors, and the first states and effects."""
    slope, season = structure
    free = [0, *([1] if slope != "none" else []), *([2] if season else []), *([3] if slope == "damped" else [])]
    grid = np.zeros((1, 4))
    for j, values in enumerate(GRID.values()):
        if j in free:
            v = np.array(values)
            v = (v - 0.7) / 0.29 if j == 3 else v
            grid = np.concatenate([np.concatenate([grid[:, :j], np.full((len(grid), 1), np.log(u / (1 - u))), grid[:, j + 1 :]], axis=1) for u in v])
    raw = np.repeat(grid[None], len(y), axis=0)
    best, least, states = None, np.full(len(y), np.inf), None
    rows = np.arange(len(y))
    for turn in range(ROUNDS + 1):
        sse, coef = solved(recursion(y, x, length, structure, m, raw))
        k = sse.argmin(axis=1)
        better = sse[rows, k] < least
        if best is None:
            best, states = raw[rows, k].copy(), coef[rows, k].copy()
        else:
            best[better], states[better] = raw[rows, k][better], coef[rows, k][better]
        least = np.minimum(least, sse[rows, k])
        step = STEP / 2**turn
        moves = np.zeros((2 * len(free), 4))
        for i, j in enumerate(free):
            moves[2 * i, j], moves[2 * i + 1, j] = step, -step
        raw = np.clip(best[:, None] + moves[None], -7, 7)
    return best, least, states


def components(y: np.ndarray, x: np.ndarray, structure: tuple[str, bool], m: int, raw: np.ndarray, states: np.ndarray):
    """Of one series: trend, season and holiday part of every one-step prediction, and the last level, slope and season
    (that of the next time first)."""
    alpha, beta, gamma, damping = (float(a) for a in smoothing(structure, raw))
    level, at = states[0], 1
    slope = 0.0
    if structure[0] != "none":
        slope, at = states[1], 2
    season = np.zeros(1)
    if structure[1]:
        season = np.append(states[at : at + m - 1], -states[at : at + m - 1].sum())
        at += m - 1
    effects = states[at:]
    out = np.zeros((len(y), 3))
    for t in range(len(y)):
        phase = t % len(season)
        out[t] = trend, _, _ = level + damping * slope, season[phase], x[t] @ effects
        e = 0.0 if np.isnan(y[t]) else y[t] - out[t].sum()
        level, slope = trend + alpha * e, damping * slope + beta * e
        season[phase] += gamma * e
    return out, level, slope, np.roll(season, -(len(y) % len(season))), effects


def _fit_group(series: list[tuple[np.ndarray, np.ndarray, np.ndarray]], m: int, names: list[str]) -> list[dict]:
    """Model rows of series (time, observations, holidays) of at least MIN_POINTS observations."""
    length = np.array([len(y) for _, y, _ in series])
    size = int(length.max())
    center = np.array([np.nanmean(y) for _, y, _ in series])
    spread = np.array([max(np.nanstd(y), 1e-9 * max(abs(c), 1.0)) for (_, y, _), c in zip(series, center)])
    y = np.full((len(series), size), np.nan)
    x = np.zeros((len(series), size, len(names)))
    for k, (_, own, h) in enumerate(series):
        y[k, : len(own)], x[k, : len(own)] = (own - center[k]) / spread[k], h
    n = (~np.isnan(y)).sum(axis=1)
    tried = []
    for structure in STRUCTURES:
        fits = search(y, x, length, structure, m) if not structure[1] or (m > 1 and (length >= MIN_SEASONS * m).any()) else None
        tried.append((structure, fits))
    out = []
    for k, (at, own, h) in enumerate(series):
        rows = []
        for structure, fits in tried:
            states = 1 + (structure[0] != "none") + (m - 1 if structure[1] else 0) + int((h.any(axis=0)).sum())
            count = 1 + (structure[0] != "none") + structure[1] + (structure[0] == "damped") + states + 1
            if fits is None or (structure[1] and length[k] < MIN_SEASONS * m) or n[k] <= states + 1:
                continue
            variance = max(fits[1][k] / n[k], 1e-12)
            likelihood = -0.5 * n[k] * (np.log(2 * np.pi * variance) + 1) - n[k] * np.log(spread[k])
            rows.append((2 * count - 2 * likelihood, structure, count, likelihood, variance * spread[k] ** 2, fits[0][k], fits[2][k]))
        if not rows:
            out.append({"status": "failed", "message": f"{n[k]} observations are too few for the simplest structure", "n_points": int(length[k]), "n_observed": int(n[k])})
            continue
        aic, structure, _, likelihood, variance, raw, states = min(rows, key=lambda r: r[0])
        parts, level, slope, season, effects = components(y[k, : length[k]], x[k, : length[k]], structure, m, raw, states)
        parts = parts * spread[k]
        parts[:, 0] += center[k]
        name = lambda s: {"none": "level", "slope": "level+slope", "damped": "level+damped slope"}[s[0]] + ("+season" if s[1] else "")
        alpha, beta, gamma, damping = (float(a) for a in smoothing(structure, raw))
        out.append({
            "status": "ok", "message": "", "n_points": int(length[k]), "n_observed": int(n[k]), "structure": name(structure), "season_length": m if structure[1] else 1,
            "alpha": alpha, "beta": beta, "gamma": gamma, "damping": damping, "log_likelihood": float(likelihood), "aic": float(aic), "variance": float(variance),
            "level": float(level * spread[k] + center[k]), "slope": float(slope * spread[k]), "season": (season * spread[k]).tolist(),
            "holiday_effects": [(c, float(e * spread[k])) for c, e in zip(names, effects)],
            "candidates": [{"structure": name(r[1]), "n_parameters": r[2], "log_likelihood": float(r[3]), "aic": float(r[0]), "variance": float(r[4])} for r in rows],
            "history": [{"at": int(a), "y": None if np.isnan(v) else float(v), "trend": float(p[0]), "seasonal": float(p[1]), "holiday": float(p[2])} for a, v, p in zip(at, own, parts)],
        })
    return out


def fit(df: DataFrame, id_col: str, season: int = 7, holidays: DataFrame | None = None, ts: str = "ts", value: str = "y", min_points: int = MIN_POINTS) -> DataFrame:
    """One model row per series (``MODEL`` beside ``id_col``) of a regular series (``ts``: date or timestamp).

    ``holidays`` (ts, holiday) is a calendar; each of its names is an effect, estimated where the history holds it."""
    names = [] if holidays is None else sorted(r[0] for r in holidays.select("holiday").distinct().collect())  # the names of a calendar
    point = df.select(F.col(id_col).cast("string").alias("id"), F.col(ts).alias("ts"), F.unix_micros(F.col(ts).cast("timestamp")).alias("at"), F.col(value).cast("double").alias("y"))
    if names:
        days = holidays.groupBy("ts").agg(F.collect_set("holiday").alias("names"))
        point = point.join(F.broadcast(days), "ts", "left")  # a calendar: one row per holiday
    else:
        point = point.withColumn("names", F.lit(None).cast("array<string>"))
    marks = F.array(*(F.coalesce(F.array_contains("names", n), F.lit(False)).cast("double") for n in names)).cast("array<double>")
    listed = point.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("at", "y", marks.alias("x")))).alias("points"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            series, rows = [], [None] * b.num_rows
            for points in b.column("points").to_pylist():
                y = np.array([np.nan if p["y"] is None else p["y"] for p in points], float)
                series.append((np.array([p["at"] for p in points], np.int64), y, np.array([p["x"] for p in points], float).reshape(len(points), len(names))))
            ready = []
            for k, (_, y, _) in enumerate(series):
                if np.isfinite(y).sum() < min_points or np.isinf(y).any():
                    rows[k] = {"status": "failed", "message": f"needs at least {min_points} finite observations, got {int(np.isfinite(y).sum())}", "n_points": len(y), "n_observed": int((~np.isnan(y)).sum())}
                else:
                    ready.append(k)
            ready.sort(key=lambda k: len(series[k][1]))  # series of like lengths go together
            width = (season + 3 + len(names)) ** 2 * 16
            step = max(1, GROUP // width)
            for a in range(0, len(ready), step):
                for k, row in zip(ready[a : a + step], _fit_group([series[i] for i in ready[a : a + step]], season, names)):
                    rows[k] = row
            yield pa.RecordBatch.from_pylist([{"id": i, **r} for i, r in zip(b.column("id").to_pylist(), rows)], schema=kind)

    kind = _arrow()
    return listed.mapInArrow(run, f"id string, {MODEL}").withColumnRenamed("id", id_col)


def _arrow() -> pa.Schema:
    f, i, s = pa.float64(), pa.int32(), pa.string()
    each = pa.struct([("structure", s), ("n_parameters", i), ("log_likelihood", f), ("aic", f), ("variance", f)])
    point = pa.struct([("at", pa.int64()), ("y", f), ("trend", f), ("seasonal", f), ("holiday", f)])
    return pa.schema([("id", s), ("status", s), ("message", s), ("n_points", i), ("n_observed", i), ("structure", s), ("season_length", i), *((c, f) for c in ("alpha", "beta", "gamma", "damping", "log_likelihood", "aic", "variance", "level", "slope")), ("season", pa.list_(f)), ("holiday_effects", pa.map_(s, f)), ("candidates", pa.list_(each)), ("history", pa.list_(point))])


def evaluate(model: DataFrame, id_col: str) -> DataFrame:
    """Every structure tried for each series with its likelihood, AIC and error variance; ``chosen`` marks the lowest
    AIC.  Failed series are one row with their message."""
    ok = model.select(id_col, "status", "message", "n_observed", F.col("structure").alias("best"), F.explode_outer("candidates").alias("c"))
    return ok.select(id_col, F.col("c.structure").alias("structure"), "c.n_parameters", "c.log_likelihood", "c.aic", "c.variance", F.coalesce(F.col("c.structure") == F.col("best"), F.lit(False)).alias("chosen"), "n_observed", "status", "message")


def _ahead(h: Column) -> tuple[Column, Column]:
    """Sum of the damped slopes up to ``h`` steps, and the variance of the error at ``h`` in units of one step's."""
    d = F.col("damping")
    run = lambda j: F.when(d == 1, j).otherwise(d * (1 - F.pow(d, j)) / (1 - d))
    weight = lambda j: F.col("alpha") + F.col("beta") * run(j) + F.when(j % F.col("season_length") == 0, F.col("gamma")).otherwise(0.0)
    past = F.when(h > 1, F.sequence(F.lit(1), h - 1)).otherwise(F.array().cast("array<int>"))
    return run(h), 1 + F.aggregate(past, F.lit(0.0), lambda total, j: total + F.pow(weight(j), F.lit(2)))


def forecast(model: DataFrame, id_col: str, horizon: int, step: str = "1 day", holidays: DataFrame | None = None, level: float = 0.95) -> DataFrame:
    """``horizon`` rows per fitted series: forecast_timestamp, horizon, forecast_value, trend, seasonal, holiday_effect
    (which add up to it), standard_error and the bounds of a ``level`` interval; failed series are one row each.

    ``step`` is the interval of the series' grid, ``holidays`` the calendar of the fit with its future days."""
    z = NormalDist().inv_cdf(0.5 + level / 2)
    last = F.element_at("history", -1)["at"]
    rows = model.withColumn("h", F.explode(F.when(F.col("status") == "ok", F.sequence(F.lit(1), F.lit(horizon))).otherwise(F.array(F.lit(None).cast("int")))))
    rows = rows.withColumn("forecast_timestamp", F.timestamp_micros(last) + F.col("h") * F.expr(f"INTERVAL {step}")) if not _months(step) else rows.withColumn("forecast_timestamp", F.add_months(F.timestamp_micros(last).cast("date"), F.col("h") * _months(step)).cast("timestamp"))
    steps, variance = _ahead(F.col("h"))
    trend = F.col("level") + F.col("slope") * steps
    seasonal = F.element_at("season", F.col("h") % F.when(F.col("h").isNotNull(), F.col("season_length")) + F.when(F.col("h") % F.col("season_length") == 0, F.col("season_length")).otherwise(0))
    effect = F.lit(0.0)
    if holidays is not None:
        days = holidays.groupBy(F.col("ts").cast("timestamp").alias("forecast_timestamp")).agg(F.collect_set("holiday").alias("names"))
        rows = rows.join(F.broadcast(days), "forecast_timestamp", "left")
        effect = F.aggregate(F.coalesce("names", F.array().cast("array<string>")), F.lit(0.0), lambda total, n: total + F.coalesce(F.element_at("holiday_effects", n), F.lit(0.0)))
    rows = rows.withColumns({"trend": trend, "seasonal": seasonal, "holiday_effect": F.when(F.col("h").isNotNull(), effect), "standard_error": F.when(F.col("h").isNotNull(), F.sqrt(F.col("variance") * variance))})
    value = F.col("trend") + F.col("seasonal") + F.col("holiday_effect")
    rows = rows.withColumn("forecast_value", value)
    return rows.select(
        id_col, "forecast_timestamp", F.col("h").alias("horizon"), "forecast_value", "trend", "seasonal", "holiday_effect", "standard_error", F.lit(level).alias("confidence_level"),
        (F.col("forecast_value") - z * F.col("standard_error")).alias("prediction_interval_lower_bound"), (F.col("forecast_value") + z * F.col("standard_error")).alias("prediction_interval_upper_bound"), "status", "message")


def _months(step: str) -> int:
    """Months of a step of calendar months, quarters or years; 0 for others."""
    n, unit = step.split()
    return int(n) * {"month": 1, "quarter": 3, "year": 12}.get(unit.rstrip("s"), 0)


def history(model: DataFrame, id_col: str, level: float = 0.95) -> DataFrame:
    """The fitted points: time, y, trend, seasonal, holiday_effect, residual and the bounds of the one-step prediction."""
    z = NormalDist().inv_cdf(0.5 + level / 2)
    p = model.where("status = 'ok'").select(id_col, "variance", F.explode("history").alias("p"))
    value = F.col("p.trend") + F.col("p.seasonal") + F.col("p.holiday")
    return p.select(id_col, F.timestamp_micros("p.at").alias("ts"), F.col("p.y").alias("y"), F.col("p.trend").alias("trend"), F.col("p.seasonal").alias("seasonal"), F.col("p.holiday").alias("holiday_effect"), (F.col("p.y") - value).alias("residual"), value.alias("fitted"), (value - z * F.sqrt("variance")).alias("lower_bound"), (value + z * F.sqrt("variance")).alias("upper_bound"))


def explain(model: DataFrame, id_col: str, horizon: int, step: str = "1 day", holidays: DataFrame | None = None, spikes: DataFrame | None = None, level: float = 0.95) -> DataFrame:
    """History and forecast rows with their components.

    In the history time_series_data = trend + seasonal + holiday_effect + spikes_and_dips + residual; in the forecast
    trend + seasonal + holiday_effect, and spikes and residual are null.  ``spikes`` (id, ts, raw) has the series before
    spikes were replaced."""
    h = history(model, id_col, level)
    if spikes is None:
        h = h.withColumn("raw", F.col("y"))
    else:
        h = h.join(spikes.select(F.col(id_col).cast("string").alias(id_col), F.col("ts").cast("timestamp").alias("ts"), "raw"), [id_col, "ts"], "left")
    part = ["trend", "seasonal", "holiday_effect"]
    past = h.select(id_col, F.col("ts").alias("time_series_timestamp"), F.lit("history").alias("time_series_type"), F.col("raw").alias("time_series_data"), F.col("y").alias("time_series_adjusted_data"), *part, (F.col("raw") - F.col("y")).alias("spikes_and_dips"), "residual", F.lit(None).cast("double").alias("standard_error"))
    f = forecast(model, id_col, horizon, step, holidays, level).where("status = 'ok'")
    none = F.lit(None).cast("double")
    return past.unionByName(f.select(id_col, F.col("forecast_timestamp").alias("time_series_timestamp"), F.lit("forecast").alias("time_series_type"), F.col("forecast_value").alias("time_series_data"), F.col("forecast_value").alias("time_series_adjusted_data"), *part, none.alias("spikes_and_dips"), none.alias("residual"), "standard_error"))


def anomalies(model: DataFrame, id_col: str, probability: float = 0.95) -> DataFrame:
    """Every fitted point with its bounds, the probability of a smaller error, and whether that passes ``probability``."""
    h = history(model, id_col, probability)
    z = (F.col("upper_bound") - F.col("fitted")) / NormalDist().inv_cdf(0.5 + probability / 2)
    inside = _erf(F.abs(F.col("residual") / z) / F.sqrt(F.lit(2.0)))
    return h.select(id_col, "ts", "y", "lower_bound", "upper_bound", inside.alias("anomaly_probability"), ((F.col("y") < F.col("lower_bound")) | (F.col("y") > F.col("upper_bound"))).alias("is_anomaly"))


def _erf(x: Column) -> Column:
    """Error function of a number from 0 on, to 1.5e-7 (a rational approximation; its five coefficients are fixed values)."""
    t = 1 / (1 + 0.3275911 * x)
    poly = F.lit(0.0)
    for c in (1.061405429, -1.453152027, 1.421413741, -0.284496736, 0.254829592):
        poly = (poly + c) * t
    return 1 - poly * F.exp(-x * x)

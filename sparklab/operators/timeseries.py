"""Time series preparation, decomposition, forecasting and evaluation.

Data stay long: (ids..., ts, value).  Preparation and decomposition are
window functions partitioned by the series ids over *aggregated* points (one
per timestamp), so a group is bounded by the length of the time grid, never by
raw event volume.  Model fitting runs per series in ``applyInPandas`` with
NumPy only (AR(p) by least squares, order chosen by AIC); a series that cannot
be fitted yields a status row — failures are rows, never absent series.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklab.operators import ranking


def _w(ids, order="ts"):
    return Window.partitionBy(*ids).orderBy(order)


def infer_frequency(df: DataFrame, ids: list[str], ts: str) -> DataFrame:
    """Step 1: the most common gap between consecutive distinct timestamps
    (ties -> the smaller gap), in seconds and days."""
    from sparklab.streaming.events import distributed_lag
    # raw timestamps (not yet a daily grid): a busy series can be huge, so the
    # lag is computed on range slices instead of one window per series
    # seconds since a fixed wall-clock origin: independent of the session time zone
    d = df.select(*ids, F.col(ts).cast("timestamp_ntz").alias("ts")).distinct().withColumn(
        "_sec", F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"))
    d = distributed_lag(d, ids, ["ts"], "_sec", "_prev").withColumn("_gap", F.col("_sec") - F.col("_prev"))
    g = d.where(F.col("_gap").isNotNull()).groupBy(*ids, "_gap").agg(F.count(F.lit(1)).alias("_n"))
    best = g.groupBy(*ids).agg(F.max_by("_gap", F.struct(F.col("_n"), -F.col("_gap"))).alias("step_seconds"))
    pts = d.groupBy(*ids).agg(F.count(F.lit(1)).alias("n_points"))
    return pts.join(best, ids, "left").withColumn("step_days", (F.col("step_seconds") / 86400).cast("int"))


def regularize(df: DataFrame, ids: list[str], ts: str, value: str, fill: str = "linear") -> DataFrame:
    """Steps 2-4: daily grid from first to last point, duplicate timestamps
    averaged, gaps filled by linear interpolation (``fill='zero'`` for counts)."""
    pts = df.groupBy(*ids, F.to_date(F.col(ts)).alias("ts")).agg(F.avg(value).alias("y"))
    rng = pts.groupBy(*ids).agg(F.min("ts").alias("_lo"), F.max("ts").alias("_hi"))
    grid = rng.select(*ids, F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY"))).alias("ts"))
    g = grid.join(pts, [*ids, "ts"], "left")
    if fill == "zero":
        return g.withColumn("is_filled", F.col("y").isNull()).withColumn("y", F.coalesce("y", F.lit(0.0)))
    w_prev = _w(ids).rowsBetween(Window.unboundedPreceding, 0)
    w_next = _w(ids).rowsBetween(0, Window.unboundedFollowing)
    known_t = F.when(F.col("y").isNotNull(), F.datediff("ts", F.lit("1970-01-01")))
    g = (g.withColumn("_py", F.last("y", ignorenulls=True).over(w_prev))
          .withColumn("_pt", F.last(known_t, ignorenulls=True).over(w_prev))
          .withColumn("_ny", F.first("y", ignorenulls=True).over(w_next))
          .withColumn("_nt", F.first(known_t, ignorenulls=True).over(w_next)))
    t = F.datediff("ts", F.lit("1970-01-01"))
    interp = F.col("_py") + (F.col("_ny") - F.col("_py")) * (t - F.col("_pt")) / (F.col("_nt") - F.col("_pt"))
    return (g.withColumn("is_filled", F.col("y").isNull())
             .withColumn("y", F.coalesce(F.col("y"), interp)).drop("_py", "_pt", "_ny", "_nt"))


#: Steps a grid can have, with the shortest usual gap (seconds) that tells each: months have 28 to 31 days.
STEPS = (("year", 360 * 86400), ("quarter", 89 * 86400), ("month", 28 * 86400), ("week", 7 * 86400), ("day", 86400),
         ("hour", 3600), ("minute", 0))


def step_of(gap_seconds):
    """Name of the grid step for the most common gap of a series."""
    out = F.when(F.col(gap_seconds) >= STEPS[0][1], STEPS[0][0])
    for name, least in STEPS[1:]:
        out = out.when(F.col(gap_seconds) >= least, name)
    return out


def _step_interval(step):
    """The step as an interval; months, quarters and years follow the calendar."""
    n = lambda name, k: F.when(step == name, k).otherwise(0)
    months = F.when(step == "month", 1).when(step == "quarter", 3).otherwise(0)
    return F.make_interval(n("year", 1), months, n("week", 1), n("day", 1), n("hour", 1), n("minute", 1), F.lit(0))


def calendar_grid(df: DataFrame, ids: list[str], ts: str, value: str, step: str = "auto", fill: str = "linear") -> DataFrame:
    """Steps 1-4 at any frequency: one row per step of the calendar from the first to the last point of a series.

    ``step`` is a name of ``STEPS``, or 'auto': each series gets that of its most common gap (a series of one point the
    day).  Points of one step are averaged; gaps are filled by linear interpolation in time, with ``fill='zero'`` by 0.
    Returns ids, ts (timestamp_ntz, the beginning of the step; weeks begin on Monday), step, is_filled and y."""
    src = df.select(*ids, F.col(ts).cast("timestamp_ntz").alias("ts"), F.col(value).cast("double").alias("y")).where("ts IS NOT NULL")
    if step == "auto":
        found = infer_frequency(src, ids, "ts").select(*[F.col(c).alias(f"_id{k}") for k, c in enumerate(ids)],
                                                       F.coalesce(step_of("step_seconds"), F.lit("day")).alias("step"))
        same = [F.col(c).eqNullSafe(F.col(f"_id{k}")) for k, c in enumerate(ids)]
        on = same[0]
        for c in same[1:]:
            on = on & c
        src = src.join(found, on).select(*ids, "ts", "y", "step")
    elif step in dict(STEPS):
        src = src.withColumn("step", F.lit(step))
    else:
        raise ValueError(f"step must be 'auto' or one of {[n for n, _ in STEPS]}")
    pts = src.groupBy(*ids, "step", F.expr("date_trunc(step, ts)").cast("timestamp_ntz").alias("ts")).agg(F.avg("y").alias("y"))
    # the points and the empty steps between two of them: no join, and no series is gathered whole before its grid
    w = _w(ids)
    nxt = pts.withColumn("_nt", F.lead("ts").over(w)).withColumn("_ny", F.lead("y").over(w))
    gap = F.sequence(F.col("ts"), F.coalesce("_nt", "ts"), _step_interval(F.col("step")))
    rows = nxt.select(*ids, "step", F.col("ts").alias("_t"), F.col("y").alias("_y"), "_nt", "_ny", F.explode(gap).alias("ts")).where(
        F.col("_nt").isNull() | (F.col("ts") < F.col("_nt")))
    sec = lambda a, b: F.expr(f"timestampdiff(SECOND, {a}, {b})")
    first = F.col("ts") == F.col("_t")
    between = F.col("_y") + (F.col("_ny") - F.col("_y")) * sec("_t", "ts") / sec("_t", "_nt")
    y = F.when(first, F.col("_y")).otherwise(F.lit(0.0) if fill == "zero" else between)
    return rows.select(*ids, "ts", "step", (~first | F.col("_y").isNull()).alias("is_filled"), y.alias("y"))


def _segment(y: np.ndarray, penalty: float, shortest: int) -> list[int]:
    """Starts of the segments of the cheapest partition: squared distances to the segment means plus ``penalty`` for each
    cut.  A start that is dearer by more than the penalty at some point can never be the last cut later (pruning)."""
    n = len(y)
    one, two = (np.concatenate([[0.0], np.cumsum(v)]) for v in (y, y * y))
    best = np.full(n + 1, np.inf)
    best[0] = -penalty
    last = np.zeros(n + 1, np.int64)
    until = np.full(n + 1, n + 1)  # from there on a start is no longer tried
    starts = np.zeros(1, np.int64)
    for t in range(shortest, n + 1):
        if t - shortest >= shortest:
            starts = np.append(starts, t - shortest)
        starts = starts[until[starts] > t]
        cost = best[starts] + (two[t] - two[starts]) - (one[t] - one[starts]) ** 2 / (t - starts)
        k = int(cost.argmin())
        best[t], last[t] = cost[k] + penalty, starts[k]
        # t itself can only be a last cut from t + shortest on
        worse = starts[cost > best[t]]
        until[worse] = np.minimum(until[worse], t + shortest)
    out, t = [], n
    while t > 0:
        t = int(last[t])
        out.append(t)
    return out[::-1]


def optimal_segments(df: DataFrame, ids: list[str], ts: str = "ts", value: str = "y", penalty: float = 3.0,
                     shortest: int = 2) -> DataFrame:
    """Change points by penalised optimal segmentation: of all partitions of a series into stretches of at least
    ``shortest`` points the one with the least sum of squared distances to the stretch means plus
    ``penalty`` * variance * ln(n) for each cut.  The variance is the square of median(|first difference|) / 0.954
    (0.6745 * sqrt(2)), which the cuts themselves hardly move; a series without any spread is one segment.

    A dynamic programme with pruning per series (its points meet in one task, as long as the series), several series per
    Arrow batch.  Rows: ids, segment (from 0), first_at and last_at (``ts``), n, mean, shift (from the segment before,
    NULL in the first), cost (squared distances).  NULL values are left out; a series of fewer than 2 * ``shortest``
    points is one segment, one without values has no row."""
    pts = df.where(F.col(value).isNotNull()).groupBy(*ids).agg(F.sort_array(F.collect_list(
        F.struct(F.col(ts).alias("t"), F.col(value).cast("double").alias("v")))).alias("_p"))
    cols = [f"_id{k}" for k in range(len(ids))]
    src = pts.select(F.struct(*[F.col(c).alias(k) for c, k in zip(ids, cols)]).alias("_ids"), F.col("_p.v").alias("_v"),
                     F.col("_p.t").alias("_t"))
    kind = T.StructType([*src.schema.fields, T.StructField("starts", T.ArrayType(T.IntegerType()))])

    def run(batches):
        for b in batches:
            found = []
            for v in b.column("_v").to_pylist():
                y = np.array(v, float)
                d = np.median(np.abs(np.diff(y))) / 0.954 if len(y) > 1 else 0.0
                ok = len(y) >= 2 * shortest and d > 0 and np.isfinite(y).all()
                found.append(_segment(y - y.mean(), penalty * d * d * np.log(len(y)), shortest) if ok else [0])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.list_(pa.int32()))], names=kind.names)

    done = src.mapInArrow(run, kind)
    ends = F.concat(F.slice("starts", 2, F.size("starts")), F.array(F.size("_v")))
    parts = done.select("*", F.posexplode(F.arrays_zip(F.col("starts").alias("a"), ends.alias("b"))).alias("segment", "_s"))
    # sums over the slice of a segment: the means come from the data, not from the search
    own = F.slice("_v", F.col("_s.a") + 1, F.col("_s.b") - F.col("_s.a"))
    total = lambda x, f: F.aggregate(x, F.lit(0.0), lambda acc, v: acc + f(v))
    parts = parts.select(*[F.col(f"_ids.{k}").alias(c) for c, k in zip(ids, cols)], "segment", F.element_at("_t", F.col("_s.a") + 1).alias("first_at"),
                         F.element_at("_t", F.col("_s.b")).alias("last_at"), own.alias("_own"))
    parts = parts.withColumn("n", F.size("_own")).withColumn("mean", total("_own", lambda v: v) / F.col("n"))
    parts = parts.withColumn("cost", total("_own", lambda v: (v - F.col("mean")) * (v - F.col("mean"))))
    return parts.withColumn("shift", F.col("mean") - F.lag("mean").over(Window.partitionBy(*ids).orderBy("segment"))).select(
        *ids, "segment", "first_at", "last_at", "n", "mean", "shift", "cost")


def _array_median(arr):
    """Interpolated median of a small numeric array (NULLs dropped)."""
    s = F.array_sort(F.filter(arr, lambda x: x.isNotNull()))
    n = F.size(s)
    lo = F.element_at(s, F.floor((n + 1) / 2).cast("int"))
    hi = F.element_at(s, F.floor(n / 2).cast("int") + 1)
    return F.when(n == 0, F.lit(None)).otherwise((lo + hi) / 2)


def clean_spikes(df: DataFrame, ids: list[str], half_window: int = 3, k: float = 5.0) -> DataFrame:
    """Step 5: a point is a spike/dip when its distance to the centred rolling
    median exceeds ``k`` times the rolling median absolute deviation; it is
    replaced by the rolling median."""
    w = _w(ids).rowsBetween(-half_window, half_window)
    # Spark has no median over a sliding frame: collect the (at most 2h+1) frame
    # values and take the middle of the sorted array.
    d = df.withColumn("_med", _array_median(F.collect_list("y").over(w)))
    d = d.withColumn("_dev", F.abs(F.col("y") - F.col("_med")))
    d = d.withColumn("_mad", _array_median(F.collect_list("_dev").over(w)))
    spike = (F.col("_mad") > 0) & (F.col("_dev") > k * F.col("_mad"))
    return (d.withColumn("is_spike", spike).withColumn("y_clean", F.when(spike, F.col("_med")).otherwise(F.col("y")))
             .drop("_med", "_dev", "_mad"))


def decompose(df: DataFrame, ids: list[str], period: int = 7) -> DataFrame:
    """Step 8: trend = centred moving average over ``period`` points (NULL where
    the window is incomplete); seasonal = mean detrended value per phase
    (day of week), centred to sum to zero; residual = y - trend - seasonal."""
    h = period // 2
    w = _w(ids).rowsBetween(-h, h)
    d = df.withColumn("_cnt", F.count("y").over(w)).withColumn(
        "trend", F.when(F.col("_cnt") == period, F.avg("y").over(w))).drop("_cnt")
    d = d.withColumn("phase", F.dayofweek("ts"))
    s = d.where(F.col("trend").isNotNull()).groupBy(*ids, "phase").agg(F.avg(F.col("y") - F.col("trend")).alias("_s"))
    s = s.withColumn("seasonal", F.col("_s") - F.avg("_s").over(Window.partitionBy(*ids))).drop("_s")
    d = d.join(s, [*ids, "phase"], "left")
    return d.withColumn("residual", F.col("y") - F.col("trend") - F.col("seasonal"))


def change_points(df: DataFrame, ids: list[str], half_window: int = 7, threshold: float = 2.0) -> DataFrame:
    """Step 6 / model-free: mean shift between the left and right windows,
    in pooled standard deviations; a change point is a local maximum above
    the threshold."""
    left = _w(ids).rowsBetween(-half_window, -1)
    right = _w(ids).rowsBetween(0, half_window - 1)
    d = (df.withColumn("_ml", F.avg("y").over(left)).withColumn("_mr", F.avg("y").over(right))
           .withColumn("_sl", F.stddev_samp("y").over(left)).withColumn("_sr", F.stddev_samp("y").over(right))
           .withColumn("_nl", F.count("y").over(left)).withColumn("_nr", F.count("y").over(right)))
    pooled = F.sqrt((F.pow("_sl", 2) + F.pow("_sr", 2)) / 2)
    d = d.withColumn("shift_score", F.when((F.col("_nl") == half_window) & (F.col("_nr") == half_window) & (pooled > 0),
                                           F.abs(F.col("_mr") - F.col("_ml")) / pooled))
    nb = _w(ids).rowsBetween(-half_window, half_window)
    d = d.withColumn("_mx", F.max("shift_score").over(nb))
    return (d.withColumn("is_change_point", (F.col("shift_score") >= threshold) & (F.col("shift_score") == F.col("_mx")))
             .drop("_ml", "_mr", "_sl", "_sr", "_nl", "_nr", "_mx"))


def seasonal_naive(df: DataFrame, ids: list[str], season: int = 7) -> DataFrame:
    return df.withColumn("naive", F.lag("y", season).over(_w(ids)))


def forecast_metrics(df: DataFrame, ids: list[str], actual: str, forecast: str, naive_mae: DataFrame) -> DataFrame:
    """MAE, MSE, RMSE, MAPE (non-zero actuals), sMAPE and MASE (MAE over the
    in-sample seasonal-naive MAE, given per series)."""
    e = F.col(forecast) - F.col(actual)
    m = df.groupBy(*ids).agg(
        F.avg(F.abs(e)).alias("mean_absolute_error"), F.avg(e * e).alias("mean_squared_error"),
        (100 * F.avg(F.when(F.col(actual) != 0, F.abs(e) / F.abs(F.col(actual))))).alias("mean_absolute_percentage_error"),
        (100 * F.avg(F.when(F.abs(F.col(actual)) + F.abs(F.col(forecast)) > 0,
                            2 * F.abs(e) / (F.abs(F.col(actual)) + F.abs(F.col(forecast)))))).alias(
            "symmetric_mean_absolute_percentage_error"))
    m = m.withColumn("root_mean_squared_error", F.sqrt("mean_squared_error"))
    return m.join(naive_mae, ids, "left").withColumn(
        "mean_absolute_scaled_error", F.col("mean_absolute_error") / F.nullif(F.col("naive_mae"), F.lit(0.0))).drop("naive_mae")


def chronological_split(df: DataFrame, ts: str, fractions=(0.8, 0.1)) -> DataFrame:
    """Last rows in time are the test set: percent rank by time (distributed)."""
    r = ranking.percent_rank(df, [], ts, "_pr")
    a, b = fractions[0], fractions[0] + fractions[1]
    return r.withColumn("split", F.when(F.col("_pr") < a, "train").when(F.col("_pr") < b, "eval").otherwise("test")).drop("_pr")


# ------------------------------------------------------------------ model fitting ---

FORECAST_SCHEMA = ("series_id string, forecast_date date, horizon int, forecast_value double, standard_error double, "
                   "status string, message string")
FIT_SCHEMA = "series_id string, ar_order int, aic double, variance double, n_points int, status string, message string"


def _fit_ar(y: np.ndarray, max_p: int):
    """AR(p) with intercept by least squares for p in 0..max_p; pick min AIC.

    All orders are compared on the same points (those that the highest order can
    explain); the chosen one is then fitted on all of its own."""
    n = len(y)
    top = min(max_p, (n - 2) // 2)

    def fit(p, first):
        X = np.column_stack([np.ones(n - first)] + [y[first - j - 1:n - j - 1] for j in range(p)])
        coef, *_ = np.linalg.lstsq(X, y[first:], rcond=None)
        resid = y[first:] - X @ coef
        return coef, float(resid @ resid) / (n - first)

    def aic(p):
        return (n - top) * np.log(max(fit(p, top)[1], 1e-12)) + 2 * (p + 1)
    p = min(range(top + 1), key=aic)
    coef, var = fit(p, p)
    return p, aic(p), coef, var


def _forecast_ar(y, coef, p, horizon, var):
    hist = list(y)
    out, se = [], []
    psi = [1.0]
    for h in range(1, horizon + 1):
        x = coef[0] + sum(coef[j + 1] * hist[-j - 1] for j in range(p))
        hist.append(x)
        out.append(float(x))
        se.append(float(np.sqrt(var * sum(v * v for v in psi))))
        nxt = sum(coef[j + 1] * (psi[-j - 1] if j < len(psi) else 0.0) for j in range(p)) if p else 0.0
        psi.append(nxt)
    return out, se


def forecast_many(df: DataFrame, id_col: str, horizon: int = 7, max_p: int = 3, min_points: int = 3) -> DataFrame:
    """One AR model per series (ids combined in ``id_col``), fitted in parallel
    across series; rows: forecasts, or one ``status='failed'`` row per series
    that has fewer than ``min_points`` points or cannot be fitted."""
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        sid = str(pdf[id_col].iloc[0])
        pdf = pdf.sort_values("ts")
        y = pdf["y"].astype(float).to_numpy()
        last = pd.Timestamp(pdf["ts"].iloc[-1])
        if len(y) < min_points or np.isnan(y).any():
            return pd.DataFrame([{"series_id": sid, "forecast_date": None, "horizon": None, "forecast_value": None,
                                  "standard_error": None, "status": "failed",
                                  "message": f"needs at least {min_points} non-null points, got {len(y)}"}])
        try:
            p, aic, coef, var = _fit_ar(y, max_p)
            vals, ses = _forecast_ar(y, coef, p, horizon, var)
        except Exception as e:  # noqa: BLE001
            return pd.DataFrame([{"series_id": sid, "forecast_date": None, "horizon": None, "forecast_value": None,
                                  "standard_error": None, "status": "failed", "message": str(e)[:200]}])
        return pd.DataFrame({"series_id": sid, "forecast_date": [(last + pd.Timedelta(days=h)).date()
                                                                 for h in range(1, horizon + 1)],
                             "horizon": list(range(1, horizon + 1)), "forecast_value": vals, "standard_error": ses,
                             "status": "ok", "message": f"AR({p}) aic={aic:.3f}"})
    return df.select(F.col(id_col).cast("string").alias(id_col), "ts", "y").groupBy(id_col).applyInPandas(
        fit, FORECAST_SCHEMA)


def fit_metadata(df: DataFrame, id_col: str, max_p: int = 3, min_points: int = 3) -> DataFrame:
    """Fit metadata per series: chosen order, AIC, variance, status."""
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        sid = str(pdf[id_col].iloc[0])
        y = pdf.sort_values("ts")["y"].astype(float).to_numpy()
        failed = {"series_id": sid, "ar_order": None, "aic": None, "variance": None, "n_points": len(y), "status": "failed"}
        if len(y) < min_points or np.isnan(y).any():
            return pd.DataFrame([failed | {"message": f"needs at least {min_points} non-null points"}])
        try:
            p, aic, _, var = _fit_ar(y, max_p)
        except Exception as e:  # noqa: BLE001
            return pd.DataFrame([failed | {"message": str(e)[:200]}])
        return pd.DataFrame([{"series_id": sid, "ar_order": p, "aic": float(aic), "variance": float(var),
                              "n_points": len(y), "status": "ok", "message": ""}])
    return df.select(F.col(id_col).cast("string").alias(id_col), "ts", "y").groupBy(id_col).applyInPandas(fit, FIT_SCHEMA)


def with_intervals(fc: DataFrame, level: float = 0.95, horizon: int | None = None) -> DataFrame:
    """``forecast``: lower/upper bounds at a confidence level; ``horizon`` only filters."""
    from statistics import NormalDist
    z = NormalDist().inv_cdf(0.5 + level / 2)
    d = fc.where(F.col("status") == "ok")
    if horizon is not None:
        d = d.where(F.col("horizon") <= horizon)
    return d.select("series_id", "forecast_date", "horizon", "forecast_value", "standard_error",
                    F.lit(level).alias("confidence_level"),
                    (F.col("forecast_value") - z * F.col("standard_error")).alias("prediction_interval_lower_bound"),
                    (F.col("forecast_value") + z * F.col("standard_error")).alias("prediction_interval_upper_bound"))


def xreg_fit_forecast(hist: DataFrame, future: DataFrame, id_col: str, xcols: list[str]) -> DataFrame:
    """Linear external regressors per series (least squares on the history);
    future regressor values must be supplied; missing history values are
    imputed with the series mean first.  A series that cannot be fitted is one
    row with ``status='failed'``."""
    schema = f"{id_col} string, ts date, forecast_value double, status string, message string"

    def fit(key, pdf: pd.DataFrame) -> pd.DataFrame:
        h = pdf[pdf["_part"] == "h"]
        f = pdf[pdf["_part"] == "f"]
        failed = {id_col: None if key[0] is None else str(key[0]), "ts": None, "forecast_value": None, "status": "failed"}
        if f.empty:
            return pd.DataFrame([failed | {"message": "no future regressor values"}])
        h = h[h["y"].notna()]
        if len(h) < len(xcols) + 2:
            return pd.DataFrame([failed | {"message": f"needs at least {len(xcols) + 2} non-null points, got {len(h)}"}])
        X = h[xcols].astype(float)
        X = X.fillna(X.mean())
        A = np.column_stack([np.ones(len(h)), X.to_numpy()])
        coef, *_ = np.linalg.lstsq(A, h["y"].astype(float).to_numpy(), rcond=None)
        Xf = f[xcols].astype(float).fillna(X.mean()).to_numpy()
        pred = np.column_stack([np.ones(len(f)), Xf]) @ coef
        return pd.DataFrame({id_col: None if key[0] is None else str(key[0]), "ts": f["ts"].to_numpy(), "forecast_value": pred,
                             "status": "ok", "message": ""})
    a = hist.select(F.col(id_col).cast("string").alias(id_col), "ts", "y", *xcols, F.lit("h").alias("_part"))
    b = future.select(F.col(id_col).cast("string").alias(id_col), "ts", F.lit(None).cast("double").alias("y"), *xcols,
                      F.lit("f").alias("_part"))
    return a.unionByName(b).groupBy(id_col).applyInPandas(fit, schema)


def reconcile_bottom_up(leaf_fc: DataFrame, levels: list[str], date_col: str, value: str) -> DataFrame:
    """Hierarchical forecasts: parents are sums of their children
    (``ROLLUP`` of the leaf forecasts; NULL = all, left-most = top parent)."""
    return (leaf_fc.rollup(date_col, *levels).agg(F.sum(value).alias(value), F.grouping_id().alias("gid"))
                   .where(F.col(date_col).isNotNull()))

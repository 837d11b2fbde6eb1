"""Time-series queries over daily order series (one series per order priority)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparklab.operators import statespace
from sparklab.operators import timeseries as ts
from sparklab.plans.fixtures import with_sql
from sparklab.plans.registry import query
from sparklab.sources.tables import Tables

IDS = ["series_id"]


def raw_series(t):
    return t.orders.select(F.col("o_orderpriority").alias("series_id"), F.col("o_orderdate").alias("ts"),
                           F.col("o_totalprice").alias("v"))


def regular(t):
    return ts.regularize(raw_series(t), IDS, "ts", "v")


REG_SQL = """pts AS (SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS ts, avg(o_totalprice) AS y FROM orders GROUP BY 1, 2),
rng AS (SELECT series_id, min(ts) AS lo, max(ts) AS hi FROM pts GROUP BY 1),
grid AS (SELECT series_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS ts FROM rng),
g AS (SELECT grid.series_id, grid.ts, pts.y, CASE WHEN pts.y IS NOT NULL THEN grid.ts - DATE '1970-01-01' END AS kt
      FROM grid LEFT JOIN pts ON pts.series_id = grid.series_id AND pts.ts = grid.ts),
f AS (SELECT *,
        last_value(y IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS py,
        last_value(kt IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pt,
        first_value(y IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ny,
        first_value(kt IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nt
      FROM g),
reg AS (SELECT series_id, ts, y IS NULL AS is_filled,
               coalesce(y, py + (ny - py) * ((ts - DATE '1970-01-01') - pt) / (nt - pt)) AS y FROM f)"""


@query("ts_infer_frequency", sql="""
WITH d AS (SELECT DISTINCT o_orderpriority AS series_id, o_orderdate AS ts FROM orders),
g AS (SELECT series_id, CAST(epoch(ts) AS BIGINT) - CAST(epoch(lag(ts) OVER (PARTITION BY series_id ORDER BY ts)) AS BIGINT) AS gap FROM d),
c AS (SELECT series_id, gap, count(*) AS n FROM g WHERE gap IS NOT NULL GROUP BY 1, 2),
b AS (SELECT series_id, gap, row_number() OVER (PARTITION BY series_id ORDER BY n DESC, gap) AS rk FROM c),
p AS (SELECT series_id, count(*) AS n_points FROM d GROUP BY 1)
SELECT p.series_id, CAST(p.n_points AS BIGINT) AS n_points, b.gap AS step_seconds, CAST(b.gap / 86400 AS INTEGER) AS step_days
FROM p LEFT JOIN b ON b.series_id = p.series_id AND b.rk = 1""")
def q_ts_infer_frequency(spark, sf):
    return ts.infer_frequency(raw_series(Tables(spark, sf)), IDS, "ts")


@query("ts_regularize", sql=with_sql(REG_SQL, "SELECT series_id, ts, is_filled, round(y, 6) AS y FROM reg"))
def q_ts_regularize(spark, sf):
    r = regular(Tables(spark, sf))
    return r.select("series_id", "ts", "is_filled", F.round("y", 6).alias("y"))


@query("ts_clean_spikes", sql=with_sql(REG_SQL, """,
m AS (SELECT *, median(y) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS med FROM reg),
d AS (SELECT *, abs(y - med) AS dev FROM m),
a AS (SELECT *, median(dev) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS mad FROM d)
SELECT series_id, ts, mad > 0 AND dev > 5.0 * mad AS is_spike,
       round(CASE WHEN mad > 0 AND dev > 5.0 * mad THEN med ELSE y END, 6) AS y_clean FROM a"""))
def q_ts_clean_spikes(spark, sf):
    c = ts.clean_spikes(regular(Tables(spark, sf)), IDS, 3, 5.0)
    return c.select("series_id", "ts", "is_spike", F.round("y_clean", 6).alias("y_clean"))


@query("ts_decompose", sql=with_sql(REG_SQL, """,
t AS (SELECT *, CASE WHEN count(y) OVER w = 7 THEN avg(y) OVER w END AS trend, dayofweek(ts) + 1 AS phase FROM reg
      WINDOW w AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
s0 AS (SELECT series_id, phase, avg(y - trend) AS s FROM t WHERE trend IS NOT NULL GROUP BY 1, 2),
s AS (SELECT series_id, phase, s - avg(s) OVER (PARTITION BY series_id) AS seasonal FROM s0)
SELECT t.series_id, t.ts, round(t.trend, 6) AS trend, round(s.seasonal, 6) AS seasonal,
       round(t.y - t.trend - s.seasonal, 6) AS residual
FROM t LEFT JOIN s ON s.series_id = t.series_id AND s.phase = t.phase"""))
def q_ts_decompose(spark, sf):
    d = ts.decompose(regular(Tables(spark, sf)), IDS, 7)
    return d.select("series_id", "ts", *[F.round(c, 6).alias(c) for c in ("trend", "seasonal", "residual")])


@query("seasonal_naive", sql=with_sql(REG_SQL, """
SELECT series_id, ts, round(y, 6) AS y, round(lag(y, 7) OVER (PARTITION BY series_id ORDER BY ts), 6) AS naive FROM reg"""))
def q_seasonal_naive(spark, sf):
    n = ts.seasonal_naive(regular(Tables(spark, sf)), IDS, 7)
    return n.select("series_id", "ts", F.round("y", 6).alias("y"), F.round("naive", 6).alias("naive"))


METRICS_SQL = with_sql(REG_SQL, """,
n AS (SELECT *, lag(y, 7) OVER (PARTITION BY series_id ORDER BY ts) AS naive,
             max(ts) OVER (PARTITION BY series_id) AS mx FROM reg),
tr AS (SELECT series_id, avg(abs(y - naive)) AS naive_mae FROM n WHERE ts <= mx - 28 GROUP BY 1),
te AS (SELECT series_id, avg(abs(naive - y)) AS mae, avg((naive - y) * (naive - y)) AS mse,
              100 * avg(CASE WHEN y != 0 THEN abs(naive - y) / abs(y) END) AS mape,
              100 * avg(CASE WHEN abs(y) + abs(naive) > 0 THEN 2 * abs(naive - y) / (abs(y) + abs(naive)) END) AS smape
       FROM n WHERE ts > mx - 28 GROUP BY 1)
SELECT te.series_id, round(mae, 4) AS mean_absolute_error, round(mse, 2) AS mean_squared_error,
       round(sqrt(mse), 4) AS root_mean_squared_error, round(mape, 4) AS mean_absolute_percentage_error,
       round(smape, 4) AS symmetric_mean_absolute_percentage_error, round(mae / nullif(naive_mae, 0), 6) AS mean_absolute_scaled_error
FROM te LEFT JOIN tr ON tr.series_id = te.series_id""")


@query("forecast_metrics", sql=METRICS_SQL)
def q_forecast_metrics(spark, sf):
    from pyspark.sql import Window
    n = ts.seasonal_naive(regular(Tables(spark, sf)), IDS, 7)
    n = n.withColumn("_mx", F.max("ts").over(Window.partitionBy(*IDS)))
    test = n.where(F.col("ts") > F.date_sub("_mx", 28))
    train = n.where(F.col("ts") <= F.date_sub("_mx", 28))
    naive_mae = train.groupBy(*IDS).agg(F.avg(F.abs(F.col("y") - F.col("naive"))).alias("naive_mae"))
    m = ts.forecast_metrics(test, IDS, "y", "naive", naive_mae)
    r = {"mean_absolute_error": 4, "mean_squared_error": 2, "root_mean_squared_error": 4,
         "mean_absolute_percentage_error": 4, "symmetric_mean_absolute_percentage_error": 4,
         "mean_absolute_scaled_error": 6}
    return m.select("series_id", *[F.round(c, d).alias(c) for c, d in r.items()])


@query("chronological_split", sql="""
SELECT o_orderkey, CASE WHEN pr < 0.8 THEN 'train' WHEN pr < 0.9 THEN 'eval' ELSE 'test' END AS split
FROM (SELECT o_orderkey, percent_rank() OVER (ORDER BY o_orderdate) AS pr FROM orders)""")
def q_chronological_split(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderdate")
    return ts.chronological_split(o, "o_orderdate").select("o_orderkey", "split")


RECON_SQL = """
WITH mx AS (SELECT max(CAST(o_orderdate AS DATE)) AS m FROM orders),
leaves AS (SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders),
days AS (SELECT m + CAST(h AS INTEGER) AS fd, m + CAST(h AS INTEGER) - 7 AS src FROM mx, range(1, 8) t(h)),
daily AS (SELECT o_orderpriority, o_orderstatus, CAST(o_orderdate AS DATE) AS d, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2, 3),
lf AS (SELECT l.o_orderpriority, l.o_orderstatus, days.fd AS forecast_date, coalesce(daily.v, 0.0) AS value
       FROM leaves l CROSS JOIN days LEFT JOIN daily ON daily.o_orderpriority = l.o_orderpriority
            AND daily.o_orderstatus = l.o_orderstatus AND daily.d = days.src)
SELECT forecast_date, o_orderpriority, o_orderstatus, round(sum(value), 2) AS value,
       CAST(grouping(forecast_date, o_orderpriority, o_orderstatus) AS BIGINT) AS gid
FROM lf GROUP BY ROLLUP (forecast_date, o_orderpriority, o_orderstatus) HAVING forecast_date IS NOT NULL"""


@query("forecast_reconcile", sql=RECON_SQL)
def q_forecast_reconcile(spark, sf):
    """Leaf forecasts (seasonal naive, 7 days ahead) per (priority, status),
    reconciled bottom-up: every parent equals the sum of its children."""
    o = Tables(spark, sf).orders
    daily = o.groupBy("o_orderpriority", "o_orderstatus", F.to_date("o_orderdate").alias("d")).agg(
        F.sum("o_totalprice").alias("v"))
    mx = o.agg(F.max(F.to_date("o_orderdate")).alias("m"))
    days = mx.select(F.explode(F.sequence(F.lit(1), F.lit(7))).alias("h"), "m").select(
        F.date_add("m", F.col("h")).alias("forecast_date"), F.date_add("m", F.col("h") - 7).alias("d"))
    leaves = o.select("o_orderpriority", "o_orderstatus").distinct()
    lf = leaves.crossJoin(F.broadcast(days)).join(daily, ["o_orderpriority", "o_orderstatus", "d"], "left").select(
        "o_orderpriority", "o_orderstatus", "forecast_date", F.coalesce("v", F.lit(0.0)).alias("value"))
    r = ts.reconcile_bottom_up(lf, ["o_orderpriority", "o_orderstatus"], "forecast_date", "value")
    return r.select("forecast_date", "o_orderpriority", "o_orderstatus", F.round("value", 2).alias("value"),
                    F.col("gid").cast("bigint").alias("gid"))


def step_sql(h: int, threshold: float) -> str:
    """Oracle of ``change_points`` with half window ``h``."""
    return with_sql(REG_SQL, f""",
w AS (SELECT series_id, ts, avg(y) OVER l AS ml, avg(y) OVER r AS mr, stddev_samp(y) OVER l AS sl,
             stddev_samp(y) OVER r AS sr, count(y) OVER l AS nl, count(y) OVER r AS nr FROM reg
      WINDOW l AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN {h} PRECEDING AND 1 PRECEDING),
             r AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND {h - 1} FOLLOWING)),
sc AS (SELECT *, CASE WHEN nl = {h} AND nr = {h} AND sqrt((pow(sl, 2) + pow(sr, 2)) / 2) > 0
                      THEN abs(mr - ml) / sqrt((pow(sl, 2) + pow(sr, 2)) / 2) END AS shift_score FROM w),
mx AS (SELECT *, max(shift_score) OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING) AS m
       FROM sc)
SELECT series_id, ts, round(shift_score, 6) AS shift_score FROM mx WHERE shift_score >= {threshold} AND shift_score = m""")


STEP_SQL = step_sql(7, 2.0)


@query("ts_step_changes", sql=STEP_SQL)
def q_ts_step_changes(spark, sf):
    c = ts.change_points(regular(Tables(spark, sf)), IDS, 7, 2.0)
    return c.where(F.col("is_change_point")).select("series_id", "ts", F.round("shift_score", 6).alias("shift_score"))


HOLIDAY_SQL = with_sql(REG_SQL, """,
t AS (SELECT *, CASE WHEN count(y) OVER w = 7 THEN avg(y) OVER w END AS trend, dayofweek(ts) + 1 AS phase FROM reg
      WINDOW w AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
s0 AS (SELECT series_id, phase, avg(y - trend) AS s FROM t WHERE trend IS NOT NULL GROUP BY 1, 2),
s AS (SELECT series_id, phase, s - avg(s) OVER (PARTITION BY series_id) AS seasonal FROM s0),
dec AS (SELECT t.series_id, t.ts, t.y - t.trend - s.seasonal AS residual
        FROM t LEFT JOIN s ON s.series_id = t.series_id AND s.phase = t.phase),
cal AS (SELECT DISTINCT make_date(year(ts), 1, 1) AS ts, '01-01' AS holiday FROM dec
        UNION SELECT DISTINCT make_date(year(ts), 12, 25), '12-25' FROM dec)
SELECT series_id, holiday, round(avg(residual), 6) AS mean_residual, CAST(count(*) AS BIGINT) AS n
FROM dec JOIN cal ON cal.ts = dec.ts GROUP BY 1, 2""")


@query("ts_holiday_effect", sql=HOLIDAY_SQL)
def q_ts_holiday_effect(spark, sf):
    """Mean residual on calendar days supplied by the user (here: 1 January and
    25 December of each year in range)."""
    d = ts.decompose(regular(Tables(spark, sf)), IDS, 7)
    cal = d.select(F.year("ts").alias("yr")).distinct().select(F.explode(F.array(
        F.make_date("yr", F.lit(1), F.lit(1)), F.make_date("yr", F.lit(12), F.lit(25)))).alias("ts"))
    cal = cal.withColumn("holiday", F.date_format("ts", "MM-dd"))
    return d.join(F.broadcast(cal), "ts").groupBy("series_id", "holiday").agg(
        F.round(F.avg("residual"), 6).alias("mean_residual"), F.count(F.lit(1)).alias("n"))


def calendar(t):
    """The fixture's holidays: 1 January and 25 December of every year of the orders and the one after it."""
    years = t.orders.agg(F.year(F.min("o_orderdate")).alias("a"), F.year(F.max("o_orderdate")).alias("b"))
    year = years.select(F.explode(F.sequence("a", F.col("b") + 1)).alias("y"))
    return year.select(F.explode(F.array(F.struct(F.make_date("y", F.lit(1), F.lit(1)).alias("ts"), F.lit("new year").alias("holiday")),
                                         F.struct(F.make_date("y", F.lit(12), F.lit(25)).alias("ts"), F.lit("christmas").alias("holiday")))).alias("d")).select("d.*")


def models(t, extra=None):
    """A model row for every series: season of a week and holidays, on spike-free data."""
    reg = regular(t)
    clean = ts.clean_spikes(reg, IDS, 3, 5.0).select("series_id", "ts", F.col("y_clean").alias("y"))
    return statespace.fit(clean if extra is None else clean.unionByName(extra(clean)), "series_id", 7, calendar(t))


def _two_days(clean):
    return clean.where(F.col("series_id") == "1-URGENT").orderBy("ts").limit(2).withColumn("series_id", F.lit("1-URGENT/first-two-days"))


@query("forecast_many")
def q_forecast_many(spark, sf):
    """One model per series, plus a deliberately short series that must come
    back as a failed row (not be absent)."""
    t = Tables(spark, sf)
    return statespace.forecast(models(t, _two_days), "series_id", 7, "1 day", calendar(t))


@query("forecast_fit")
def q_forecast_fit(spark, sf):
    return models(Tables(spark, sf)).drop("history", "candidates", "holiday_effects")


@query("arima_evaluate")
def q_arima_evaluate(spark, sf):
    """All structures tried per series with likelihood, AIC and variance; failed series with their message."""
    return statespace.evaluate(models(Tables(spark, sf), _two_days), "series_id")


@query("forecast")
def q_forecast(spark, sf):
    t = Tables(spark, sf)
    f = statespace.forecast(models(t), "series_id", 14, "1 day", calendar(t), 0.95)
    return f.where(F.col("horizon") <= 3).drop("status", "message")


@query("explain_forecast")
def q_explain_forecast(spark, sf):
    """History rows with components that add up, then forecast rows (spikes and residual NULL there)."""
    t = Tables(spark, sf)
    raw = regular(t).select("series_id", "ts", F.col("y").alias("raw"))
    return statespace.explain(models(t), "series_id", 14, "1 day", calendar(t), raw)


@query("forecast_monthly")
def q_forecast_monthly(spark, sf):
    """Monthly order totals per priority, a season of twelve calendar months, twelve months ahead."""
    grid = ts.calendar_grid(monthly(Tables(spark, sf)), IDS, "ts", "v")
    return statespace.forecast(statespace.fit(grid, "series_id", 12), "series_id", 12, "1 month")


@query("forecast_xreg")
def q_forecast_xreg(spark, sf):
    """Daily revenue per priority explained by the daily order count (an
    external regressor whose future values are supplied: the last week's)."""
    o = Tables(spark, sf).orders
    daily = o.groupBy(F.col("o_orderpriority").alias("series_id"), F.to_date("o_orderdate").alias("ts")).agg(
        F.sum("o_totalprice").alias("y"), F.count(F.lit(1)).cast("double").alias("n_orders"))
    mx = daily.agg(F.max("ts").alias("_m"))
    future = (daily.crossJoin(F.broadcast(mx)).where(F.col("ts") > F.date_sub("_m", 7))
                   .select("series_id", F.date_add("ts", 7).alias("ts"), "n_orders"))
    return ts.xreg_fit_forecast(daily, future, "series_id", ["n_orders"])


@query("ts_anomalies")
def q_ts_anomalies(spark, sf):
    """Points outside the 99 % band of the fitted model's one-step prediction, with the probability of a smaller error."""
    reg = regular(Tables(spark, sf))
    return statespace.anomalies(statespace.fit(reg, "series_id", 7), "series_id", 0.99).where("is_anomaly")


@query("walk_forward")
def q_walk_forward(spark, sf):
    """Forward chaining: 4 folds, each fits on data up to its cut and scores the
    next 7 days; folds are rows, so all (series, fold) fits run in parallel.  A
    fold that cannot be fitted is a row with its message."""
    reg = regular(Tables(spark, sf))
    mx = reg.agg(F.max("ts").alias("_m"))
    folds = mx.select(F.explode(F.sequence(F.lit(1), F.lit(4))).alias("fold"), "_m").select(
        "fold", F.date_sub("_m", F.col("fold") * 7).alias("cut"))
    folds = folds.unionByName(reg.agg(F.min("ts").alias("cut")).select(F.lit(5).alias("fold"), "cut"))  # one day of history
    x = reg.crossJoin(F.broadcast(folds))  # 5 folds: a fixed multiplier
    sid = F.concat_ws("#", "series_id", F.col("fold").cast("string"))
    fits = statespace.fit(x.where(F.col("ts") <= F.col("cut")).select(sid.alias("sid"), "ts", "y"), "sid", 7)
    fc = statespace.forecast(fits, "sid", 7)
    actual = x.where((F.col("ts") > F.col("cut")) & (F.col("ts") <= F.date_add("cut", 7))).select(
        sid.alias("sid"), F.col("ts").cast("timestamp").alias("forecast_timestamp"), "y")
    j = fc.join(actual, ["sid", "forecast_timestamp"], "left")
    e = F.col("forecast_value") - F.col("y")
    return j.groupBy("sid").agg(F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.count("y").alias("n"),
                                F.first("status").alias("status"), F.first("message").alias("message")).withColumnRenamed("sid", "series_id")


def hourly(t):
    """Hourly mean value per event type, with the gaps that the events leave."""
    return t.events.groupBy(F.col("event_type").alias("series_id"), F.date_trunc("hour", "ts").alias("ts")).agg(F.avg("value").alias("v"))


def monthly(t):
    """Monthly order totals per priority; December 1996 to February 1997 are left out."""
    o = t.orders.where((F.col("o_orderdate") < F.lit("1996-12-01").cast("timestamp_ntz")) | (F.col("o_orderdate") >= F.lit("1997-03-01").cast("timestamp_ntz")))
    return o.groupBy(F.col("o_orderpriority").alias("series_id"), F.date_trunc("month", "o_orderdate").alias("ts")).agg(F.sum("o_totalprice").alias("v"))


def grid_sql(points: str, unit: str) -> str:
    """Oracle of ``calendar_grid`` over the points (series_id, ts, y)."""
    sec = lambda a: f"epoch({a})"
    return f"""
WITH pts AS ({points}),
rng AS (SELECT series_id, min(ts) AS lo, max(ts) AS hi FROM pts GROUP BY 1),
grid AS (SELECT series_id, unnest(generate_series(lo, hi, INTERVAL 1 {unit})) AS ts FROM rng),
g AS (SELECT grid.series_id, grid.ts, pts.y, CASE WHEN pts.y IS NOT NULL THEN {sec('grid.ts')} END AS kt
      FROM grid LEFT JOIN pts ON pts.series_id = grid.series_id AND pts.ts = grid.ts),
f AS (SELECT *,
        last_value(y IGNORE NULLS) OVER p AS py, last_value(kt IGNORE NULLS) OVER p AS pt,
        first_value(y IGNORE NULLS) OVER n AS ny, first_value(kt IGNORE NULLS) OVER n AS nt
      FROM g WINDOW p AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                    n AS (PARTITION BY series_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT series_id, ts, '{unit.lower()}' AS step, y IS NULL AS is_filled,
       round(coalesce(y, py + (ny - py) * ({sec('ts')} - pt) / (nt - pt)), 9) AS y FROM f"""


HOURLY_SQL = "SELECT event_type AS series_id, date_trunc('hour', ts) AS ts, avg(value) AS y FROM events GROUP BY 1, 2"
MONTHLY_SQL = """SELECT o_orderpriority AS series_id, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS ts, sum(o_totalprice) AS y FROM orders
  WHERE o_orderdate < TIMESTAMP '1996-12-01' OR o_orderdate >= TIMESTAMP '1997-03-01' GROUP BY 1, 2"""


@query("ts_regularize_hourly", sql=grid_sql(HOURLY_SQL, "HOUR"))
def q_ts_regularize_hourly(spark, sf):
    """A grid of the step that the series themselves show (hours)."""
    return ts.calendar_grid(hourly(Tables(spark, sf)), IDS, "ts", "v").withColumn("y", F.round("y", 9))


@query("ts_regularize_monthly", sql=grid_sql(MONTHLY_SQL, "MONTH"))
def q_ts_regularize_monthly(spark, sf):
    """A grid of calendar months, with three months filled in."""
    return ts.calendar_grid(monthly(Tables(spark, sf)), IDS, "ts", "v").withColumn("y", F.round("y", 9))


#: The optimal partition by the full dynamic programme (every last cut is tried at every week), then walked back.
SEGMENT_SQL = """
WITH RECURSIVE
pts AS (SELECT o_orderpriority AS series_id, CAST(date_trunc('week', o_orderdate) AS TIMESTAMP) AS ts, sum(o_totalprice) AS y FROM orders GROUP BY 1, 2),
whole AS (SELECT series_id, list(ts ORDER BY ts) AS at, list(y ORDER BY ts) AS v FROM pts GROUP BY 1),
spread AS (SELECT *, len(v) AS n, list_avg(v) AS m, list_aggregate(list_transform(range(1, len(v)), lambda i: abs(v[i + 1] - v[i])), 'median') / 0.954 AS d FROM whole),
zero AS (SELECT *, list_transform(v, lambda x: x - m) AS c, 0.5 * d * d * ln(n) AS penalty FROM spread),
src AS (SELECT *, list_transform(range(0, n + 1), lambda i: coalesce(list_sum(c[1:i]), 0.0)) AS p,
               list_transform(range(0, n + 1), lambda i: coalesce(list_sum(list_transform(c[1:i], lambda x: x * x)), 0.0)) AS q FROM zero),
dp AS (
  SELECT series_id, CAST(1 AS BIGINT) AS t, [-penalty, 1e300] AS f, [CAST(0 AS BIGINT), 0] AS prev FROM src
  UNION ALL
  SELECT series_id, t + 1, list_append(f, list_min(costs) + penalty), list_append(prev, CAST(list_position(costs, list_min(costs)) - 1 AS BIGINT))
  FROM (SELECT dp.series_id, dp.t, dp.f, dp.prev, src.penalty,
               list_transform(range(0, dp.t), lambda s: dp.f[s + 1] + (src.q[dp.t + 2] - src.q[s + 1]) - (src.p[dp.t + 2] - src.p[s + 1]) * (src.p[dp.t + 2] - src.p[s + 1]) / (dp.t + 1 - s)) AS costs
        FROM dp JOIN src ON src.series_id = dp.series_id WHERE dp.t < src.n)),
done AS (SELECT dp.series_id, dp.prev, src.n FROM dp JOIN src ON src.series_id = dp.series_id AND src.n = dp.t),
cuts AS (
  SELECT series_id, prev, prev[n + 1] AS a, CAST(n AS BIGINT) AS b FROM done
  UNION ALL
  SELECT series_id, prev, prev[a + 1], a FROM cuts WHERE a > 0),
parts AS (
  SELECT c.series_id, row_number() OVER (PARTITION BY c.series_id ORDER BY c.a) - 1 AS segment, s.at[c.a + 1] AS first_at, s.at[c.b] AS last_at,
         c.b - c.a AS n, list_avg(s.v[c.a + 1:c.b]) AS mean
  FROM cuts c JOIN src s ON s.series_id = c.series_id)
SELECT series_id, CAST(segment AS INTEGER) AS segment, first_at, last_at, CAST(n AS INTEGER) AS n, round(mean, 2) AS mean,
       round(mean - lag(mean) OVER (PARTITION BY series_id ORDER BY segment), 2) AS shift
FROM parts"""


@query("change_points", sql=SEGMENT_SQL)
def q_change_points(spark, sf):
    """Weekly order totals per priority, cut where the level shifts: the cheapest partition of each whole series."""
    o = Tables(spark, sf).orders
    weekly = o.groupBy(F.col("o_orderpriority").alias("series_id"), F.date_trunc("week", "o_orderdate").cast("timestamp_ntz").alias("ts")).agg(F.sum("o_totalprice").alias("y"))
    s = ts.optimal_segments(weekly, IDS, "ts", "y", penalty=0.5)
    return s.select("series_id", "segment", "first_at", "last_at", "n", F.round("mean", 2).alias("mean"), F.round("shift", 2).alias("shift"))

"""Calendar grids and optimal segmentation against plain versions."""

import datetime as dt
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparklab.operators import timeseries as ts


def plain_partition(y, penalty, shortest):
    """The cheapest of all partitions, by trying each."""
    n, best = len(y), None
    for k in range(n // shortest):
        for cuts in itertools.combinations(range(1, n), k):
            edges = [0, *cuts, n]
            if any(b - a < shortest for a, b in zip(edges, edges[1:])):
                continue
            cost = sum(((y[a:b] - y[a:b].mean()) ** 2).sum() for a, b in zip(edges, edges[1:])) + penalty * k
            if best is None or cost < best[0] - 1e-12:
                best = (cost, edges[:-1])
    return best


@pytest.mark.parametrize("shortest", [1, 2, 3])
def test_segments_equal_all_partitions(shortest):
    rng = np.random.default_rng(shortest)
    for k in range(60):
        y = rng.normal(size=rng.integers(1, 13)) + np.repeat(rng.normal(scale=3, size=13), 5)[: 13][: 1]
        y[len(y) // 2 :] += rng.choice([0, 4])
        penalty = float(rng.choice([0.1, 1.0, 5.0]))
        if len(y) < shortest:
            continue
        got = ts._segment(y - y.mean(), penalty, shortest)
        edges = [*got, len(y)]
        cost = sum(((y[a:b] - y[a:b].mean()) ** 2).sum() for a, b in zip(edges, edges[1:])) + penalty * (len(got) - 1)
        want = plain_partition(y, penalty, shortest)
        assert cost == pytest.approx(want[0]) and all(b - a >= shortest for a, b in zip(edges, edges[1:]))


def test_segments_of_series(spark):
    rng = np.random.default_rng(0)
    y = np.concatenate([np.full(80, 5.0), np.full(50, 9.0), np.full(70, 2.0)]) + rng.normal(scale=0.5, size=200)
    rows = [("a", k, float(v)) for k, v in enumerate(y)] + [("flat", k, 3.0) for k in range(20)] + [("one", 0, 1.0), ("none", 0, None), (None, 1, 2.0), ("a", 500, None)]
    got = ts.optimal_segments(spark.createDataFrame(rows, "id string, ts long, y double"), ["id"]).collect()
    a = sorted((r for r in got if r["id"] == "a"), key=lambda r: r["segment"])
    assert [(r["first_at"], r["last_at"], r["n"]) for r in a] == [(0, 79, 80), (80, 129, 50), (130, 199, 70)]
    assert a[0]["shift"] is None and a[1]["shift"] == pytest.approx(4, abs=0.3) and a[1]["mean"] == pytest.approx(y[80:130].mean())
    assert a[2]["cost"] == pytest.approx(((y[130:] - y[130:].mean()) ** 2).sum())
    assert {(r["id"], r["n"], r["mean"]) for r in got if r["id"] != "a"} == {("flat", 20, 3.0), ("one", 1, 1.0), (None, 1, 2.0)}


STARTS = {"hour": dt.datetime(2024, 1, 31, 5), "week": dt.datetime(2024, 2, 26), "month": dt.datetime(2023, 11, 1), "quarter": dt.datetime(2023, 10, 1), "year": dt.datetime(2019, 1, 1), "day": dt.datetime(2024, 2, 27), "minute": dt.datetime(2024, 1, 1, 23, 58)}


def later(at, step, n):
    months = {"month": 1, "quarter": 3, "year": 12}.get(step)
    if months:
        m = at.month - 1 + months * n
        return at.replace(year=at.year + m // 12, month=m % 12 + 1)
    return at + n * {"hour": dt.timedelta(hours=1), "week": dt.timedelta(weeks=1), "day": dt.timedelta(days=1), "minute": dt.timedelta(minutes=1)}[step]


@pytest.mark.parametrize("how", ["auto", "named"])
def test_grids_follow_the_calendar(spark, how):
    """Steps 0, 1, 2, 5 (twice, to be averaged) and 6 of each kind of series; 3 and 4 are filled in."""
    rows = []
    for step, at in STARTS.items():
        rows += [(step, later(at, step, n), float(v)) for n, v in ((0, 1), (1, 2), (2, 3), (5, 8), (5, 10), (6, 5))]
    src = spark.createDataFrame(rows, "id string, at timestamp_ntz, v double")
    got = {}
    for step in STARTS:
        own = src if how == "auto" else src.where(F.col("id") == step)
        got[step] = sorted((r for r in ts.calendar_grid(own, ["id"], "at", "v", "auto" if how == "auto" else step).where(F.col("id") == step).collect()), key=lambda r: r["ts"])
        if how == "auto":
            assert {r["step"] for r in got[step]} == {step}
        assert [r["ts"] for r in got[step]] == [later(STARTS[step], step, n) for n in range(7)]
        assert [r["is_filled"] for r in got[step]] == [False] * 3 + [True] * 2 + [False] * 2
        a, b = (got[step][k]["ts"] for k in (2, 5))
        want = [1, 2, 3, *(3 + 6 * ((got[step][k]["ts"] - a) / (b - a)) for k in (3, 4)), 9, 5]
        assert np.allclose([r["y"] for r in got[step]], want)
    zero = ts.calendar_grid(src.where("id = 'month'"), ["id"], "at", "v", fill="zero").orderBy("ts").collect()
    assert [r["y"] for r in zero] == [1, 2, 3, 0, 0, 9, 5]


def test_grid_of_edge_series(spark):
    one = dt.datetime(2024, 3, 5, 7, 30)
    rows = [("one", one, 4.0), (None, one, 1.0), (None, one + dt.timedelta(days=2), 3.0), (None, one + dt.timedelta(days=3), 9.0), ("bad", None, 2.0)]
    got = sorted(ts.calendar_grid(spark.createDataFrame(rows, "id string, at timestamp_ntz, v double"), ["id"], "at", "v").collect(), key=lambda r: (r["id"] or "", r["ts"]))
    assert [(r["id"], r["ts"].day, r["y"], r["step"]) for r in got] == [(None, 5, 1.0, "day"), (None, 6, 2.0, "day"), (None, 7, 3.0, "day"), (None, 8, 9.0, "day"), ("one", 5, 4.0, "day")]
    with pytest.raises(ValueError, match="step"):
        ts.calendar_grid(spark.createDataFrame(rows, "id string, at timestamp_ntz, v double"), ["id"], "at", "v", "fortnight")

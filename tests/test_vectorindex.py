"""The vector index against exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparklab.operators import vectorindex as vi


def clustered(n=3000, dims=10, groups=40, seed=0):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(groups, dims))[rng.integers(0, groups, n)] * 3 + rng.normal(size=(n, dims)) * 0.6


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    x = clustered()
    rows = [(k, v.tolist(), f"label{k % 3}") for k, v in enumerate(x)]
    odd = [(9001, None, "x"), (9002, [1.0], "x"), (9003, [float("nan")] * 10, "x"), (9004, [None] * 10, "x"), (None, [0.0] * 10, "x")]
    base = spark.createDataFrame(rows + odd, "id long, v array<double>, label string")
    out = {}
    for metric in ("euclidean", "cosine"):
        folder = str(tmp_path_factory.mktemp(metric) / "index")
        vi.build(base, "id", "v", folder, n_cells=24, parts=4, words=32, metric=metric, carry=("label",))
        out[metric] = vi.Index(spark, folder)
    return x, out


def exact(x, q, metric, k):
    if metric == "cosine":
        u, w = x / np.linalg.norm(x, axis=1, keepdims=True), q / np.linalg.norm(q)
        d = 1 - u @ w
    else:
        d = np.sqrt(((x - q) ** 2).sum(1))
    order = np.lexsort((np.arange(len(x)), d))[:k]
    return order.tolist(), d


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_recall_and_exact_distances(spark, indexed, metric):
    x, index = indexed[0], indexed[1][metric]
    ids = list(range(0, 3000, 50))
    queries = spark.createDataFrame([(i, x[i].tolist()) for i in ids] + [(-1, None), (-2, [2.0])], "qid int, qv array<double>")
    got = index.search(queries, "qid", "qv", k=10, probes=6).collect()
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append(r)
    assert sorted(found) == ids
    hit = 0
    for i in ids:
        want, d = exact(x, x[i], metric, 10)
        rows = sorted(found[i], key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, 11))
        assert np.allclose([r["distance"] for r in rows], d[[r["base_id"] for r in rows]], atol=1e-9)
        assert all(r["label"] == f"label{r['base_id'] % 3}" for r in rows) and rows[0]["base_id"] == i
        hit += len({r["base_id"] for r in rows} & set(want))
    assert hit / (10 * len(ids)) >= 0.9
    work = index.workload(queries, "qid", "qv", 6).first()
    assert (work["n_queries"], work["n_rows"], work["pairs_all"]) == (60, 3000, 180_000) and work["pairs_scored"] < 0.5 * work["pairs_all"]


def test_all_cells_and_rows_give_the_exact_result_however_they_are_split(spark, indexed):
    x, index = indexed[0], indexed[1]["euclidean"]
    queries = spark.createDataFrame([(i, (x[i] + 0.1).tolist()) for i in range(40)], "qid int, qv array<double>")
    for slices, block in ((50_000, 256), (37, 3)):
        got = index.search(queries, "qid", "qv", k=7, probes=24, refine=10_000, slice_rows=slices, block=block).collect()
        assert len(got) == 40 * 7
        for i in range(40):
            assert [r["base_id"] for r in sorted((r for r in got if r["query_id"] == i), key=lambda r: r["rank"])] == exact(x, x[i] + 0.1, "euclidean", 7)[0]


def test_tables_give_the_distance_to_what_codes_stand_for():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 7))
    cells = vi.Model(x[:5], np.zeros((1, 1, 7))).cells(x)[:, 0]
    m = vi.Model(x[:5], vi.train_books(x - x[:5][cells], 3, 16))
    codes = m.encode(x - m.centers[cells])
    q = rng.normal(size=7)
    for c in range(5):
        own = cells == c
        near = m.tables((q - m.centers[c])[None])[0][np.arange(3), codes[own]].sum(1)
        assert np.allclose(near, ((m.decode(codes[own], cells[own]) - q) ** 2).sum(1))
    # codes are the nearest words, so decoding is nearer than the cell's centre for most
    assert ((m.decode(codes, cells) - x) ** 2).sum() < 0.6 * ((m.centers[cells] - x) ** 2).sum()


def test_ties_repeats_and_empty_tables(spark, tmp_path):
    same = [(k, [1.0, 2.0]) for k in range(30)] + [(30, [5.0, 5.0])]
    vi.build(spark.createDataFrame(same, "id int, v array<double>"), "id", "v", str(tmp_path / "a"), n_cells=4)
    got = vi.Index(spark, str(tmp_path / "a")).search(spark.createDataFrame([("q", [1.0, 2.0])], "q string, v array<double>"), "q", "v", k=4, refine=1, slice_rows=5).orderBy("rank").collect()
    assert len(got) == 4 and all(r["distance"] == 0 for r in got)
    none = spark.createDataFrame([], "id int, v array<double>")
    vi.build(none, "id", "v", str(tmp_path / "b"), n_cells=4)
    empty = vi.Index(spark, str(tmp_path / "b"))
    assert empty.search(none, "id", "v").count() == 0 and empty.search(spark.createDataFrame([(1, [1.0])], "q int, v array<double>"), "q", "v").count() == 0


def test_only_probed_cells_are_read(indexed):
    """The folder is partitioned by cell, and the join prunes it."""
    index = indexed[1]["euclidean"]
    plan = index.rows.where(F.col("cell") == 3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan and "cell" not in plan.split("PushedFilters")[1].split("ReadSchema")[0]

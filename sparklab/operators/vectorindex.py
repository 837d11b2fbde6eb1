"""Nearest-neighbour index: inverted cells with product-quantised residuals.

``build`` trains coarse cells (k-means) and, for each of ``parts`` groups of dimensions, a codebook of the residuals (vector
less its cell's centre), both on a bounded sample; then it indexes *every* row: cell, code (one byte per group) and the
vector for the exact re-ranking, written as a folder partitioned by cell, beside the model and the rows of each cell.

``search`` sends a query to its ``probes`` nearest cells only.  Rows and queries of a cell meet in groups of bounded size:
a cell of many rows is split into slices of about ``SLICE`` rows, the queries of a cell into blocks of about ``BLOCK``;
slices go to all blocks and blocks to all slices of their cell, by an equi-join.  In a group the distances to all codes
come from tables (one entry per codebook word), the ``refine * k`` nearest rows are measured exactly, and the k best leave
the task.  Nothing is broadcast but the model, whose size is set when the index is built (cells and codebooks).

Null vectors, vectors of another length and vectors with a null or non-finite number are not indexed, and such queries
have no result.  Distances are exact; what is approximate is which rows are found.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that train cells and codebooks at most (those of the smallest key hashes).
SAMPLE = 50_000
#: Rows of a slice and queries of a block, about.
SLICE, BLOCK = 50_000, 256
#: Rounds of the codebook training.
ROUNDS = 12


@dataclass
class Model:
    centers: np.ndarray  # cells x dims
    books: np.ndarray  # parts x words x dims of a part

    @property
    def width(self) -> int:
        return self.books.shape[0] * self.books.shape[2]

    def padded(self, x: np.ndarray) -> np.ndarray:
        """Vectors filled up with zeros to a multiple of the parts."""
        return np.pad(x, ((0, 0), (0, self.width - x.shape[1])))

    def cells(self, x: np.ndarray, n: int = 1) -> np.ndarray:
        """The ``n`` nearest cells of every vector, nearest first (ties: the smaller number)."""
        d = (self.centers**2).sum(1) - 2 * x @ self.centers.T
        return np.argsort(d, axis=1, kind="stable")[:, :n]

    def tables(self, residual: np.ndarray) -> np.ndarray:
        """Squared distances of each part of the vectors to all words of its codebook: vectors x parts x words."""
        r = self.padded(residual).reshape(len(residual), self.books.shape[0], 1, self.books.shape[2])
        return ((r - self.books[None]) ** 2).sum(-1)

    def encode(self, residual: np.ndarray) -> np.ndarray:
        out = np.empty((len(residual), self.books.shape[0]), np.uint8)
        for k in range(0, len(residual), 512):
            out[k : k + 512] = self.tables(residual[k : k + 512]).argmin(-1)
        return out

    def decode(self, codes: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """The vectors that the codes stand for."""
        words = self.books[np.arange(self.books.shape[0])[None], codes].reshape(len(codes), -1)
        return words[:, : self.centers.shape[1]] + self.centers[cells]


def train_books(residual: np.ndarray, parts: int, words: int, seed: int = 7) -> np.ndarray:
    """A codebook for every part of the dimensions (Lloyd's rounds from distinct rows; empty words take the farthest row)."""
    rng = np.random.default_rng(seed)
    size = -(-residual.shape[1] // parts)
    x = np.pad(residual, ((0, 0), (0, parts * size - residual.shape[1]))).reshape(len(residual), parts, size)
    out = np.zeros((parts, words, size))
    for p in range(parts):
        own = np.unique(x[:, p], axis=0)
        book = own[rng.choice(len(own), min(words, len(own)), replace=False)]
        for _ in range(ROUNDS if len(own) > words else 0):
            d = (book**2).sum(1) - 2 * x[:, p] @ book.T
            near = d.argmin(1)
            count = np.bincount(near, minlength=len(book))
            total = np.stack([np.bincount(near, x[:, p, j], minlength=len(book)) for j in range(size)], axis=1)
            book = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], book)
            empty = np.flatnonzero(count == 0)
            far = np.argsort(-(d[np.arange(len(near)), near] + (x[:, p] ** 2).sum(1)), kind="stable")[: len(empty)]
            book[empty] = x[far, p]
        out[p, : len(book)] = book
        out[p, len(book) :] = book[0]
    return out


def _usable(vec: str, dims: int) -> Column:
    v = F.col(vec)
    return v.isNotNull() & (F.size(v) == dims) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x**2).sum(1, keepdims=True)), 1e-300)


def build(base: DataFrame, key: str, vec: str, folder: str, n_cells: int, parts: int = 8, words: int = 64, metric: str = "euclidean",
          carry: tuple[str, ...] = (), sample: int = SAMPLE, seed: int = 7) -> None:
    """Write the index of all rows of ``base`` to ``folder``: rows/cell=.., cells (rows of each) and model.

    ``metric`` is 'euclidean' or 'cosine' (vectors are scaled to length 1; distances are 1 - cosine)."""
    spark = base.sparkSession
    src = base.select(F.col(key).alias("base_id"), F.col(vec).cast("array<double>").alias("vec"), *carry)
    some = src.where("vec IS NOT NULL AND size(vec) > 0").orderBy(F.xxhash64("base_id"), "base_id").limit(sample).select("vec")  # at most ``sample`` rows
    dims = some.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dims = dims["d"] if dims else 0
    known = some.where(_usable("vec", dims)).toArrow()
    x = _matrix(known.column("vec").combine_chunks(), dims) if known.num_rows else np.zeros((0, max(dims, 1)))
    x = _unit(x) if metric == "cosine" else x
    if len(x) > n_cells > 1:
        points = spark.createDataFrame(pa.table({"v": pa.array(list(x))})).select(array_to_vector("v").alias("features"))
        centers = np.array(KMeans(k=n_cells, seed=seed, maxIter=15).fit(points).clusterCenters())
    else:
        centers = x.mean(0, keepdims=True) if len(x) else np.zeros((1, max(dims, 1)))
    residual = x - centers[Model(centers, np.zeros((1, 1, x.shape[1]))).cells(x)[:, 0]] if len(x) else x
    model = Model(centers, train_books(residual, parts, words, seed) if len(x) else np.zeros((parts, words, -(-x.shape[1] // parts))))
    held = spark.sparkContext.broadcast(model)
    kind = T.StructType([*src.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("code", T.BinaryType())])

    def encode(batches):
        m = held.value
        for b in batches:
            v = _matrix(b.column("vec"), dims)
            v = _unit(v) if metric == "cosine" else v
            cell = m.cells(v)[:, 0] if len(v) else np.zeros(0, np.int64)
            codes = m.encode(v - m.centers[cell])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary())], names=kind.names)

    rows = src.where(_usable("vec", dims) & F.col("base_id").isNotNull()).mapInArrow(encode, kind)
    # a cell's rows may be many: the hash of the key splits them over tasks
    rows.repartition("cell", F.pmod(F.xxhash64("base_id"), F.lit(8))).write.partitionBy("cell").parquet(f"{folder}/rows")
    read(spark, folder, kind).groupBy("cell").agg(F.count(F.lit(1)).alias("n")).coalesce(1).write.parquet(f"{folder}/cells")  # a row per cell
    meta = [(metric, dims, carry_ddl(src, carry), centers.astype("<f8").tobytes(), model.books.astype("<f8").tobytes(), *map(int, model.books.shape))]
    spark.createDataFrame(meta, "metric string, dims int, kind string, centers binary, books binary, parts int, words int, size int").coalesce(1).write.parquet(f"{folder}/model")


def carry_ddl(src: DataFrame, carry: tuple[str, ...]) -> str:
    return src.select("base_id", "vec", *carry).schema.json()


def read(spark: SparkSession, folder: str, kind: T.StructType) -> DataFrame:
    """The indexed rows (an index without rows is an empty table)."""
    return spark.read.schema(kind).parquet(f"{folder}/rows")


class Index:
    """A written index."""

    def __init__(self, spark: SparkSession, folder: str):
        m = spark.read.parquet(f"{folder}/model").first()
        self.spark, self.metric, self.dims = spark, m["metric"], m["dims"]
        centers = np.frombuffer(m["centers"], "<f8").reshape(-1, max(m["dims"], 1))
        self.model = Model(centers, np.frombuffer(m["books"], "<f8").reshape(m["parts"], m["words"], m["size"]))
        base = T.StructType.fromJson(json.loads(m["kind"]))
        self.carry = [f for f in base.fields if f.name not in ("base_id", "vec")]
        self.base_id = base["base_id"]
        self.rows = read(spark, folder, T.StructType([*base.fields, T.StructField("cell", T.IntegerType()), T.StructField("code", T.BinaryType())]))
        self.cells = spark.read.schema("cell int, n long").parquet(f"{folder}/cells")

    def probed(self, queries: DataFrame, query_key: str, query_vec: str, probes: int) -> DataFrame:
        """query_id, qv and each of the ``probes`` nearest cells of every query."""
        held, metric, dims = self.spark.sparkContext.broadcast(self.model), self.metric, self.dims
        src = queries.select(F.col(query_key).alias("query_id"), F.col(query_vec).cast("array<double>").alias("qv")).where(_usable("qv", dims))
        kind = T.StructType([*src.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))])

        def near(batches):
            for b in batches:
                q = _matrix(b.column("qv"), dims)
                q = _unit(q) if metric == "cosine" else q
                found = held.value.cells(q, probes).astype(np.int32) if len(q) else []
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([f.tolist() for f in found], pa.list_(pa.int32()))], names=kind.names)

        return src.mapInArrow(near, kind).select("query_id", "qv", F.explode("cells").alias("cell"))

    def workload(self, queries: DataFrame, query_key: str, query_vec: str, probes: int) -> DataFrame:
        """One row: queries, rows, pairs of a query and a row whose distance is looked up, and all pairs."""
        p = self.probed(queries, query_key, query_vec, probes)
        scored = p.groupBy("cell").agg(F.count(F.lit(1)).alias("q")).join(self.cells, "cell").agg(F.coalesce(F.sum(F.col("q") * F.col("n")), F.lit(0)).alias("pairs_scored"))
        size = self.cells.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))
        many = p.agg(F.count_distinct("query_id").alias("n_queries"))
        return many.crossJoin(size).crossJoin(scored).withColumn("pairs_all", F.col("n_queries") * F.col("n_rows"))  # one row each

    def search(self, queries: DataFrame, query_key: str, query_vec: str, k: int = 5, probes: int = 8, refine: int = 8, slice_rows: int = SLICE, block: int = BLOCK) -> DataFrame:
        """query_id, base_id, the carried columns, distance (exact) and rank of the ``k`` nearest rows found per query."""
        p = self.probed(queries, query_key, query_vec, probes)
        asked = p.groupBy("cell").agg(F.count(F.lit(1)).alias("asked"))
        # a row per probed cell: its slices of rows and blocks of queries
        plan = self.cells.join(asked, "cell").select("cell", F.ceil(F.col("n") / slice_rows).cast("int").alias("slices"), F.ceil(F.col("asked") / block).cast("int").alias("blocks"))
        plan = F.broadcast(plan)  # at most the number of cells, which the build sets
        each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        part = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
        left = self.rows.join(plan, "cell").withColumn("slice", part("base_id", "slices")).withColumn("block", each("blocks")).drop("slices", "blocks")
        right = p.join(plan, "cell").withColumn("block", part("query_id", "blocks")).withColumn("slice", each("slices")).drop("slices", "blocks")
        held, metric, dims = self.spark.sparkContext.broadcast(self.model), self.metric, self.dims
        names = [f.name for f in self.carry]
        kind = T.StructType([T.StructField("query_id", p.schema["query_id"].dataType), T.StructField("base_id", self.base_id.dataType), *self.carry, T.StructField("distance", T.DoubleType())])

        def group(keys, rows: pa.Table, asks: pa.Table) -> pa.Table:
            m = held.value
            v, q = (_matrix(t.column(c).combine_chunks(), dims) for t, c in ((rows, "vec"), (asks, "qv")))
            if not len(v) or not len(q):
                return pa.table({"query_id": asks.column("query_id").slice(0, 0), "base_id": rows.column("base_id").slice(0, 0), **{c: rows.column(c).slice(0, 0) for c in names}, "distance": pa.array([], pa.float64())})
            v, q = (_unit(x) for x in (v, q)) if metric == "cosine" else (v, q)
            codes = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint8).reshape(len(v), -1)
            center = m.centers[keys[0].as_py()]
            rest = min(len(v), refine * k)
            found_q, found_v, found_d = [], [], []
            parts = np.arange(codes.shape[1])
            for i in range(len(q)):
                table = m.tables(q[i : i + 1] - center)[0]
                near = table[parts, codes].sum(1)
                some = np.argpartition(near, rest - 1)[:rest] if rest < len(v) else np.arange(len(v))
                d = ((v[some] - q[i]) ** 2).sum(1)
                order = np.argsort(d, kind="stable")[: max(k, 1)]
                edge = d[order[-1]]
                best = np.flatnonzero(d <= edge)  # rows at the k-th distance all go on: the ranking decides by key
                found_q.append(np.full(len(best), i))
                found_v.append(some[best])
                found_d.append(d[best] / 2 if metric == "cosine" else np.sqrt(d[best]))
            at = pa.array(np.concatenate(found_v))
            return pa.table({"query_id": asks.column("query_id").take(pa.array(np.concatenate(found_q))), "base_id": rows.column("base_id").take(at), **{c: rows.column(c).take(at) for c in names}, "distance": pa.array(np.concatenate(found_d))})

        met = left.groupBy("cell", "slice", "block").cogroup(right.groupBy("cell", "slice", "block")).applyInArrow(group, kind)
        w = Window.partitionBy("query_id").orderBy("distance", "base_id")
        return met.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

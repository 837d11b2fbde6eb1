"""Helpers shared by the text operators: table access, shared scratch folders and Arrow <-> NumPy views."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklab.session import ensure_checkpoint_dir, small_batches


def unused(df: DataFrame, name: str) -> str:
    """``name``, or the first of its successors that is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder of ``scratch`` through the cluster's file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def documents(spark: SparkSession, sf_dir: str, *cols: str, table: str = "documents") -> DataFrame:
    """Columns of a fixture table (bounded Arrow batches)."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*cols)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder of the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and fixes one evaluation of the plan."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit("")).alias(col)


def strings(column) -> list[str]:
    """Python strings of an Arrow column; null is the empty text."""
    return ["" if t is None else t for t in column.to_pylist()]


def utf8(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """Bytes of all texts of an Arrow string column, and the n + 1 byte offsets of the rows; null is empty."""
    a = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(a, pa.ChunkedArray):
        a = a.combine_chunks()
    offs = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1] if len(a) else np.zeros(1, np.int64)
    data = a.buffers()[2]
    raw = data[int(offs[0]) : int(offs[-1])].to_pybytes() if data is not None else b""
    return raw, offs - offs[0]


def binary_rows(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Arrow binary column of the slices of ``data`` between byte ``offsets``."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


#: Odd multiplier of the rolling polynomial hash and the constants of its finaliser (fixed values).
P = np.uint64(0x9E3779B97F4A7C15)
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on every input bit."""
    h = (h ^ (h >> np.uint64(30))) * M1
    h = (h ^ (h >> np.uint64(27))) * M2
    return h ^ (h >> np.uint64(31))


def powers(n: int, base: np.uint64 = P) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)[:n]


P_INVERSE = np.uint64(pow(int(P), -1, 1 << 64))


class Rolling:
    """Hashes of arbitrary slices of an integer sequence from one prefix pass (modulo 2 ** 64)."""

    def __init__(self, values: np.ndarray):
        v = values.astype(np.uint64) + np.uint64(1)
        self.prefix = np.zeros(len(v) + 1, np.uint64)
        np.cumsum(mixed(v) * powers(len(v)), out=self.prefix[1:])
        self.back = powers(len(v) + 1, P_INVERSE)

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of values[start:end]; equal slices hash equal wherever they lie."""
        return mixed((self.prefix[end] - self.prefix[start]) * self.back[start] + (end - start).astype(np.uint64) * M2)


#: Bytes that separate words: blank and the ASCII controls 9 to 13 (fixed values).
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[32, 9, 10, 11, 12, 13]] = True


def word_spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word of the rows of ``data``, and the words before each row (n + 1 numbers)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~separator[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    first[cuts] = inside[cuts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = offsets[1:][offsets[1:] > 0] - 1
    last[ends] = inside[ends]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def ranges(lengths: np.ndarray) -> np.ndarray:
    """0 .. n - 1 for every n of ``lengths``, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)

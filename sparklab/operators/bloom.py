"""Bloom filters of a bounded size, built by a DataFrame aggregate and shared with the tasks of a scan."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits per value, probes, and the largest filter (log2 of its bits: 16 MB).
BITS_PER_VALUE, PROBES, LARGEST = 16, 4, 27
_MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit values whose bits all depend on all bits of ``h``."""
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


class Bloom:
    """A filter over 64-bit values: ``might_contain`` is true for all that were put in, and for few others."""

    def __init__(self, log2_bits: int, cells: np.ndarray = (), masks: np.ndarray = ()):
        self.log2_bits = log2_bits
        self.cells = np.zeros(max(1 << (log2_bits - 6), 1), np.uint64)
        if len(cells):
            self.cells[cells] = masks

    def places(self, h: np.ndarray):
        for k in range(PROBES):
            yield mixed(h + np.uint64(k)) >> np.uint64(64 - self.log2_bits)

    def put(self, h: np.ndarray) -> None:
        for at in self.places(h):
            np.bitwise_or.at(self.cells, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))

    def might_contain(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for at in self.places(h):
            out &= (self.cells[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out


def build(df: DataFrame, column: str, largest: int = LARGEST) -> Bloom:
    """The filter of a long column (nulls left out), sized by its distinct count.

    Beyond 2 ** ``largest`` bits it grows no more and lets more other values pass.  Tasks fill a filter each, and only
    the cells that are set leave them."""
    n = df.agg(F.approx_count_distinct(column)).first()[0]
    size = int(min(max(np.ceil(np.log2(max(n, 1) * BITS_PER_VALUE)), 10), largest))

    def fill(batches):
        own = Bloom(size)
        for b in batches:
            own.put(b.column(0).drop_null().to_numpy(zero_copy_only=False).view(np.uint64))
        some = np.flatnonzero(own.cells)
        for k in range(0, len(some), 100_000):
            s = some[k : k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(s.astype(np.int32)), pa.array(own.cells[s].view(np.int64))], names=["cell", "mask"])

    cells = df.select(F.col(column).cast("long")).mapInArrow(fill, "cell int, mask long").groupBy("cell").agg(F.bit_or("mask").alias("mask")).toArrow()  # bounded by the size
    return Bloom(size, cells.column("cell").to_numpy(), cells.column("mask").to_numpy().view(np.uint64))

"""Token-id files: an adaptive context-mixing range coder over independently reset, checksummed blocks.

``encode_ids`` runs the tokenizers library, ``write`` stores the ids of all documents in ascending order of their key,
``read`` brings them back.  A file is a Parquet folder on the cluster's storage; each row (a group) holds whole
documents whose ids are cut into blocks of ``BLOCK`` ids.  Every block starts from the same model state and carries a
CRC-32 of its ids, so any group, and any block in it, decodes alone and damage is found where it lies.

The model of a block keeps three predictions of the next id: order 2 (the id that last followed the last two ids),
order 1 (the last one) and order 0 (the id of the last literal).  An arithmetic-coded choice says which prediction is
right, or none; its distribution is the mixture of three adaptive distributions, one per order and its confidence,
under weights that follow each order's success.  An id that nobody predicted is a literal: two nibbles under
adaptive order-0 distributions, then its low byte.  The blocks of a group are coded in lockstep as NumPy lanes, one
step of arithmetic for all of them; all of it is integer arithmetic, so every machine decodes alike.

Defined cases: null and empty texts have only the end id; ties of the key are stored in any order; extra columns are
not stored; a document of more than a group's ids makes a larger group; an empty table gives an empty file; ids lie
below 65,536.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklab.llm.common import strings

#: Ids of a block, and the ids after which a group of blocks (one row of the file) closes.
BLOCK, GROUP = 2048, 4_000_000
#: Slots of a block's order-1 and order-2 tables.
SLOTS = 2048
#: Words that a worker remembers the ids of (memory bound only).
MEMO = 600_000

TOP, BOTTOM = np.uint64(1 << 48), np.uint64(1 << 40)
WORD, SHIFT = np.uint64(16), np.uint64(48)
#: Distributions are cumulative over 2 ** BITS; the last byte of a literal is coded flat.
BITS, FLAT = 14, 8
SCALE = 1 << BITS


def _target(symbols: int, least: int) -> np.ndarray:
    """Where a cumulative distribution moves after a symbol: all ends behind it up, but for a floor for each symbol."""
    j = np.arange(symbols + 1)
    return np.array([np.where(j > s, SCALE - least * (symbols - j), least * j) for s in range(symbols)], np.int16)


TARGET, NIBBLE = _target(4, 32), _target(16, 32)


class Lanes:
    """The model and the arithmetic of many blocks in lockstep; ``n`` blocks begin in the same state."""

    def __init__(self, n: int):
        self.n, self.row = n, np.arange(n)
        self.low = np.zeros(n, np.uint64)
        self.range = np.full(n, (1 << 64) - 1, np.uint64)
        # cumulative distributions: of the choice by (order, confidence), of a literal's first two nibbles
        self.choice = np.empty((3, n * 4, 5), np.int16)
        self.choice[:] = np.array([0, SCALE // 4, SCALE // 2, SCALE * 5 // 8, SCALE])
        self.nibble1, self.nibble2 = np.empty((n, 17), np.int16), np.empty((n * 16, 17), np.int16)
        self.nibble1[:] = self.nibble2[:] = np.arange(17) * (SCALE // 16)
        self.weight = np.full((3, n), 1 << 10, np.int32)
        self.first, self.second = np.zeros(n * SLOTS, np.uint16), np.zeros(n * SLOTS, np.uint16)
        self.sure1, self.sure2 = np.zeros(n * SLOTS, np.uint8), np.zeros(n * SLOTS, np.uint8)
        self.last, self.before, self.literal, self.streak = (np.zeros(n, np.int32) for _ in range(4))

    def narrow(self, n: int) -> None:
        """Keep the first ``n`` lanes: the others have ended."""
        if n == self.n:
            return
        for k in ("low", "range", "last", "before", "literal", "streak", "nibble1"):
            setattr(self, k, getattr(self, k)[:n])
        self.choice, self.weight = self.choice[:, : n * 4], self.weight[:, :n]
        self.n, self.row = n, self.row[:n]

    def predict(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The ids predicted by orders 2, 1 and 0, and the mixed distribution of the choice among them."""
        base = self.row * SLOTS
        near = self.last * 40503
        self.at1 = base + ((near >> 3) & (SLOTS - 1))
        self.at2 = base + (((near + self.before * 30011) >> 2) & (SLOTS - 1))
        c2, c1 = self.second[self.at2].astype(np.int32), self.first[self.at1].astype(np.int32)
        four = self.row * 4
        self.ctx = (four + self.sure2[self.at2], four + self.sure1[self.at1], four + self.streak)
        self.rows = [self.choice[k].take(self.ctx[k], axis=0) for k in range(3)]
        mix = self.rows[0] * self.weight[0][:, None]
        mix += self.rows[1] * self.weight[1][:, None]
        mix += self.rows[2] * self.weight[2][:, None]
        mix //= self.weight.sum(axis=0, dtype=np.int32)[:, None]
        return c2, c1, self.literal, mix

    def learn(self, choice: np.ndarray, ids: np.ndarray, c2: np.ndarray, c1: np.ndarray) -> None:
        """Update the distributions, the weights and the tables by what was coded."""
        target = TARGET.take(choice, axis=0)
        flat = self.row * 5 + choice
        for k in range(3):
            r, w = self.rows[k], self.weight[k]
            ends = r.reshape(-1)
            w += (((ends.take(flat + 1) - ends.take(flat)) >> 2) - w) >> 5
            np.maximum(w, 16, out=w)
            self.choice[k][self.ctx[k]] = r + ((target - r) >> 4)
        for table, sure, at, old in ((self.second, self.sure2, self.at2, c2), (self.first, self.sure1, self.at1, c1)):
            s = sure[at]
            right = old == ids
            keep = ~right & (s > 1)
            table[at] = np.where(keep, old, ids)
            sure[at] = np.where(right, np.minimum(s + 1, 3), np.where(keep, s - 1, 0))
        self.streak = np.where(choice == 3, 0, np.minimum(self.streak + 1, 3))
        self.before, self.last = self.last, ids


class Encoder(Lanes):
    def __init__(self, n: int, longest: int):
        super().__init__(n)
        self.out = np.zeros((n, 2 * longest + 16), np.uint16)
        self.size = np.zeros(n, np.int64)

    def code(self, rows: np.ndarray, start: np.ndarray, width: np.ndarray, bits: int) -> None:
        """Narrow the interval of the lanes ``rows`` to [start, start + width) of 2 ** bits; emit the settled words."""
        rng = self.range[rows] >> np.uint64(bits)
        low = self.low[rows] + rng * start.astype(np.uint64)
        rng *= width.astype(np.uint64)
        while True:
            self.low[rows], self.range[rows] = low, rng
            settled = (low ^ (low + rng)) < TOP
            go = np.flatnonzero(settled | (rng < BOTTOM))
            if not len(go):
                return
            low, rng, rows, settled = low[go], rng[go], rows[go], settled[go]
            rng = np.where(settled, rng, (np.uint64(0) - low) & (BOTTOM - np.uint64(1)))
            size = self.size[rows]
            self.out[rows, size] = low >> SHIFT
            self.size[rows] = size + 1
            low <<= WORD
            rng <<= WORD

    def step(self, ids: np.ndarray) -> None:
        c2, c1, c0, mix = self.predict()
        choice = np.where(ids == c2, 0, np.where(ids == c1, 1, np.where(ids == c0, 2, 3)))
        ends, at = mix.reshape(-1).astype(np.int64), self.row * 5 + choice
        start = ends.take(at)
        width = (ends.take(at + 1) - start) << BITS
        start <<= BITS
        lanes = np.flatnonzero(choice == 3)
        value = ids[lanes]
        # the choice of a literal and its first nibble are one step of arithmetic
        one, rows = value >> 12, self.nibble1.take(lanes, axis=0)
        flat, at = rows.reshape(-1), np.arange(len(lanes)) * 17
        begin = flat.take(at + one).astype(np.int64)
        share = width[lanes] >> BITS
        start[lanes] += begin * share
        width[lanes] = (flat.take(at + one + 1) - begin) * share
        self.code(self.row, start, width, 2 * BITS)
        self.nibble1[lanes] = rows + ((NIBBLE.take(one, axis=0) - rows) >> 4)
        # so are its second nibble and the flat byte
        two, under = (value >> 8) & 15, lanes * 16 + one
        rows = self.nibble2.take(under, axis=0)
        flat = rows.reshape(-1)
        begin = flat.take(at + two).astype(np.int64)
        wide = flat.take(at + two + 1) - begin
        self.code(lanes, (begin << FLAT) + (value & 255) * wide, wide, BITS + FLAT)
        self.nibble2[under] = rows + ((NIBBLE.take(two, axis=0) - rows) >> 4)
        self.literal[lanes] = value
        self.learn(choice, ids, c2, c1)

    def finish(self, lanes: slice) -> None:
        """Emit what tells the last interval of ``lanes`` from its neighbours."""
        rows = self.row[lanes]
        for k in range(4):
            self.out[rows, self.size[rows]] = (self.low[lanes] >> np.uint64(48 - 16 * k)).astype(np.uint16)
            self.size[rows] += 1


class Decoder(Lanes):
    def __init__(self, words: np.ndarray, at: np.ndarray):
        super().__init__(len(at))
        self.words, self.at = np.concatenate([words, np.zeros(8, np.uint16)]).astype(np.uint64), at.astype(np.int64).copy()
        self.value = np.zeros(self.n, np.uint64)
        for _ in range(4):
            self.value = (self.value << WORD) | self.words[self.at]
            self.at += 1

    def narrow(self, n: int) -> None:
        if n != self.n:
            self.value, self.at = self.value[:n], self.at[:n]
        super().narrow(n)

    def target(self, rows: np.ndarray, bits: int) -> np.ndarray:
        """Where the values lie in their intervals, of 2 ** bits."""
        return np.minimum((self.value[rows] - self.low[rows]) // (self.range[rows] >> np.uint64(bits)), np.uint64((1 << bits) - 1)).astype(np.int64)

    def take(self, rows: np.ndarray, start: np.ndarray, width: np.ndarray, bits: int) -> None:
        """Narrow as the encoder did, and read as many words as it emitted."""
        rng = self.range[rows] >> np.uint64(bits)
        low = self.low[rows] + rng * start.astype(np.uint64)
        rng *= width.astype(np.uint64)
        while True:
            self.low[rows], self.range[rows] = low, rng
            settled = (low ^ (low + rng)) < TOP
            go = np.flatnonzero(settled | (rng < BOTTOM))
            if not len(go):
                return
            low, rng, rows, settled = low[go], rng[go], rows[go], settled[go]
            rng = np.where(settled, rng, (np.uint64(0) - low) & (BOTTOM - np.uint64(1)))
            at = self.at[rows]
            self.value[rows] = (self.value[rows] << WORD) | self.words.take(at, mode="clip")
            self.at[rows] = at + 1
            low <<= WORD
            rng <<= WORD

    def step(self) -> np.ndarray:
        c2, c1, c0, mix = self.predict()
        t = self.target(self.row, 2 * BITS)
        choice = (mix[:, 1:4] <= (t >> BITS).astype(np.int32)[:, None]).sum(axis=1)
        ends, at = mix.reshape(-1).astype(np.int64), self.row * 5 + choice
        start = ends.take(at)
        width = (ends.take(at + 1) - start) << BITS
        start <<= BITS
        ids = np.where(choice == 0, c2, np.where(choice == 1, c1, c0))
        lanes = np.flatnonzero(choice == 3)
        rows, share = self.nibble1.take(lanes, axis=0), width[lanes] >> BITS
        inner = ((t[lanes] - start[lanes]) // share).astype(np.int16)
        one = (rows[:, 1:] <= inner[:, None]).sum(axis=1)
        flat, at = rows.reshape(-1), np.arange(len(lanes)) * 17
        begin = flat.take(at + one).astype(np.int64)
        start[lanes] += begin * share
        width[lanes] = (flat.take(at + one + 1) - begin) * share
        self.take(self.row, start, width, 2 * BITS)
        self.nibble1[lanes] = rows + ((NIBBLE.take(one, axis=0) - rows) >> 4)
        under = lanes * 16 + one
        rows = self.nibble2.take(under, axis=0)
        t = self.target(lanes, BITS + FLAT)
        two = (rows[:, 1:] <= (t >> FLAT).astype(np.int16)[:, None]).sum(axis=1)
        flat = rows.reshape(-1)
        begin = flat.take(at + two).astype(np.int64)
        wide = flat.take(at + two + 1) - begin
        byte = (t - (begin << FLAT)) // wide
        self.take(lanes, (begin << FLAT) + byte * wide, wide, BITS + FLAT)
        self.nibble2[under] = rows + ((NIBBLE.take(two, axis=0) - rows) >> 4)
        ids[lanes] = self.literal[lanes] = one << 12 | two << 8 | byte
        self.learn(choice, ids, c2, c1)
        return ids


def _shape(n: int, block: int) -> np.ndarray:
    """Ids of each block of ``n`` ids: all full but the last."""
    sizes = np.full(-(-n // block), block, np.int64)
    if n % block:
        sizes[-1] = n % block
    return sizes


def compress(ids: np.ndarray, block: int = BLOCK) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The coded blocks of ``ids`` (below 65,536), one after the other, their bytes and their CRC-32."""
    sizes = _shape(len(ids), block)
    if not len(sizes):
        return b"", np.zeros(0, np.int32), np.zeros(0, np.int64)
    grid = np.zeros((len(sizes), block), np.int32)
    grid.reshape(-1)[: len(ids)] = ids
    coder = Encoder(len(sizes), block)
    columns = np.ascontiguousarray(grid.T)
    for k in range(block):
        if k == sizes[-1]:
            coder.finish(slice(len(sizes) - 1, len(sizes)))
            coder.narrow(len(sizes) - 1)
            if not coder.n:
                break
        coder.step(columns[k, : coder.n])
    coder.finish(slice(0, coder.n))
    size = coder.size
    crc = np.array([zlib.crc32(grid[k, : sizes[k]].astype("<u4").tobytes()) for k in range(len(sizes))], np.int64)
    return b"".join(coder.out[k, : size[k]].astype("<u2").tobytes() for k in range(len(sizes))), (size * 2).astype(np.int32), crc


def expand(payload: bytes, sizes: np.ndarray, crc: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ids of ``compress``; a block whose ids do not give its CRC-32 raises an error that names it."""
    shape = _shape(n, block)
    if not len(shape):
        return np.zeros(0, np.int32)
    ends = np.cumsum(sizes.astype(np.int64)) // 2
    coder = Decoder(np.frombuffer(payload, "<u2"), ends - sizes // 2)
    columns = np.zeros((block, len(shape)), np.int32)
    for k in range(block):
        if k == shape[-1]:
            coder.narrow(len(shape) - 1)
            if not coder.n:
                break
        columns[k, : coder.n] = coder.step()
    grid = np.ascontiguousarray(columns.T)
    for k in range(len(shape)):
        if zlib.crc32(grid[k, : shape[k]].astype("<u4").tobytes()) != crc[k]:
            raise ValueError(f"block {k} is damaged: its checksum differs")
    return grid.reshape(-1)[:n]


class _Words(dict):
    """Ids of words, as the library encodes them (white space separates words for good in its pattern)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.mark_id, added = max(self.library.get_added_tokens_decoder().items())
        self.mark = added.content

    def ids(self, texts: list[str], end: int | None) -> list[bytes]:
        words = [t.split() if ODD_SPACE.search(t) is None else [w for w in BLANKS.split(t) if w] for t in texts]
        if len(self) > MEMO:
            self.clear()
        new = [*set(chain.from_iterable(words)).difference(self)]
        plain = [w for w in new if self.mark not in w]
        # a special token between two words keeps them apart and shows where each one's ids end; offsets are not needed
        for k in range(0, len(plain), 20_000):
            part = plain[k : k + 20_000]
            found = np.array(self.library.encode_batch_fast([self.mark.join(part)], add_special_tokens=False)[0].ids, "<u2")
            cuts = [0, *(2 * np.flatnonzero(found == self.mark_id)).tolist(), 2 * len(found)]
            raw = found.tobytes()
            self.update((w, raw[a + 2 * (k > 0) : b]) for k, (w, a, b) in enumerate(zip(part, cuts, cuts[1:])))
        for w in set(new).difference(plain):
            self[w] = np.array(self.library.encode(w, add_special_tokens=False).ids, "<u2").tobytes()
        tail = b"" if end is None else np.array([end], "<u2").tobytes()
        return [b"".join(map(self.__getitem__, w)) + tail for w in words]


#: White space other than the blank and the ASCII controls 9 to 13, at which str.split would cut too.
ODD_SPACE = re.compile(r"[^\S \t-\r]")
BLANKS = re.compile(r"[ \t-\r]")


@functools.lru_cache(2)
def words(path: str) -> _Words:
    return _Words(path)


def encode_ids(texts: list[str], path: str, end: int | None) -> list[bytes]:
    """Ids of texts as little-endian 16-bit integers, ``end`` appended.

    The vocabularies meant here (word-end BPE behind a pattern that drops white space) treat every word alike wherever
    it stands, so each new word goes through the library once per worker."""
    return words(path).ids(texts, end)


SCHEMA = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("group", T.IntegerType()), T.StructField("n_ids", T.LongType()), T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("lengths", T.ArrayType(T.IntegerType())), T.StructField("block", T.IntegerType()), T.StructField("sizes", T.ArrayType(T.IntegerType())), T.StructField("crc32", T.ArrayType(T.LongType())), T.StructField("payload", T.BinaryType())])


def write(docs: DataFrame, folder: str, path: str, key: str = "doc_id", text: str = "text", end: int | None = 1, block: int = BLOCK, group: int = GROUP) -> None:
    """Encode the texts and write the ids in ascending order of ``key`` (a long) to ``folder``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at, keys, ids, n = TaskContext.get().partitionId(), 0, [], [], 0

        def row():
            every = np.frombuffer(b"".join(ids), "<u2")
            payload, sizes, crc = compress(every, block)
            columns = ([part], [at], [len(every)], [keys], [[len(x) // 2 for x in ids]], [block], [sizes.tolist()], [crc.tolist()], [payload])
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary()))], names=SCHEMA.names)

        for b in batches:
            for k, x in zip(b.column(key).to_pylist(), encode_ids(strings(b.column(text)), path, end)):
                keys.append(k)
                ids.append(x)
                n += len(x) // 2
                if n >= group:
                    yield row()
                    at, keys, ids, n = at + 1, [], [], 0
        if keys:
            yield row()

    ordered = docs.select(key, text).repartitionByRange(key).sortWithinPartitions(key)
    ordered.mapInArrow(run, SCHEMA).write.parquet(folder)


def read(spark: SparkSession, folder: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """The documents of a file: ``key``, ``start`` (ids before the document), ``n_tokens``, ``ids_crc32`` (CRC-32 of
    the ids as little-endian 32-bit integers) and ``ids`` (those bytes)."""
    rows = spark.read.schema(SCHEMA).parquet(folder)
    # parts are as many as the range partitions: their totals, not the rows, meet in one task
    totals = rows.groupBy("part").agg(F.sum("n_ids").alias("n"))
    totals = totals.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    within = Window.partitionBy("part").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.select("part", "group", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("skipped")).join(totals, "part").select("part", "group", (F.col("before") + F.col("skipped")).alias("first"))
    out = T.StructType([T.StructField(key, T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("group", T.IntegerType()), T.StructField("offset", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField(ids, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                every = expand(r["payload"], np.array(r["sizes"], np.int64), np.array(r["crc32"], np.int64), r["n_ids"], r["block"]).astype("<u4")
                n = np.array(r["lengths"], np.int64)
                offs = np.concatenate([[0], np.cumsum(n)])
                raw = memoryview(every.tobytes())
                texts = [raw[4 * a : 4 * z] for a, z in zip(offs.tolist(), offs[1:].tolist())]
                for k in range(0, len(n), 2000):
                    some = slice(k, k + 2000)
                    m = len(n[some])
                    yield pa.RecordBatch.from_arrays([pa.array(r["keys"][some], pa.int64()), pa.array([r["part"]] * m, pa.int32()), pa.array([r["group"]] * m, pa.int32()), pa.array(offs[:-1][some]), pa.array(n[some]), pa.array([zlib.crc32(x) for x in texts[some]], pa.int64()), pa.array([bytes(x) for x in texts[some]], pa.binary())], names=out.names)

    found = rows.mapInArrow(run, out)
    return found.join(starts, ["part", "group"]).select(key, (F.col("first") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", ids)

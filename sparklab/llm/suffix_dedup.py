"""Suffix-array deduplication by external induced sorting.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts earlier in the corpus (smaller key, or the same
document before).  Strings are judged on the input and never cross documents.

Shards.  Every string of ``LENGTH`` bytes has an anchor, its ``GRAM``-byte gram of the smallest hash (the leftmost of
equals).  Strings that share one occurrence of an anchor lie in one segment of the text, less than 2 * ``LENGTH``
bytes; equal strings have equal anchors, so segments dealt out by their anchor bring equal strings together.

Naming.  As in induced sorting, equal substrings get one name before anything is sorted: equal segments (by two hashes)
are one, and only the first of them can keep a string; all strings of the others have an earlier start.  Names are
summed inside each batch before the shuffle, so a name in a third of all texts arrives once per batch.  Spark sorts the
segments by anchor and name on disk, and a task reads them in that order, one batch at a time.

Frequent anchors.  An anchor of more than ``HOT`` segments is not sorted: it would meet in one task.  Its segments are
cut into their strings, each a segment of its own that is named and dealt out by the whole string.  ``CELLS`` counts
bound the segments of every anchor from above; anchors are counted one by one only where that bound is passed.

Induced sorting.  First segments whose anchor has several names are sorted by suffixes: the order of the suffixes at a
column is induced from the order at the next column, recursively from the segments' ends.  The tuples (segment, common
prefix with the tuple before) pass through a queue keyed by the byte in front, first in, first out; the common prefix
with the last tuple of the same byte is one more than the smallest on the way.  A task takes whole anchors up to about
``GROUP`` bytes at a time, so what it holds does not grow with its shard; queues and segments beyond ``HELD`` tuples
live in files of the worker's temporary folder, which go with it.  At each column, successive tuples that have
``LENGTH`` bytes in common hold one string; all but its first start are repeats.

Defined cases: null and empty texts and texts shorter than ``LENGTH`` lose nothing; a null key counts as the largest;
rows of the same key are ordered by a hash of their text, and rows of the same key and text are one document, of which
each row gets what is left; extra columns are not carried; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklab.llm.common import M2, P, Rolling, mixed, powers, ranges, utf8, written

LENGTH, GRAM = 100, 24
#: Tuples that a queue holds in memory.
HELD = 2_000_000
#: Bytes of segments that a task sorts at once, about, and the segments of an anchor that fit in (of 176 bytes at most).
GROUP = 16 << 20
HOT = GROUP // 176
CELLS = 1 << 18
LAST = (1 << 63) - 1


def anchors(raw: bytes, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Segments of the rows: row, first string start (in the batch), number of strings, anchor place, anchor hash."""
    data = np.frombuffer(raw, np.uint8)
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none.astype(np.uint64)
    one = data.astype(np.uint64) + np.uint64(1)
    h, done = one, 1
    for bit in bin(gram)[3:]:
        h, done = h[:-done] * powers(done + 1)[done] + h[done:], 2 * done
        if bit == "1":
            h, done = h[:-1] * P + one[done:], done + 1
    h = mixed(h)
    # smallest (hash, place) of the grams of every string, by doubling
    least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    span, width = 1, length - gram + 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # strings inside one row
    n = np.maximum(np.diff(offsets) - length + 1, 0)
    start = np.repeat(offsets[:-1], n) + ranges(n)
    row = np.repeat(np.arange(len(n)), n)
    place = place[start]
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    return row[first], start[first], np.diff(np.append(first, len(start))), place[first], h[place[first]]


class Queue:
    """First in, first out for each symbol; chunks beyond the memory bound go to a file."""

    def __init__(self, symbols: int, held: int):
        self.chunks: list[list] = [[] for _ in range(symbols)]
        self.held, self.size, self.file = held, 0, None

    def put(self, symbol: int, rows: np.ndarray) -> None:
        self.size += len(rows)
        if self.size <= self.held:
            self.chunks[symbol].append(rows)
            return
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.chunks[symbol].append((self.file.seek(0, 2), len(rows)))
        self.file.write(rows.tobytes())

    def drain(self) -> Iterator[np.ndarray]:
        """All tuples by symbol, in the order they came; the queue keeps them."""
        some: list[np.ndarray] = []
        n = 0
        for chunks in self.chunks:
            for c in chunks:
                if isinstance(c, tuple):
                    self.file.seek(c[0])
                    c = np.frombuffer(self.file.read(8 * c[1]), np.int64)
                some.append(c)
                n += len(c)
                if n >= self.held // 2:
                    yield np.concatenate(some)
                    some, n = [], 0
        if some:
            yield np.concatenate(some)

    def close(self) -> None:
        self.chunks = []
        if self.file is not None:
            self.file.close()


class Shard:
    """Segments aligned at their anchors, column by column: 0 is no byte, others are the byte + 1."""

    def __init__(self, segments: list[np.ndarray], left: np.ndarray, strings: np.ndarray, length: int, held: int):
        """``segments``: bytes of each; ``left``: bytes before the anchor; ``strings``: strings that start in it."""
        self.left, self.strings, self.length, self.held = left, strings, length, held
        size = np.array([len(s) for s in segments], np.int64)
        self.before, self.after = int(left.max()), int((size - left).max())
        shape = (self.before + self.after, len(segments))
        big = shape[0] * shape[1] > 64 * held
        self.columns = np.memmap(tempfile.TemporaryFile(), np.uint16, "w+", shape=shape) if big else np.zeros(shape, np.uint16)
        for k in range(0, len(segments), 4096):
            some = slice(k, k + 4096)
            flat = np.concatenate(segments[some]).astype(np.uint16) + 1
            n = size[some]
            self.columns[ranges(n) + np.repeat(self.before - left[some], n), np.repeat(np.arange(k, k + len(n)), n)] = flat

    def repeats(self, rank: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(segments, string starts in them) of all strings but the first of each kind; ``rank`` orders the segments
        by where they start in the corpus (less their anchor's distance)."""
        n = self.columns.shape[1]
        # a tuple is common prefix << 40 | segment
        queue = Queue(1, self.held)
        for k in range(0, n, self.held):
            queue.put(0, np.arange(k, min(k + self.held, n), dtype=np.int64))
        for column in range(self.before + self.after - 1, -1, -1):
            symbol = self.columns[column]
            after = Queue(257, self.held)
            way = np.full(257, -1, np.int64)  # smallest common prefix since the last tuple of each symbol
            for rows in queue.drain():
                segment, common = rows & ((1 << 40) - 1), rows >> 40
                s = symbol[segment]
                order = np.argsort(s, kind="stable")
                grouped = s[order]
                cuts = np.flatnonzero(np.concatenate([[True], grouped[1:] != grouped[:-1]]))
                present = grouped[cuts]
                rest = np.where(way >= 0, np.minimum(way, common.min()), -1)
                for k, a, z in zip(present.tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(order)]):
                    at = order[a:z]
                    if k:
                        got = np.empty(len(at), np.int64)
                        got[0] = 0 if way[k] < 0 else 1 + min(int(way[k]), int(common[: at[0] + 1].min()))
                        if len(at) > 1:
                            got[1:] = 1 + np.minimum.reduceat(common[: at[-1] + 1], at[:-1] + 1)
                    else:
                        got = np.zeros(len(at), np.int64)
                    after.put(k, segment[at] | got << 40)
                    rest[k] = common[at[-1] + 1 :].min() if at[-1] + 1 < len(common) else 1 << 20
                way = rest
            queue.close()
            queue = after
            d = self.before - column  # bytes from here to the anchor
            if d >= 0:
                yield from self.again(queue, d, rank)
        queue.close()

    def again(self, queue: Queue, d: int, rank: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of a column's tuples with equal strings, all but the one of the smallest rank."""
        held = None  # the first one so far of a string that the next chunk may go on with: (segment, start, rank)
        for rows in queue.drain():
            segment, common = rows & ((1 << 40) - 1), rows >> 40
            start = self.left[segment] - d
            label = np.cumsum(common < self.length)
            some = (start >= 0) & (start < self.strings[segment])
            segment, start, label = segment[some], start[some], label[some]
            if held is not None:
                segment, start, label = (np.concatenate([[x], y]) for x, y in zip((*held, 0), (segment, start, label)))
            if not len(segment):
                continue
            order = np.lexsort((rank[segment], label))
            first = np.ones(len(order), bool)
            first[1:] = label[order][1:] != label[order][:-1]
            yield segment[order[~first]], start[order[~first]]
            at = order[first][-1]
            held = (segment[at], start[at])


RUN = "id long, tie long, run long"
#: A segment: of one anchor, with its place, the strings that start in it and the bytes before the anchor.
SEGMENT = "anchor long, name long, id long, tie long, at int, strings short, left short"
NAMES = [c.split()[0] for c in SEGMENT.split(", ")]


def _runs(id_: np.ndarray, tie: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(id_.astype(np.int64)), pa.array(tie.astype(np.int64)), pa.array((start.astype(np.int64) << 32) | end.astype(np.int64))], names=["id", "tie", "run"])


def _spans(id_: np.ndarray, tie: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    """Runs of which those of one document that overlap or touch are one."""
    order = np.lexsort((end, start, tie, id_))
    id_, tie, start, end = id_[order], tie[order], start[order], end[order]
    other = np.ones(len(order), bool)
    other[1:] = (id_[1:] != id_[:-1]) | (tie[1:] != tie[:-1])
    # the furthest end so far within the document: documents are set apart by a base that grows
    base = (np.cumsum(other) - 1) * (np.int64(end.max()) + 1)
    far = np.maximum.accumulate(end + base)
    new = other.copy()
    new[1:] |= start[1:] + base[1:] > far[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(order)) - 1
    return _runs(id_[first], tie[first], start[first], far[last] - base[last])


def _first_of_names(anchor, name, id_, tie, at):
    """Sorting order by anchor, name and place, and which rows of it are the first of their name; of equal places, which
    repeated rows give, the order holds one."""
    order = np.lexsort((at, tie, id_, name, anchor))
    new = np.ones(len(order), bool)
    new[1:] = np.any([x[order][1:] != x[order][:-1] for x in (anchor, name, id_, tie, at)], axis=0)
    order = order[new]
    first = np.ones(len(order), bool)
    first[1:] = (anchor[order][1:] != anchor[order][:-1]) | (name[order][1:] != name[order][:-1])
    return order, first


def _merged(anchor, name, id_, tie, at, strings, left, length: int, kind: list[str]) -> Iterator[pa.RecordBatch]:
    """The first segments of each name of a batch, and the runs of the others (no ``anchor``; ``run_id`` and so on)."""
    order, first = _first_of_names(anchor, name, id_, tie, at)
    again, some = order[~first], order[first]
    if len(again):
        runs = _spans(id_[again], tie[again], at[again], at[again] + strings[again] - 1 + length)
        none = pa.nulls(runs.num_rows)
        yield pa.RecordBatch.from_arrays([*(none.cast(t) for t in (*[pa.int64()] * 4, pa.int32(), pa.int16(), pa.int16())), *runs.columns, *[none.cast(pa.binary())] * (len(kind) - 10)], names=kind)
    cols = [pa.array(x[some].astype(k)) for x, k in zip((anchor, name, id_, tie, at, strings, left), (*["i8"] * 4, "i4", "i2", "i2"))]
    none = pa.nulls(len(some))
    yield pa.RecordBatch.from_arrays([*cols, *[none.cast(pa.int64())] * 3, *[none.cast(pa.binary())] * (len(kind) - 10)], names=kind)


def _named(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """The segments of all documents; equal ones of a batch are one (the others are runs); and per task the counts of
    the cells of its anchors (``cells``)."""
    kind = [*NAMES, "run_id", "run_tie", "run", "cells"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, np.int64)
        for b in batches:
            raw, offs = utf8(b.column("text"))
            row, start, strings, place, h = anchors(raw, offs, length, gram)
            if not len(row):
                continue
            name = mixed(Rolling(np.frombuffer(raw, np.uint8)).slices(start, start + strings - 1 + length) + M2 * (place - start).astype(np.uint64)).view(np.int64)
            id_, tie = (b.column(c).to_numpy()[row] for c in ("id", "tie"))
            for out in _merged(h.view(np.int64), name, id_, tie, start - offs[row], strings, place - start, length, kind):
                some = out.column("anchor").drop_null().to_numpy().view(np.uint64)
                counts += np.bincount((some >> np.uint64(46)).astype(np.int64), minlength=CELLS)
                yield out
        at = np.flatnonzero(counts)
        if len(at):
            none = pa.nulls(1)
            yield pa.RecordBatch.from_arrays([*(none.cast(t) for t in (*[pa.int64()] * 4, pa.int32(), pa.int16(), pa.int16(), *[pa.int64()] * 3)), pa.array([np.stack([at, counts[at]]).astype("<i4").tobytes()], pa.binary())], names=kind)

    return docs.select("id", "tie", "text").mapInArrow(run, f"{SEGMENT}, run_id long, run_tie long, run long, cells binary")


def _frequent(named: DataFrame, hot: int) -> DataFrame | None:
    """The anchors of more than ``hot`` segments; None if there are none."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for b in batches:
            for x in b.column("cells").to_pylist():
                at, n = np.frombuffer(x, "<i4").reshape(2, -1)
                total[at] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

    cells = named.where("cells is not null").select("cells").mapInArrow(add, "cell long, n long")
    over = written(cells.groupBy("cell").agg(F.sum("n").alias("n")).where(F.col("n") > hot).select("cell"), "dedup-cells")
    if over.isEmpty():
        return None
    some = named.where("anchor is not null").select("anchor", F.shiftrightunsigned("anchor", 46).alias("cell")).join(F.broadcast(over), "cell", "left_semi")
    found = written(some.groupBy("anchor").count().where(F.col("count") > hot).select("anchor"), "dedup-frequent")
    return None if found.isEmpty() else found


def _firsts(segments: DataFrame, length: int, shards: list[int]) -> DataFrame:
    """Runs of segments whose name has an earlier start (``run``), and the first segments of anchors with several names
    or with ``frequent`` set (``anchor``, ``strings``, ``left`` set; their place is the run)."""
    kind = ["id", "tie", "run", "anchor", "strings", "left", "frequent"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(x, several, first):
            """``several`` and ``first`` are masks of the rows ``x``."""
            some = several | ~first
            anchor, _, id_, tie, at, strings, left, frequent = x[:, some]
            own = lambda y: pa.array(y, pa.int64(), mask=~first[some])
            return pa.RecordBatch.from_arrays([*_runs(id_, tie, at, at + strings - 1 + length).columns, own(anchor), own(strings), own(left), own(frequent)], names=kind)

        held, known = None, False  # the last first segment so far, and whether another name of its anchor came before it
        for b in batches:
            if not b.num_rows:
                continue
            anchor, name, id_, tie, place = (b.column(c).to_numpy() for c in ("anchor", "name", "id", "tie", "place"))
            x = np.stack([anchor, name, id_, tie, place >> 24 & 0xFFFFFFFF, place >> 12 & 0xFFF, place & 0xFFF, place >> 56])
            if held is not None:
                x = np.concatenate([held, x], axis=1)
            order, first = _first_of_names(*x[:5])
            x = x[:, order]
            at = np.flatnonzero(first)
            same = x[0, at[1:]] == x[0, at[:-1]]
            before = np.concatenate([[known], same])
            several = np.zeros(len(first), bool)
            several[at] = before | np.concatenate([same, [False]]) | (x[7, at] == 1)
            held, known = x[:, at[-1:]], bool(before[-1])
            first[at[-1]], several[at[-1]] = True, False
            yield out(x, several, first)
        if held is not None:
            yield out(held, np.array([known or held[7, 0] == 1]), np.array([True]))

    # one number for frequent, at, strings and left: fewer bytes to shuffle
    place = sum((F.shiftleft(F.col(c).cast("long"), k) for c, k in (("frequent", 56), ("at", 24), ("strings", 12))), F.col("left").cast("long"))
    # the names of a frequent anchor go to different tasks
    dealt = segments.select("anchor", "name", "id", "tie", place.alias("place")).repartition(*shards, "anchor", F.when(F.col("place") >= 1 << 56, F.col("name"))).sortWithinPartitions("anchor", "name", "id", "tie", "place")
    return dealt.mapInArrow(run, f"{RUN}, anchor long, strings long, left long, frequent long")


def _texts(docs: DataFrame, segments: DataFrame) -> DataFrame:
    """The documents of the segments with a list of them; repeated rows come once."""
    lists = segments.groupBy("id", "tie").agg(F.collect_list(F.struct("run", "anchor", "strings", "left")).alias("segments"))
    return docs.select("id", "tie", "text").dropDuplicates(["id", "tie"]).join(lists, ["id", "tie"]).select("id", "tie", "text", "segments")


def _listed(b: pa.RecordBatch):
    """Bytes of a batch of ``_texts``, and of each segment: row, start in the bytes, run, anchor, strings, left."""
    raw, offs = utf8(b.column("text"))
    rows = b.column("segments")
    flat = rows.flatten()
    row = np.repeat(np.arange(b.num_rows), np.diff(rows.offsets.to_numpy()))
    run, anchor, strings, left = (flat.field(k).to_numpy() for k in range(4))
    return raw, offs, row, offs[row] + (run >> 32), run, anchor, strings, left


def _cut(docs: DataFrame, segments: DataFrame) -> DataFrame:
    """The bytes of the segments to be sorted, from the documents."""
    kind = f"{RUN}, anchor long, strings long, left long, bytes binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offs, row, start, place, anchor, strings, left = _listed(b)
            a, z = start.tolist(), (offs[row] + (place & 0xFFFFFFFF)).tolist()
            id_, tie = (b.column(c).to_numpy()[row] for c in ("id", "tie"))
            yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in (id_, tie, place, anchor, strings, left)), pa.array([raw[x:y] for x, y in zip(a, z)], pa.binary())], names=[c.split()[0] for c in kind.split(", ")])

    return _texts(docs, segments).mapInArrow(run, kind)


def _strings(docs: DataFrame, segments: DataFrame, length: int) -> DataFrame:
    """Every string of the segments as a segment; equal ones of a batch are one (the others are runs)."""
    kind = [*NAMES, "run_id", "run_tie", "run"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offs, row, start, _, anchor, strings, left = _listed(b)
            if not len(row):
                continue
            k = ranges(strings)
            row, start, anchor, left = (np.repeat(x, strings) for x in (row, start, anchor, left))
            start, left = start + k, left - k
            name = mixed(Rolling(np.frombuffer(raw, np.uint8)).slices(start, start + length) + M2 * left.astype(np.uint64)).view(np.int64)
            id_, tie = (b.column(c).to_numpy()[row] for c in ("id", "tie"))
            yield from _merged(anchor, name, id_, tie, start - offs[row], np.ones(len(row), np.int64), left, length, kind)

    return _texts(docs, segments).mapInArrow(run, f"{SEGMENT}, run_id long, run_tie long, run long")


def _sorted(segments: DataFrame, length: int, held: int, size: int, shards: list[int]) -> DataFrame:
    """Runs of repeated strings of the segments, sorted in groups of whole anchors of about ``size`` bytes."""

    def one(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_, tie, place, strings, left = (np.concatenate([b.column(c).to_numpy() for b in batches]) for c in ("id", "tie", "run", "strings", "left"))
        raw = [np.frombuffer(x.as_buffer(), np.uint8) for b in batches for x in b.column("bytes")]
        start = place >> 32
        rank = np.empty(len(raw), np.int64)
        rank[np.lexsort((start + left, tie, id_))] = np.arange(len(raw))
        shard = Shard(raw, left, strings, length, held)
        del raw
        found = [*shard.repeats(rank)]
        if not found:
            return
        segment, at = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((at, segment))
        segment, at = segment[order], at[order]
        new = np.ones(len(at), bool)
        new[1:] = (segment[1:] != segment[:-1]) | (at[1:] != at[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        for k in range(0, len(first), 100_000):
            s, x, y = segment[first[k : k + 100_000]], at[first[k : k + 100_000]], at[last[k : k + 100_000]]
            yield _runs(id_[s], tie[s], start[s] + x, start[s] + y + length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, bytes_ = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            if some and bytes_ >= size:
                # the group ends before the first new anchor of the batch
                new = np.flatnonzero(b.column("anchor").to_numpy() != some[-1].column("anchor")[-1].as_py())
                cut = int(new[0]) if len(new) else b.num_rows
                some.append(b.slice(0, cut))
                if cut == b.num_rows:
                    continue
                yield from one(some)
                some, bytes_, b = [], 0, b.slice(cut)
            some.append(b)
            bytes_ += b.column("bytes").nbytes
        if some:
            yield from one(some)

    dealt = segments.repartition(*shards, "anchor").sortWithinPartitions("anchor").select("anchor", "id", "tie", "run", "strings", "left", "bytes")
    return dealt.mapInArrow(run, RUN)


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, held: int = HELD, shards: int | None = None, carry: tuple[str, ...] = (), hot: int = HOT, group: int = GROUP) -> DataFrame:
    """Per document: ``key`` (a long), the columns of ``carry``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed
    runs), ``kept`` (the other bytes), ``kept_sha256`` (of them, lowercase hexadecimal) and ``kept_text`` (of them,
    without the parts of characters that a cut has split)."""
    docs = docs.select(F.coalesce(F.col(key), F.lit(LAST)).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(key).isNull()).alias("tie"), F.col(text).alias("text"), F.struct(F.col(key).cast("long").alias("_key"), *carry).alias("carried"))
    shards = [shards] if shards else []
    named = written(_named(docs, length, gram), "dedup-named")
    segments = named.where("anchor is not null").select(*NAMES)
    frequent = _frequent(named, hot)
    if frequent is None:
        segments = segments.withColumn("frequent", F.lit(0))
    else:
        segments = segments.join(frequent.withColumn("frequent", F.lit(1)), "anchor", "left").withColumn("frequent", F.coalesce("frequent", F.lit(0)))
    firsts = written(_firsts(segments, length, shards), "dedup-firsts")
    own = lambda rows: rows.where("run is not null and anchor is null").select(F.col("run_id").alias("id"), F.col("run_tie").alias("tie"), "run")
    runs = own(named).union(firsts.where("anchor is null").select("id", "tie", "run"))
    runs = runs.union(_sorted(_cut(docs, firsts.where("anchor is not null and frequent = 0")), length, held, group, shards))
    if frequent is not None:
        strings = written(_strings(docs, firsts.where("frequent = 1"), length), "dedup-strings")
        # a string of the whole length shares none with those of another name
        again = _firsts(strings.where("anchor is not null").select(*NAMES, F.lit(1).alias("frequent")), length, shards).where("anchor is null")
        runs = runs.union(own(strings)).union(again.select("id", "tie", "run"))
    # fewer runs than the document has bytes; length before start, as the set's hash folds the upper half onto the lower
    start = F.shiftright("run", 32)
    lists = runs.groupBy("id", "tie").agg(F.collect_set(F.shiftleft(F.col("run").bitwiseAND(0xFFFFFFFF) - start, 32) + start).alias("runs"))
    kind = T.StructType([T.StructField(key, T.LongType()), *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")), T.StructField("kept", T.BinaryType()), T.StructField("kept_sha256", T.StringType()), T.StructField("kept_text", T.StringType()), docs.schema["carried"]])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offs = utf8(b.column("text"))
            rows = b.column("runs")
            n = np.diff(rows.offsets.to_numpy())
            flat = rows.flatten().to_numpy()
            base = np.repeat(offs[:-1], n)
            depth = np.zeros(len(raw) + 1, np.int32)
            start = base + (flat & 0xFFFFFFFF)
            np.add.at(depth, start, 1)
            np.add.at(depth, start + (flat >> 32), -1)
            gone = np.cumsum(depth)[:-1] > 0
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            heads = offs[:-1][offs[:-1] < len(raw)]
            begins[heads] = gone[heads]
            total, spans = (np.concatenate([[0], np.cumsum(x)]) for x in (gone, begins))
            data = np.frombuffer(raw, np.uint8)
            kept = data[~gone].tobytes()
            ends = (offs - total[offs]).tolist()
            parts = [kept[a:z] for a, z in zip(ends, ends[1:])]
            ids = b.column("carried").field("_key")
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.diff(offs)), pa.array(np.diff(total[offs])), pa.array(np.diff(spans[offs])), pa.array(parts, pa.binary()), pa.array([hashlib.sha256(x).hexdigest() for x in parts], pa.string()), pa.array([x.decode("utf-8", "ignore") for x in parts], pa.string()), b.column("carried")], names=kind.names)

    done = docs.join(lists, ["id", "tie"], "left").select("id", "text", "carried", F.coalesce("runs", F.array().cast("array<long>")).alias("runs")).mapInArrow(remove, kind)
    return done.select(key, *(F.col(f"carried.{c}").alias(c) for c in carry), *[c for c in kind.names[1:] if c != "carried"])

"""Periodic runs of words by block convolution.

A run is a stretch of words with smallest period q, of at least ``max(MIN_WORDS, COPIES * q)`` words, that no neighbour
extends keeping q.  Periods from B to 2B - 1 belong to the dyadic scale B = 1, 2, 4, ...  At each scale the text is cut
into blocks of B words, and the following window of 3B - 1 words is searched for all occurrences of a block: the sum of
squared differences of block and window at every distance comes from an exact integer number-theoretic transform
(modulo a prime), all blocks of a batch of texts side by side.  A distance with sum zero is compared word by word once
(the sum is exact modulo the prime only) and seeds an extension to both sides.

What cannot seed is not transformed, which is exact:

* a block whose first B words do not all come again within 2B - 1 words;
* a block whose window lies inside a run found at a smaller scale of a period up to B: every distance that matches
  there is a multiple of that period, and its extension is that run again.

So a text of one word takes one scale, and prose few blocks.  Periods are met in ascending order, which makes the
period of what is left the smallest one: an interval with a smaller period is inside a run found before, whose period
divides the distance (Fine and Wilf), and such seeds are dropped.

Texts do not depend on each other: there is no shuffle, and a task holds one bounded Arrow batch.

Defined cases: null and empty texts have no words and no runs; repeated rows are treated each; extra columns are
carried, those named like a result column are replaced; a very long text is a batch of its own, its work grows with
n log(n)^2 at most; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklab.llm.common import ranges, small_batches, utf8, word_spans

#: Words and repetitions of a run at least.
MIN_WORDS, COPIES = 6, 4
#: Prime of the transform (15 * 2 ** 27 + 1) and a generator of its units: fixed values.
PRIME, ROOT = 2013265921, 31
#: Elements transformed at a time.
CHUNK = 1 << 19
RESULT = T.StructType([
    T.StructField("n_runs", T.LongType()), *(T.StructField(c, T.LongType()) for c in ("start", "length", "period", "exponent_milli")),
    T.StructField("runs", T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))), T.StructField("collapsed", T.StringType()),
])


def _roots(size: int, inverse: bool) -> np.ndarray:
    """The powers 0 .. size / 2 - 1 of a ``size``-th root of unity modulo the prime."""
    root = pow(ROOT, (PRIME - 1) // size, PRIME)
    root = pow(root, -1, PRIME) if inverse else root
    out = np.ones(max(size // 2, 1), np.uint64)
    have = 1
    while have < len(out):  # doubling: the second half is the first times one power
        out[have : 2 * have] = out[:have] * np.uint64(pow(root, have, PRIME)) % np.uint64(PRIME)
        have *= 2
    return out


def transform(rows: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Number-theoretic transform of every row (a power of two of values below the prime)."""
    p = np.uint64(PRIME)
    n, size = rows.shape
    x = rows.astype(np.uint64).reshape(n, 1, size)
    # each step splits every sequence into sums and twisted differences of its halves, in an order that needs no swap
    while x.shape[2] > 1:
        half = x.shape[2] // 2
        a, b = x[:, :, :half], x[:, :, half:]
        low, high = a + b, a + (p - b)
        np.subtract(low, p, out=low, where=low >= p)
        high = high * _roots(2 * half, inverse) % p
        x = np.concatenate([low, high], axis=1)
    out = x.reshape(n, size)
    return out * np.uint64(pow(size, -1, PRIME)) % p if inverse else out


def zero_distances(block: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Whether each block (rows x B) equals its window (rows x 2B) at the offsets 0 .. B - 1, by squared differences
    modulo the prime."""
    p = np.uint64(PRIME)
    b = block.shape[1]
    size = 2 * b
    x = np.zeros((len(block), size), np.uint64)
    x[:, :b] = block[:, ::-1]
    w = window.astype(np.uint64)
    # the cyclic product of length 2B is right at the offsets that the block does not wrap around at
    cross = transform(transform(x) * transform(w) % p, inverse=True)[:, b - 1 : size - 1]
    square = np.concatenate([np.zeros((len(w), 1), np.uint64), np.cumsum(w * w % p, axis=1)], axis=1)
    moving = (square[:, b:size] - square[:, :b]) % p
    own = (block.astype(np.uint64) ** 2 % p).sum(axis=1)[:, None] % p
    return (own + moving + np.uint64(2) * (p - cross)) % p == 0


def next_again(ids: np.ndarray) -> np.ndarray:
    """Words from each word to the next equal one (a large number if there is none)."""
    out = np.full(len(ids), 1 << 60, np.int64)
    order = np.argsort(ids, kind="stable")
    same = ids[order][1:] == ids[order][:-1]
    out[order[:-1][same]] = np.diff(order)[same]
    return out


class _Known:
    """Intervals with a period that were found, for all texts of a batch on one axis."""

    def __init__(self):
        self.start = self.end = self.period = np.zeros(0, np.int64)

    def add(self, start, end, period) -> None:
        self.start, self.end, self.period = (np.concatenate([a, np.array(b, np.int64)]) for a, b in ((self.start, start), (self.end, end), (self.period, period)))
        order = np.lexsort((self.period, self.start))
        self.start, self.end, self.period = self.start[order], self.end[order], self.period[order]

    def covers(self, start: np.ndarray, end: np.ndarray, distance: np.ndarray | int) -> np.ndarray:
        """Whether an interval with a period that divides ``distance`` (0: any) holds start .. end."""
        out = np.zeros(len(start), bool)
        for period in np.unique(self.period).tolist():
            s, e = self.start[self.period == period], self.end[self.period == period]
            # intervals of one period overlap by less than it, so their ends are in the order of their starts
            at = np.searchsorted(s, start, "right") - 1
            inside = (at >= 0) & (e[at] >= end) if len(s) else out
            out |= inside & (np.asarray(distance) % period == 0)
        return out


def runs(ids: np.ndarray, offsets: np.ndarray, min_words: int = MIN_WORDS, copies: int = COPIES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs of the texts ``ids[offsets[k]:offsets[k + 1]]``, by start, then period.

    ``ids`` are numbers from 1 on; starts and ends count from the beginning of ``ids``."""
    known = _Known()
    length = np.diff(offsets)
    again = next_again(ids + np.repeat(np.arange(len(length)), length) * (int(ids.max(initial=0)) + 1))
    found: list[tuple[int, int, int]] = []
    scale = 1
    while len(ids) and (some := length >= max(min_words, copies * scale)).any():
        n = length // scale * some  # whole blocks of each text
        start = np.repeat(offsets[:-1], n) + ranges(n) * scale
        end = np.repeat(offsets[1:], n)
        late = np.concatenate([[0], np.cumsum(again >= 2 * scale)])
        keep = start + 2 * scale <= end
        keep[keep] = late[start[keep] + scale] == late[start[keep]]
        start, end = start[keep], end[keep]
        free = ~known.covers(start, np.minimum(start + 3 * scale - 1, end), 0)
        start, end = start[free], end[free]
        seeds = [_seeds(ids, start[k : k + max(CHUNK // scale, 1)], end[k : k + max(CHUNK // scale, 1)], scale) for k in range(0, len(start), max(CHUNK // scale, 1))]
        at, distance, end = (np.concatenate(x) if seeds else np.zeros(0, np.int64) for x in (zip(*seeds) if seeds else ((), (), ())))
        fresh = ~known.covers(at, at + distance + scale, distance)
        new = _extended(ids, offsets, at[fresh], distance[fresh], scale)
        known.add(*(np.array([x[k] for x in new if x[1] - x[0] >= 3 * x[2]], np.int64) for k in range(3)))
        found += [x for x in new if x[1] - x[0] >= max(min_words, copies * x[2])]
        scale *= 2
    out = np.array(sorted(found, key=lambda x: (x[0], x[2])), np.int64).reshape(-1, 3)
    return out[:, 0], out[:, 1], out[:, 2]


def _seeds(ids: np.ndarray, start: np.ndarray, end: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(block start, distance, end of the text) of all blocks that come again at a distance of scale .. 2 scale - 1."""
    inside = np.arange(scale)
    block = ids[start[:, None] + inside]
    place = (start + scale)[:, None] + np.arange(2 * scale)
    window = np.where(place < end[:, None], ids[np.minimum(place, len(ids) - 1)], 0)
    row, offset = np.nonzero(zero_distances(block, window))
    true = np.ones(len(row), bool)
    for k in range(0, len(row), max(CHUNK // scale, 1)):  # the sums are exact modulo the prime: compare the words
        s = slice(k, k + max(CHUNK // scale, 1))
        true[s] = (block[row[s]] == window[row[s][:, None], offset[s][:, None] + inside]).all(axis=1)
    row, offset = row[true], offset[true]
    return start[row], offset + scale, end[row]


def _extended(ids: np.ndarray, offsets: np.ndarray, at: np.ndarray, distance: np.ndarray, scale: int) -> list[tuple[int, int, int]]:
    """Maximal intervals (start, end, period) around the seeds; seeds of one interval give it once."""
    order = np.lexsort((at, distance))
    at, distance = at[order], distance[order]
    # blocks next to each other with one distance lie in one interval
    first = np.concatenate([[True], (np.diff(distance) != 0) | (np.diff(at) != scale)]) if len(at) else np.zeros(0, bool)
    last = np.append(first[1:], True) if len(at) else first
    text = np.searchsorted(offsets, at, "right") - 1
    out: list[tuple[int, int, int]] = []
    for a, b, q, lo, hi in zip(at[first].tolist(), (at[last] + scale).tolist(), distance[first].tolist(), offsets[text[first]].tolist(), offsets[text[first] + 1].tolist()):
        if out and out[-1][2] == q and out[-1][0] <= a < out[-1][1] - q:
            continue
        # ids[i] == ids[i + q] holds for a <= i < b: go on while it holds, by steps of growing length
        step = 2 * scale
        while a > lo:
            c = max(lo, a - step)
            bad = np.flatnonzero(ids[c:a] != ids[c + q : a + q])
            if len(bad):
                a = c + int(bad[-1]) + 1
                break
            a, step = c, 2 * step
        step = 2 * scale
        while b + q < hi:
            c = min(hi - q, b + step)
            bad = np.flatnonzero(ids[b:c] != ids[b + q : c + q])
            if len(bad):
                b += int(bad[0])
                break
            b, step = c, 2 * step
        out.append((a, b + q, q))
    return out


def word_ids(raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """A number from 1 on for every word (equal words, equal numbers), the words before each text, and the words."""
    starts, ends, before = word_spans(np.frombuffer(raw, np.uint8), offsets)
    words = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number) + 1) for w in words), np.int64, len(words))
    return ids, before, words


def summary(raw: bytes, offsets: np.ndarray) -> list[dict]:
    """The result columns of every text."""
    ids, before, words = word_ids(raw, offsets)
    start, end, period = runs(ids, before)
    drop = np.zeros(len(ids) + 1, np.int64)
    np.add.at(drop, start + period, 1)
    np.add.at(drop, end, -1)
    keep = (np.cumsum(drop[:-1]) == 0).tolist()
    of = np.searchsorted(start, before)  # runs are ordered by start, so those of a text are together
    out = []
    for k in range(len(before) - 1):
        lo, hi = int(before[k]), int(before[k + 1])
        mine = [(int(a) - lo, int(b - a), int(q)) for a, b, q in zip(start[of[k] : of[k + 1]], end[of[k] : of[k + 1]], period[of[k] : of[k + 1]])]
        row: dict = dict.fromkeys(("start", "length", "period", "exponent_milli"))
        best = None
        for a, n, q in mine:  # by start, then period: only a greater exponent takes over
            if best is None or n * best[2] > best[1] * q:
                best = (a, n, q)
        if best:
            row = {"start": best[0], "length": best[1], "period": best[2], "exponent_milli": 1000 * best[1] // best[2]}
        kept = b" ".join(words[lo:hi]) if not mine else b" ".join(w for w, here in zip(words[lo:hi], keep[lo:hi]) if here)
        out.append({"n_runs": len(mine), **row, "runs": [dict(zip(("start", "length", "period"), r)) for r in mine], "collapsed": kept.decode("utf-8", "replace")})
    return out


def find(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the runs of every text: n_runs; start, length, period and exponent_milli (floor of 1000 length / period) of the
    run with the greatest exponent (ties: smallest start, then period; null without runs); ``runs`` (start, length and
    period of all, by start, then period) and ``collapsed`` (the words that no run holds behind its first period, with
    single blanks).  Words are numbered from 0."""
    small_batches(df.sparkSession)
    keep = [c for c in df.columns if c not in RESULT.names]
    schema = T.StructType([df.schema[c] for c in keep] + RESULT.fields)
    kind = pa.schema([(f, pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])) if f == "runs" else pa.string() if f == "collapsed" else pa.int64()) for f in RESULT.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = pa.RecordBatch.from_pylist(summary(*utf8(b.column(text))), schema=kind)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *done.columns], names=[*keep, *RESULT.names])

    return df.mapInArrow(run, schema)


def runs_text(runs: str = "runs"):
    """All runs as lines ``start,length,period``, each ended by a line feed."""
    line = lambda r: F.concat(F.array_join(F.array(*(r[c].cast("string") for c in ("start", "length", "period"))), ","), F.lit("\n"))
    return F.array_join(F.transform(runs, line), "")

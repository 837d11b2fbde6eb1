"""Benchmark decontamination by the q-gram lemma.

A passage within an edit budget of k of an item of m characters shares at least m - q + 1 - k * q of the item's q-grams
with it, all on diagonals (place in the text minus place in the item) at most k apart.  Windows of a text with too few
q-grams of any item are left out first; the q-grams of the others are counted per item in overlapping bands of
diagonals, bands that meet the bound are kept, and banded alignment verifies them: the smallest edit distance of the
item to any stretch of the band, with the stretch.

Texts are compared as lower-case letters and digits with single blanks between, so case, marks and line breaks do not
count as edits.  ``EDITS`` of an item's characters may be changed (fewer in items so short that the bound would vanish;
items of fewer than Q characters are not searched).

The items are the stated query set: those of ``BLOCK`` characters at most go to all tasks at a time; more items are
searched in blocks.

Defined cases: null and empty texts and items have no hits; repeated rows and items are reported each; extra columns
are carried; empty tables give empty results; very long texts are searched whole, by array work over their batch.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklab.llm.bpe import OTHER, SPACE, char_classes
from sparklab.llm.common import M1, P, powers, ranges, utf8

Q = 10
EDITS = 0.06
#: Characters of all items of a block.
BLOCK = 20_000_000
#: Bits of the table that tells most other q-grams from the items'.
TABLE = 23

HITS = [T.StructField("item_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("distance", T.IntegerType())]


@functools.lru_cache(1)
def _folded() -> np.ndarray:
    """Lower-case code point of letters and digits, 32 for all others."""
    kinds = char_classes()
    out = np.arange(0x110000, dtype=np.uint32)
    out[(kinds == OTHER) | (kinds == SPACE)] = 32
    for c in np.flatnonzero(kinds == 0).tolist():
        low = chr(c).lower()
        if len(low) == 1:
            out[c] = ord(low)
    return out


def folded(raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Compared characters of all rows, their places in the rows' code points, and the characters before each row."""
    points = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    data = np.frombuffer(raw, np.uint8)
    bounds = np.searchsorted(np.flatnonzero((data & 0xC0) != 0x80), offsets)
    low = _folded()[points]
    keep = low != 32
    follows = keep.copy()
    begin = bounds[:-1][bounds[:-1] < len(low)]
    keep[1:] |= follows[:-1]  # the first blank after a character stays
    keep[begin] = low[begin] != 32
    places = np.flatnonzero(keep)
    at = np.searchsorted(places, bounds)
    return low[places], places - np.repeat(bounds[:-1], np.diff(at)), at


def gram_hashes(chars: np.ndarray, q: int = Q) -> np.ndarray:
    """Hashes of the q-grams at all places of a character array (also over row ends), by doubling their length."""
    if len(chars) < q:
        return np.zeros(0, np.uint64)
    one = chars.astype(np.uint64)
    h, done = one, 1
    for bit in bin(q)[3:]:
        h, done = h[:-done] * powers(done + 1)[done] + h[done:], 2 * done
        if bit == "1":
            h, done = h[:-1] * P + one[done:], done + 1
    return h


def slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes * M1) >> np.uint64(64 - TABLE)


class Index:
    """The q-grams of a block of items."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q, edits: float = EDITS):
        self.q = q
        rows = []
        for key, text in items:
            raw = (text or "").encode()
            chars = folded(raw, np.array([0, len(raw)]))[0]
            chars = chars[: len(chars) - 1] if len(chars) and chars[-1] == 32 else chars
            if len(chars) >= q:
                rows.append((key, chars))
        self.keys = np.array([k for k, _ in rows], np.int64)
        self.chars = [c for _, c in rows]
        self.size = np.array([len(c) for c in self.chars], np.int64)
        self.budget = np.minimum((edits * self.size).astype(np.int64), (self.size - q) // q)
        self.least = self.size - q + 1 - self.budget * q
        grams = [gram_hashes(c, q) for c in self.chars]
        h = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = ranges(np.array([len(g) for g in grams], np.int64))
        order = np.argsort(h, kind="stable")
        self.h, self.item, self.place = h[order], item[order], place[order]
        self.table = np.zeros(1 << TABLE, bool)
        self.table[slots(h)] = True
        # windows that any item of a class of similar lengths needs: (places of q-grams, q-grams found in them)
        kinds = np.floor(np.log(np.maximum(self.size, 1)) / np.log(1.25)).astype(int)
        self.windows = [(int((self.size + self.budget)[kinds == k].max()) - q + 1, int(self.least[kinds == k].min())) for k in np.unique(kinds)]

    def search(self, raw: bytes, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """All hits: (row, item key, first and last + 1 code point, distance), by row, item and place."""
        chars, places, at = folded(raw, offsets)
        n = len(chars) - self.q + 1
        if n <= 0 or not len(self.h):
            return []
        h = gram_hashes(chars, self.q)
        found = self.table[slots(h)]
        for end in at[1:-1].tolist():  # q-grams over the ends of rows are none
            found[max(0, end - self.q + 1) : end] = False
        # q-grams that lie in some window with enough of them
        hit = np.flatnonzero(found)
        dense = np.zeros(len(hit) + 1, np.int32)
        for width, least in self.windows:
            first = np.flatnonzero(hit[least - 1 :] - hit[: len(hit) - least + 1] < width) if len(hit) >= least else hit[:0]
            dense[first] += 1
            dense[first + least] -= 1
        hit = hit[np.cumsum(dense)[:-1] > 0]
        if not len(hit):
            return []
        a, b = np.searchsorted(self.h, h[hit], "left"), np.searchsorted(self.h, h[hit], "right")
        if not (b > a).any():  # hits of the table alone: no q-gram of an item is there
            return []
        which = np.repeat(a, b - a) + ranges(b - a)
        hit = np.repeat(hit, b - a)
        item, row = self.item[which], np.searchsorted(at, hit, "right") - 1
        diagonal = hit - self.place[which]
        # cells of k + 1 diagonals; two neighbours make a band that holds any k + 1 successive diagonals
        cell = diagonal // (self.budget[item] + 1)
        order = np.lexsort((cell, item, row))
        row, item, cell = row[order], item[order], cell[order]
        new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (cell[1:] != cell[:-1])]))
        count = np.diff(np.append(new, len(row)))
        row, item, cell = row[new], item[new], cell[new]
        joined = np.zeros(len(row), bool)
        joined[:-1] = (row[1:] == row[:-1]) & (item[1:] == item[:-1]) & (cell[1:] == cell[:-1] + 1)
        both = count + np.where(joined, np.append(count[1:], 0), 0)
        keep = np.flatnonzero(both >= self.least[item])
        return self.verify(chars, places, at, row[keep], item[keep], cell[keep])

    def verify(self, chars, places, at, row, item, cell) -> list[tuple[int, int, int, int, int]]:
        """Banded alignment of candidate bands, of similar lengths together."""
        hits: dict[tuple[int, int], list] = {}
        order = np.argsort(self.size[item], kind="stable")
        for k in range(0, len(order), 256):
            some = order[k : k + 256]
            for j, (distance, start, end) in zip(some.tolist(), self.align(chars, at, row[some], item[some], cell[some])):
                if distance <= self.budget[item[j]]:
                    hits.setdefault((int(row[j]), int(item[j])), []).append((distance, start, end))
        out = []
        for (r, i), spans in hits.items():
            kept: list[tuple[int, int, int]] = []
            for d, s, e in sorted(spans):  # of overlapping stretches the closest one
                if all(e <= x[1] or s >= x[2] for x in kept):
                    kept.append((d, s, e))
            out += [(r, int(self.keys[i]), int(places[s]), int(places[e - 1]) + 1, int(d)) for d, s, e in kept]
        return sorted(out)

    def align(self, chars, at, row, item, cell) -> list[tuple[int, int, int]]:
        """Smallest edit distance of each item to a stretch of its band, and the stretch (places in ``chars``)."""
        budget, size = self.budget[item], self.size[item]
        low, wide = cell * (budget + 1) - budget, 4 * budget + 3
        first, last = at[row], at[row + 1]
        n, width, longest = len(row), int(wide.max()), int(size.max())
        band = np.arange(width)
        text = np.zeros((n, longest), np.uint32)
        for k, i in enumerate(item.tolist()):
            text[k, : size[k]] = self.chars[i]
        one, far = np.int64(1) << 40, np.int64(1) << 60
        steps = band * one
        # a state is distance << 40 | first place: equal distances begin as far left as they can
        start = low[:, None] + band
        state = np.where((band < wide[:, None]) & (start >= first[:, None]) & (start <= last[:, None]), start, far)
        best = np.full((n, 2), far)
        for i in range(longest):
            place = low[:, None] + i + band  # the character that step i consumes on each diagonal
            inside = (place >= first[:, None]) & (place < last[:, None])
            char = chars[np.clip(place, 0, len(chars) - 1)]
            move = np.where(inside, state + np.where(char == text[:, i : i + 1], 0, one), far)
            skip = np.concatenate([state[:, 1:], np.full((n, 1), far)], axis=1) + one
            state = np.minimum(move, skip)
            state = np.minimum.accumulate(state - steps, axis=1) + steps
            end = place + 1
            state = np.where((band < wide[:, None]) & (end >= first[:, None]) & (end <= last[:, None]), np.minimum(state, far), far)
            done = np.flatnonzero(size == i + 1)
            if len(done):
                b = np.argmin(state[done], axis=1)
                best[done] = np.column_stack([state[done, b], low[done] + i + b + 1])
        return [(int(v >> 40), int(v & (one - 1)), int(e)) for v, e in best.tolist()]


def indexes(items: DataFrame, item_id: str, item_text: str, q: int, edits: float, block: int) -> Iterator:
    """Broadcast indexes of the items, of ``block`` characters each on average."""
    spark = items.sparkSession
    queries = items.select(F.col(item_id).alias("item"), F.col(item_text).alias("text")).where("item is not null and text is not null")
    size = queries.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block))
    for k in range(blocks):
        some = queries.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        yield spark.sparkContext.broadcast(Index([(r["item"], r["text"]) for r in some.collect()], q, edits))


def hits(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", q: int = Q, edits: float = EDITS, block: int = BLOCK) -> DataFrame:
    """One row per passage of a document near an item: the document's other columns, ``item_id`` (long), ``start`` and
    ``end`` (code points) and ``distance``."""
    names = [f.name for f in HITS]
    keep = [c for c in docs.columns if c != text and c not in names]
    schema = T.StructType([docs.schema[c] for c in keep] + HITS)

    def searched(shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for b in batches:
                found = index.search(*utf8(b.column(text)))
                if found:
                    rows = pa.array([x[0] for x in found])
                    cols = [pa.array([x[j + 1] for x in found], pa.int32() if j == 3 else pa.int64()) for j in range(4)]
                    yield pa.RecordBatch.from_arrays([*(b.column(c).take(rows) for c in keep), *cols], names=schema.names)

        return docs.select(*keep, text).mapInArrow(run, schema)

    return functools.reduce(DataFrame.unionByName, map(searched, indexes(items, item_id, item_text, q, edits, block)))


def clean(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", q: int = Q, edits: float = EDITS, block: int = BLOCK) -> DataFrame:
    """The documents without any passage near an item, all columns as they are."""

    def without(rows: DataFrame, shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                keep[[x[0] for x in index.search(*utf8(b.column(text)))]] = False
                yield b.filter(pa.array(keep))

        return rows.mapInArrow(run, docs.schema)

    return functools.reduce(without, indexes(items, item_id, item_text, q, edits, block), docs)

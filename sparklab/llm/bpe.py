"""BPE encoding and decoding by forced-boundary splitting.

A byte pair that occurs inside no vocabulary token can never be merged over, so a cut between its two bytes is
certain.  Texts are cut at the pre-token starts and at every such pair; the fragments are encoded independently
(equal fragments once per worker, in a bounded memo) and their ids concatenated.  Finding all cuts is array work over
a whole Arrow batch; only new fragments run the merge loop.

Results equal the public ``tokenizers`` library for byte-level BPE files (``encode(..., add_special_tokens=False)``
without truncation or padding, ``decode(..., skip_special_tokens=False)``): strings of added tokens inside a text
become their id.

Defined cases: null and empty texts have no ids; repeated rows are encoded each; extra columns are carried, those named like a result column are replaced; very long
texts need memory in proportion to one Arrow batch; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import heapq
import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklab.llm.common import utf8

#: Fragments that a worker remembers; beyond them it starts anew (memory bound only, results do not change).
MEMO = 350_000

#: Bytes up to which a fragment is merged by plain search, which is faster there.
SHORT = 100

LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3
#: Suffixes that a pre-token of their own begins with an apostrophe (fixed values of the public pattern).
SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")


@functools.lru_cache(1)
def char_classes() -> np.ndarray:
    """Class of every code point: letter, number, white space or other."""
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\p{White_Space}")):
        out[[ord(c) for c in regex.findall(pattern, every)]] = kind
    return out


def byte_symbols() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte, reversed (public rule)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class ByteBPE:
    """A byte-level BPE vocabulary with its merge ranks and its table of pairs that can lie inside a token."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols = byte_symbols()
        raw = lambda s: bytes(symbols[c] for c in s)
        self.ids = {raw(t): i for t, i in spec["model"]["vocab"].items()}
        #: (left id << 32 | right id) -> rank, and the id that the merge of each rank makes
        self.ranks, self.made = {}, []
        for m in spec["model"]["merges"]:
            left, right = map(raw, m if isinstance(m, list) else m.split(" "))
            self.ranks[self.ids[left] << 32 | self.ids[right]] = len(self.made)
            self.made.append(self.ids[left + right])
        self.pairs, self.pair_ranks = (np.array(x, np.int64) for x in zip(*sorted(self.ranks.items())))
        self.single = [self.ids[bytes([k])] for k in range(256)]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.tokens: dict[int, bytes] = {i: t for t, i in self.ids.items()} | {i: t.encode() for t, i in self.added.items()}
        #: pairs of bytes (first << 8 | second) that no token holds
        self.outside = np.ones(65536, bool)
        for t in self.ids:
            b = np.frombuffer(t, np.uint8).astype(np.int32)
            self.outside[b[:-1] * 256 + b[1:]] = False
        self.memo = _Memo(self)

    def merge(self, fragment: bytes) -> bytes:
        """Ids of one fragment as little-endian 32-bit integers: the lowest-ranked pair merges first, of equal ones the
        leftmost."""
        single, ranks, made = self.single, self.ranks.get, self.made
        parts = [single[b] for b in fragment]
        if len(parts) > SHORT:
            return self._merge_long(parts)
        worst = len(made)
        scores = [ranks(a << 32 | b, worst) for a, b in zip(parts, parts[1:])]
        while scores and (best := min(scores)) < worst:
            k = scores.index(best)
            parts[k] = new = made[best]
            del parts[k + 1], scores[k]
            if k:
                scores[k - 1] = ranks(parts[k - 1] << 32 | new, worst)
            if k < len(scores):
                scores[k] = ranks(new << 32 | parts[k + 1], worst)
        return struct.pack(f"<{len(parts)}I", *parts)

    def _ranked(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids, -1 for those that do not merge."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.pair_ranks[at], -1)

    def _merge_long(self, ids: list[int]) -> bytes:
        """The same for long fragments: parts in a linked list, and all places of the lowest rank merge at once.

        A merge's token takes part in later merges only, so no lower rank can come up in between."""
        parts = np.array(ids, np.int64)
        n = len(parts)
        after, before = np.append(np.arange(1, n), -1), np.arange(-1, n - 1)
        waiting: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def wait(at: np.ndarray) -> None:
            rank = self._ranked(parts[at], parts[after[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(np.append(True, rank[1:] != rank[:-1])) if len(rank) else np.zeros(0, np.int64)
            for r, some in zip(rank[cuts].tolist(), np.split(at, cuts[1:])):
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(heap, r)
                waiting[r].append(some)

        wait(np.arange(n - 1))
        while heap:
            rank = heapq.heappop(heap)
            at = np.unique(np.concatenate(waiting.pop(rank)))
            at = at[(parts[at] >= 0) & (after[at] >= 0)]
            at = at[self._ranked(parts[at], parts[after[at]]) == rank]
            if not len(at):
                continue
            # of pairs that share a part the first, third, .. merge
            chain = np.append(True, after[at[:-1]] != at[1:])
            place = np.arange(len(at))
            at = at[(place - place[chain][np.cumsum(chain) - 1]) % 2 == 0]
            right = after[at]
            parts[at], parts[right] = self.made[rank], -1
            far = after[right]
            after[at] = far
            before[far[far >= 0]] = at[far >= 0]
            near = before[at]
            again = np.unique(np.concatenate([at, near[near >= 0]]))
            wait(again[after[again] >= 0])
        left = parts[parts >= 0]
        return left.astype("<u4").tobytes()

    def segments(self, text: str, offsets: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """Character offsets between which pre-tokens are found apart, and (start, end, id) of added tokens."""
        found = []
        for token, i in self.added.items():
            at = text.find(token)
            while at >= 0:
                row = np.searchsorted(offsets, at, "right")
                if row < len(offsets) and at + len(token) <= offsets[row]:
                    found.append((at, at + len(token), i))
                    at = text.find(token, at + len(token))
                else:
                    at = text.find(token, at + 1)
        if not found:
            return offsets, found
        return np.unique(np.concatenate([offsets, np.array([x for f in found for x in f[:2]], np.int64)])), sorted(found)

    def starts(self, points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Flags of the characters at which a pre-token begins; ``bounds``: offsets that nothing matches across."""
        n = len(points)
        kind = char_classes()[points]
        first = np.empty(n, bool)
        first[0] = True
        np.not_equal(kind[1:], kind[:-1], out=first[1:])
        bounds = bounds[bounds < n]
        first[bounds] = True
        last = np.empty(n, bool)
        last[:-1] = first[1:]
        last[-1] = True
        space = kind == SPACE
        # the last white space before other characters is a token of its own, or the start of the next one
        followed = np.flatnonzero(last & space)
        edge = np.zeros(n + 1, bool)
        edge[bounds] = edge[n] = True
        followed = followed[~edge[followed + 1]]
        first[followed] = True
        first[followed[points[followed] == 32] + 1] = False
        # an apostrophe that begins a token and is followed by one of the suffixes
        for at in np.flatnonzero((points[:-1] == 39) & first[:-1] & last[:-1] & (kind[1:] == LETTER)).tolist():
            if edge[at + 1]:
                continue
            end = at + 1
            tail = ""
            while end < n and len(tail) < 2 and not (len(tail) and edge[end]):
                tail += chr(points[end])
                end += 1
            for s in SUFFIXES:
                if tail.startswith(s):
                    first[at + 1] = False
                    if at + 1 + len(s) < n:
                        first[at + 1 + len(s)] = True
                    break
        return first

    def fragments(self, raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[int, bytes]]:
        """Byte offsets of all certain cuts of a batch, byte and character offsets of the pre-token starts, and the ids
        of added tokens by byte offset."""
        text = raw.decode("utf-8")
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        data = np.frombuffer(raw, np.uint8)
        at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(raw))
        bounds, special = self.segments(text, np.searchsorted(at, offsets))
        first = self.starts(points, bounds)
        added = {}
        for a, b, i in special:
            first[a + 1 : b] = False
            added[int(at[a])] = i.to_bytes(4, "little")
        chars = np.append(np.flatnonzero(first), len(points))
        starts = at[chars]
        cut = np.empty(len(raw) + 1, bool)
        pairs = data[:-1].astype(np.int32)
        pairs <<= 8
        pairs |= data[1:]
        cut[1:-1] = self.outside[pairs]
        cut[starts] = True
        for a, b, _ in special:
            cut[at[a] + 1 : at[b]] = False
        return np.flatnonzero(cut), starts, chars, added

    def encode_batch(self, raw: bytes, offsets: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """Ids of every fragment, the fragments' byte offsets, and the byte and character offsets of the pre-tokens."""
        if not raw:
            zero = np.zeros(1, np.int64)
            return [], zero, zero, zero
        cuts, starts, chars, added = self.fragments(raw, offsets)
        c = cuts.tolist()
        if len(self.memo) > MEMO:
            self.memo.clear()
        ids = list(map(self.memo.__getitem__, [raw[a:b] for a, b in zip(c, c[1:])]))
        for k, i in zip(np.searchsorted(cuts, list(added)).tolist(), added.values()):
            ids[k] = i
        return ids, cuts, starts, chars

    def pretokens(self, raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Characters and ids of every pre-token, and the pre-tokens before each text (n + 1 numbers)."""
        ids, cuts, starts, chars = self.encode_batch(raw, offsets)
        if not ids:
            return np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        n = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        counts = np.add.reduceat(n, np.searchsorted(cuts, starts[:-1]))
        return np.diff(chars).astype(np.int32), counts.astype(np.int32), np.searchsorted(starts, offsets)

    def encode_texts(self, raw: bytes, offsets: np.ndarray) -> list[bytes]:
        """Ids of every text as little-endian 32-bit integers."""
        ids, cuts, _, _ = self.encode_batch(raw, offsets)
        at = np.searchsorted(cuts, offsets).tolist()
        return [b"".join(ids[a:b]) for a, b in zip(at, at[1:])]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.tokens.__getitem__, ids.tolist())).decode("utf-8", "replace")


class _Memo(dict):
    def __init__(self, bpe: ByteBPE):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, fragment: bytes) -> bytes:
        self[fragment] = out = self.bpe.merge(fragment)
        return out


@functools.lru_cache(2)
def load(path: str) -> ByteBPE:
    """The vocabulary at ``path``, once per worker."""
    return ByteBPE(path)


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Replace column ``text`` by ``out``: the ids as little-endian unsigned 32-bit integers (binary).

    All other columns are carried.  Null and empty texts have the empty value."""
    keep = [c for c in df.columns if c not in (text, out)]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(out, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in batches:
            raw, offs = utf8(b.column(text))
            rows = pa.array(bpe.encode_texts(raw, offs), pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), rows], names=[*keep, out])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """Add column ``out``: the text of the ``ids`` (special tokens are written out); null ids give the empty text."""
    keep = [c for c in df.columns if c != out]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in batches:
            texts = [bpe.decode(np.frombuffer(x or b"", "<u4")) for x in b.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(texts, pa.string())], names=[*keep, out])

    return df.mapInArrow(run, schema)


def n_ids(ids: str = "ids"):
    return (F.octet_length(ids) / 4).cast("long")


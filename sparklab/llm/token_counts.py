"""Edit-aware token counts: pre-token segment trees per document.

``build`` keeps, per document, the characters and ids of every pre-token (the leaves).  ``apply_edits`` loads them into
a segment tree whose nodes hold subtree sums of characters and ids, finds the leaves that an edit touches by descending
the sums, re-encodes only those leaves plus a boundary context, and updates the sums on the paths to the root.  The
pre-token scanner reads left to right without memory, so the old and the new cuts agree again at the first cut that
both share behind the edit; everything beyond stays as it is.

Edits are structs (start, length, replacement) in code points, applied in the order of the array; ``attach_edits``
collects them from a table.  Out-of-range starts and lengths are clipped to the text; null fields count as 0 or "".

Defined cases: a null text is the empty text; null or empty edit lists leave the counts; repeated rows are counted
each; extra columns are carried; empty tables give empty results.  Memory: one Arrow batch and the tree of one
document at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklab.llm.bpe import ByteBPE, load
from sparklab.llm.common import binary_rows, strings, utf8

#: Leaves of the tree hold so many pre-tokens.
LEAF = 32
#: Characters before an edit whose pre-tokens are found again: more than any suffix or added token reaches ahead.
CONTEXT = 16

EDIT = "array<struct<start:int,length:int,replacement:string>>"
STATE = [T.StructField("leaf_chars", T.BinaryType()), T.StructField("leaf_tokens", T.BinaryType())]


class Tree:
    """Segment tree over a document's pre-tokens; nodes hold the sums of characters and ids below them."""

    def __init__(self, text: str, chars: list[int], tokens: list[int], bpe: ByteBPE):
        self.text, self.bpe, self.encoded = text, bpe, 0
        self.leaves = [(chars[k : k + LEAF], tokens[k : k + LEAF]) for k in range(0, len(chars), LEAF)] or [([], [])]
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for k, (c, t) in enumerate(self.leaves):
            self.chars[self.width + k], self.tokens[self.width + k] = sum(c), sum(t)
        for k in range(self.width - 1, 0, -1):
            self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
            self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]

    def find(self, offset: int) -> tuple[int, int, int]:
        """Leaf, place in it and first character of the pre-token that holds character ``offset`` (the end: behind the
        last one)."""
        node, at = 1, 0
        while node < self.width:
            node *= 2
            if offset - at >= self.chars[node] and self.chars[node + 1]:
                at += self.chars[node]
                node += 1
        leaf = node - self.width
        for k, n in enumerate(self.leaves[leaf][0]):
            if offset < at + n:
                return leaf, k, at
            at += n
        return leaf, len(self.leaves[leaf][0]), at

    def put(self, leaf: int) -> None:
        """Update the sums from a changed leaf to the root."""
        node = self.width + leaf
        self.chars[node], self.tokens[node] = sum(self.leaves[leaf][0]), sum(self.leaves[leaf][1])
        node //= 2
        while node:
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]
            node //= 2

    def edit(self, start: int, length: int, replacement: str) -> None:
        """Replace ``length`` characters from ``start``."""
        old = len(self.text)
        start = min(max(start, 0), old)
        end = min(start + max(length, 0), old)
        shift = len(replacement) - (end - start)
        self.text = self.text[:start] + replacement + self.text[end:]
        first, place, left = self.find(max(0, start - CONTEXT))
        reach = 4 * CONTEXT
        while True:
            stop = min(old, end + reach)
            last, k, at = self.find(stop)
            if stop >= old:
                last, k, at = len(self.leaves) - 1, len(self.leaves[-1][0]), old
            raw = self.text[left : at + shift].encode()
            chars, tokens, _ = self.bpe.pretokens(raw, np.array([0, len(raw)]))
            self.encoded += at + shift - left
            if at >= old:
                break
            # cuts that the old and the new text share, behind the edit and out of reach of the window's end
            shared = self.shared(first, place, left, last, k, shift, np.cumsum(chars) + left, end, at - CONTEXT)
            if shared is not None:
                last, k, n = shared
                chars, tokens = chars[:n], tokens[:n]
                break
            reach *= 4
        a, b = self.leaves[first], self.leaves[last]
        tail = b[0][k:], b[1][k:]
        for x in range(first + 1, last + 1):
            if self.leaves[x][0]:
                self.leaves[x] = ([], [])
                self.put(x)
        self.leaves[first] = (a[0][:place] + chars.tolist() + tail[0], a[1][:place] + tokens.tolist() + tail[1])
        self.put(first)

    def shared(self, leaf, place, left, last, k, shift, ends, low, high):
        """The first old cut in [low, high] that is a new cut too: its leaf and place, and the new pre-tokens before it."""
        at = left
        while (leaf, place) < (last, k):
            sizes = self.leaves[leaf][0]
            if place >= len(sizes):
                leaf, place = leaf + 1, 0
                continue
            at += sizes[place]
            place += 1
            if at > high:
                return None
            if at >= low and (n := int(np.searchsorted(ends, at + shift))) < len(ends) and ends[n] == at + shift:
                return leaf, place, n + 1
        return None


def build(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Add the leaves of every document's tree (``leaf_chars``, ``leaf_tokens``: little-endian 32-bit integers)."""
    names = [f.name for f in STATE]
    keep = [c for c in df.columns if c not in names]
    schema = T.StructType([df.schema[c] for c in keep] + STATE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in batches:
            raw, offs = utf8(b.column(text))
            chars, tokens, at = bpe.pretokens(raw, offs)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), binary_rows(chars, at * 4), binary_rows(tokens, at * 4)], names=[*keep, *names])

    return df.mapInArrow(run, schema)


def attach_edits(state: DataFrame, edits: DataFrame, key: str = "doc_id", order: str = "seq") -> DataFrame:
    """Join a table of edits (key, order, start, length, replacement) to the documents as the column ``edits``.

    Ties in ``order`` are resolved by the other fields; edits of unknown documents are ignored."""
    one = F.struct(F.col(order).alias("seq"), F.col("start").cast("int").alias("start"), F.col("length").cast("int").alias("length"), F.col("replacement"))
    lists = edits.groupBy(key).agg(F.sort_array(F.collect_list(one)).alias("edits"))
    lists = lists.withColumn("edits", F.transform("edits", lambda e: F.struct(e.start.alias("start"), e.length.alias("length"), e.replacement.alias("replacement"))))
    return state.drop("edits").join(lists, key, "left")


def apply_edits(state: DataFrame, path: str, text: str = "text", edits: str = "edits") -> DataFrame:
    """Apply the ``edits`` column to the documents of ``build``.

    The text and the leaves are replaced by those after the edits, and columns are added: ``n_tokens`` (before),
    ``edited_tokens`` (after), ``n_reencoded`` (characters that were encoded again).  ``edits`` is dropped."""
    new = [T.StructField(text, T.StringType()), *STATE, *(T.StructField(c, T.LongType()) for c in ("n_tokens", "edited_tokens", "n_reencoded"))]
    names = [f.name for f in new]
    keep = [c for c in state.columns if c not in (*names, edits)]
    schema = T.StructType([state.schema[c] for c in keep] + new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in batches:
            rows = []
            for t, c, k, edit in zip(strings(b.column(text)), b.column("leaf_chars").to_pylist(), b.column("leaf_tokens").to_pylist(), b.column(edits).to_pylist()):
                tree = Tree(t, np.frombuffer(c or b"", "<i4").tolist(), np.frombuffer(k or b"", "<i4").tolist(), bpe)
                before = tree.tokens[1]
                for e in edit or ():
                    if e is not None:
                        tree.edit(e["start"] or 0, e["length"] or 0, e["replacement"] or "")
                rows.append((tree.text, *(np.array([x for leaf in tree.leaves for x in leaf[j]], "<i4").tobytes() for j in (0, 1)), before, tree.tokens[1], tree.encoded))
            cols = [pa.array([r[j] for r in rows], kind) for j, kind in enumerate((pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *cols], names=[*keep, *names])

    return state.mapInArrow(run, schema)

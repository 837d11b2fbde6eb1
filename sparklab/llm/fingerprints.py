"""Threshold-scaled document fingerprints.

A fingerprint keeps every hash of a document's word shingles that lies below a fixed fraction of the hash range, so a
longer document keeps more hashes and two fingerprints sample the same part of the hash range: the share of the smaller
one's hashes found in the larger one estimates the containment of very unequal documents.  Fingerprints merge by union.
Below ``LEAST`` expected hashes a document keeps a finer scale, by halves of the divisor down to all of its hashes, so
that short texts are told apart; two fingerprints are compared by their hashes below the smaller of the two fractions.
The scale depends on the number of different shingles alone, and a merge keeps the coarser one.

Words are separated by blanks and the ASCII controls 9 to 13, A-Z count as a-z; a shingle is five words, or the whole
sequence of a text with fewer.  A fingerprint is a digit, the binary logarithm of its divisor, and 16 hexadecimal digits
per hash, ascending.

Defined cases: null and empty texts and texts of separators have the empty fingerprint, which is like the empty
fingerprint (1) and unlike all others (0); two documents of which one has no hash below the common fraction are unlike;
repeated rows and ties of the key are ordered by their text; rows with a null key come last, also if all are such; a
very long text is an Arrow batch of its own; extra columns are not carried; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklab.llm.common import Rolling, mixed, ranges, strings, utf8, word_spans

WORDS = 5
#: One of so many hashes is kept at the coarsest scale (a power of two), and the hashes that call for a finer one.
SCALED, LEAST = 8, 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Odd multipliers that set the words of a shingle apart by their place.
_PLACE = np.uint64(0xD6E8FEB86659FD93)


def shingle_hashes(raw: bytes, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all word shingles of the rows, in order, and the shingles before each row (n + 1 numbers).

    A row of fewer words has one shingle, a row of none has none."""
    data = _LOWER[np.frombuffer(raw, np.uint8)]
    starts, ends, before = word_spans(data, offsets)
    n = np.diff(before)
    count = np.where(n == 0, 0, np.maximum(n - words + 1, 1))
    at = np.concatenate([[0], np.cumsum(count)])
    if not len(starts):
        return np.zeros(0, np.uint64), at
    word = Rolling(data).slices(starts, ends)
    first = np.repeat(before[:-1], count) + ranges(count)
    out = np.zeros(len(first), np.uint64)
    last = np.repeat(before[1:], count)
    for k in range(words):
        inside = first + k < last
        out = np.where(inside, mixed(out * _PLACE + word[np.minimum(first + k, len(word) - 1)]), out)
    return out, at


def scale_of(n: np.ndarray, scaled: int = SCALED) -> np.ndarray:
    """Binary logarithm of the divisor for documents of ``n`` different shingles."""
    return np.clip(np.floor(np.log2(np.maximum(n, 1) / LEAST)), 0, int(np.log2(scaled))).astype(np.int64)


Sketch = tuple[int, np.ndarray]


def sketches(raw: bytes, offsets: np.ndarray, words: int = WORDS, scaled: int = SCALED) -> list[Sketch]:
    """The scale (logarithm of the divisor) and the kept hashes of every row, ascending and distinct."""
    hashes, at = shingle_hashes(raw, offsets, words)
    n = len(offsets) - 1
    if not n:
        return []
    row = np.repeat(np.arange(n), np.diff(at))
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    row, hashes = row[new], hashes[new]
    scale = scale_of(np.bincount(row, minlength=n), scaled)
    keep = below(hashes, scale[row])
    row, hashes = row[keep], hashes[keep]
    return [*zip(scale.tolist(), np.split(hashes, np.searchsorted(row, np.arange(1, n))))]


def below(hashes: np.ndarray, scale: np.ndarray | int) -> np.ndarray:
    """Whether hashes lie in the fraction 2 ** -scale of their range."""
    return hashes >> (np.uint64(63) - np.asarray(scale, np.uint64)) >> np.uint64(1) == 0


def digest(sketch: Sketch) -> str:
    scale, kept = sketch
    return str(scale) + kept.astype(">u8").tobytes().hex() if len(kept) else ""


def likeness(a: Sketch, b: Sketch) -> float:
    """Containment of the smaller sketch in the larger one, at the coarser of their scales."""
    if not len(a[1]) or not len(b[1]):
        return float(len(a[1]) == len(b[1]))
    x, y = (s[below(s, max(a[0], b[0]))] for s in (a[1], b[1]))
    if not len(x) or not len(y):
        return 0.0
    both = np.concatenate([x, y])
    both.sort()
    return float(np.count_nonzero(both[1:] == both[:-1])) / min(len(x), len(y))


def scale(fingerprint: str | Column) -> Column:
    f = F.col(fingerprint) if isinstance(fingerprint, str) else fingerprint
    return F.when(F.length(f) > 0, F.substring(f, 1, 1).cast("int")).otherwise(0)


def hashes(fingerprint: str | Column) -> Column:
    """The hashes of a fingerprint column as an array of strings."""
    f = F.col(fingerprint) if isinstance(fingerprint, str) else fingerprint
    n = (F.length(f) / 16).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.substring(f, i * 16 + 2, F.lit(16)))).otherwise(F.array().cast("array<string>"))


def _below(found: Column, to: Column) -> Column:
    """The hashes (strings) in the fraction 2 ** -to of their range."""
    bounds = F.array(F.lit("g"), *(F.lit(f"{(1 << 64) >> k:016x}") for k in range(1, 10)))
    return F.filter(found, lambda x: x < F.get(bounds, to))


def containment(a: str | Column, b: str | Column) -> Column:
    """Likeness of two fingerprint columns: containment of the smaller one in the larger one."""
    to = F.greatest(scale(a), scale(b))
    x, y = _below(hashes(a), to), _below(hashes(b), to)
    least = F.least(F.size(x), F.size(y))
    empty = F.size(hashes(a)) + F.size(hashes(b)) == 0
    return F.when(least > 0, F.size(F.array_intersect(x, y)) / least).otherwise(empty.cast("double"))


def merge(fingerprints: str | Column, scaled: int = SCALED) -> Column:
    """Aggregate: the fingerprint of the union of documents."""
    top = F.max(scale(fingerprints))
    union = _below(F.array_distinct(F.flatten(F.collect_set(hashes(fingerprints)))), top)
    whole = F.size(union) * F.pow(F.lit(2), top)  # different shingles; exact while all hashes are kept
    to = F.greatest(top, F.least(F.floor(F.log2(F.greatest(whole, F.lit(1)) / LEAST)).cast("int"), F.lit(int(np.log2(scaled)))))
    kept = F.array_sort(_below(union, to))
    return F.when(F.size(kept) > 0, F.concat(to.cast("string"), F.concat_ws("", kept))).otherwise(F.lit(""))


def fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint", words: int = WORDS, scaled: int = SCALED) -> DataFrame:
    """Add the fingerprint of column ``text``; all columns are carried."""
    keep = [c for c in df.columns if c != out]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [digest(s) for s in sketches(*utf8(b.column(text)), words, scaled)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(found, pa.string())], names=[*keep, out])

    return df.mapInArrow(run, schema)


def against_next(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, scaled: int = SCALED, slices: int | None = None) -> DataFrame:
    """Fingerprint every document, its edited text and the next document in descending order of ``key`` (a long).

    The edited text is the document whose last half (rounded down, in code points) gives way to the first as many code
    points of the next document; the first one follows the last.  Returns ``key``, ``n_chars``,
    ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and ``near_next``.

    The texts are shuffled once, into slices of the key; the first document of a slice is sent to the slice above it as
    well.  Slice bounds are quantiles of the key, one number per slice; ``slices`` defaults to twice the shuffle
    partitions, which the cluster sets in proportion to its data."""
    spark = docs.sparkSession
    slices = slices or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    bounds = np.unique(np.array(docs.approxQuantile("key", [k / slices for k in range(slices + 1)], 0.1 / slices), np.int64))
    sliced = T.StructType([T.StructField("key", T.LongType()), T.StructField("text", T.StringType()), T.StructField("slice", T.IntegerType()), T.StructField("halo", T.BooleanType())])
    top = len(bounds) - 1
    none = docs.orderBy("text").limit(1) if top < 0 else None  # without any key the first of the texts follows the last

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = np.array([-1 if x is None else x for x in b.column("key").to_pylist()], np.int64)
            null = np.array([x is None for x in b.column("key").to_pylist()], bool)
            # slice j: bounds[j - 1] < key <= bounds[j]
            at = np.where(null, 0, np.searchsorted(bounds, ids)).astype(np.int32)
            rows = pa.RecordBatch.from_arrays([b.column("key"), b.column("text"), pa.array(at), pa.array(np.zeros(len(ids), bool))], names=sliced.names)
            yield rows
            first = np.flatnonzero(~null & (bounds[np.minimum(at, max(top, 0))] == ids)) if top >= 0 else []
            if len(first):
                up = np.where(at[first] == top, 0, at[first] + 1).astype(np.int32)
                some = rows.take(pa.array(first))
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(up), pa.array(np.ones(len(first), bool))], names=sliced.names)

    out = T.StructType([T.StructField(key, T.LongType()), T.StructField("n_chars", T.LongType()), *(T.StructField(c, T.StringType()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")), *(T.StructField(c, T.DoubleType()) for c in ("near_edited", "near_next"))])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple] = []  # the last row so far waits for its next document
        for b in batches:
            texts = strings(b.column("text"))
            own = sketches(*utf8(b.column("text")), words, scaled)
            rows = kept + [*zip(b.column("key").to_pylist(), texts, b.column("slice").to_pylist(), b.column("halo").to_pylist(), own)]
            kept = rows[-1:]
            pairs = [(r, s) for r, s in zip(rows, rows[1:]) if not r[3] and r[2] == s[2]]
            if not pairs:
                continue
            edited = [r[1][: len(r[1]) - len(r[1]) // 2] + s[1][: len(r[1]) // 2] for r, s in pairs]
            changed = sketches(*utf8(pa.array(edited, pa.string())), words, scaled)
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r, _ in pairs], pa.int64()), pa.array([len(r[1]) for r, _ in pairs], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                pa.array([digest(r[4]) for r, _ in pairs], pa.string()), pa.array([digest(s) for s in changed], pa.string()),
                pa.array([likeness(r[4], s) for (r, _), s in zip(pairs, changed)], pa.float64()), pa.array([likeness(r[4], s[4]) for r, s in pairs], pa.float64()),
            ], names=out.names)

    dealt = docs.mapInArrow(deal, sliced)
    if none is not None:
        dealt = dealt.unionAll(none.select("key", "text", F.lit(0).alias("slice"), F.lit(True).alias("halo")))
    dealt = dealt.repartition(slices, "slice")
    ordered = dealt.sortWithinPartitions("slice", "halo", F.col("key").desc_nulls_last(), "text")
    return ordered.mapInArrow(compare, out)

"""Language identification by language-bitmask n-gram filters.

Training counts the character 4-grams of every language.  All of them go into filters: a 4-gram belongs to the language
in which it makes up the largest share of the 4-grams, and to every other one with at least ``SHARE`` of that (less is
what quotations and wrong labels bring into any large corpus).  So none is dropped, and the rule is the same for every
size of the corpus.  One Bloom filter per language holds its 4-grams; the filters are bit-sliced: a cell has one bit per
language, so a look-up of a 4-gram reads ``HASHES`` cells and their conjunction is the set of languages that contain it.
Cells are set by Spark sums; their number follows the distinct 4-grams up to 2 ** ``BITS``, beyond which the rate of false
positives rises, and with it the correction.  A document's bits are counted per language, corrected by each
filter's rate of false positives, and the largest count decides.

Letters are lower-cased code point by code point, everything else counts as a blank (runs as one).

Defined cases: a text that is null or has no letter is ``und`` with score 0; ties go to the language with more training
text, then by name; rows with a null language or text do not train; repeated rows count each; extra columns are
carried, those named like a result are replaced; a very long text is an Arrow batch of its own; without any training row every text is ``und``; empty tables give empty results.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklab.llm.bpe import LETTER, char_classes
from sparklab.llm.common import mixed, utf8, written

GRAM = 4
#: A 4-gram belongs to a language if its rate there is at least this share of its largest rate in any language.
SHARE = 0.02
#: Cells per 4-gram (at least), cells that each 4-gram is looked up in, and the most cells (log2) of a filter.
CELLS, HASHES, BITS = 8, 3, 25
#: Distinct 4-grams that a task gathers before it passes them on.
HELD = 1_000_000

UNKNOWN = "und"


@functools.lru_cache(1)
def _letters() -> np.ndarray:
    """Lower-case code point of every letter, 32 for everything else."""
    out = np.full(0x110000, 32, np.uint32)
    for c in np.flatnonzero(char_classes() == LETTER).tolist():
        low = chr(c).lower()
        out[c] = ord(low) if len(low) == 1 else c
    return out


def grams(raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the 4-grams of all rows, the row of each, and whether a row has a letter."""
    n = len(offsets) - 1
    points = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    data = np.frombuffer(raw, np.uint8)
    at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(raw))
    row = np.repeat(np.arange(n), np.diff(np.searchsorted(at, offsets)))
    low = _letters()[points]
    has = np.bincount(row[low != 32], minlength=n) > 0
    # one blank between words, and one before and behind each text
    keep = low != 32
    keep[1:] |= low[:-1] != 32
    low, row = low[keep], row[keep]
    count = np.bincount(row, minlength=n)
    size = np.where(count > 0, count + 2, 0)
    ends = np.cumsum(size)
    padded = np.full(ends[-1] if n else 0, 32, np.uint64)
    padded[np.arange(len(low)) + 2 * np.cumsum(count > 0)[row] - 1] = low
    rows = np.repeat(np.arange(n), size)
    if len(padded) < GRAM:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), has
    h = padded[: 1 - GRAM].copy()
    for k in range(1, GRAM):
        h *= np.uint64(0x110000)
        h += padded[k : len(padded) - GRAM + 1 + k]
    inside = rows[: 1 - GRAM] == rows[GRAM - 1 :]
    # a gram that begins or ends in a doubled blank says nothing more than its neighbour
    inside &= ~((padded[: 1 - GRAM] == 32) & (padded[1 : len(padded) - GRAM + 2] == 32))
    return mixed(h[inside]), rows[: 1 - GRAM][inside], has


def places(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The cells of each 4-gram."""
    mask = np.uint64((1 << bits) - 1)
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    for k in range(HASHES):
        yield ((hashes + np.uint64(k) * step) & mask).astype(np.int64)


class Filters:
    """Bit-sliced Bloom filters: cell c, byte l // 8, bit l % 8 belongs to language l."""

    def __init__(self, languages: list[str], bits: int, words: np.ndarray = (), slices: np.ndarray = (), masks: np.ndarray = ()):
        """``masks``: the bits of eight cells each, at 8 * ``words`` of the slice of eight languages."""
        self.languages, self.bits = languages, bits
        self.width = max(1, -(-len(languages) // 8))
        eight = np.zeros((self.width, 1 << (bits - 3)), np.uint64)
        if len(words):
            eight[slices, words] = masks
        self.cells = eight.view(np.uint8)
        fill = np.array([np.mean(self.cells[i // 8] >> (i % 8) & 1) for i in range(len(languages))])
        self.false = fill**HASHES

    def places(self, hashes: np.ndarray) -> Iterator[np.ndarray]:
        return places(hashes, self.bits)

    def counts(self, hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """4-grams of each row that each language contains, and 4-grams of each row."""
        places = [*self.places(hashes)]
        total = np.bincount(rows, minlength=n)
        out = np.zeros((n, 8 * self.width))
        table = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
        for k in range(self.width):
            mask = self.cells[k][places[0]]
            for at in places[1:]:
                mask &= self.cells[k][at]
            out[:, 8 * k : 8 * k + 8] = np.bincount(rows * 256 + mask, minlength=n * 256).reshape(n, 256) @ table
        return out[:, : len(self.languages)], total


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", share: float = SHARE) -> Filters:
    """Fit the filters on all rows with a text and a language.

    Counts are summed in each task first; what reaches the driver are the cells, bounded by 2 ** ``BITS``."""
    counts = T.StructType([T.StructField("lang", T.StringType()), T.StructField("gram", T.LongType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0

        def flush():
            for name, (h, n) in held.items():
                for k in range(0, len(h), 100_000):
                    part = slice(k, k + 100_000)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(h[part]), pa.string()), pa.array(h[part].view(np.int64)), pa.array(n[part])], names=counts.names)

        for b in batches:
            names = np.array(b.column("lang").to_pylist(), object)
            h, rows, _ = grams(*utf8(b.column("text")))
            for name in {*names.tolist()}:
                new, n = np.unique(h[(names == name)[rows]], return_counts=True)
                if name in held:
                    old = held[name]
                    new, back = np.unique(np.concatenate([old[0], new]), return_inverse=True)
                    n = np.bincount(back, np.concatenate([old[1], n])).astype(np.int64)
                held[name] = (new, n)
            size = sum(len(x[0]) for x in held.values())
            if size > HELD:
                yield from flush()
                held = {}
        yield from flush()

    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    found = rows.mapInArrow(run, counts).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    found = written(found, "language-grams")
    totals = found.groupBy("lang").agg(F.sum("n").alias("total")).collect()  # a row per language
    totals = sorted(((r["lang"], r["total"]) for r in totals), key=lambda x: (-x[1], x[0]))
    if not totals:
        return Filters([], 10)
    index = F.create_map(*(F.lit(x) for k, (name, _) in enumerate(totals) for x in (name, k)))
    whole = F.create_map(*(x for name, total in totals for x in (F.lit(name), F.lit(float(total)))))
    rated = found.select("gram", index[F.col("lang")].alias("language"), (F.col("n") / whole[F.col("lang")]).alias("rate"))
    # a row per 4-gram: the languages it belongs to
    many = rated.groupBy("gram").agg(F.collect_list(F.struct("language", "rate")).alias("x"), F.max("rate").alias("top"))
    owned = many.select("gram", F.transform(F.filter("x", lambda x: x["rate"] >= share * F.col("top")), lambda x: x["language"]).alias("languages"))
    size = owned.agg(F.sum(F.size("languages"))).first()[0]
    bits = int(np.clip(np.ceil(np.log2(size * CELLS)), 10, BITS))
    kind = "slice int, word int, mask long"

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("languages")
            language = lists.flatten().to_numpy()
            h = np.repeat(b.column("gram").to_numpy().view(np.uint64), np.diff(lists.offsets.to_numpy()))
            for at in places(h, bits):
                bit = (language % 8 + 8 * (at % 8)).astype(np.uint64)
                key, back = np.unique((language // 8).astype(np.int64) << 32 | at // 8, return_inverse=True)
                mask = np.zeros(len(key), np.uint64)
                np.bitwise_or.at(mask, back, np.uint64(1) << bit)
                yield pa.RecordBatch.from_arrays([pa.array((key >> 32).astype(np.int32)), pa.array((key & 0xFFFFFFFF).astype(np.int32)), pa.array(mask.view(np.int64))], names=["slice", "word", "mask"])

    held = owned.mapInArrow(cells, kind).groupBy("slice", "word").agg(F.bit_or("mask").alias("mask")).toArrow()  # at most 2 ** (BITS - 3) rows for eight languages
    return Filters([x[0] for x in totals], bits, *(held.column(c).to_numpy() for c in ("word", "slice")), held.column("mask").to_numpy().view(np.uint64))


def predict(df: DataFrame, filters: Filters, text: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """Add the predicted language and its score: the corrected share of the text's 4-grams that the language contains."""
    keep = [c for c in df.columns if c not in (lang_out, score_out)]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType())])
    shared = df.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        for b in batches:
            n = b.num_rows
            h, rows, has = grams(*utf8(b.column(text)))
            names, best = [UNKNOWN] * n, np.zeros(n)
            if f.languages and n:
                hits, total = f.counts(h, rows, n)
                share = (hits - total[:, None] * f.false) / np.maximum(total[:, None] * (1 - f.false), 1e-9)
                top = np.argmax(share, axis=1)
                best = np.where(has, np.clip(share[np.arange(n), top], 0, 1), 0.0)
                names = [f.languages[k] if ok else UNKNOWN for k, ok in zip(top.tolist(), has.tolist())]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(names, pa.string()), pa.array(best, pa.float64())], names=[*keep, lang_out, score_out])

    return df.mapInArrow(run, schema)

"""Phrase collocation mining by direct-address tiles.

Phrases are counted length by length.  Words get numbers by rank of frequency: the ``HEAD`` most frequent ones of the
corpus have theirs in every task, rarer words are numbered per window of ``WINDOW`` words.  The pairs (number, number of
the next word) of a window fall into square tiles of the number plane; a tile of ranks that holds many pairs of the
window is counted densely, by one ``bincount`` over its cells, all the others in sorted coordinate form.  Tasks pass on
one row per different pair of a window, Spark sums them, and pairs of ``min_count`` or more are the candidates.  They are
then ranked themselves and take the place of the first number: (pair, word) tiles count the three-word phrases, and so
on.  A phrase can only be frequent if both its parts without the last and the first word are, so only such positions
are counted; tasks know the frequent phrases from Bloom filters of a fixed size (``BITS``).  False positives of a
filter cost rows, not correctness: sums decide.

Words are told apart by 64-bit hashes of language and word.  The table of words holds each with its text, so two words
with one hash are seen there; that hash is then no word's any more and the words are counted again, until no two are
alike.

A cut of a phrase after k words has the score floor(SCALE * f(phrase)^2 / (f(first part) * f(rest))), in 38-digit
decimals; the cut with the lowest score counts, ties go to the smallest k.

Defined cases: null and empty texts have no words; a null language is ``und``; repeated rows count each; extra columns
are not read; words and texts may be of any length (one longer text is an Arrow batch of its own); an empty table gives
an empty result.  Ties in a ranking are ordered by count, then phrase (in byte order).
"""

from __future__ import annotations

import functools
import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklab.llm.common import M2, P_INVERSE, mixed, powers, small_batches, utf8, word_spans, written

#: Words of a phrase at most, its occurrences at least, phrases of a language in the report, scale of the score, and
#: the percentage of a phrase's occurrences inside a longer one from which only the longer one is reported.
LONGEST, MIN_COUNT, TOP, SCALE, INSIDE = 3, 10, 2000, 1_000_000, 50
#: Ranked phrases of a length that all tasks know, words of a window, and the bits of a tile's side.
HEAD, WINDOW, SIDE = 1 << 14, 1 << 20, 9
#: A tile with a pair for every so many cells is counted densely.
SPARSE = 16
#: Bits of a Bloom filter (log2) and bits set per phrase.
BITS, PROBES = 26, 3
#: Words that a task gathers at most before it starts anew.
MEMO = 400_000
#: Parts in which the phrases of a language are ranked first.
PARTS = 64
#: Bytes between words: blank and tab, and those that also end a piece (fixed values).
_ENDS, _BETWEEN = (np.zeros(256, bool) for _ in range(2))
_ENDS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_BETWEEN[[32, 9]] = True
_BETWEEN |= _ENDS
#: Bytes whose hashes are summed at a time, and what each byte value counts.
SPAN = 1 << 20
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64))


class _Numbers(dict):
    """64-bit numbers of the words of a language whose hash is shared; those in ``bad`` are no word's number."""

    def __init__(self, lang: str, bad: frozenset):
        super().__init__()
        self.bad, self.salt = bad, hashlib.blake2b(lang.encode(), digest_size=16).digest()

    def __missing__(self, word: bytes) -> int:
        turn, out = 0, None
        while out is None or out in self.bad:
            out = int.from_bytes(hashlib.blake2b(word, digest_size=8, salt=self.salt, person=str(turn).encode()).digest(), "little", signed=True)
            turn += 1
        self[word] = out
        return out


@functools.lru_cache(1)
def _scales() -> tuple[np.ndarray, np.ndarray]:
    return powers(SPAN + 1), powers(SPAN + 1, P_INVERSE)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of the words between ``starts`` and ``ends`` (ascending), equal for equal bytes; the sums run
    over ``SPAN`` bytes at a time, or one longer word."""
    out = np.zeros(len(starts), np.uint64)
    k = 0
    while k < len(starts):
        z = max(int(np.searchsorted(ends, starts[k] + SPAN, "right")), k + 1)
        at = int(starts[k])
        part = data[at : int(ends[z - 1])]
        up, back = _scales() if len(part) <= SPAN else (powers(len(part)), powers(len(part), P_INVERSE))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTES[part] * up[: len(part)], out=sums[1:])
        a, e = starts[k:z] - at, ends[k:z] - at
        out[k:z] = (sums[e] - sums[a]) * back[a] + (e - a).astype(np.uint64) * M2
        k = z
    return out


def word_ids(raw: bytes, starts: np.ndarray, ends: np.ndarray, langs: list[str], n: np.ndarray, bad: frozenset) -> np.ndarray:
    """The ids of words, the next ``n[k]`` of them in ``langs[k]``; words whose hash is in ``bad`` are numbered singly."""
    salts = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in set(langs)}
    out = mixed(word_hashes(np.frombuffer(raw, np.uint8), starts, ends) ^ np.repeat(np.array([salts[x] for x in langs], np.uint64), n)).view(np.int64)
    if bad:
        numbers = {x: _Numbers(x, bad) for x in salts}
        rows = np.repeat(np.arange(len(langs)), n)
        for k in np.flatnonzero(np.isin(out, np.array([*bad], np.int64))).tolist():
            out[k] = numbers[langs[rows[k]]][raw[starts[k] : ends[k]]]
    return out


def _spans(b: pa.RecordBatch) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased bytes of all texts, start and end of their words, and the words before each text (n + 1 numbers)."""
    raw, offsets = utf8(b.column("text"))
    raw = raw.lower()  # of bytes: A-Z alone
    return raw, *word_spans(np.frombuffer(raw, np.uint8), offsets, _BETWEEN)


def _goes_on(raw: bytes, starts: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Whether each word goes on with the next one in its piece."""
    if not len(starts):
        return np.zeros(0, bool)
    pieces = np.cumsum(_ENDS[np.frombuffer(raw, np.uint8)])[starts]
    joined = np.append(pieces[1:] == pieces[:-1], False)
    joined[before[1:][before[1:] > 0] - 1] = False
    return joined


def _words(docs: DataFrame, bad: frozenset) -> DataFrame:
    """id, lang, word, n of all words; an id may still stand for several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush():
            for lang, counter in held.items():
                items = list(counter.items())
                for k in range(0, len(items), 20_000):
                    some = items[k : k + 20_000]
                    ends = np.cumsum([len(w) for w, _ in some])
                    ids = word_ids(b"".join(w for w, _ in some), np.append(0, ends[:-1]), ends, [lang], np.array([len(some)]), bad)
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array([lang] * len(some)), pa.array([w.decode("utf-8", "replace") for w, _ in some]), pa.array([n for _, n in some], pa.int64())], names=["id", "lang", "word", "n"])

        for b in batches:
            raw, starts, ends, before = _spans(b)
            words = [raw[a:e] for a, e in zip(starts.tolist(), ends.tolist())]
            for lang, a, e in zip(b.column("lang").to_pylist(), before[:-1].tolist(), before[1:].tolist()):
                if e > a:
                    held.setdefault(lang, Counter()).update(words[a:e])
            if sum(map(len, held.values())) > MEMO:
                yield from flush()
                held.clear()
        yield from flush()

    return docs.mapInArrow(run, "id long, lang string, word string, n long").groupBy("id", "lang", "word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame) -> tuple[DataFrame, frozenset]:
    """The table of words (w0, lang, phrase, n), and the hashes that are not used because two words share them."""
    bad: frozenset = frozenset()
    while True:
        words = written(_words(docs, bad), "phrase-words")
        shared = words.groupBy("id").count().where("count > 1").collect()  # of n words about n * n / 2 ** 65
        if not shared:
            return words.select(F.col("id").alias("w0"), "lang", F.col("word").alias("phrase"), "n"), bad
        bad |= {r["id"] for r in shared}


def _key(columns: list[np.ndarray]) -> np.ndarray:
    """A 64-bit key of phrases, given as a column of word ids for each place."""
    out = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        out = mixed(out * np.uint64(3) + c.view(np.uint64))
    return out


def _probes(key: np.ndarray) -> list[np.ndarray]:
    return [mixed(key ^ np.uint64(k + 1)) >> np.uint64(64 - BITS) for k in range(PROBES)]


class Bloom:
    """Which phrases are frequent; some others pass as well."""

    def __init__(self, cells: np.ndarray, masks: np.ndarray):
        self.bits = np.zeros(1 << (BITS - 6), np.uint64)
        self.bits[cells] = masks

    def __call__(self, columns: list[np.ndarray]) -> np.ndarray:
        out = np.ones(len(columns[0]), bool)
        for at in _probes(_key(columns)):
            out &= (self.bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out


class Head:
    """Ranks of the most frequent phrases of a length."""

    def __init__(self, columns: list[np.ndarray]):
        self.columns = columns  # by rank
        key = _key(columns)
        self.order = np.argsort(key, kind="stable")
        self.keys = key[self.order]

    def __len__(self) -> int:
        return len(self.keys)

    def __call__(self, columns: list[np.ndarray]) -> np.ndarray:
        """The rank of each phrase, -1 for those that have none; equal keys are compared word by word."""
        if not len(self):
            return np.full(len(columns[0]), -1, np.int64)
        key = _key(columns)
        rank = self.order[np.minimum(np.searchsorted(self.keys, key), len(self) - 1)]
        same = np.ones(len(key), bool)
        for own, c in zip(self.columns, columns):
            same &= own[rank] == c
        return np.where(same, rank, -1)


@dataclass
class Level:
    """What tasks know of the frequent phrases of one length."""

    head: Head
    frequent: Bloom


def _level(found: DataFrame, length: int, head: int) -> Level:
    """Ranks and filter of the phrases ``found`` (w0 .. and n)."""
    columns = [f"w{k}" for k in range(length)]
    top = found.orderBy(F.desc("n"), *columns).limit(head).select(*columns).toArrow()  # at most ``head`` rows

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(1 << (BITS - 6), np.uint64)
        for b in batches:
            for at in _probes(_key([c.to_numpy(zero_copy_only=False) for c in b.columns])):
                np.bitwise_or.at(own, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
        some = np.flatnonzero(own)
        for k in range(0, len(some), 100_000):
            s = some[k : k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(s.astype(np.int32)), pa.array(own[s].view(np.int64))], names=["cell", "mask"])

    cells = found.select(*columns).mapInArrow(bits, "cell int, mask long").groupBy("cell").agg(F.bit_or("mask").alias("mask")).toArrow()  # at most 2 ** (BITS - 6) rows
    return Level(Head([top.column(c).to_numpy() for c in columns]), Bloom(cells.column("cell").to_numpy(), cells.column("mask").to_numpy().view(np.uint64)))


def tiled(a: np.ndarray, b: np.ndarray, heads: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs of two columns of numbers, and how often each occurs.

    ``heads`` says below which numbers they are ranks: in that part of the plane crowded tiles are counted densely."""
    out = []
    wide = max(heads[1] >> SIDE, 1)
    tile = np.where((a < (heads[0] >> SIDE << SIDE)) & (b < (heads[1] >> SIDE << SIDE)), (a >> SIDE) * wide + (b >> SIDE), -1)
    cells = 1 << (2 * SIDE)
    low = (1 << SIDE) - 1
    for t in np.flatnonzero(np.bincount(tile + 1)[1:] >= cells // SPARSE).tolist():
        inside = tile == t
        counts = np.bincount((a[inside] & low) << SIDE | (b[inside] & low), minlength=cells)
        some = np.flatnonzero(counts)
        out.append(((some >> SIDE) + (t // wide << SIDE), (some & low) + (t % wide << SIDE), counts[some]))
        tile[inside] = -2
    rest = np.sort(a[tile > -2] << 32 | b[tile > -2])
    new = np.flatnonzero(np.append(True, rest[1:] != rest[:-1])) if len(rest) else np.zeros(0, np.int64)
    out.append((rest[new] >> 32, rest[new] & 0xFFFFFFFF, np.diff(np.append(new, len(rest)))))
    return tuple(np.concatenate(x) for x in zip(*out))


def _numbered(head: Head, columns: list[np.ndarray], local: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Numbers of the phrases at the ``wanted`` places (others: 0): their rank, or one behind all ranks that stands for
    equal ``local`` values; and the word ids behind every number."""
    number = np.zeros(len(local), np.int64)
    at = np.flatnonzero(wanted)
    rank = head([c[at] for c in columns])
    number[at] = rank
    rare = at[rank < 0]
    _, first, inverse = np.unique(local[rare], return_index=True, return_inverse=True)
    number[rare] = len(head) + inverse
    return number, [np.concatenate([own, c[rare[first]]]) for own, c in zip(head.columns, columns)]


def window_counts(ids: np.ndarray, joined: np.ndarray, levels: list[Level]) -> tuple[list[np.ndarray], np.ndarray]:
    """Word ids (a column for each place) and counts of all phrases of ``len(levels) + 1`` words in a window whose parts
    may be frequent by ``levels`` (of 1, 2, .. words)."""
    valid = levels[0].frequent([ids])
    word, table = _numbered(levels[0].head, [ids], ids, valid)
    symbol, names = word, table
    for length, level in enumerate(levels[1:], 2):
        # both parts frequent, in one piece, and the whole frequent
        n = len(ids) - length + 1
        if n < 1:
            return [np.zeros(0, np.int64)] * (len(levels) + 1), np.zeros(0, np.int64)
        columns = [ids[k : k + n] for k in range(length)]
        valid = valid[:n] & valid[1 : n + 1] & joined[length - 2 : length - 2 + n]
        valid[valid] = level.frequent([c[valid] for c in columns])
        symbol, names = _numbered(level.head, columns, symbol[:n] << 32 | word[length - 1 :], valid)
    last = len(levels)  # the place of the last word
    n = max(len(ids) - last, 0)
    valid = valid[:n] & valid[1 : n + 1] & joined[last - 1 : last - 1 + n]
    a, b, count = tiled(symbol[:n][valid], word[last:][valid], (len(levels[-1].head), len(levels[0].head)))
    return [*(c[a] for c in names), table[0][b]], count


def _counted(docs: DataFrame, levels: list[Level], bad: frozenset, window: int) -> DataFrame:
    """w0 .. and n of the phrases of ``len(levels) + 1`` words that may be frequent."""
    held = docs.sparkSession.sparkContext.broadcast(levels)
    columns = [f"w{k}" for k in range(len(levels) + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[np.ndarray] = []
        joined: list[np.ndarray] = []
        n = 0

        def flush():
            words, counts = window_counts(np.concatenate(ids), np.concatenate(joined), held.value)
            for k in range(0, len(counts), 100_000):
                s = slice(k, k + 100_000)
                yield pa.RecordBatch.from_arrays([*(pa.array(w[s]) for w in words), pa.array(counts[s])], names=[*columns, "n"])

        for b in batches:
            raw, starts, ends, before = _spans(b)
            found = word_ids(raw, starts, ends, b.column("lang").to_pylist(), np.diff(before), bad)
            goes_on = _goes_on(raw, starts, before)
            k = 0
            while k < len(before) - 1:
                # the texts that fill the window
                z = min(int(np.searchsorted(before, before[k] + window - n)), len(before) - 1)
                ids.append(found[before[k] : before[z]])
                joined.append(goes_on[before[k] : before[z]])
                n += int(before[z] - before[k])
                k = z
                if n >= window:
                    yield from flush()
                    ids, joined, n = [], [], 0
        if n:
            yield from flush()

    kind = T.StructType([T.StructField(c, T.LongType()) for c in [*columns, "n"]])
    return docs.mapInArrow(run, kind).groupBy(*columns).agg(F.sum("n").alias("n"))


def _score(a: Column, left: Column, right: Column) -> Column:
    whole = "decimal(19,0)"
    return F.call_function("div", F.lit(SCALE).cast("decimal(7,0)") * (a.cast(whole) * a.cast(whole)), left.cast(whole) * right.cast(whole)).cast("long")


def candidates(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, min_count: int = MIN_COUNT, head: int = HEAD, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """All phrases of 2 to ``longest`` words with ``min_count`` occurrences: lang, phrase, a, l, r, score (of their
    worst cut) and ``inside``, the largest count of a longer one that holds them (or null); and n of each lang."""
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    words, bad = vocabulary(docs)
    found = {1: words.where(F.col("n") >= min_count)}
    levels = [_level(found[1], 1, head)]
    for length in range(2, longest + 1):
        found[length] = written(_counted(docs, levels, bad, window).where(F.col("n") >= min_count), f"phrases-{length}")
        if length < longest:
            levels.append(_level(found[length], length, head))
    named = {1: found[1]}
    out = None
    for length in range(2, longest + 1):
        columns = [f"w{k}" for k in range(length)]
        row = found[length].withColumnRenamed("n", "a")
        for k in range(1, length):  # the cut after k words
            first, rest = named[k] if k == 1 else found[k], named[length - k] if k == 1 else found[length - k]
            label = {"lang": "lang", "phrase": "p1"} if k == 1 else {}
            row = row.join(first.select(*(F.col(f"w{i}") for i in range(k)), F.col("n").alias(f"l{k}"), *(F.col(c).alias(n) for c, n in label.items())), [f"w{i}" for i in range(k)])
            row = row.join(rest.select(*(F.col(f"w{i}").alias(f"w{k + i}") for i in range(length - k)), F.col("n").alias(f"r{k}"), *([F.col("phrase").alias("p2")] if k == 1 else [])), [f"w{k + i}" for i in range(length - k)])
        cuts = F.array(*(F.struct(_score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, length)))
        row = row.select(*columns, "lang", F.concat_ws(" ", "p1", "p2").alias("phrase"), "a", F.array_min(cuts).alias("cut"))
        longer = None
        for more in range(length + 1, longest + 1):
            for at in range(more - length + 1):
                part = found[more].select(*(F.col(f"w{at + i}").alias(f"w{i}") for i in range(length)), "n")
                longer = part if longer is None else longer.unionAll(part)
        if longer is None:
            row = row.withColumn("inside", F.lit(None).cast("long"))
        else:
            row = row.join(longer.groupBy(*columns).agg(F.max("n").alias("inside")), columns, "left")
        if length < longest:  # the next length takes its texts from here
            row = written(row, f"phrase-rows-{length}")
            named[length] = row.select(*columns, "lang", "phrase", F.col("a").alias("n"))
        mine = row.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", "inside")
        out = mine if out is None else out.unionAll(mine)
    return out, words.groupBy("lang").agg(F.sum("n").alias("n"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, min_count: int = MIN_COUNT, top: int = TOP, inside: int = INSIDE, head: int = HEAD, window: int = WINDOW) -> DataFrame:
    """The ``top`` phrases of each language by score, a (both descending) and phrase: lang, rank, phrase, a, l, r, n,
    score.  Phrases of whose occurrences ``inside`` percent are also those of one longer phrase are left out."""
    rows, totals = candidates(docs, text, lang, longest, min_count, head, window)
    kept = rows.where(F.col("inside").isNull() | (100 * F.col("inside") < inside * F.col("a"))).drop("inside")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # first within parts of a language, so that one task never sorts all its phrases
    part = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    best = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

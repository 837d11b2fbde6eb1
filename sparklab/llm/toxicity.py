"""Toxicity by class-conditional Kneser-Ney models.

Two models of words, one of toxic and one of ordinary texts, are compared by the length-normalised log-likelihood ratio
of passages: a text's ratio is the largest mean over ``PASSAGE`` successive words.  Both models use Kneser-Ney
continuation counts with absolute discounting and back off, with one weight, to counts shared by the classes:

    P_c(w) = (1 - b) * max(n_c(w) - d, 0) / sum + b * P_shared(w)

n_c(w) is the number of different words before w in texts of the class (at most the number of the class's texts that
hold w, so that neither copies of a text nor one very long text lift a rare expression), P_shared comes from the
number of texts that hold w in the whole corpus, labelled or not, and b is the discounted share of both classes.  An expression that neither class
shows more than d times has the ratio 0: a class of few texts does not look likely by its size alone.  A tenth of the
training documents stays out of the counts and fits the two numbers that turn the ratio into a probability.

The class counts come from at most ``SAMPLE`` labelled documents of each class (``chosen``: those of the smallest id
hashes, which are few enough to be broadcast, so that no text is shuffled); the shared counts from all documents.

Word entries grow with the corpus.  Up to ``BROADCAST`` entries (12 bytes each) go to all tasks; beyond, texts and
entries meet in a shuffle join.  Words are runs of letters, lower-cased, as 64-bit hashes.

Defined cases: null and empty texts and texts without letters have the ratio 0; rows with a null label do not train;
repeated rows count each; extra columns are carried, one named like the result is replaced; a
very long text is an Arrow batch of its own; a class without training rows, or no calibration row, gives the
score 0 to all; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklab.llm.common import P, Rolling, mixed, unused, utf8, written
from sparklab.llm.language import _letters

#: Discount of continuation counts; words of a passage.
DISCOUNT, PASSAGE = 2.0, 2
#: One of so many training documents calibrates instead of being counted.
CALIBRATE = 10
#: Labelled documents of a class that are counted at most.
SAMPLE = 20_000
#: Entries that are broadcast at most (12 bytes each).
BROADCAST = 8_000_000
#: Distinct bigrams that a task gathers before it passes them on.
HELD = 1_000_000
#: The word before the first one.
BEGIN = np.uint64(1)
#: Ratios are gathered in cells of this width, over this range, to fit the probability.
CELL, RANGE = 0.01, 20.0


def words(raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words of the rows, of the words before them, and the row of each."""
    n = len(offsets) - 1
    points = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    data = np.frombuffer(raw, np.uint8)
    at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(raw))
    bounds = np.searchsorted(at, offsets)
    low = _letters()[points]
    letter = low != 32
    first, last = letter.copy(), letter.copy()
    first[1:] &= ~letter[:-1]
    last[:-1] &= ~letter[1:]
    begin, end = bounds[:-1][bounds[:-1] < len(low)], bounds[1:][bounds[1:] > 0] - 1
    first[begin], last[end] = letter[begin], letter[end]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word = Rolling(low).slices(starts, ends)
    row = np.searchsorted(bounds, starts, "right") - 1
    before = np.empty_like(word)
    before[0], before[1:] = BEGIN, word[:-1]
    before[1:][row[1:] != row[:-1]] = BEGIN
    return word, before, row


def pair_key(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(before * P + word)


@dataclass
class Model:
    """Entries (key, value) of the words with a ratio, and the two numbers of the probability."""

    entries: DataFrame
    n_entries: int
    slope: float = 0.0
    offset: float = -np.inf


def _first(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorting order by the keys (the last one first) and the places in it where a new combination begins."""
    order = np.lexsort(keys)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    return order, np.flatnonzero(new)


def chosen(labels: DataFrame, label: str = "toxic", key: str = "doc_id", sample: int = SAMPLE) -> DataFrame:
    """``key`` and ``label`` (the largest of an id) of at most ``sample`` ids of each class, those of the smallest hashes."""
    rows = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias("label"))
    of = lambda c: rows.where(F.col("label") == c).orderBy(F.xxhash64(key), key).limit(sample)
    return of(1).unionAll(of(0))


def _held_by(docs: DataFrame) -> DataFrame:
    """word, texts: how many texts hold each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merge():
            w, n = (np.concatenate([x[k] for x in held]) for k in range(2))
            order, new = _first(w)
            return (w[order][new], np.add.reduceat(n[order], new)) if len(new) else (w, n)

        def flush():
            w, n = merge()
            for k in range(0, len(w), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(w[k : k + 100_000].view(np.int64)), pa.array(n[k : k + 100_000])], names=["word", "texts"])

        for b in batches:
            word, _, row = words(*utf8(b.column("text")))
            order, new = _first(word, row)
            held.append((word[order][new], np.ones(len(new), np.int64)))
            size += len(new)
            if size > HELD:
                held = [merge()]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return docs.mapInArrow(run, "word long, texts long").groupBy("word").agg(F.sum("texts").alias("texts"))


def _counted(rows: DataFrame) -> DataFrame:
    """What tasks saw, summed in each first: of a word and the word before it (``pair`` is their hash), whether toxic
    and ordinary texts hold it; of a word alone (``pair`` 0), how many toxic and ordinary texts hold it."""
    out = T.StructType([*(T.StructField(c, T.LongType()) for c in ("word", "pair")), *(T.StructField(c, T.IntegerType()) for c in ("toxic", "ordinary"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def merge():
            w, p, t, o = (np.concatenate([x[k] for x in held]) for k in range(4))
            order, new = _first(p, w)
            if not len(new):
                return w, p, t, o
            w, p = w[order][new], p[order][new]
            t, o = np.add.reduceat(t[order], new), np.add.reduceat(o[order], new)
            return w, p, np.where(p == 0, t, np.minimum(t, 1)), np.where(p == 0, o, np.minimum(o, 1))

        def flush():
            w, p, t, o = merge()
            for k in range(0, len(w), 100_000):
                s = slice(k, k + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(w[s].view(np.int64)), pa.array(p[s].view(np.int64)), pa.array(t[s].astype(np.int32)), pa.array(o[s].astype(np.int32))], names=out.names)

        for b in batches:
            word, before, row = words(*utf8(b.column("text")))
            label = np.array(b.column("label").to_pylist(), bool)
            toxic = label[row] if len(row) else np.zeros(0, bool)
            held.append((word, pair_key(before, word) | np.uint64(1), toxic.astype(np.int64), (~toxic).astype(np.int64)))
            order, new = _first(word, row)
            w, toxic = word[order][new], toxic[order][new]
            held.append((w, np.zeros(len(w), np.uint64), toxic.astype(np.int64), (~toxic).astype(np.int64)))
            size += len(word) + len(w)
            if size > HELD:
                held = [merge()]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return rows.mapInArrow(run, out)


def _stats(counts: DataFrame) -> DataFrame:
    """Per word: n_toxic and n_ordinary, the continuation counts (at most the texts)."""
    pairs = counts.groupBy("word", "pair").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
    alone = F.col("pair") == 0
    of = lambda c: F.least(F.sum((~alone & (F.col(c) > 0)).cast("long")), F.sum(F.when(alone, F.col(c)).otherwise(0))).alias(f"n_{c}")
    return pairs.groupBy("word").agg(of("toxic"), of("ordinary"))


def _ratios(stats: DataFrame, shared: DataFrame) -> DataFrame | None:
    """The entries (key, value) of all words whose ratio is not 0."""
    left = {c: F.greatest(F.col(f"n_{c}") - DISCOUNT, F.lit(0.0)) for c in ("toxic", "ordinary")}
    total = stats.agg(F.sum(left["toxic"]).alias("toxic"), F.sum(left["ordinary"]).alias("ordinary"), F.sum(F.col("n_toxic") + F.col("n_ordinary")).alias("n")).first()
    if not total["toxic"] or not total["ordinary"]:
        return None
    texts, kinds = shared.agg(F.sum("texts"), F.count("*")).first()
    back = 1 - (total["toxic"] + total["ordinary"]) / total["n"]
    behind = back * (F.coalesce("texts", F.lit(0)) + 0.5) / ((texts or 0) + 0.5 * (kinds + 1))
    p = {c: (1 - back) * left[c] / total[c] + behind for c in left}
    known = stats.where((left["toxic"] > 0) | (left["ordinary"] > 0)).join(shared, "word", "left")
    return known.select(F.col("word").alias("key"), F.log(p["toxic"] / p["ordinary"]).cast("float").alias("value"))


def train(labelled: DataFrame, text: str = "text", label: str = "label", key: str = "doc_id", corpus: DataFrame | None = None) -> Model:
    """Fit the models on all rows with a text and a 0/1 label, and the probability on a tenth of them (by ``key``).

    The shared counts are those of the texts of ``corpus`` (``labelled`` itself without one)."""
    spark = labelled.sparkSession
    rows = labelled.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).cast("int").alias("label")).where("text is not null and label is not null")
    part = F.pmod(F.xxhash64("key"), F.lit(CALIBRATE))
    stats = written(_stats(_counted(rows.where(part != 0).select("text", "label"))), "toxicity-counts")
    shared = written(_held_by((labelled if corpus is None else corpus).select(F.col(text).alias("text"))), "toxicity-words")
    found = _ratios(stats, shared)
    if found is None:
        return Model(spark.createDataFrame([], "key long, value float"), 0)
    found = written(found, "toxicity-ratios")
    model = Model(found, found.count())
    ratios = top_ratio(rows.where(part == 0).select("text", "label"), model)
    cells = ratios.groupBy(F.least(F.greatest(F.floor(F.col("ratio") / CELL), F.lit(int(-RANGE / CELL))), F.lit(int(RANGE / CELL))).alias("cell")).agg(F.sum("label").alias("toxic"), F.count("*").alias("n")).toPandas()
    if len(cells):
        model.slope, model.offset = _logistic((cells["cell"].to_numpy(float) + 0.5) * CELL, cells["toxic"].to_numpy(float), cells["n"].to_numpy(float))
    return model


def _logistic(x: np.ndarray, toxic: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability (two numbers, Newton steps, a little shrinkage of the scaled slope)."""
    scale = max(float(np.sqrt(np.average((x - np.average(x, weights=n)) ** 2, weights=n))), 1e-6)
    design = np.column_stack([x / scale, np.ones(len(x))])
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (toxic - n * p) - np.array([0.05, 0.01]) * beta
        hessian = (design * (n * p * (1 - p))[:, None]).T @ design + np.diag([0.05, 0.01])
        step = np.linalg.solve(hessian, gradient)
        beta = beta + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0] / scale), float(beta[1])


class Lookup:
    """Values of sorted keys; unknown keys have 0."""

    def __init__(self, key: np.ndarray, value: np.ndarray):
        order = np.argsort(key)
        self.key, self.value = key[order], value[order]

    def __call__(self, key: np.ndarray) -> np.ndarray:
        if not len(self.key):
            return np.zeros(len(key), np.float32)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.value[at], np.float32(0))


def passages(value: np.ndarray, row: np.ndarray, n: int, width: int) -> np.ndarray:
    """The largest mean of ``width`` successive values of each of ``n`` rows (shorter rows: of all); 0 without values."""
    out = np.zeros(n)
    count = np.bincount(row, minlength=n)
    end = np.cumsum(count)
    total = np.concatenate([[0.0], np.cumsum(value, dtype=np.float64)])
    short = np.flatnonzero((count > 0) & (count <= width))
    out[short] = (total[end[short]] - total[end[short] - count[short]]) / count[short]
    first = np.flatnonzero(np.arange(len(value)) + width <= end[row]) if len(value) else np.zeros(0, np.int64)
    first = first[count[row[first]] > width]
    if len(first):
        mean = (total[first + width] - total[first]) / width
        at = np.flatnonzero(np.concatenate([[True], row[first][1:] != row[first][:-1]]))
        out[row[first][at]] = np.maximum.reduceat(mean, at)
    return out


def top_ratio(df: DataFrame, model: Model, text: str = "text", out: str = "ratio", broadcast: int = BROADCAST, width: int = PASSAGE) -> DataFrame:
    """Add the log-likelihood ratio (toxic over ordinary) per word of a text's most toxic passage."""
    spark = df.sparkSession
    if model.n_entries <= broadcast:
        held = model.entries.toArrow()
        table = spark.sparkContext.broadcast(Lookup(held.column("key").to_numpy().view(np.uint64), held.column("value").to_numpy()))
        keep = [c for c in df.columns if c != out]
        schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(out, T.DoubleType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            look = table.value
            for b in batches:
                word, _, row = words(*utf8(b.column(text)))
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(passages(look(word), row, b.num_rows, width))], names=[*keep, out])

        return df.mapInArrow(run, schema)
    # beyond the bound: every word meets its entry in a shuffle join (hot words are split by the engine), and the
    # values of each passage are summed; passages without an entry have the ratio 0
    place, top, bare = (unused(df, n) for n in ("_row", "_top", "_bare"))
    rows = df.drop(out).withColumn(place, F.monotonically_increasing_id())
    kind = T.StructType([T.StructField(c, T.LongType()) for c in ("row", "key", "at", "n")])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            word, _, row = words(*utf8(b.column("text")))
            n = np.bincount(row, minlength=b.num_rows)
            at = np.arange(len(word)) - (np.cumsum(n) - n)[row]
            yield pa.RecordBatch.from_arrays([pa.array(b.column("row").to_numpy()[row]), pa.array(word.view(np.int64)), pa.array(at), pa.array(n[row])], names=kind.names)

    found = rows.select(F.col(place).alias("row"), F.col(text).alias("text")).mapInArrow(emit, kind).join(model.entries, "key")
    starts = F.sequence(F.greatest(F.col("at") - (width - 1), F.lit(0)), F.least(F.col("at"), F.greatest(F.col("n") - width, F.lit(0))))
    sums = found.select("row", "n", "value", F.explode(starts).alias("start")).groupBy("row", "start", "n").agg((F.sum("value") / F.least(F.lit(width), F.col("n"))).alias("mean"))
    best = sums.groupBy(F.col("row").alias(place)).agg(F.max("mean").alias(top), (F.count("*") < F.greatest(F.max("n") - width + 1, F.lit(1))).alias(bare))
    ratio = F.coalesce(F.when(F.col(bare), F.greatest(F.col(top), F.lit(0.0))).otherwise(F.col(top)), F.lit(0.0))
    return rows.join(best, place, "left").withColumn(out, ratio).drop(place, top, bare)


def score(df: DataFrame, model: Model, text: str = "text", out: str = "score", broadcast: int = BROADCAST) -> DataFrame:
    """Add the probability that a text is toxic."""
    ratio = unused(df, "_ratio")
    ratios = top_ratio(df.drop(out), model, text, ratio, broadcast)
    if not np.isfinite(model.offset):
        return ratios.drop(ratio).withColumn(out, F.lit(0.0))
    return ratios.withColumn(out, 1 / (1 + F.exp(-F.least(F.greatest(F.col(ratio) * model.slope + model.offset, F.lit(-30.0)), F.lit(30.0))))).drop(ratio)

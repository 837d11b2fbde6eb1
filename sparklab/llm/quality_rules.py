"""Quality classifier: a sparse ensemble of rules over text statistics.

Shallow trees are grown on the statistics of labelled texts; every path from a root is a conjunctive rule (all of a few
statistics above or below thresholds).  A lasso logistic regression over the rules leaves few of them a weight, and
those are compiled into one Spark column expression, so scoring is a projection beside the statistics.

The statistics describe a text's form (shares of letters, capitals, symbols, bars, marks and digits, word lengths,
repeated words, lines); no label, language, source or id goes in.  The fit uses at most ``SAMPLE`` labelled rows, those
of the smallest id hashes.

Defined cases: null and empty texts have the statistics 0 and are scored like any other; rows with a null label do not
train; several labels of an id count once (the largest); extra columns are carried, one named like
the score is replaced; a very long text is an Arrow batch of its own (some 60 bytes per byte of it); without training rows, or with one
class only, all scores are the share of label 1 (0.5 without rows); empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklab.llm.common import Rolling, scratch, unused, utf8, word_spans, written

#: Labelled rows that the fit uses at most.
SAMPLE = 20_000
TREES, DEPTH, LASSO, SEED = 24, 3, 0.002, 7

STATISTICS = ["n_words", "word_length", "longest_word", "letter_share", "upper_share", "digit_share", "symbol_share", "bar_share", "mark_share", "space_share", "line_words", "distinct_share", "repeat_share", "bare_share", "high_share"]

_LETTER, _UPPER, _DIGIT, _SYMBOL, _BAR, _MARK, _BLANK, _HIGH = (np.zeros(256, bool) for _ in range(8))
_UPPER[65:91] = True
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = _HIGH[128:] = True
_DIGIT[48:58] = True
_SYMBOL[[ord(c) for c in "#$%&*+/<=>@\\^_`{}~[]"]] = True
_BAR[ord("|")] = True
_MARK[[ord(c) for c in "!?"]] = True
_BLANK[[32, 9, 10, 11, 12, 13]] = True


def measure(raw: bytes, offsets: np.ndarray) -> np.ndarray:
    """The statistics of every row (rows x statistics)."""
    n = len(offsets) - 1
    data = np.frombuffer(raw, np.uint8)
    size = np.maximum(np.diff(offsets), 1)
    row = np.repeat(np.arange(n), np.diff(offsets))

    # one pass over byte values; all byte shares are sums over its columns
    counts = np.bincount(row * 256 + data, minlength=n * 256).reshape(n, 256) if n else np.zeros((0, 256))
    total = lambda table: counts[:, table].sum(axis=1)
    starts, ends, before = word_spans(data, offsets)
    words = np.diff(before)
    some = np.maximum(words, 1)
    length = ends - starts
    of = np.repeat(np.arange(n), words)
    longest = np.zeros(n)
    np.maximum.at(longest, of, length)
    distinct, repeat, bare = np.zeros(n), np.zeros(n), np.zeros(n)
    if len(starts):
        hashes = Rolling(data).slices(starts, ends)
        same = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
        repeat = np.bincount(of[1:][same], minlength=n)
        order = np.lexsort((hashes, of))
        h, o = hashes[order], of[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (o[1:] != o[:-1])])
        distinct = np.bincount(o[new], minlength=n)
        letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
        bare = np.bincount(of[letters[ends] == letters[starts]], minlength=n)
    lines = counts[:, 10] + 1
    return np.column_stack([words, np.bincount(of, length, minlength=n) / some, longest, total(_LETTER) / size, total(_UPPER) / np.maximum(total(_LETTER), 1), total(_DIGIT) / size, total(_SYMBOL) / size, total(_BAR) / size, total(_MARK) / size, total(_BLANK) / size, words / lines, distinct / some, repeat / some, bare / some, total(_HIGH) / size]).astype(np.float64)


def statistics(df: DataFrame, text: str = "text", keep_text: bool = False, out: str = "stats") -> DataFrame:
    """Replace ``text`` (or keep it beside) by the columns of ``STATISTICS`` in a struct ``out``; others are carried."""
    keep = [c for c in df.columns if c != out and (keep_text or c != text)]
    kind = T.StructType([T.StructField(c, T.DoubleType()) for c in STATISTICS])
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(out, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = measure(*utf8(b.column(text)))
            stats = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(m[:, k])) for k in range(len(STATISTICS))], STATISTICS)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), stats], names=[*keep, out])

    return df.mapInArrow(run, schema)


#: A rule: (statistic, below or equal, threshold) of all its conditions.
Rule = tuple[tuple[str, bool, float], ...]


@dataclass
class Ensemble:
    rules: list[tuple[Rule, float]]
    intercept: float

    def score(self, stats: str = "stats") -> Column:
        """Probability of label 1 as a column expression over the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(condition(rule, stats), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def condition(rule: Rule, stats: str = "stats") -> Column:
    out = F.lit(True)
    for name, below, at in rule:
        c = F.col(f"{stats}.{name}")
        out = out & (c <= at if below else c > at)
    return out


def paths(nodes: list) -> list[Rule]:
    """All conjunctions from the root to another node of a tree, whose ``nodes`` are (id, left, right, statistic,
    threshold); conditions on one side of one statistic are merged."""
    tree = {n[0]: n for n in nodes}
    out: list[Rule] = []

    def walk(i: int, so_far: dict) -> None:
        if so_far:
            out.append(tuple(sorted((s, b, t) for (s, b), t in so_far.items())))
        _, left, right, feature, at = tree[i]
        if left < 0:
            return
        name = STATISTICS[feature]
        walk(left, so_far | {(name, True): min(at, so_far.get((name, True), at))})
        walk(right, so_far | {(name, False): max(at, so_far.get((name, False), at))})

    walk(0, {})
    return out


def fit(docs: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Ensemble:
    """Fit the ensemble on the documents of at most ``sample`` rows of ``labels`` (``key``, ``label`` 0/1)."""
    spark = docs.sparkSession
    rows = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).cast("double").alias("label"))
    chosen = rows.orderBy(F.xxhash64(key), key).limit(sample)  # at most ``sample`` rows of an id and a number
    known = written(statistics(docs.select(key, text).join(F.broadcast(chosen), key).select("label", text), text), "quality-sample")
    n, ones = known.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not n or ones in (0, n):
        p = ones / n if n else 0.5
        return Ensemble([], float(np.clip(np.log((p + 1e-6) / (1 - p + 1e-6)), -13, 13)))
    vectors = VectorAssembler(inputCols=STATISTICS, outputCol="features").transform(known.select("label", "stats.*")).select("label", "features").coalesce(2).cache()  # at most ``sample`` rows: many small tasks would only wait
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, maxBins=64, featureSubsetStrategy="sqrt", subsamplingRate=0.7, seed=SEED).fit(vectors)
    folder = scratch(spark, "quality-forest")
    forest.write().save(folder)
    nodes = spark.read.parquet(f"{folder}/data")
    if "nodeData" in nodes.columns:
        nodes = nodes.select("treeID", "nodeData.*")
    trees: dict[int, list] = {}
    for r in nodes.collect():  # at most TREES * 2 ** (DEPTH + 1) rows
        split = r["split"]
        leaf = r["leftChild"] < 0
        trees.setdefault(r["treeID"], []).append((r["id"], r["leftChild"], r["rightChild"], -1 if leaf else split["featureIndex"], 0.0 if leaf else split["leftCategoriesOrThreshold"][0]))
    rules = sorted({rule for tree in trees.values() for rule in paths(tree)})
    vectors.unpersist()
    held = known.coalesce(2).select("label", F.array(*(condition(rule).cast("double") for rule in rules)).alias("held"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, standardization=False, maxIter=60).fit(held.select("label", array_to_vector("held").alias("features")).cache())
    weights = lasso.coefficients.toArray()
    return Ensemble([(rule, float(w)) for rule, w in zip(rules, weights) if w], float(lasso.intercept))


def score(df: DataFrame, ensemble: Ensemble, text: str = "text", out: str = "score", keep_text: bool = False) -> DataFrame:
    """Replace ``text`` (or keep it beside) by the probability of label 1; other columns are carried."""
    stats = unused(df, "_stats")
    return statistics(df.drop(out), text, keep_text, stats).withColumn(out, ensemble.score(stats)).drop(stats)

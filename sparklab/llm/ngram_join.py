"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

A document is the set of its word n-grams (as 64-bit hashes).  Sets are ordered by how often their n-grams occur, rare
ones first; two sets of Jaccard similarity t share an n-gram among the first n - ceil(t * n) + 1 of each.  Sets meet on
those prefix n-grams, and are compared by

* length: the smaller size is at least t times the larger one,
* position: what can follow the shared n-gram in both orders still allows the overlap that t asks for,
* suffix: n-grams fall into 512 classes by hash; each class whose two counts differ in parity holds an n-gram of one
  set only, so the number of these classes bounds from below how far the sets differ (pairs of long sets are compared
  by 4,096 classes as well),

and each pair that remains is verified once on the whole sets.

Documents of equal sets are one class and need no pairs.  Classes that meet on an n-gram are first compared with one
member only (a pivot, the same for most n-grams they share), and what links is merged into components; pairs are then
formed only between classes of different components.  In the next rounds classes that share prefix n-grams with others
have one pivot for each two least hashes of a whole set (under two of the seeds): sets of similarity t have the same
least hash with probability t, so copies inside a crowd that shares a passage find a pivot of their own.  While the
pairs that remain are many times the rows they come from, classes are compared with a few pivots drawn anew for each
n-gram, as long as that merges components.  At last all pairs that remain on any prefix n-gram are compared, each on the
first n-gram it shares if few n-grams lie between: the rounds before only save pairs.  Of the pairs that are left then,
one for each component is verified first, and those that its links have joined need no look.  So a group of near copies
costs a number of pairs in proportion to its size, and no link between different texts is lost for the components.

The order comes from a table of ``CELLS`` counts that n-grams are hashed to: 2 MB whatever the corpus; n-grams that
share a cell count together, which changes the order but never the result.

Defined cases: null and empty texts, and texts of separators, have no n-grams and link with nothing; a text of fewer
words is one n-gram; repeated rows are one class; a row with a null id takes its class's component, which is null where
all ids are; extra columns are not carried; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklab.llm.common import M1, M2, mixed, ranges, utf8, written
from sparklab.llm.components import ROWS, joined
from sparklab.llm.fingerprints import shingle_hashes

CELLS = 1 << 18
#: Rows that a set with its prefix and classes counts as when files are dealt out.
DENSE = 16
CLASSES = 512
#: Classes of sets of more than ``LONG`` n-grams in a second look: 512 are nearly all odd or even by chance there.
FINE, LONG = 4096, 1000
#: Places that sets are sent to, broadcast at most (24 bytes each); more are joined by a shuffle.
BROADCAST = 1_000_000
#: Partners of a hub that one task compares with it, and bytes of sets that leave a task in one Arrow batch.
PARTNERS, FLUSH = 64, 8 << 20
#: Rounds of pivots before all remaining pairs: one of each n-gram, the others of each two least hashes.
ROUNDS = 4
#: Rounds of drawn pivots at most, pivots of an n-gram in each, and the remaining pairs per row that need no such round.
DRAWN, PIVOTS, PAIRS = 8, 16, 16
#: Shared n-grams before its own that a row knows: a pair that shares one of them has met there.
BEFORE = 16
#: Times that the last pairs are verified one for each component before all that are left.
FIRSTS = 2


class Sets:
    """The n-gram sets of the rows of a batch, flat and sorted by row and hash."""

    def __init__(self, raw: bytes, offsets: np.ndarray, words: int):
        hashes, at = shingle_hashes(raw, offsets, words)
        self.rows = len(offsets) - 1
        row = np.repeat(np.arange(self.rows), np.diff(at))
        order = np.lexsort((hashes, row))
        hashes, row = hashes[order], row[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
        self.hash, self.row = hashes[new], row[new]
        self.n = np.bincount(self.row, minlength=self.rows)
        self.at = np.concatenate([[0], np.cumsum(self.n)])

    def keys(self) -> np.ndarray:
        """64-bit ids of the sets: equal sets, equal ids; 0 for empty sets."""
        total = np.zeros(len(self.hash) + 1, np.uint64)
        np.cumsum(mixed(self.hash ^ M1), out=total[1:])
        sums = total[self.at[1:]] - total[self.at[:-1]]
        key = mixed(sums * M2 + self.n.astype(np.uint64))
        return np.where(self.n > 0, key, np.uint64(0)).view(np.int64)

    def least(self, seeds: int) -> np.ndarray:
        """The least hash of every set that is not empty under each of so many seeds (sets x seeds)."""
        at = self.at[:-1][self.n > 0]
        if not len(at):
            return np.zeros((0, seeds), np.int64)
        marks = mixed(np.arange(1, seeds + 1, dtype=np.uint64))
        return np.stack([np.minimum.reduceat(mixed(self.hash ^ k), at) for k in marks], axis=1).view(np.int64)


def _needed(n, percent: int):
    """Overlap that a partner of the same or another size must at least have with a set of ``n``."""
    return -(-percent * n // 100)


def _few(rows: DataFrame, most: int) -> DataFrame:
    """``rows``, at most so many, in tasks of ``ROWS`` rows at least: few rows are written to few files."""
    return rows.coalesce(max(-(-most // ROWS), 1))


def _summary(docs: DataFrame, words: int) -> DataFrame:
    """Rows of two kinds: per document (key, id, tie, n), and per task the counts of the cells in pieces of 4,096."""
    kind = T.StructType([T.StructField("key", T.LongType()), T.StructField("id", T.LongType()), T.StructField("tie", T.LongType()), T.StructField("n", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("counts", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, np.int64)
        for b in batches:
            s = Sets(*utf8(b.column("text")), words)
            counts += np.bincount((s.hash >> np.uint64(46)).astype(np.int64), minlength=CELLS)
            none = pa.nulls(s.rows)
            yield pa.RecordBatch.from_arrays([pa.array(s.keys()), b.column("id"), b.column("tie"), pa.array(s.n.astype(np.int64)), none.cast(pa.int32()), none.cast(pa.binary())], names=kind.names)
        pieces = [k for k in range(CELLS // 4096) if counts[4096 * k : 4096 * k + 4096].any()]
        none = pa.nulls(len(pieces)).cast(pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(pieces, pa.int32()), pa.array([counts[4096 * k : 4096 * k + 4096].astype("<i8").tobytes() for k in pieces], pa.binary())], names=kind.names)

    return docs.mapInArrow(run, kind)


def _cells(summary: DataFrame) -> np.ndarray:
    """The cells' counts over all documents: a table of fixed size."""

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, "<i8") for x in table.column("counts").to_pylist())
        return pa.table({"piece": table.column("piece")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros(CELLS, np.int64)
    for r in summary.where("piece is not null").select("piece", "counts").groupBy("piece").applyInArrow(add, "piece int, counts binary").collect():
        out[4096 * r["piece"] : 4096 * r["piece"] + 4096] = np.frombuffer(r["counts"], "<i8")
    return out


def _parities(hashes: np.ndarray) -> np.ndarray:
    """The parities of the ``FINE`` classes of a set, as bits."""
    return np.packbits((np.bincount((hashes & np.uint64(FINE - 1)).astype(np.int64), minlength=FINE) & 1).astype(np.uint8), bitorder="little").view("<i8")


def _prefixes(docs: DataFrame, cells: np.ndarray, words: int, percent: int) -> DataFrame:
    """Per document with n-grams: key, n, its prefix (hashes, rare first), the parities of its suffix classes as bits
    and its least hashes, and the parities of the finer classes if the set is long (else null)."""
    shared = docs.sparkSession.sparkContext.broadcast(cells)
    kind = T.StructType([T.StructField("key", T.LongType()), T.StructField("n", T.LongType()), T.StructField("prefix", T.BinaryType()), T.StructField("classes", T.ArrayType(T.LongType())), T.StructField("least", T.ArrayType(T.LongType())), T.StructField("fine", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = shared.value
        for b in batches:
            s = Sets(*utf8(b.column("text")), words)
            often = count[(s.hash >> np.uint64(46)).astype(np.int64)]
            order = np.lexsort((s.hash, often, s.row))
            prefix = s.n - _needed(s.n, percent) + 1
            place = ranges(s.n)
            kept = s.hash[order][place < np.repeat(prefix, s.n)]
            some = np.flatnonzero(s.n)
            ends = np.cumsum(prefix[some])
            classes = np.bincount(s.row * CLASSES + (s.hash & np.uint64(CLASSES - 1)).astype(np.int64), minlength=s.rows * CLASSES).reshape(s.rows, CLASSES)[some]
            bits = np.packbits((classes & 1).astype(np.uint8), axis=1, bitorder="little").reshape(-1).view("<i8")
            fine = pa.array([_parities(s.hash[s.at[k] : s.at[k + 1]]) if s.n[k] > LONG else None for k in some.tolist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([
                pa.array(s.keys()[some]), pa.array(s.n[some].astype(np.int64)), pa.array([kept[a:z].tobytes() for a, z in zip([0, *ends.tolist()], ends.tolist())], pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * (CLASSES // 64)), pa.array(bits)),
                pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * (ROUNDS - 1)), pa.array(s.least(ROUNDS - 1).reshape(-1))),
                fine,
            ], names=kind.names)

    return docs.mapInArrow(run, kind).dropDuplicates(["key"])


def _spread(prefixes: DataFrame) -> DataFrame:
    """One row per prefix n-gram: (h, key, place of h << 32 | size)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = [np.frombuffer(x, np.int64) for x in b.column("prefix").to_pylist()]
            if h:
                size = np.array([len(x) for x in h])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(h)), pa.array(np.repeat(b.column("key").to_numpy(), size)), pa.array((ranges(size) << 32) + np.repeat(b.column("n").to_numpy(), size))], names=["h", "key", "at"])

    return prefixes.select("key", "n", "prefix").mapInArrow(run, "h long, key long, at long")


def _size(at: str):
    """The size of ``at`` (place << 32 | size)."""
    return F.col(at).bitwiseAND(F.lit(0xFFFFFFFF))


def _sized(n, m, percent: int):
    """Whether sets of ``n`` and ``m`` n-grams may link."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _passes(x: str, y: str, percent: int):
    """Length and position of a pair that shares an n-gram: ``x`` and ``y`` hold place << 32 | size.

    The first n-gram that two linked sets share passes; a later one may not, which loses nothing."""
    n, m = _size(x), _size(y)
    i, j = (F.shiftright(F.col(c), 32) for c in (x, y))
    most = F.least(n - i, m - j)
    return _sized(n, m, percent) & ((100 + percent) * most >= percent * (n + m))


def _near(c: str, d: str, n, m, percent: int):
    """Whether sets of ``n`` and ``m`` n-grams with the parities ``c`` and ``d`` may link."""
    apart = sum((F.bit_count(F.col(c)[k].bitwiseXOR(F.col(d)[k])) for k in range(CLASSES // 64)), F.lit(0))
    return _close(apart, n, m, percent)


def _close(apart, n, m, percent: int):
    """Whether sets of ``n`` and ``m`` n-grams of which at least ``apart`` are in one only may link."""
    return (100 + percent) * apart <= (100 - percent) * (n + m)


def _candidates(pairs: DataFrame, sizes: DataFrame, long: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) that pass the suffix filter."""
    pairs = pairs.select(F.least("key", "other").alias("a"), F.greatest("key", "other").alias("b")).distinct()
    x, y = sizes.toDF("a", "n", "c"), sizes.toDF("b", "m", "d")
    pairs = pairs.join(x, "a").join(y, "b").where(_near("c", "d", F.col("n"), F.col("m"), percent)).select("a", "b", "n", "m")
    pairs = pairs.join(long.toDF("a", "c"), "a", "left").join(long.toDF("b", "d"), "b", "left")
    apart = F.aggregate(F.zip_with("c", "d", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    return pairs.where(F.col("c").isNull() | F.col("d").isNull() | _close(apart, F.col("n"), F.col("m"), percent)).select("a", "b")


def _verified(docs: DataFrame, members: DataFrame, pairs: DataFrame, hub, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are as similar as asked; ``hub`` picks a side of each.

    A hub's set travels once per ``PARTNERS`` partners and a partner's set once per pair, straight from the texts: the
    sets are neither stored nor sent to be joined twice.  No part of a hub is larger than about ``PARTNERS`` sets.
    Pairs that link are dealt anew, so that the sets are compared in as many tasks as ever and few files are written."""
    most = pairs.count()
    pairs = pairs.select("a", "b", hub.alias("hub"))
    parts = pairs.groupBy("hub").agg(F.ceil(F.count("*") / PARTNERS).alias("parts"))
    spread = pairs.join(parts, "hub").select("hub", F.when(F.col("hub") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("key"), "parts")
    spread = spread.withColumn("part", F.pmod(F.xxhash64("key"), "parts")).select("key", "hub", "part")
    ways = spread.union(spread.select(F.col("hub").alias("key"), "hub", "part").distinct())
    # a class is read from the row of its smallest id, or by the hash of a text if all its ids are null
    first = members.join(ways.select("key").distinct(), "key").groupBy("key").agg(F.min("id").alias("id"), F.min("tie").alias("tie"))
    bare = F.col("id").isNull()
    ways = ways.join(first, "key").groupBy("id", F.when(bare, F.col("tie")).alias("tie"), F.floor(F.col("part") / 256).alias("some")).agg(F.collect_list(F.struct("key", "hub", "part")).alias("ways")).select("id", "tie", "ways")
    ways = written(_few(ways, 3 * most), "join-ways")
    small = (ways.agg(F.sum(F.size("ways"))).first()[0] or 0) <= BROADCAST
    to = lambda rows: F.broadcast(rows) if small else rows
    texts = docs.select("id", "text").join(to(ways.where(~bare).drop("tie")), "id").select("text", "ways")
    if not ways.where(bare).isEmpty():
        # copies have the same hash: one of them is enough
        rest = docs.where(bare).select("tie", "text").join(to(ways.where(bare).select("tie").distinct()), "tie", "left_semi").dropDuplicates(["tie"])
        texts = texts.union(rest.join(to(ways.where(bare).drop("id")), "tie").select("text", "ways"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for b in batches:
            s = Sets(*utf8(b.column("text")), words)
            keys = s.keys().tolist()
            for row, ways_ in enumerate(b.column("ways")):
                x = s.hash[s.at[row] : s.at[row + 1]].tobytes()
                for w in ways_.as_py():
                    # an id with several texts can stand for several classes
                    if w["key"] == keys[row]:
                        out.append((w["hub"], w["part"], w["key"], x))
                        size += len(x)
                        if size > FLUSH:
                            yield _batch(out)
                            out, size = [], 0
        if out:
            yield _batch(out)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, whole = None, None
        for b in batches:
            a, z = [], []
            for hub_, part, key, raw in zip(b.column("hub").to_pylist(), b.column("part").to_pylist(), b.column("key").to_pylist(), b.column("set")):
                x = np.frombuffer(raw.as_buffer(), np.uint64)
                if key == hub_:
                    at, whole = (hub_, part), x.copy()
                elif at == (hub_, part):
                    all_ = np.sort(np.concatenate([whole, x]), kind="stable")
                    both = int(np.count_nonzero(all_[1:] == all_[:-1]))
                    if 100 * both >= percent * (len(all_) - both):
                        a.append(min(key, hub_))
                        z.append(max(key, hub_))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(z, pa.int64())], names=["a", "b"])

    sent = texts.mapInArrow(send, "hub long, part long, key long, set binary").repartition("hub", "part")
    return sent.sortWithinPartitions("hub", "part", F.col("key") != F.col("hub")).mapInArrow(compare, "a long, b long").repartition(max(-(-most // ROWS), 1))


def _split(rest: DataFrame, percent: int) -> DataFrame:
    """The rows (h, at, label) whose n-gram another component holds too, in a set of a size that may link.

    Sizes fall into bands as wide as linked sizes may differ (and a little wider): those of linked sets are the same or
    neighbours, so each row counts in its own band and the next."""
    band = F.floor(F.ln(_size("at")) / float(np.log(100.1 / percent))).cast("int")
    of = rest.withColumn("band", band)
    each = of.select("h", "label", F.explode(F.array("band", F.col("band") + 1)).alias("band"))
    mixed_ = each.groupBy("h", "band").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").groupBy("h").agg(F.collect_set("band").alias("bands"))
    return of.join(mixed_, "h").where(F.array_contains("bands", F.col("band")) | F.array_contains("bands", F.col("band") + 1)).drop("band", "bands")


def _left(rest: DataFrame) -> tuple[int, int]:
    """Pairs of classes of different components that meet on the n-grams of ``rest``, and its rows."""
    square = lambda c: F.sum(F.col(c).cast("decimal(38,0)") * F.col(c))
    each = rest.groupBy("h", "label").agg(F.count("*").alias("n")).groupBy("h").agg(F.sum("n").alias("n"), square("n").alias("same"))
    got = each.agg(square("n").alias("all"), F.sum("same").alias("same"), F.sum("n").alias("n")).first()
    return int((got["all"] or 0) - (got["same"] or 0)) // 2, got["n"] or 0


def _drawn(rest: DataFrame, sizes: DataFrame, seed: int, percent: int) -> DataFrame:
    """Pairs (key, other) of the classes with ``PIVOTS`` classes at most that are drawn for each n-gram.

    The n-gram need not be the first that a pair shares, so its position tells nothing here."""
    by = F.xxhash64(F.lit(seed), "h", "key")
    pivots = rest.groupBy("h", F.pmod(by, F.lit(PIVOTS)).alias("some")).agg(*(F.min_by(c, by).alias(o) for c, o in (("key", "other"), ("label", "other_label"))))
    pivots = pivots.drop("some").join(sizes.toDF("other", "other_n", "other_classes"), "other")
    near = _sized(F.col("n"), F.col("other_n"), percent) & _near("classes", "other_classes", F.col("n"), F.col("other_n"), percent)
    return rest.join(pivots, (rest["h"] == pivots["h"]) & (F.col("label") != F.col("other_label")) & near).select("key", "other")


def _all(rest: DataFrame, percent: int) -> DataFrame:
    """All pairs (key, other) of classes of different components, on the first n-gram they share at least.

    The order of n-grams is the same in all sets: what two sets share before an n-gram lies before it in both.  Both
    sides are one plan, so that Spark shuffles the rows once."""
    before = F.collect_list("h").over(Window.partitionBy("key").orderBy("at").rowsBetween(-BEFORE, -1))
    rest = rest.withColumn("before", before)
    near = _passes("x.at", "y.at", percent) & _near("x.classes", "y.classes", _size("x.at"), _size("y.at"), percent) & ~F.arrays_overlap("x.before", "y.before")
    apart = (F.col("x.key") < F.col("y.key")) & (F.col("x.label") != F.col("y.label"))
    return rest.alias("x").join(rest.alias("y"), (F.col("x.h") == F.col("y.h")) & apart & near).select(F.col("x.key").alias("key"), F.col("y.key").alias("other"))


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes of different components, with these."""
    for c in "ab":
        pairs = pairs.join(labels.toDF(c, f"label_{c}"), c, "left").withColumn(f"label_{c}", F.coalesce(f"label_{c}", c))
    return pairs.where("label_a <> label_b")


def _firsts(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """One pair (a, b) for each component that has any."""
    by = F.xxhash64("a", "b")
    each = _apart(pairs, labels).withColumn("label", F.explode(F.array("label_a", "label_b")))
    return each.groupBy("label").agg(F.min_by("a", by).alias("a"), F.min_by("b", by).alias("b")).select("a", "b").distinct()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    hub, part, key, sets = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(hub, pa.int64()), pa.array(part, pa.int64()), pa.array(key, pa.int64()), pa.array(sets, pa.binary())], names=["hub", "part", "key", "set"])


def linked(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, percent: int = 90) -> DataFrame:
    """Per document: ``key`` (a long), ``n_shingles`` and ``component_id`` (the smallest key that links lead to).

    Documents link when 100 * (n-grams of both) >= ``percent`` * (n-grams of either)."""
    docs = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("tie"), F.col(text).alias("text"))
    summary = written(_summary(docs, words), "join-summary")
    members = summary.where("piece is null").select("key", "id", "tie", "n")
    prefixes = written(_few(_prefixes(docs, _cells(summary), words, percent), DENSE * members.count()), "join-prefixes")
    n_sets, size = prefixes.agg(F.count("*"), F.coalesce(F.sum(F.length("prefix") / 8), F.lit(0)).cast("long")).first()
    sizes = prefixes.select("key", "n", "classes")
    long = prefixes.where("fine is not null").select("key", "fine")
    rows = _spread(prefixes)
    # the pivot of an n-gram is its class of the smallest key (a hash); n-grams of one class only meet nobody
    pivot = rows.groupBy("h").agg(F.min("key").alias("other"), F.min_by("at", "key").alias("other_at"), F.count("*").alias("n")).where("n > 1").select("h", "other", "other_at")
    shared = written(_few(rows.join(pivot, "h"), size), "join-shared")
    pairs = shared.where("key <> other").where(_passes("at", "other_at", percent))
    picks = written(_few(prefixes.join(shared.select("key").distinct(), "key").select("key", "n", "least"), n_sets), "join-picks")
    tested = rest = None
    last, fresh, most = False, 0, size
    hub = F.col("a")
    labels = docs.sparkSession.createDataFrame([], "key long, label long")
    for k in itertools.count():
        found = _candidates(pairs, sizes, long, percent)
        if tested is not None:
            found = found.join(tested, ["a", "b"], "left_anti")
        found = written(_few(found, most), "join-pairs")
        fresh = step = 0
        while n := found.count():
            some = written(_few(_firsts(found, labels), n), "join-firsts") if last and step < FIRSTS else found
            new = written(_verified(docs, members, some, hub, words, percent), "join-links")
            tested = some if tested is None else tested.union(some)
            linked_now = new.count()
            if linked_now:
                labels = joined(labels.toDF("node", "label"), new).toDF("key", "label")
            fresh += linked_now
            if some is found:
                break
            found = written(_few(_apart(found.join(some, ["a", "b"], "left_anti"), labels).select("a", "b"), n), "join-pairs")
            step += 1
        if last:
            break
        named = lambda rows: rows.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))  # noqa: E731, B023
        if k + 1 < ROUNDS:
            # least hashes whose classes are still of different components: a pair for each class at most
            most = n_sets
            by = F.xxhash64(F.lit(k), "key")
            at = named(picks.select("key", "n", F.xxhash64(F.col("least")[k], F.col("least")[(k + 1) % (ROUNDS - 1)]).alias("least")))
            split = at.groupBy("least").agg(F.min("label").alias("x"), F.max("label").alias("y"), *(F.min_by(c, by).alias(o) for c, o in (("key", "other"), ("n", "other_n"), ("label", "other_label")))).where("x <> y")
            hub = F.when(F.xxhash64(F.lit(k), "a") < F.xxhash64(F.lit(k), "b"), F.col("a")).otherwise(F.col("b"))
            sized = _sized(F.col("n"), F.col("other_n"), percent)
            pairs = at.join(split.select("least", "other", "other_n", "other_label"), "least").where(sized & (F.col("label") != F.col("other_label"))).select("key", "other")
        else:
            hub = F.col("a")
            at = named(shared.select("h", "key", "at") if rest is None else rest.drop("label"))
            rest = written(_few(_split(at, percent), size), "join-rest")
            left, size = _left(rest)
            # drawn pivots go on while they find links of a hundredth of the rows
            last = left <= PAIRS * size or k + 1 >= ROUNDS + DRAWN or (k >= ROUNDS and 100 * fresh < size)
            # the classes of a set are long: they are joined to the rows that are compared, and not kept with them
            whole = rest.join(sizes, "key")
            pairs = _all(whole, percent) if last else _drawn(whole, sizes, k, percent)
            most = left if last else PIVOTS * size
    names = members.where("n > 0").select("key", "id").join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    least = names.groupBy("label").agg(F.min("id").alias("component_id"))
    # one row per class, so that copies do not meet in one task: their rows are split by the join
    of = names.select("key", "label").distinct().join(least, "label").select("key", "component_id")
    out = members.join(of, "key", "left")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))

"""Line de-duplication by levelled sorted runs of line hashes, in DataFrame functions only.

A line's key is the line without white space at its ends, A-Z lower-cased; keys of ``min_chars`` code points or more
count.  The runs hold each key once, as a 128-bit hash with the largest document id known to hold it, bucketed and
sorted by the hash.  Documents arrive in batches; a batch's keys, aggregated before they are shuffled, meet the runs in
a merge join on the buckets (the runs are not shuffled):

* keys that no run holds (the anti join) become the batch's own run on level 0;
* keys that some run holds are repeats, written beside it with the batch's number of documents.

Two runs of one level are merged into one of the next, so that n batches leave log2(n) + 1 runs at most, and a key is
rewritten log2(n) times at most.  Keys of a single document, most of all, never leave the runs.  The repeats of all
batches give the keys found in ``min_docs`` documents and their largest id; lines of these keys go from all other
documents.  Only line numbers meet the texts again.

Each step writes a table in the shared folder, and superseded runs are removed from it.  A key of very many documents
is one row per task after the partial aggregation; its lines meet it in a join whose skewed partitions Spark splits.

Defined cases: null and empty texts are one empty line; every row counts as a document, rows of one id share its fate as
the largest id or not; a null id is less than any other, and if all holders have none all keep their lines; equal rows
give equal results; a document of which all lines go has the empty text; extra columns are carried, those named like a
result column are replaced; long texts are one array of lines; an empty table gives an empty result.  The ids may be of
any type with an order.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklab.llm.common import removed, scratch, unused, written

#: Code points of a key and documents that hold it, from which its lines go.
MIN_CHARS, MIN_DOCS = 40, 5
#: Batches in which a whole table is taken.
BATCHES = 8
#: White space that is stripped from a line (fixed values: blank and 9 to 13).
WHITE = " \t\n\x0b\x0c\r"
KEY = ["h1", "h2"]


def lines(text: Column) -> Column:
    """The lines of a text; of a null text one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(WHITE))
    ascii_only = F.octet_length(bare) == F.char_length(bare)  # then lower() changes A-Z alone, and is much faster
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def row_hashes(key: str, text: str) -> list[Column]:
    """Two 64-bit hashes of a row's id and text."""
    parts = [F.col(key), F.col(text), F.col(key).isNull(), F.col(text).isNull()]
    return [F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *reversed(parts))]


def occurrences(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """A row for each line with a key of ``min_chars`` or more: r1, r2 (the row), doc, h1, h2 (the key), at (line
    number), fresh (1 on a key's first line of the row, else 0)."""
    keyed = docs.select(*(h.alias(n) for h, n in zip(row_hashes(key, text), ("r1", "r2"))), F.col(key).alias("doc"), F.transform(lines(F.col(text)), line_key).alias("keys"))
    found = F.transform("keys", lambda k, i: F.when(F.char_length(k) >= min_chars, F.struct(F.xxhash64(F.lit(3), k).alias("h1"), F.xxhash64(F.lit(4), k).alias("h2"), i.alias("at"))))
    listed = keyed.select("r1", "r2", "doc", F.sort_array(F.filter(found, lambda x: x.isNotNull())).alias("items"))

    def marked(x: Column, i: Column) -> Column:
        before = F.get("items", i - 1)
        again = (i > 0) & (before["h1"] == x["h1"]) & (before["h2"] == x["h2"])
        return F.struct(x["h1"].alias("h1"), x["h2"].alias("h2"), x["at"].alias("at"), F.when(again, 0).otherwise(1).alias("fresh"))

    return listed.select("r1", "r2", "doc", F.inline(F.transform("items", marked)))


class LineRuns:
    """The runs of a store of line keys, and the repeats that its batches found."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        #: (level, table) of the live runs, the largest level first
        self.runs: list[tuple[int, str]] = []
        self.batches: list[str] = []
        self.folders: dict[str, str] = {}

    def _save(self, df: DataFrame, *parts: str) -> str:
        """Write a table bucketed and sorted by the key in the shared folder."""
        name = f"line_run_{uuid.uuid4().hex}"
        self.folders[name] = scratch(self.spark, "line-run")
        out = df.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", self.folders[name])
        (out.partitionBy(*parts) if parts else out).saveAsTable(name)
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE {name}")
        removed(self.spark, self.folders.pop(name))

    def _run(self, level: int, name: str) -> DataFrame:
        run = self.spark.table(name)
        return (run.where("is_new") if level == 0 else run).select(*KEY, "keeper")

    def add(self, batch: DataFrame) -> None:
        """Take a batch of ``occurrences``: merge its keys with the runs, write its own run and its repeats."""
        found = batch.groupBy(*KEY).agg(F.sum("fresh").alias("n"), F.max("doc").alias("keeper"))
        held = []
        for k, (level, name) in enumerate(self.runs):
            found = found.join(self._run(level, name).withColumnRenamed("keeper", f"keeper_{k}").withColumn(f"held_{k}", F.lit(True)), KEY, "left")
            held.append(k)
        new = ~F.coalesce(*(F.col(f"held_{k}") for k in held), F.lit(False)) if held else F.lit(True)
        keeper = F.greatest("keeper", *(F.col(f"keeper_{k}") for k in held)) if held else F.col("keeper")
        name = self._save(found.select(*KEY, "n", keeper.alias("keeper"), new.alias("is_new")), "is_new")
        self.batches.append(name)
        self.runs.append((0, name))
        while len(self.runs) > 1 and self.runs[-1][0] == self.runs[-2][0]:
            self._compact()

    def _compact(self) -> None:
        """Merge the two last runs, which share no key, into one of the next level."""
        (level, right), (_, left) = self.runs.pop(), self.runs.pop()
        a, b = self._run(level, left).alias("a"), self._run(level, right).alias("b")
        both = a.join(b, (F.col("a.h1") == F.col("b.h1")) & (F.col("a.h2") == F.col("b.h2")), "full")
        self.runs.append((level + 1, self._save(both.select(*(F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in (*KEY, "keeper"))))))
        for name in (left, right) if level else ():  # batches stay: they hold the repeats
            self._drop(name)

    def frequent(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """Keys of at least ``min_docs`` documents, with the largest id that holds them."""
        out = None
        for name in self.batches:
            # of a key's documents all but one are counted, so that new keys of one document drop out before the shuffle
            more = self.spark.table(name).withColumn("n", F.col("n") - F.col("is_new").cast("long")).select(*KEY, "n", "keeper")
            out = more if out is None else out.unionAll(more)
        many = out.where("n > 0").groupBy(*KEY).agg(F.sum("n").alias("n"), F.max("keeper").alias("keeper"))
        return many.where(F.col("n") >= min_docs - 1).select(*KEY, "keeper")

    def close(self) -> None:
        for name in list(self.folders):
            self._drop(name)


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """Add n_lines, n_dropped and ``kept``: the text without the lines whose key at least ``min_docs`` documents hold, but
    for the largest id among them (all lines stay if ``min_docs`` is below 2 and no other document holds the key)."""
    spark = docs.sparkSession
    found = occurrences(docs, key, text, min_chars).withColumn("batch", F.pmod(F.xxhash64("doc"), F.lit(batches)).cast("int"))
    path = scratch(spark, "line-occurrences")
    found.write.partitionBy("batch").parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    runs = LineRuns(spark)
    for b in range(batches):
        runs.add(found.where(F.col("batch") == b))
    many = written(runs.frequent(min_docs), "line-frequent")
    runs.close()
    gone = found.join(many, KEY).where(~F.col("doc").eqNullSafe(F.col("keeper"))).groupBy("r1", "r2").agg(F.sort_array(F.collect_set("at")).alias("gone"))
    rest = docs.drop("n_lines", "n_dropped", "kept")
    one, two, hits = (unused(rest, n) for n in ("_row_1", "_row_2", "_gone"))
    rows = rest.withColumns(dict(zip((one, two), row_hashes(key, text))))
    joined = rows.join(gone.select(F.col("r1").alias(one), F.col("r2").alias(two), F.col("gone").alias(hits)), [one, two], "left")
    parts = unused(rest, "_lines")
    joined = joined.withColumn(parts, lines(F.col(text)))
    n_lines = F.size(parts)
    cuts = F.concat(F.array(F.lit(-1)), F.col(hits), F.array(n_lines))
    kept = F.when(F.col(hits).isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(F.array_join(_between(F.col(parts), cuts), "\n"))
    return joined.select(*rest.columns, n_lines.cast("long").alias("n_lines"), F.coalesce(F.size(hits), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept"))


def _between(parts: Column, cuts: Column) -> Column:
    """The elements of ``parts`` between each two successive ``cuts``, in one pass."""
    spans = F.arrays_zip(F.slice(cuts, 1, F.size(cuts) - 1).alias("a"), F.slice(cuts, 2, F.size(cuts) - 1).alias("b"))
    return F.flatten(F.transform(spans, lambda x: F.slice(parts, x["a"] + 2, x["b"] - x["a"] - 1)))

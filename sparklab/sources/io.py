"""Sources and sinks: declared-schema CSV, object tables, batch-scoring inputs,
federated (JDBC) relations, exports and table replacement."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def load_csv(spark: SparkSession, path: str, ddl: str, header: bool = True, multiline: bool = False,
             sep: str = ",") -> DataFrame:
    """CSV with a declared schema (never inferred: a dirty numeric column stays
    a STRING instead of silently changing type), header skipped.
    ``multiline`` allows quoted line breaks in a field, and makes each file one
    task: files without them stay splittable."""
    return (spark.read.schema(ddl).option("header", header).option("multiLine", multiline)
                 .option("sep", sep).option("mode", "PERMISSIVE").csv(path))


def object_table(spark: SparkSession, path: str, glob: str | None = None, with_content: bool = False) -> DataFrame:
    """One row per file: uri, size, updated, content type (from the extension)
    and an md5 of the content.  Without ``with_content`` the file bytes are not
    read at all (the metadata columns come from the listing)."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    r = r.option("recursiveFileLookup", "true").load(path)
    ext = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    ctype = (F.when(ext.isin("jpg", "jpeg"), "image/jpeg").when(ext == "png", "image/png")
              .when(ext.isin("html", "htm"), "text/html").when(ext == "json", "application/json")
              .when(ext == "txt", "text/plain").otherwise("application/octet-stream"))
    cols = [F.col("path").alias("uri"), ctype.alias("content_type"), F.col("length").alias("size"),
            F.col("modificationTime").alias("updated")]
    if with_content:
        cols += [F.md5("content").alias("md5_hash"), F.col("content")]
    return r.select(*cols)


def object_inventory(objects: DataFrame) -> DataFrame:
    return objects.agg(F.count(F.lit(1)).alias("objects"), F.count_distinct("content_type").alias("content_types"),
                       F.round(F.sum("size") / 1024 / 1024, 6).alias("total_mb"))


def read_jsonl_batch(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return spark.read.schema(ddl).json(path)


def read_csv_batch(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return load_csv(spark, path, ddl, multiline=False)


def _opened(uri: str):
    """A pyarrow file system and the path on it (file, s3, gs, hdfs and the like); paths are taken as they are, without
    percent escapes."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    scheme, mark, rest = uri.partition("://")
    if not mark:
        raise ValueError("no URI with a scheme")
    authority, _, path = rest.partition("/")
    store, base = fs.FileSystem.from_uri(f"{scheme}://{authority}")
    return store, f"{base.rstrip('/')}/{path}"


def read_uri_list(spark: SparkSession, list_path: str) -> DataFrame:
    """Text files of URIs -> the referenced files: path, modificationTime, length, content and ``error`` (NULL, or why the
    file could not be read; the other columns but the path are NULL then).

    The list stays distributed: its rows are dealt out by hash, and each task opens its files itself, one at a time."""
    uris = spark.read.text(list_path).select(F.trim("value").alias("path")).where("path <> ''").repartition("path")
    kind = "path string, modificationTime timestamp, length long, content binary, error string"

    def run(batches):
        for b in batches:
            for uri in b.column(0).to_pylist():
                at = size = data = error = None
                try:
                    store, path = _opened(uri)
                    at = store.get_file_info(path).mtime
                    with store.open_input_stream(path) as f:
                        data = f.read()
                    size = len(data)
                except Exception as e:  # noqa: BLE001
                    at, error = None, f"{type(e).__name__}: {e}"[:300]
                yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([at], pa.timestamp("us", "UTC")), pa.array([size], pa.int64()), pa.array([data], pa.binary()),
                                                  pa.array([error], pa.string())], names=["path", "modificationTime", "length", "content", "error"])
    return uris.mapInArrow(run, kind)


def row_groups(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet row groups under a folder: file, row_group, n_rows, n_bytes.  Files come from the listing; each footer
    is read by a task."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path).select("path").repartition("path")

    def run(batches):
        import pyarrow.parquet as pq

        for b in batches:
            for uri in b.column(0).to_pylist():
                store, at = _opened(uri)
                with store.open_input_file(at) as f:
                    m = pq.read_metadata(f)
                g = [m.row_group(k) for k in range(m.num_row_groups)]
                yield pa.RecordBatch.from_arrays([pa.array([uri] * len(g), pa.string()), pa.array(range(len(g)), pa.int32()), pa.array([x.num_rows for x in g], pa.int64()),
                                                  pa.array([x.total_byte_size for x in g], pa.int64())], names=["file", "row_group", "n_rows", "n_bytes"])
    return files.mapInArrow(run, "file string, row_group int, n_rows long, n_bytes long")


#: Neighbouring row groups of a file that are read together.
GROUPS = 256


def neighbours(chosen: DataFrame) -> DataFrame:
    """Row groups of a file in lists of neighbours, so that a file is opened and its footer read once for all of a list."""
    near = chosen.groupBy("file", F.floor(F.col("row_group") / GROUPS).alias("_part"))
    return near.agg(F.array_sort(F.collect_list("row_group")).alias("row_groups")).select("file", "row_groups")


def row_group_sample(spark: SparkSession, path: str, fraction: float, seed: int = 7, columns: list[str] | None = None) -> DataFrame:
    """Block sampling that reads in proportion to the sample: whole row groups, chosen by a seeded hash of the file's name
    and the group's number; of the others only the footers are read.  Rows of a block are alike, as in any block sample."""
    kind = spark.read.parquet(path).select(*(columns or ["*"])).schema
    name = F.substring_index("file", "/", -1)
    chosen = row_groups(spark, path).where(F.pmod(F.xxhash64(name, "row_group", F.lit(seed)), F.lit(1_000_000)) < int(fraction * 1_000_000))
    near = neighbours(chosen)
    dealt = near.repartition("file", F.col("row_groups")[0])

    def run(batches):
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(kind)
        for b in batches:
            for uri, groups in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                store, at = _opened(uri)
                with store.open_input_file(at) as f:
                    held = pq.ParquetFile(f)
                    for group in groups:
                        own = held.read_row_group(group, columns=kind.names).select(kind.names)
                        yield from own.cast(target).to_batches(max_chunksize=10_000)
    return dealt.mapInArrow(run, kind)


def federated_query(spark: SparkSession, url: str, query: str, props: dict | None = None) -> DataFrame:
    """A relation computed inside another database (a pushed-down query): the
    query text runs remotely; put filters and casts inside it."""
    r = spark.read.format("jdbc").option("url", url).option("query", query)
    for k, v in (props or {}).items():
        r = r.option(k, v)
    return r.load()


def federated_join(local: DataFrame, remote: DataFrame, key: str) -> DataFrame:
    return local.join(remote, on=[key], how="inner")


def export_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def export_jsonl(df: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None) -> None:
    w = df.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.json(path)


def replace_table(df: DataFrame, path: str, partition_cols: list[str] = ()) -> str:
    """``CREATE OR REPLACE TABLE ... AS SELECT`` on a path: write to a fresh
    version folder, then point the table at it (readers never see a half
    written table and the query may read the previous version)."""
    version = f"{path.rstrip('/')}/_v={uuid.uuid4().hex}"
    w = df.write.mode("errorifexists")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(version)
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_CURRENT")
    fs = p.getFileSystem(conf)
    out = fs.create(p, True)
    out.write(bytearray(version.encode()))
    out.close()
    return version


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Read the current version written by ``replace_table``."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_CURRENT")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = fs.open(p)
    try:
        txt = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return spark.read.parquet(txt.strip())


def ctas(spark: SparkSession, df: DataFrame, name: str, partition_cols: list[str] = ()) -> DataFrame:
    """Catalog form: ``saveAsTable`` with overwrite."""
    w = df.write.mode("overwrite")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.saveAsTable(name)
    return spark.table(name)


def write_truncate(df: DataFrame, path: str) -> None:
    """Query result to a destination with a truncate disposition."""
    df.write.mode("overwrite").parquet(path)


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)

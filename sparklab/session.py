"""Session factory and the few session-level settings every operator relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators assume: UTC (oracle parity for dates), ANSI on
# (4.1 default, so ``try_*`` is used wherever the SQL says SAFE_*), AQE on
# (coalescing + skew-join splitting at runtime) and Arrow for Python workers.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "sparklab", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's settings.

    On a cluster ``master`` stays ``None`` so spark-submit decides; tests pass
    ``local[*]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", os.environ.get("SPARKLAB_DRIVER_MEM", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session; a private folder is set
    only when it is unset (local tests).  Never a machine-local folder on a
    cluster: there the setting is expected to be present.
    """
    cur = spark.conf.get("spark.checkpoint.dir", None)
    if not cur:
        cur = spark.sparkContext.getCheckpointDir()
    if not cur:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        cur = tempfile.mkdtemp(prefix="sparklab-ckpt-")
        spark.conf.set("spark.checkpoint.dir", cur)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(cur)
    return cur


#: Rows and bytes that an Arrow batch holds at most (one longer text is a batch of its own).
BATCH_ROWS, BATCH_BYTES = 1000, 1 << 20


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS, size: int = BATCH_BYTES) -> None:
    """Bound the Arrow batches handed to Python workers by rows and bytes: array work takes tens of times a batch.

    Both are settings of the session, which hold for all plans it runs from then on."""
    for key, value in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        if spark.conf.get(f"spark.sql.execution.arrow.{key}") != str(value):
            spark.conf.set(f"spark.sql.execution.arrow.{key}", str(value))

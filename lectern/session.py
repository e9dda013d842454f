"""Session construction and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # rows here are CPU-heavy (whole texts): do not let AQE fold a small shuffle into
    # one task; big shuffles are unaffected (their partitions exceed this anyway)
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # whole documents travel through Arrow batches; keep a batch well below executor memory
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
}


def build_session(master: str | None = None, app: str = "lectern",
                  shuffle_partitions: int | None = None,
                  driver_memory: str | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: rows and bytes in an Arrow batch, at most: a batch of texts is held by the executor, by its Python worker
#: and there again as Python objects, several times its size
BATCH_ROWS, BATCH_BYTES = 1024, 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Keep the session's Arrow batches at ``BATCH_ROWS`` rows and ``BATCH_BYTES`` bytes at most, so that what a
    Python worker holds does not grow with the rows of a partition."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        had = spark.conf.get(f"spark.sql.execution.arrow.{key}").lower().removesuffix("b")
        if not had.isdigit() or not 0 < int(had) <= most:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", str(most))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator and is read, never replaced.  Only when
    it is unset (local runs, tests) a private folder is created and registered.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not sc.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            d = tempfile.mkdtemp(prefix="lectern-ckpt-")  # unset: local runs and tests only
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory path under the checkpoint root for a written table."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/lectern-{name}-{uuid.uuid4().hex[:12]}"


def hadoop_fs(spark: SparkSession, path: str):
    """Hadoop FileSystem handle for ``path`` (works for file:, hdfs:, s3a:, ...)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p

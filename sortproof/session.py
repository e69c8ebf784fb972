"""Session construction and the shared scratch folder.

Everything that has to outlive one query plan (sorted outputs, landed
tables, stream checkpoints) goes under the folder the cluster names in
``spark.checkpoint.dir``.  A local temporary folder is only used when the
setting is absent *and* the session runs in local mode (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults that matter for every job in this package.  They are applied
# only when building a new session; an existing cluster session keeps its
# own values.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # zstd for shuffle and for the Parquet outputs (the reference compresses
    # its topics with zstd as well).
    "spark.io.compression.codec": "zstd",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(
    master: str | None = None,
    app_name: str = "sortproof",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return the active session or build one with :data:`DEFAULT_CONF`."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir).  Only a local-mode session without the setting gets a
    fresh folder under ``/tmp``; on a cluster the setting is required.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            root = None
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a folder every "
                "executor can reach (HDFS/S3/ABFS/...)."
            )
        root = tempfile.mkdtemp(prefix="sortproof-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


_handed_out: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below :func:`checkpoint_root` for one table."""
    path = f"{checkpoint_root(spark)}/sortproof/{name}-{uuid.uuid4().hex[:12]}"
    _handed_out.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables this process has made so far; returns how many there were.

    Call it when the results that read them (ranks, reports, operators'
    outputs) have been written or are no longer needed.
    """
    conf, n, root = spark._jsc.hadoopConfiguration(), 0, f"{checkpoint_root(spark)}/sortproof/"
    own = [p for p in _handed_out if p.startswith(root)]
    for p in own:
        _handed_out.remove(p)
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        n += path.getFileSystem(conf).delete(path, True)
    return n


def write_and_read(df, path: str, mode: str = "overwrite", partition_by: list[str] | None = None):
    """Write ``df`` as Parquet at ``path`` and return it read back.

    The schema is known before the write, so the read-back passes it
    explicitly instead of running a job to infer it from the file footers.
    """
    # zstd like the reference's topics, whatever the session default is
    w = df.write.mode(mode).option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Session helpers: sensible defaults for local tests, nothing forced on a cluster."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "evidentia", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (cluster jobs bring their own)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**LOCAL_DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("EVIDENTIA_DRIVER_MEMORY", "8g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is. Only a local-mode session without it gets a scratch folder (tests): a
    machine-local folder would not survive a lost executor, so a cluster
    session without the setting is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: set it to a folder every "
                             "executor and the driver share (e.g. on HDFS or an object store)")
        current = tempfile.mkdtemp(prefix="evidentia-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-path of the shared checkpoint folder for staged outputs."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def sized_conf(shuffle_bytes: int, slots: int, text_heavy: bool = True) -> dict:
    """Settings for a cluster run, sized from the bytes the widest shuffle
    moves (for the coding run that is page text in ``assemble_pages`` /
    ``first_accepted_text``; the coding join itself moves short strings).

    * ~200 MB per shuffle partition, and at least two waves of tasks;
    * 64 MB input splits for text tables (strings expand ~3x once decoded
      from compressed Parquet, and per-row work is CPU-bound);
    * adaptive execution with skew-join splitting, coalescing that respects
      the advisory size (so CPU-heavy stages are not squeezed into few tasks);
    * Arrow batches to Python workers (the responder) capped by bytes
      as well as rows, so long papers cannot make one batch huge.
    """
    per_partition = 200 * 1024 * 1024
    partitions = max(2 * slots, -(-shuffle_bytes // per_partition))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str((64 if text_heavy else 128) * 1024 * 1024),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.execution.arrow.maxBytesPerBatch": str((64 if text_heavy else 256) * 1024 * 1024),
    }

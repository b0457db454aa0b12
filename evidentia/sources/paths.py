"""Folder operations on the cluster's file system (Hadoop ``FileSystem``:
HDFS, object stores or local disk, whatever the path's scheme names).

Driver-side metadata only: existence, listing, removal. No data is
read or written through the driver.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    """``(Path, FileSystem)`` for ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = hadoop_path(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    """Remove ``path`` and everything below it (no-op when missing)."""
    p, fs = hadoop_path(spark, path)
    fs.delete(p, True)


def scheme(spark: SparkSession, path: str) -> str:
    """The scheme of the file system ``path`` is on (a path without one is on the default file system)."""
    _, fs = hadoop_path(spark, path)
    return str(fs.getUri().getScheme())


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as a URI with its scheme."""
    p, fs = hadoop_path(spark, path)
    return str(fs.makeQualified(p).toString())


def committed(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a committed Spark output (its _SUCCESS marker)."""
    return exists(spark, path.rstrip("/") + "/_SUCCESS")


def child_dirs(spark: SparkSession, path: str) -> list[str]:
    """Sub-folders of ``path`` whose names do not start with '_' or '.'."""
    p, fs = hadoop_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().toString() for st in fs.listStatus(p)
                  if st.isDirectory() and not st.getPath().getName().startswith(("_", ".")))

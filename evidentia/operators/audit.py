"""Extraction audit: per-file status, a one-row summary, the failures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.functions.strings import WS_CLASS, col, py_strip

SUCCESS, FAILED, ERROR = "SUCCESS", "FAILED", "ERROR"
PREVIEW_CHARS = 100


def audit_extraction(files: DataFrame, file="file", text="text", size_bytes="size_bytes",
                     error=None, sort: bool = True) -> DataFrame:
    """``(file, status, chars, words, size_mb, preview, error)`` per file.

    SUCCESS when the stripped text is non-empty, FAILED otherwise, ERROR when
    ``error`` is set (counts and size then null). ``words`` counts runs of
    non-whitespace. Sorted by file name, as the original report is.
    """
    t = col(text)
    err = col(error) if error is not None else F.lit(None).cast("string")
    status = (F.when(err.isNotNull(), F.lit(ERROR))
               .when(F.length(py_strip(t)) > 0, F.lit(SUCCESS)).otherwise(F.lit(FAILED)))
    out = files.select(col(file).alias("file"), t.alias("_t"), col(size_bytes).alias("_size"),
                       err.alias("error"), status.alias("status"))
    ok, failed = F.col("status") == SUCCESS, F.col("status") == FAILED
    words = F.regexp_count(F.col("_t"), F.lit(r"(?U)[^\s\x1c-\x1f]+"))
    out = out.select(
        "file", "status",
        F.when(ok, F.length("_t").cast("long")).when(failed, F.lit(0).cast("long")).alias("chars"),
        F.when(ok, words.cast("long")).when(failed, F.lit(0).cast("long")).alias("words"),
        F.when(F.col("status") != ERROR, F.col("_size") / F.lit(1024 * 1024)).alias("size_mb"),
        F.when(ok, py_strip(F.replace(F.substr("_t", F.lit(1), F.lit(PREVIEW_CHARS)),
                                      F.lit("\n"), F.lit(" ")))).alias("preview"),
        "error")
    if not sort:
        return out
    # The range partitioner samples its input before the sort; shuffling the
    # (small) audit rows first makes it sample materialized rows instead of
    # re-running the per-file text work a second time. Copies of one file
    # share a name (and a whole audit row), so neither that shuffle nor the
    # sort may key on the name alone: the shuffle is keyless and the sort
    # breaks ties on the row's input position (taken before any shuffle, so
    # a retried task sees the same values), letting the range partitioner
    # spread a name held by many rows over many tasks.
    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = out.withColumn("_pos", F.monotonically_increasing_id())
    return ranked.repartition(n).orderBy("file", "_pos").drop("_pos")


def audit_summary(audit: DataFrame) -> DataFrame:
    """One row: total, successful, failed, success rate (%, 1 decimal; null
    when empty), total and mean chars over successful files."""
    ok = F.col("status") == SUCCESS
    total = F.count(F.lit(1))
    good = F.count_if(ok)
    return audit.agg(
        total.alias("total"), good.alias("successful"), F.count_if(~ok).alias("failed"),
        F.round(F.try_divide(good * F.lit(100.0), total), 1).alias("success_rate"),
        F.sum(F.when(ok, F.col("chars"))).alias("total_chars"),
        F.avg(F.when(ok, F.col("chars"))).alias("avg_chars"))


def audit_failures(audit: DataFrame) -> DataFrame:
    return audit.where(F.col("status") != SUCCESS).select("file", "status", "error")


__all__ = ["audit_extraction", "audit_summary", "audit_failures", "WS_CLASS"]

"""Sinks: the coding table as CSV (the original tool's format) or Parquet."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from evidentia.schema import CSV_COLUMNS, TITLE
from evidentia.sources import paths

BOM = "\ufeff"


def default_csv_name(now: _dt.datetime | None = None) -> str:
    now = now or _dt.datetime.now()
    return f"literature_coding_results_{now.strftime('%Y%m%d_%H%M%S')}.csv"


def _csv_writer(df: DataFrame):
    return (df.write.mode("overwrite")
            .option("header", True).option("quote", '"').option("escape", '"')
            .option("emptyValue", "").option("nullValue", "")
            # no comment character: a value starting with '#' stays unquoted
            .option("comment", "\u0000")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .option("encoding", "UTF-8").option("lineSep", "\n"))


def write_coding_csv(df: DataFrame, folder: str, name: str | None = None) -> str:
    """Write the 27 columns in order as CSV: header, no index column, UTF-8 with
    a byte-order mark, minimal quoting with doubled quotes, empty strings kept
    empty. Every task writes its own part file (with the header) into the
    directory ``folder/name``, at every size. Returns that path; an empty input
    leaves nothing and returns "".
    """
    out = df.select(*[F.col(f"`{c}`").cast("string") for c in CSV_COLUMNS])
    # the BOM rides on the first header cell, so each part file starts with it
    out = out.withColumnRenamed(TITLE, BOM + TITLE)
    target = f"{folder.rstrip('/')}/{name or default_csv_name()}"
    rows = Observation()
    _csv_writer(out.observe(rows, F.count(F.lit(1)).alias("n"))).csv(target)
    if rows.get["n"]:
        return target
    paths.delete(df.sparkSession, target)
    return ""


def read_coding_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read a coding CSV back (BOM stripped from the first header cell). The format
    has no null: an empty cell is the empty string."""
    df = (spark.read.option("header", True).option("multiLine", True)
          .option("quote", '"').option("escape", '"').option("encoding", "UTF-8")
          .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
          .csv(path))
    first = df.columns[0]
    if first.startswith(BOM):
        df = df.withColumnRenamed(first, first[len(BOM):])
    return df.na.fill("")


def write_parquet(df: DataFrame, path: str) -> str:
    """The scale-out sink: Parquet, one file per task, column names kept."""
    df.write.mode("overwrite").parquet(path)
    return path


def write_bucketed(df: DataFrame, table: str, key: str = "doc_id", buckets: int = 512,
                   path: str | None = None) -> str:
    """Save ``df`` as a table bucketed (and sorted) on ``key``.

    Write papers and stored replies this way with the same bucket count and
    the coding join reads them co-partitioned: no shuffle at all, however
    large the tables. ``path`` puts the files in a shared folder of your
    choice (an external table); otherwise the warehouse location is used.
    """
    w = df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
    return table

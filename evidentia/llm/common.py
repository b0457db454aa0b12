"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evidentia.session import scratch_path
from evidentia.sources import paths

#: The white space that separates words; the byte class ``bytes.split()`` uses.
WHITE = r"\x20\x09-\x0D"


def read(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the driver and all executors share."""
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    if (made := _MADE.get()) is not None:
        made.append(path)
    return path


@contextmanager
def scratch() -> Iterator[list[str]]:
    """The list of the paths that ``shared_path`` makes inside the block, for their removal (``remove``) once
    what was computed from them is written. A block around this one lists them too."""
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)
        if (outer := _MADE.get()) is not None:
            outer.extend(made)


def remove(spark: SparkSession, made: Iterable[str]) -> None:
    for path in made:
        paths.delete(spark, path)


def stage(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there,
    each row is committed once, and a lost executor costs only its running tasks.
    ``compression``: of the files, if not the session's."""
    path = shared_path(df.sparkSession, name)
    (df.write.option("compression", compression) if compression else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            empty: bool = True) -> DataFrame:
    """Only the two columns an operator needs, as ``doc_id`` and ``text``; other
    columns, whatever their names, never reach the operator. ``empty``: null
    texts become ''."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       (F.coalesce(text, F.lit("")) if empty else text).alias("text"))


def whole_groups(arrow: Iterator[pa.RecordBatch], key: str, *columns: str) -> Iterator[list[np.ndarray]]:
    """From Arrow batches sorted by ``key`` (no nulls): arrays of ``key`` and ``columns`` that hold
    whole groups; only a group that goes on in the next batch is held back."""
    held: list[list[np.ndarray]] = []
    for batch in arrow:
        if not batch.num_rows:
            continue
        new = [batch.column(c).to_numpy(zero_copy_only=False) for c in (key, *columns)]
        held.append(new)
        last = new[0][-1]
        if held[0][0][0] != last:
            joined = [np.concatenate(c) for c in zip(*held, strict=True)]
            done = len(joined[0]) - int((joined[0][::-1] != last).argmax())
            yield [c[:done] for c in joined]
            held = [[c[done:] for c in joined]]
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def few(df: DataFrame, most: int) -> DataFrame:
    """``df`` (cheap to count, e.g. staged) marked for a broadcast if it has at most ``most``
    rows; beyond that it is left as it is, for a sort-merge join with the same rows."""
    return F.broadcast(df) if df.count() <= most else df


def prefix_sums(totals: DataFrame, key: str, value: str, block: int = 4096) -> DataFrame:
    """``key`` (a non-negative long, one row each) and ``before``: the sum of
    ``value`` over all smaller keys.

    Sums run inside blocks of ``block`` keys, each block in a task of its own;
    only the block totals, a 4096th of the rows, are summed up in one task.
    """
    rows = totals.select(F.col(key), F.col(value).alias("__v"), F.expr(f"`{key}` div {block}").alias("__b"))
    inside = F.sum("__v").over(Window.partitionBy("__b").orderBy(key)) - F.col("__v")
    blocks = rows.groupBy("__b").agg(F.sum("__v").alias("__t"))
    blocks = blocks.select("__b", (F.sum("__t").over(Window.orderBy("__b")) - F.col("__t")).alias("__o"))
    return (rows.withColumn("__i", inside).join(blocks, "__b")
                .select(key, (F.col("__i") + F.col("__o")).alias("before")))


def drop_rows(docs: DataFrame, actions: DataFrame, key: dict) -> DataFrame:
    """``docs`` without the rows that ``actions`` names, all columns kept.

    ``key``: name of a column of ``actions`` -> expression over ``docs``. ``actions``
    has one row per key and ``once``: false drops every row of that key, true
    keeps one of its (repeated) rows, the same in every run. Keys that it doesn't list stay. Only rows to
    drop or to thin out are listed, so the list is short beside ``docs`` and Spark
    chooses between a broadcast and a sort-merge join by its measured size.
    """
    # the user's columns travel as one struct, so that no name of theirs meets one of ours
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        *[e.alias(f"key_{i}") for i, e in enumerate(key.values())])
    listed = actions.select(*[F.col(k).alias(f"listed_{i}") for i, k in enumerate(key)], F.col("once").alias("once"))
    on = reduce(lambda a, b: a & b, [F.col(f"key_{i}").eqNullSafe(F.col(f"listed_{i}")) for i in range(len(key))])
    joined = keyed.join(listed, on, "left")
    plain = joined.filter(F.col("once").isNull()).select("row")
    # of repeated rows the same one stays in every run: the smallest as JSON
    once = (joined.filter(F.col("once")).groupBy(*[f"key_{i}" for i in range(len(key))])
                  .agg(F.min_by("row", F.to_json("row")).alias("row")).select("row"))
    return plain.unionByName(once).select(*[F.col("row")[c].alias(c) for c in docs.columns])

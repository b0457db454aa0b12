"""Coding replies as they land, whichever comes first: the reply or its paper.

Replies arrive as Parquet files ``(key, response, error)`` in a folder (for example, written batch by
batch by a responder job), papers as Parquet files in another one, or as a table given at each
start. Both are streams. Papers are routed as they are read, once each, to thin rows
``(key, route, Title)``; no paper text reaches a shuffle. The two streams meet in keyed state
(``applyInPandasWithState``): a key's state holds its thin paper row, once that is known, and
the replies that still wait for it. A reply whose paper is known goes on at once and leaves nothing behind;
one that comes first waits, through any number of batches and restarts, and goes on when its paper comes. The
parse is the batch coder's, stateless and JVM-side, on the way to an appending Parquet sink.

State is kept by RocksDB on the executors (unless the session names another store) and, like the offsets,
checkpointed in the shared ``spark.checkpoint.dir``, so a restarted query resumes where it
stopped and each reply is coded once.

Defined results: rows without a key have no paper and are left out; of several papers of one key the first that comes
counts (of one batch, the smallest); each reply row gives one coded row.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from evidentia.operators.coding import coded_rows
from evidentia.plans.pipeline import finish_coded, routed_papers
from evidentia.schema import TITLE
from evidentia.session import scratch_path
from evidentia.sources import paths

REPLY_SCHEMA = "doc_id long, response string, error string"
PAPER_SCHEMA = "doc_id long, file_name string, text string"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STORE = "spark.sql.streaming.stateStore.providerClass"
_REPLY = "response string, error string"


def stream_code_replies(spark: SparkSession, replies_dir: str, papers: DataFrame | str, output_dir: str,
                        checkpoint: str | None = None, key: str = "doc_id", reply_schema: str = REPLY_SCHEMA,
                        available_now: bool = True, max_files_per_trigger: int | None = None,
                        paper_schema: str = PAPER_SCHEMA):
    """Start the streaming coding query; returns the ``StreamingQuery``.

    ``papers``: a folder of Parquet files ``(key, file_name, text)`` that may grow while the query runs, or
    a table of which each start adds the papers that no earlier start has brought. With ``available_now``
    every file present is processed and the query stops; otherwise it keeps polling both folders.
    """
    # one checkpoint per output folder: another output starts its own
    own = hashlib.sha256(output_dir.rstrip("/").encode()).hexdigest()[:16]
    checkpoint = checkpoint or scratch_path(spark, f"coding-stream-{own}")

    def files(schema: str, path: str) -> DataFrame:
        reader = spark.readStream.schema(schema)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.parquet(path)

    replies = files(reply_schema, replies_dir)
    if isinstance(papers, str):
        routed = routed_papers(files(paper_schema, papers), key=key)
    else:
        folder = f"{checkpoint.rstrip('/')}-papers"
        key_type = papers.schema[key].dataType.simpleString()
        _add_papers(papers, folder, key)
        routed = files(f"{key} {key_type}, route string, {TITLE} string", f"{folder}/*")
    coded = code_as_they_come(routed, replies, key)
    writer = (coded.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint)
              .option("path", output_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer
    if spark.conf.get(_STORE) == ROCKSDB or not spark.conf.get(_STORE).endswith("HDFSBackedStateStoreProvider"):
        return writer.start()
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, ROCKSDB)  # the query takes the setting along when it starts
    try:
        return writer.start()
    finally:
        spark.conf.set(_STORE, before)


def _add_papers(papers: DataFrame, folder: str, key: str) -> None:
    """Write the thin rows of the papers that earlier starts have not brought, as one committed part of ``folder``."""
    spark = papers.sparkSession
    thin = routed_papers(papers, key=key).where(F.col(key).isNotNull())
    done = [d for d in paths.child_dirs(spark, folder) if paths.committed(spark, d)]
    if done:
        thin = thin.join(spark.read.parquet(*done).select(key), key, "left_anti")
    thin.write.parquet(f"{folder}/start-{int(time.time() * 1000)}-{uuid.uuid4().hex[:8]}")


def code_as_they_come(routed: DataFrame, replies: DataFrame, key: str = "doc_id") -> DataFrame:
    """One coded row per reply of the stream ``replies`` whose paper has come in the stream ``routed``, before or after it."""
    key_type = routed.schema[key].dataType.simpleString()
    none = F.lit(None).cast("string")
    both = (replies.select(key, "response", "error", none.alias("route"), none.alias(TITLE), F.lit(False).alias("is_paper"))
            .unionByName(routed.select(key, none.alias("response"), none.alias("error"), "route", TITLE, F.lit(True).alias("is_paper")))
            .where(F.col(key).isNotNull()))

    def meet(key_values: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        return _meet(key_values, batches, state, key)

    matched = both.groupBy(key).applyInPandasWithState(
        meet, f"{key} {key_type}, {_REPLY}, route string, {TITLE} string",
        f"route string, title string, waiting array<struct<{_REPLY.replace(' string', ': string')}>>",
        "append", GroupStateTimeout.NoTimeout)
    parsed = coded_rows(matched.withColumn("_has_reply", F.lit(True)), response="response", title=TITLE,
                        keep=(key, "error", "_has_reply", "route"))
    return finish_coded(parsed, key)


def _meet(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState, name: str = "doc_id") -> Iterator[pd.DataFrame]:
    """What one key's new rows add: its replies, with the paper's route and title as soon as both are there."""
    route, title, waiting = state.get if state.exists else (None, None, [])
    waiting = [tuple(w) for w in waiting]
    known, first = route is not None, None
    for rows in batches:
        papers = rows[rows["is_paper"]]
        if not known and len(papers):
            least = min(zip(papers["route"], papers[TITLE].where(papers[TITLE].notna(), None), strict=True), key=lambda p: (p[0], p[1] or ""))
            first = least if first is None else min(first, least, key=lambda p: (p[0], p[1] or ""))
        new = rows[~rows["is_paper"]]
        new = [(None if pd.isna(r) else r, None if pd.isna(e) else e) for r, e in zip(new["response"], new["error"], strict=True)]
        if known:  # replies of a known paper pass through, batch by batch
            yield _matched(name, key, new, route, title)
        else:
            waiting += new
    if not known and first is not None:
        route, title = first
        yield _matched(name, key, waiting, route, title)
        waiting = []
    if not known:
        state.update((route, title, waiting))


def _matched(name: str, key: tuple, replies: list[tuple], route: str, title: str | None) -> pd.DataFrame:
    return pd.DataFrame({name: [key[0]] * len(replies), "response": [r for r, _ in replies], "error": [e for _, e in replies],
                         "route": [route] * len(replies), TITLE: [title] * len(replies)})

"""Exact dedup against a persistent digest index.

The index is a Parquet table bucketed and sorted by the SHA-256 of the text. A
batch of new documents is reduced to one row per digest (partial aggregation
first, so a text that a third of all rows share is summed up before it moves),
anti-joined with the index bucket by bucket (sort-merge; the index side is not
shuffled), and what is new is appended. Documents then learn from the index
which row of their text stays.

Native: DataFrame operations only.

Defined results: a null text counts as ''. Of equal texts in a batch the
largest ``doc_id`` stays; a text the index already holds keeps the row of the
earlier batch. A null ``doc_id`` is smaller than any other. Of fully repeated
rows (same id, same text) one stays. An empty table gives no rows. Running a
batch again gives the same decisions: a row whose own id the index names stays.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.llm.common import drop_rows, id_text, remove, shared_path, stage

BUCKETS = 64


def digest(text) -> F.Column:
    """SHA-256 of the UTF-8 text, 32 bytes; null counts as ''."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256))


class DigestIndex:
    """A bucketed table ``digest -> keep_id`` in a folder that all executors see.

    Opening the same ``path`` again (in any session) finds what earlier batches
    appended. Batches are appended one at a time: two appends at once may each find a digest absent and store it twice. Each append adds one file per bucket; ``compact`` rewrites them
    as one sorted file per bucket into a new folder.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = BUCKETS):
        self.spark, self.buckets = spark, buckets
        self.path = path or shared_path(spark, "digest-index")
        self.table = f"llm_digest_index_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {int(buckets)} BUCKETS LOCATION '{self.path}'")

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, groups: DataFrame) -> None:
        """Append the groups (digest, keep_id) whose digest is not in the index."""
        known = self.rows().select("digest").hint("merge")
        fresh = groups.select("digest", "keep_id").join(known, "digest", "left_anti")
        (fresh.repartition(self.buckets, "digest").sortWithinPartitions("digest")
              .write.insertInto(self.table))
        self.spark.catalog.refreshTable(self.table)

    def drop(self) -> None:
        """Remove the index: its catalog entry and its files."""
        self.spark.sql(f"DROP TABLE {self.table}")
        remove(self.spark, [self.path])

    def compact(self, path: str | None = None) -> DigestIndex:
        new = DigestIndex(self.spark, path, self.buckets)
        new.append(self.rows())
        return new


def decide(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row per (digest, doc_id): digest, doc_id, n (its repeated rows), keep_id, group_size."""
    own = DigestIndex(docs.sparkSession) if index is None else None
    index = index or own
    rows = id_text(docs, id_col, text_col).select("doc_id", digest(F.col("text")).alias("digest"))
    # keyed by (digest, id), so one hot text is spread over all tasks
    ids = stage(rows.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("n")), "dedup-ids")
    groups = stage(ids.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size")),
                   "dedup-groups")
    index.append(groups)
    # staged, so that the last join has an exchange on both sides and Spark can split a hot digest
    held = stage(groups.drop("keep_id").join(index.rows().hint("merge"), "digest"), "dedup-held")
    if own:  # an index of this call alone has done its work
        own.drop()
    return ids.join(held, "digest")


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    each = decide(docs, index, id_col, text_col).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return each.select("doc_id", "keep_id", "group_size",
                       (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
                       F.lower(F.hex("digest")).alias("text_sha256"))


def keep_first(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) with one row per text."""
    d = decide(docs, index, id_col, text_col)
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    actions = d.filter(~stays | (F.col("n") > 1)).select("digest", "doc_id", stays.alias("once"))
    return drop_rows(docs, actions, {"digest": digest(F.col(text_col)), "doc_id": F.col(id_col).cast("long")})


ORACLE = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

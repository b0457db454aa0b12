"""Two-pass external shuffle into shards.

Pass 1 scatters the records uniformly into buckets that fit one task's memory:
a seeded hash of the record and of its place in the input picks the bucket, so
repeated rows spread like any others. Pass 2 reads each bucket in one task,
puts it into a fixed order, shuffles it with a seeded Fisher-Yates
permutation and writes it. The written buckets, one after the other, are the
shuffled data set; the prefix sums of their sizes place each record, and shard
``s`` of ``k`` holds places ``s * n // k`` up to ``(s + 1) * n // k``, so the
row counts of shards differ by at most one (law ``rows``).

Defined results: a null text has size 1 and the checksum of no bytes, and comes
back null; repeated rows are records of their own; an empty table gives no
rows. The place of a record follows the order of the input files, so a run
over the same files gives the same shards.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import few, id_text, prefix_sums, stage

SEED = 20240607
#: Bytes of text in a bucket: what one Python task holds at a time.
BUCKET_BYTES = 16 * 2**20
SHARDS = 16
#: Bucket offsets (16 bytes each) to broadcast at most.
MOST_OFFSETS = 1_000_000


def shuffle_records(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, seed: int = SEED,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The shuffled records, written once: bucket, rank (in the bucket), doc_id, text, size, text_crc32."""
    rows = id_text(docs, id_col, text_col, empty=False)
    blank = F.coalesce(F.col("text"), F.lit(""))
    size = (F.octet_length(blank) + 1).cast("long")
    total = rows.agg(F.sum(size)).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    rows = rows.withColumns({"size": size, "text_crc32": F.crc32(blank.cast("binary")),
                             "place": F.monotonically_increasing_id()})
    scattered = rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "place"), F.lit(buckets)))

    def fisher_yates(key, table):
        bucket = key[0].as_py()
        table = table.sort_by("place")  # the order rows arrive in differs between runs
        order = np.random.Generator(np.random.PCG64([seed, bucket])).permutation(table.num_rows)
        table = table.take(pa.array(order))
        table = table.append_column("rank", pa.array(np.arange(table.num_rows)))
        return table.select(["doc_id", "text", "size", "text_crc32", "bucket", "rank"])

    shuffled = scattered.groupBy("bucket").applyInArrow(
        fisher_yates, "doc_id long, text string, size long, text_crc32 long, bucket long, rank long")
    return stage(shuffled, "shards")


def place(shuffled: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``shuffled`` with ``shard`` and ``slot`` (gapless from 0 in its shard)."""
    sizes = shuffled.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    n = shuffled.count()
    offsets = stage(prefix_sums(sizes, "bucket", "n"), "bucket-offsets")
    out = shuffled.join(few(offsets, MOST_OFFSETS), "bucket")
    # the shard is the last s with s * n // shards <= place
    out = out.withColumn("shard", F.expr(f"cast(((before + rank + 1) * {shards} - 1) div {max(n, 1)} as int)"))
    return out.withColumn("slot", F.expr(f"before + rank - (cast(shard as long) * {n}) div {shards}")).drop("before")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, **options) -> None:
    """The shards as Parquet folders ``path/shard=s``, rows in slot order in each file."""
    placed = place(shuffle_records(docs, **options), shards)
    (placed.select("doc_id", "text", "shard", "slot").sortWithinPartitions("shard", "slot")
           .write.partitionBy("shard").parquet(path))

"""SimHash near-dedup by a segment-popcount embedding.

A fingerprint's 64 bits are cut into 32 segments of two bits, and the number of
set bits of each segment is a coordinate. The Manhattan distance of two such
points is at most the Hamming distance of the fingerprints, so fingerprints
that differ in at most three bits have points within distance three. The
coordinates form two halves; in one of them such points are within distance one
(else both halves differ by two or more, four together). Each point therefore
lies in one grid cell per half (the cell of its 16 coordinates) and is also sent
to the cells one step up in one coordinate: two points within distance one
meet, equal points at home and others where the lower one steps up. What meets
is verified by the exact Hamming distance.

Equal fingerprints are one node, so copies meet no one. A cell passes on
only a spanning forest of its links (same components, fewer rows than
points), and a cell with many points is cut into blocks, each pair of
blocks compared in a group of its own; nothing is capped. Components come from
minimum labels with pointer jumping over checkpointed tables.

Defined results: a null text counts as ''; a text without words has
fingerprint zero, linked like any other; a null ``doc_id`` never names a
component that has another id (else the component's id is null); repeated rows
come back each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import drop_rows, few, id_text, stage, whole_groups

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Points of a cell that are compared in one group.
BLOCK = 4096
#: Cells cut into blocks (16 bytes each) to broadcast at most.
MOST_LARGE = 1_000_000


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text (unsigned)."""
    import xxhash

    words = text.encode().lower().split()  # ASCII letters and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    k = min(shingle, len(words))
    starts, ends = (end - size)[:len(words) - k + 1].tolist(), end[k - 1:].tolist()
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(line[a:b], SEED) for a, b in zip(starts, ends, strict=True)], np.uint64)
    n, ones = len(hashes), np.zeros(64, np.int64)
    for i in range(0, n, 1 << 14):
        ones += np.unpackbits(hashes[i:i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the 64 bits as a long), text_hash."""

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow:
            fp = np.fromiter((fingerprint(t, shingle) for t in batch.column("text").to_pylist()), np.uint64, batch.num_rows)
            yield pa.record_batch([batch.column("doc_id"), pa.array(fp.view(np.int64)), batch.column("text_hash")],
                                  ["doc_id", "fp", "text_hash"])

    rows = id_text(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    return rows.mapInArrow(run, "doc_id long, fp long, text_hash long")


# --- grid -------------------------------------------------------------------


def _cells(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fingerprint's home cells and the cells one step up.

    A cell is the half's 16 coordinates, two bits each, as a 32-bit number, with
    the half above it. The sums of neighbouring bits of all segments are one
    arithmetic step on the whole word; a coordinate that may step up is below 2.
    """
    low = np.uint64(0x5555555555555555)
    for batch in arrow:
        fp = batch.column("fp").to_numpy().view(np.uint64)
        point = (fp & low) + ((fp >> np.uint64(1)) & low)
        cells, points, probes = [], [], []
        for half in (0, 1):
            home = ((point >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)).astype(np.int64)
            tag = half << 32
            cells.append(home | tag)
            points.append(fp)
            probes.append(np.zeros(len(fp), bool))
            for i in range(16):
                can = ((home >> (2 * i)) & 3) < 2
                cells.append((home[can] + (1 << (2 * i))) | tag)
                points.append(fp[can])
                probes.append(np.ones(int(can.sum()), bool))
        yield pa.record_batch([pa.array(np.concatenate(cells)), pa.array(np.concatenate(points).view(np.int64)),
                               pa.array(np.concatenate(probes))], ["cell", "fp", "probe"])


def _forest(fp: np.ndarray, probe: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links of one group that connect what its links connect: home with home, probe with home."""
    nodes, index = np.unique(fp, return_inverse=True)
    at_home = index[~probe]
    home, label, links = nodes[at_home], np.arange(len(nodes)), []
    for i in np.unique(index).tolist():
        near = at_home[np.bitwise_count(nodes[i] ^ home) <= bits]
        found, first = np.unique(label[near], return_index=True)
        for other, at in zip(found.tolist(), near[first].tolist(), strict=True):
            if other != label[i]:
                links.append((int(nodes[i]), int(nodes[at])))
                label[label == max(other, label[i])] = min(other, label[i])
    return links


def _small_groups(key: np.ndarray, fp: np.ndarray, probe: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """All links in groups of few rows, rows sorted by group: compare each row with the d-th after it."""
    a, b = [], []
    d, rows = 1, np.arange(len(key))
    while True:
        rows = rows[rows + d < len(key)]
        rows = rows[key[rows] == key[rows + d]]
        if not len(rows):
            break
        near = rows[~(probe[rows] & probe[rows + d]) & (np.bitwise_count(fp[rows] ^ fp[rows + d]) <= bits)]
        a.append(fp[near])
        b.append(fp[near + d])
        d += 1
    none = np.zeros(0, np.uint64)
    return (np.concatenate(a) if a else none), (np.concatenate(b) if b else none)


#: Groups of up to this many rows are compared all at once.
FEW = 24


def _links(bits: int):
    """Rows sorted by group -> links (a, b)."""

    def pairs(key, fp, probe):
        cut = np.flatnonzero(np.diff(key)) + 1
        starts, ends = np.concatenate(([0], cut)), np.concatenate((cut, [len(key)]))
        large = ends - starts > FEW
        small = np.repeat(~large, ends - starts)
        a, b = _small_groups(key[small], fp[small], probe[small], bits)
        found = [p for s, e in zip(starts[large], ends[large], strict=True) for p in _forest(fp[s:e], probe[s:e], bits)]
        more = np.array(found, np.uint64).reshape(-1, 2)
        a, b = np.concatenate((a, more[:, 0])), np.concatenate((b, more[:, 1]))
        a, b = np.minimum(a, b)[a != b], np.maximum(a, b)[a != b]
        return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, fp, probe in whole_groups(arrow, "group", "fp", "probe"):
            yield pairs(key, fp.view(np.uint64), probe)

    return run


def links(points: DataFrame, bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that differ in at most three bits:
    of each cell a spanning forest at least, so that the components are whole."""
    if bits > MAX_BITS:
        raise ValueError("two halves find links of up to three bits")
    cells = points.select("fp").mapInArrow(_cells, "cell long, fp long, probe boolean")
    # the cells with many points (at most one for every `block` rows) are cut into blocks
    large = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
    large = few(stage(large.select("cell", F.ceil(F.col("n") / block).alias("blocks")), "large-cells"), MOST_LARGE)
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    other = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("long")))
                      .otherwise(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = cells.join(large, "cell", "left").select("cell", "fp", "probe", mine.alias("mine"), other.alias("other"))
    group = F.when(F.col("mine").isNull(), F.xxhash64("cell")).otherwise(
        F.xxhash64("cell", F.least("mine", "other"), F.greatest("mine", "other")))
    grouped = dealt.select(group.alias("group"), "fp", "probe")
    n = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (grouped.repartition(n, "group").sortWithinPartitions("group")
                   .mapInArrow(_links(bits), "a long, b long").distinct())


# --- components -------------------------------------------------------------


def components(nodes: DataFrame, edges: DataFrame, key: str = "fp") -> DataFrame:
    """``key`` and ``root`` for every node: the same root for what edges (a, b) connect.

    Only nodes with an edge take part in the rounds. In each, every node's label
    becomes the smallest label around it, then the label of its label (pointer
    jumping), until nothing changes; labels are checkpointed each round.
    """
    edges = stage(edges, "edges")
    both = stage(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges-both")
    labels = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("v"), F.least("a", "m").alias("l"))
    labels = labels.checkpoint()
    while True:
        # hook: a root takes the smallest label seen by any node it labels
        seen = both.join(labels, F.col("b") == F.col("v")).groupBy("a").agg(F.min("l").alias("m"))
        near = labels.join(seen, F.col("v") == F.col("a")).select("v", "l", F.least("l", "m").alias("m"))
        hooks = near.filter("m < l").groupBy("l").agg(F.min("m").alias("to")).withColumnRenamed("l", "r")
        step = near.join(hooks, F.col("l") == F.col("r"), "left").select("v", "l", F.least("m", F.coalesce("to", "m")).alias("n"))
        step = step.checkpoint()
        jump = step.select(F.col("v").alias("p"), F.col("n").alias("pn"))
        new = step.join(jump, F.col("n") == F.col("p"), "left").select("v", F.least("n", F.coalesce("pn", "n")).alias("l"), F.col("l").alias("was"))
        new = new.checkpoint()
        changed = new.filter("l < was").limit(1).count()
        labels = new.select("v", "l")
        if not changed:
            break
    return nodes.select(key).join(labels, F.col(key) == F.col("v"), "left").select(key, F.coalesce("l", key).alias("root"))


def near_groups(docs: DataFrame, shingle: int = SHINGLE, bits: int = MAX_BITS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fp, text_hash, root (a fingerprint that names the group), component_id."""
    rows = stage(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    points = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "points")
    roots = components(points, links(points, bits))
    labelled = points.join(roots, "fp")
    names = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stage(labelled.join(names, "root").select("fp", "root", "component_id"), "components")
    return rows.join(named, "fp")


def simhash_dedup(docs: DataFrame, shingle: int = SHINGLE, bits: int = MAX_BITS, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    g = near_groups(docs, shingle, bits, id_col, text_col)
    return g.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, bits: int = MAX_BITS, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) with one row per component: the one with the smallest id
    (of several texts with that id, the one with the smallest hash)."""
    g = near_groups(docs, shingle, bits, id_col, text_col)
    ids = stage(g.groupBy("root", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")), "members")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    best = ids.groupBy("root").agg(F.min(first).alias("best"))
    marked = ids.join(best, "root").select("doc_id", "text_hash", "n", (first == F.col("best")).alias("stays"))
    actions = marked.filter(~F.col("stays") | (F.col("n") > 1)).select("doc_id", "text_hash", F.col("stays").alias("once"))
    return drop_rows(docs, actions, {"doc_id": F.col(id_col).cast("long"),
                                     "text_hash": F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))})

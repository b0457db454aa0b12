"""The trie of conversation prefixes, by a splitter skeleton.

A conversation is the path of its turns' SHA-256 digests. The paths are dealt into
ranges (``repartitionByRange`` on path and id, so that copies of one conversation are
split too) and each range is a sorted shard. A node whose prefix no splitter has
lies in one shard, and that shard finishes it alone. The prefixes that cross from a
shard into the next one are the skeleton: the trie of the splitters' paths, as
edges (splitter, depth it shares with the one before, depth it crosses), three
numbers a shard, is broadcast. Shards hand out partial counts of their skeleton
nodes, which Spark adds up by node; a last fold over the skeleton, whose size follows
the number of shards and not the data, adds up its subtrees.

Texts never move: a turn is reduced to a digest and its number of code points
before the first shuffle. The ids that end at a skeleton node are hashed from
chunks in the order of the shards, streamed.

Defined results: rows without a conversation id are left out; a null role or text
counts as ''; a null turn comes first; rows of one turn follow the order of their
digests (repeated rows are turns of their own); texts of any length are only
digested; an empty table gives no rows; other columns, whatever their names, never
reach the operator. A conversation is one row of about 40 bytes a turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evidentia.llm.common import few, stage

#: Of conversation c - c % GROUP the first turns are put before c's own; at most MOST_SHARED - 1 of them.
GROUP = 100
MOST_SHARED = 6
#: Skeleton rows (about 60 bytes each) to broadcast at most when children look up their parent.
MOST_SKELETON = 500_000
#: Ids of one chunk of a skeleton node's ends.
CHUNK = 50_000
NOTHING = hashlib.sha256(b"").hexdigest()

_TURN = "struct<digest: binary, chars: bigint>"
_NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, ends_sha256 string")
_OUT = _NODE + ", owner int, chars long, parent int, ends array<string>, first_ends array<long>"
_NAMES = [c.split()[0] for c in _OUT.split(", ")]
_TYPES = [pa.int64()] * 7 + [pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int64())]


def turn_lists(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
               text_col: str = "text") -> DataFrame:
    """conv_id, turns: per conversation the digest and the code points of each turn, in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    turn = F.col(turn_col).cast("long")
    rows = conversations.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.struct(turn.isNotNull().alias("given"), F.coalesce(turn, F.lit(0)).alias("turn"), digest.alias("digest"),
                 F.length(text).cast("long").alias("chars")).alias("t"))
    lists = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return lists.select("conv_id", F.transform("t", lambda t: F.struct(t["digest"].alias("digest"), t["chars"].alias("chars"))).alias("turns"))


def with_shared_start(lists: DataFrame) -> DataFrame:
    """The first h turns of conversation c - c % 100 (h: crc32 of the decimal c, mod 6), then c's own behind its first h."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED).cast("int")
    starts = lists.filter(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("start_id"), F.slice("turns", 1, MOST_SHARED - 1).alias("start"))
    joined = lists.withColumn("start_id", F.col("conv_id") - F.col("conv_id") % GROUP).join(starts, "start_id", "left")
    none = F.expr(f"CAST(array() AS array<{_TURN}>)")
    own = F.when(F.size("turns") > h, F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))).otherwise(none)
    return joined.select("conv_id", F.concat(F.slice(F.coalesce("start", none), F.lit(1), h), own).alias("turns"))


class Skeleton:
    """The splitters' trie. ``edges``: (shard, share, cross) in the order of the shards; the prefixes of
    ``shard``'s first path down to depth ``cross`` lie in the shard before too, those down to ``share``
    belong to earlier splitters. A skeleton node is named by the splitter that owns it and its depth."""

    def __init__(self, edges: list[tuple[int, int, int]]):
        self.edges, self.up, self.next = {}, {}, {}
        before = None
        for shard, share, cross in edges:
            self.edges[shard] = share, cross
            k = before
            while k is not None and self.edges[k][0] >= share:  # the owner of depth ``share`` lies further up
                k = self.up[k]
            self.up[shard] = k
            if before is not None:
                self.next[before] = shard
            before = shard

    def owner(self, shard: int, depth: int) -> int:
        while depth <= self.edges[shard][0]:
            shard = self.up[shard]
        return shard


class _Node:
    __slots__ = ("chars", "children", "conv", "convs", "ends", "leaves", "n_children", "owner", "saved")

    def __init__(self, chars: int, owner: int | None):
        self.chars, self.owner = chars, owner
        self.conv, self.convs, self.n_children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends, self.children = [], []


def _ends(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def _shard_nodes(rows: Iterator[tuple], shard: int, tree: Skeleton, chunk: int) -> Iterator[tuple]:
    """The nodes of one sorted shard, rows (conv_id, digests, chars). Finished nodes come once their parent is
    done, with its id; skeleton nodes come as partial counts, their children with the parent's name."""
    cross = tree.edges[shard][1]
    stack, path = [_Node(0, tree.owner(shard, 0) if cross >= 0 else None)], []

    def close() -> Iterator[tuple]:
        depth = len(stack) - 1
        node = stack.pop()
        above = stack[-1] if stack else None
        partial = node.owner is not None
        if above is not None:
            above.conv = node.conv if above.conv is None else min(above.conv, node.conv)
            above.convs += node.convs
        for c in node.children:  # (conv, convs, children, leaves, saved, ends)
            yield (c[0], depth + 1, None if partial else node.conv, *c[1:], None, None, node.owner, None, None)
        if partial:
            cut = [node.ends[i:i + chunk] for i in range(0, len(node.ends), chunk)]
            yield (node.conv, depth, None, node.convs, node.n_children, node.leaves, node.saved, None, node.owner, node.chars, None,
                   [",".join(map(str, x)) for x in cut], [x[0] for x in cut])
            return
        leaves, saved = max(node.leaves, 1), node.saved + (node.convs - 1) * node.chars
        done = node.conv, node.convs, node.n_children, leaves, saved, _ends(node.ends)
        if above is None:
            yield (done[0], 0, None, *done[1:], None, None, None, None, None)
            return
        above.children.append(done)
        above.n_children, above.leaves, above.saved = above.n_children + 1, above.leaves + leaves, above.saved + saved

    for first, (conv, digests, chars) in enumerate(rows):
        same = 0
        for a, b in zip(path, digests):
            if a != b:
                break
            same += 1
        while len(stack) - 1 > same:
            yield from close()
        for d in range(len(stack), len(digests) + 1):
            stack.append(_Node(chars[d - 1], tree.owner(shard, d) if not first and d <= cross else None))
        top = stack[-1]
        top.ends.append(conv)
        top.conv = conv if top.conv is None else min(top.conv, conv)
        top.convs += 1
        path = digests
    follows = tree.next.get(shard)
    if follows is not None:  # what is still open and goes on in the next shard
        for d in range(min(tree.edges[follows][1], len(stack) - 1) + 1):
            stack[d].owner = tree.owner(follows, d)
    while stack:
        yield from close()


def _batches(rows: Iterator[tuple], names: list[str], types: list, most: int = 5000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)
            held = []
    if held:
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)


def _edges(ranged: DataFrame) -> list[tuple[int, int, int]]:
    """(shard, share, cross) of each shard that has rows: three numbers a shard come to the driver."""
    ends = ranged.groupBy("shard").agg(F.min(F.struct("path", "conv_id")).alias("a"), F.max(F.struct("path", "conv_id")).alias("b"))
    w = Window.orderBy("shard")  # one row a shard
    ends = ends.select("shard", F.col("a.path").alias("first"), F.lag("a.path").over(w).alias("first_before"), F.lag("b.path").over(w).alias("last_before"))

    def common(a: str, b: str):
        n = F.least(F.size(a), F.size(b))
        at = F.array_position(F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n), lambda x, y: x == y), False)
        return F.when(F.col(b).isNull(), F.lit(-1)).when(at == 0, n).otherwise(at - 1).cast("int")

    rows = ends.select("shard", common("first", "first_before").alias("share"), common("first", "last_before").alias("cross")).orderBy("shard").collect()
    out, before = [], -1
    for shard, share, cross in rows:
        out.append((shard, min(share, before), cross))
        before = cross
    return out


def _shards(ranged: DataFrame, tree: Skeleton, chunk: int) -> DataFrame:
    spark = ranged.sparkSession
    shared = spark.sparkContext.broadcast(tree)

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []

        def rows() -> Iterator[tuple]:
            for batch in arrow:
                yield from zip(*(batch.column(c).to_pylist() for c in ("shard", "conv_id", "path", "chars")), strict=True)

        every = rows()

        def of(shard: int, row: tuple) -> Iterator[tuple]:
            held.clear()
            yield row[1:]
            for row in every:
                if row[0] != shard:
                    held.append(row)
                    return
                yield row[1:]

        def nodes() -> Iterator[tuple]:
            row = next(every, None)
            while row is not None:
                yield from _shard_nodes(of(row[0], row), row[0], shared.value, chunk)
                row = held.pop() if held else None

        yield from _batches(nodes(), _NAMES, _TYPES)

    dealt = ranged.repartition(_tasks(spark), "shard").sortWithinPartitions("shard", "path", "conv_id")
    return dealt.select("shard", "conv_id", "path", "chars").mapInArrow(run, _OUT)


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _skeleton_ends(parts: DataFrame) -> DataFrame:
    """owner, depth, ends_sha256 of the skeleton nodes at which conversations end: their chunks, streamed in order."""
    chunks = parts.select("owner", "depth", F.inline(F.arrays_zip("ends", "first_ends")))

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def nodes() -> Iterator[tuple]:
            at, h = None, None
            for batch in arrow:
                for owner, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("owner", "depth", "ends")), strict=True):
                    if (owner, depth) != at:
                        if h:
                            yield (*at, h.hexdigest())
                        at, h = (owner, depth), hashlib.sha256(ids.encode())
                    else:
                        h.update(b"," + ids.encode())
            if h:
                yield (*at, h.hexdigest())

        yield from _batches(nodes(), ["owner", "depth", "ends_sha256"], [pa.int32(), pa.int64(), pa.string()])

    dealt = chunks.repartition(_tasks(parts.sparkSession), "owner", "depth").sortWithinPartitions("owner", "depth", "first_ends")
    return dealt.select("owner", "depth", "ends").mapInArrow(run, "owner int, depth long, ends_sha256 string")


def _fold(parts: DataFrame, tree: Skeleton) -> DataFrame:
    """The skeleton nodes, whole: owner and the columns of a node. The partial counts are added up by node in Spark; the
    fold over the skeleton's own edges, deepest first, is one task over rows that follow the number of shards."""
    sums = parts.groupBy("owner", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.max("chars").alias("chars"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    whole = sums.join(_skeleton_ends(parts), ["owner", "depth"], "left")
    names = ["owner", "depth", "conv_id", "chars", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    shared = parts.sparkSession.sparkContext.broadcast(tree)

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes = {}
        for batch in arrow:
            for r in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                nodes[r[:2]] = list(r)
        for owner, depth in sorted(nodes, key=lambda k: -k[1]):
            n = nodes[owner, depth]
            n[6] = max(n[6], 1)
            n[7] += (n[4] - 1) * n[3]
            if depth:
                above = nodes[shared.value.owner(owner, depth - 1), depth - 1]
                above[5], above[6], above[7] = above[5] + 1, above[6] + n[6], above[7] + n[7]

        def rows() -> Iterator[tuple]:
            for (owner, depth), n in nodes.items():
                up = nodes[shared.value.owner(owner, depth - 1), depth - 1][2] if depth else None
                yield n[2], depth, up, *n[4:8], n[8] or NOTHING, owner

        yield from _batches(rows(), _NAMES[:9], _TYPES[:9])

    return whole.select(*names).coalesce(1).mapInArrow(run, _NODE + ", owner int")


def prefix_trie(lists: DataFrame, shards: int | None = None, chunk: int = CHUNK) -> DataFrame:
    """One row per node of the trie of ``lists`` (conv_id, each once, and turns: array of digest and chars): conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. ``shards``: ranges; as many as
    shuffle partitions by default."""
    paths = stage(lists.select("conv_id", F.col("turns.digest").alias("path"), F.col("turns.chars").alias("chars")), "trie-paths")
    ranged = paths.repartitionByRange(shards or _tasks(lists.sparkSession), "path", "conv_id").withColumn("shard", F.spark_partition_id())
    ranged = stage(ranged, "trie-ranges")  # the ranges, and so the splitters, are fixed here
    tree = Skeleton(_edges(ranged))
    nodes = stage(_shards(ranged, tree, chunk), "trie-nodes")
    columns = [c.split()[0] for c in _NODE.split(", ")]
    skeleton = stage(_fold(nodes.filter("owner is not null"), tree), "trie-skeleton")
    own = nodes.filter("owner is null and parent is null").select(*columns)
    up = skeleton.select(F.col("owner").alias("parent"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("up"))
    below = nodes.filter("parent is not null").join(few(up, MOST_SKELETON), ["parent", "depth"])
    below = below.withColumn("parent_conv_id", F.col("up")).select(*columns)
    return own.unionByName(below).unionByName(skeleton.select(*columns))


ORACLE = f"""
WITH t AS (
    SELECT conv_id, turn, sha256(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS d,
           length(coalesce(text, '')) AS chars
    FROM conversations WHERE conv_id IS NOT NULL
), l AS (
    SELECT conv_id, list({{'d': d, 'c': chars}} ORDER BY turn NULLS FIRST, d) AS turns,
           list_reduce(list_prepend(4294967295, list_transform(str_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(unicode(x) AS BIGINT))),
                       lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))) AS crc
    FROM t GROUP BY conv_id
), h AS (SELECT *, CAST(xor(crc, 4294967295) % {MOST_SHARED} AS BIGINT) AS h FROM l),
r AS (
    SELECT a.conv_id, list_concat(coalesce(b.turns, [])[1:a.h], a.turns[a.h + 1:]) AS turns
    FROM h a LEFT JOIN h b ON b.conv_id = a.conv_id - a.conv_id % {GROUP}
), m AS (SELECT conv_id, len(turns) AS size, unnest(range(len(turns) + 1)) AS depth, turns FROM r),
n AS (
    SELECT turns[1:depth] AS k, depth, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(max(turns[depth].c), 0) AS chars,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE size = depth), '')) AS ends_sha256
    FROM m GROUP BY ALL
), c AS (SELECT k[1:depth - 1] AS k, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
e AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c USING (k)),
s AS (
    SELECT k[1:a] AS k, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * chars) AS saved_tokens
    FROM (SELECT *, unnest(range(depth + 1)) AS a FROM e) GROUP BY ALL
)
SELECT e.conv_id, e.depth, p.conv_id AS parent_conv_id, e.n_convs, e.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, e.ends_sha256
FROM e JOIN s USING (k) LEFT JOIN e p ON e.depth > 0 AND p.k = e.k[1:e.depth - 1]
"""

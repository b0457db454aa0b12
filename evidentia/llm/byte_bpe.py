"""Byte-level BPE encoding by a segment tree, and decoding.

A piece of text is a row of byte symbols. The leaves of a segment tree hold the
merge rank of each symbol with its live right neighbour; each inner node keeps
the leftmost smallest rank below it. A merge joins the pair at the root's
position and then updates three leaves (the pair's, its left neighbour's and
the swallowed symbol's), each along one path to the root. Pieces of like
size form the rows of one array of trees, so that one step of numpy work does
one merge in each of them.

Each text is split by the pattern of the vocabulary; pieces that were encoded
before come from a bounded cache (module ``chunks``).

Defined results: a null text counts as '' (no ids); invalid ids don't arise;
repeated rows are encoded each; an empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.chunks import PieceCache, batches
from evidentia.llm.common import id_text

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Above every rank: no merge here.
NONE = np.int64(1 << 40)
#: Trees worked on at a time: this many leaves.
LEAVES = 1 << 18
#: Encoded pattern matches kept per worker.
CACHE_MATCHES = 300_000

_TABLES: dict[tuple, BytePairs] = {}


class BytePairs:
    """The ranks of a vocabulary file, and the merges that they imply."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.find = regex.compile(pattern).findall
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.token = [b""] * (max(self.rank.values()) + 1)
        for t, r in self.rank.items():
            self.token[r] = t
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        pairs = {(self.rank[t[:i]] << 20) | self.rank[t[i:]]: r for t, r in self.rank.items()
                 for i in range(1, len(t)) if t[:i] in self.rank and t[i:] in self.rank}
        self.pair = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in self.pair.tolist()], np.int64)
        self.known: dict[str, bytes] = {}
        self.cache = PieceCache(self.encode_pieces)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank (also the id) of each pair of ids; NONE where they don't merge."""
        key = (left << 20) | right
        i = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.pair[i] == key), self.merged[i], NONE)

    def merge_rows(self, words: list[bytes], width: int) -> list[np.ndarray]:
        """The ids of words of at most ``width`` (a power of two) bytes."""
        m = len(words)
        sym = np.full((m, width + 2), -1, np.int64)  # column 0 and width + 1: no neighbour
        for i, w in enumerate(words):
            sym[i, 1:len(w) + 1] = self.byte[np.frombuffer(w, np.uint8)]
        prev = np.tile(np.arange(-1, width + 1), (m, 1))
        following = np.tile(np.arange(1, width + 3), (m, 1))
        prev[:, 0] = 0
        following[:, -2:] = width + 1
        # node 1 is the root, leaves start at width; a node holds rank << 32 | position, so the
        # smaller of two nodes is the smaller rank and, of equal ranks, the one to the left
        tree = np.full((m, 2 * width), NONE << 20, np.int64)
        pos = np.arange(width)

        def leaf(rank, position):
            return np.where(rank >= NONE, NONE << 20, (rank << 32) | position)

        tree[:, width:] = leaf(self.ranks_of(sym[:, 1:-1], sym[:, 2:]), pos)
        level = width
        while level > 1:
            tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
            level //= 2
        live = np.arange(m)

        def update(rows, columns, rank):
            """Set leaves (one per row; columns count from 1) and their paths to the root."""
            node = columns - 1 + width
            tree[rows, node] = leaf(rank, columns - 1)
            while node[0] > 1:
                node = node >> 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

        while width > 1:
            live = live[tree[live, 1] < NONE << 20]
            if not len(live):
                break
            top = tree[live, 1]
            at = (top & 0xFFFFFFFF) + 1
            right = following[live, at]
            after, before = following[live, right], prev[live, at]
            sym[live, at] = top >> 32
            sym[live, right] = -1
            following[live, at] = after
            prev[live, after] = at
            update(live, right, np.full(len(live), NONE))
            update(live, at, self.ranks_of(sym[live, at], sym[live, after]))
            has = before > 0
            if has.any():
                rows, b = live[has], before[has]
                update(rows, b, self.ranks_of(sym[rows, b], sym[rows, at[has]]))
        return [row[row >= 0] for row in sym]

    def encode_matches(self, matches: list[str]) -> None:
        """Put the ids of matches of the pattern into ``known``."""
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for s in matches:
            w = s.encode()
            if (r := self.rank.get(w)) is not None:
                self.known[s] = r.to_bytes(4, "little")
            else:
                by_width.setdefault(1 << (len(w) - 1).bit_length(), []).append((s, w))
        for width, group in by_width.items():
            step = max(1, LEAVES // width)
            for i in range(0, len(group), step):
                some = group[i:i + step]
                for (s, _), ids in zip(some, self.merge_rows([w for _, w in some], width), strict=True):
                    self.known[s] = ids.astype("<u4").tobytes()

    def encode_pieces(self, texts: list[str]) -> list[bytes]:
        found = [self.find(t) for t in texts]
        if len(self.known) > CACHE_MATCHES:
            self.known.clear()
        self.encode_matches(list({m for f in found for m in f if m not in self.known}))
        get = self.known.__getitem__
        return [b"".join([get(m) for m in f]) for f in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        return self.cache.encode(texts)

    def decode(self, ids: bytes) -> bytes:
        """The bytes that ids (as ``encode`` gives them) stand for."""
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def byte_pairs(path: str | None = None, pattern: str | None = None) -> BytePairs:
    """The tables of a vocabulary file, loaded once per Python worker."""
    import public_tokenizers

    key = (path or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN)
    if key not in _TABLES:
        _TABLES[key] = BytePairs(*key)
    return _TABLES[key]


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, decoded: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers) and, if asked for,
    ``decoded``: the bytes that the ids decode to, in the same pass."""

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_pairs(path, pattern)
        for batch in arrow:
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
            for some in batches(rows, lambda r: len(r[1])):
                ids = bpe.encode([t for _, t in some])
                cols = [pa.array([i for i, _ in some], pa.int64()), pa.array(ids, pa.binary())]
                if decoded:
                    cols.append(pa.array([bpe.decode(x) for x in ids], pa.binary()))
                yield pa.record_batch(cols, ["doc_id", "ids", "decoded"][:len(cols)])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids binary" + ", decoded binary" * decoded)


def decode(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, text of a frame with doc_id and ids."""

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_pairs(path, pattern)
        for batch in arrow:
            out = [None if x is None else bpe.decode(x).decode("utf-8", "replace") for x in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document."""
    e = encode(docs, path, decoded=True, id_col=id_col, text_col=text_col)
    return e.select("doc_id", F.expr("cast(length(ids) div 4 as long)").alias("n_tokens"),
                    F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))

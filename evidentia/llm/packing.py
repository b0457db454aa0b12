"""Packing by concatenate and cut.

Pass 1 encodes the documents in Arrow batches, ends each with the separator id 0
and writes the ids with their running offset in the partition (the
first prefix sum). The token totals of the partitions, summed up in partition
order, give each partition its global offset (the second). Pass 2 reads the
written ids once more and cuts the global token line at every multiple of
the sequence length: a document that crosses a window boundary gets one record
per window. Nothing is shuffled but the partition totals, and only the last
sequence has padding.

Defined results: a null text counts as '' (its document is the separator
alone); repeated rows are documents of their own; an empty table gives no rows.
Documents follow one another in the order of the input files.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.chunks import PieceTable, batches
from evidentia.llm.common import few, id_text, prefix_sums, stage

SEQUENCE = 1024
SEPARATOR = 0
#: Partition offsets (16 bytes each) to broadcast at most.
MOST_OFFSETS = 1_000_000
VOCABULARY = "byte_bpe_50k.json"

_ENCODERS: dict[str, PieceTable] = {}


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_of() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def ids_of(path: str):
    """A function from strings to id lists under the byte-level vocabulary file of ``tokenizers``.

    The file's vocabulary and special tokens are handed to tiktoken, which gives
    the ids ``tokenizers`` gives (tests hold one against the other) in a third of the time.
    """
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    byte = _byte_of()
    ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    bpe = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    some = re.compile("|".join(map(re.escape, special)) or r"(?!)")
    return lambda texts: [bpe.encode(t, allowed_special="all") if some.search(t) else bpe.encode_ordinary(t) for t in texts]


def id_type(path: str) -> str:
    """The numpy type of the written ids: 2 bytes where the vocabulary's ids fit, else 4."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    most = max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"]), SEPARATOR])
    return "<u2" if most < 1 << 16 else "<u4"


def _encoder(path: str) -> PieceTable:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceTable(ids_of(path), id_type(path))
    return _ENCODERS[path]


def token_line(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pass 1, written: part, first (tokens before it in the part), doc_id, ids (``id_type``), doc_tokens."""

    def encode(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first = TaskContext.get().partitionId(), 0
        table = _encoder(path)
        width = table.dtype.itemsize
        for batch in arrow:
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
            for some in batches(rows, lambda r: len(r[1])):
                ids, n = table.encode_joined([t for _, t in some], SEPARATOR)
                end = np.cumsum(n)
                at = first + end - n
                first += int(end[-1])
                places = np.concatenate(([0], end * width)).astype(np.int32)
                cells = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(places), pa.py_buffer(ids)])
                yield pa.record_batch([pa.array(np.full(len(n), part, "int64")), pa.array(at),
                                       pa.array([i for i, _ in some], pa.int64()), cells, pa.array(n)],
                                      ["part", "first", "doc_id", "ids", "doc_tokens"])

    rows = id_text(docs, id_col, text_col)
    return stage(rows.mapInArrow(encode, "part long, first long, doc_id long, ids binary, doc_tokens long"), "token-line")


def pack(docs: DataFrame, path: str | None = None, length: int = SEQUENCE, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    crosses (the document goes on in the next sequence) and, if asked for, ids (``id_type``)."""
    path = path or vocabulary_path()
    kind = id_type(path)
    width = np.dtype(kind).itemsize
    line = token_line(docs, path, id_col, text_col)
    totals = line.groupBy("part").agg(F.sum("doc_tokens").alias("n"))
    offsets = stage(prefix_sums(totals, "part", "n"), "part-offsets")  # one row per input partition
    placed = line.join(few(offsets, MOST_OFFSETS), "part")
    placed = placed.select("doc_id", (F.col("before") + F.col("first")).alias("at"), "ids", "doc_tokens")

    def cut(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow:
            out = []
            for doc, at, ids, n in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "at", "ids", "doc_tokens")), strict=True):
                wide = np.frombuffer(ids, kind).astype("<u4").tobytes()
                start = 0
                while start < n:
                    sequence, offset = divmod(at + start, length)
                    take = min(length - offset, n - start)
                    out.append((doc, start, take, zlib.crc32(wide[4 * start:4 * (start + take)]), n, sequence, offset,
                                start + take < n, ids[width * start:width * (start + take)] if with_ids else None))
                    start += take
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _TYPES, strict=True)] if out else
                                             [pa.array([], t) for t in _TYPES], _NAMES)

    pieces = placed.mapInArrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                                    "sequence_id long, offset long, crosses boolean, ids binary")
    return pieces if with_ids else pieces.drop("ids")


_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "crosses", "ids"]
_TYPES = [pa.int64()] * 7 + [pa.bool_(), pa.binary()]


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences of ``pack(..., with_ids=True)``: sequence_id, n_tokens, ids
    (``id_type``). A group holds at most one sequence's tokens."""
    whole = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"), F.sum("length").alias("n_tokens"))
    joined = F.aggregate(F.col("p.ids"), F.lit(b""), lambda a, b: F.concat(a, b))
    return whole.select("sequence_id", "n_tokens", joined.alias("ids"))

"""Substring dedup by collinear chaining of shared k-mer seeds.

Words are lower-cased (A-Z) runs without white space. Of every ``SPREAD``
consecutive k-mers of ``K`` words the one with the smallest hash is a seed
(a minimizer), so a run of K + SPREAD - 1 = 16 equal words shares a
seed wherever it stands. From each seed on, runs of ``RUNS`` words are matched with the run's
representative, its occurrence in the smallest ``doc_id`` - one row per occurrence and length
however many documents share it, so a passage of a third of all documents makes
no pairs. A short run that a smaller document holds too doesn't hide the
longer one: a repeat of 50 words holds whole runs of 39, each matched with a
document that has all 39. A run whose shorter run has the same representative is left out.
Per document and representative document the matches are
chained: a Fenwick tree of prefix maxima over the representative's positions finds
for each match the best chain to go on, an anchor counts K words and each word of
a gap, on either side, costs ``GAP``. Chains are aligned word by word (a byte of
each word's hash; of the counterpart, ``BACK`` words in front of each match and ``SEEN`` from it on): equal stretches
directly, unequal ones in a band, with an extension at both ends. A chain of less than 0.8
equal words is cut at its worst gap until each part has them; parts that lie next to
each other in both documents are joined if the whole has them too,
and passages of ``MIN_WORDS`` words or more are returned: every exact repeat of 50 words
is found. Up to 11 words at either end of a repeat are not seen where no counterpart of its inner runs has them.

Defined results: a null text has no passages; rows of one ``doc_id`` are one document
to each other (no passage between them; word positions are those of the row's own text); rows without an id are left out, for
no result could name them; repeated rows add nothing; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import id_text, stage, whole_groups

K = 5
SPREAD = 12
GAP = 0.1
SIMILAR = 0.8
MIN_WORDS = 35
#: Lengths of the runs of words that are matched from each seed on. A repeat of 50 words holds a whole run
#: of the last length: its first seed is at most SPREAD - 1 words inside.
RUNS = (K, 14, 39)
#: Words of the counterpart in front of a match and from it on that travel with it.
BACK, SEEN = 12, 48
#: Matches between two anchors are aligned in a band; words beyond what is seen count as unequal.
BAND = 8

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


def _codes(text: str) -> np.ndarray:
    words = text.encode().lower().split()
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words)) * np.uint64(_ODD)


def word_bytes(text: str) -> bytes:
    """A byte of each word's hash."""
    return (_codes(text) >> np.uint64(56)).astype(np.uint8).tobytes()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def minima(h: np.ndarray, width: int) -> np.ndarray:
    """The places of the (leftmost) smallest value of every window of ``width`` values, each place once: windows
    of twice the width come from two of the width, until two that overlap cover the window."""
    at, size = np.arange(len(h)), 1
    while size < width:
        step = min(size, width - size)
        right = h[step:] < h[:-step]
        h, at = np.where(right, h[step:], h[:-step]), np.where(right, at[step:], at[:-step])
        size += step
    return at[np.flatnonzero(np.diff(at, prepend=-1))]  # the places never go back


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the odd number and of its inverse, kept per Python worker up to the longest text it met."""
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_ODD, _INVERSE)):
            _POWERS[i] = np.cumprod(np.concatenate(([np.uint64(1)], np.full(2 * n - 1, base, np.uint64))))
    return _POWERS[0][:n], _POWERS[1][:n]


def seeds(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, word position and length of the runs from each seed on."""
    codes = _mixed(_codes(text))
    n = len(codes) - K + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)
    # sums of codes times powers of an odd number give the hash of any run; overflow is modulo 2 ** 64
    power, back = _powers(len(codes))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * power)))

    def run(at, length):
        return _mixed((sums[at + length] - sums[at]) * back[at] + np.uint64(length))

    at = minima(run(np.arange(n), K), min(SPREAD, n))
    out = []
    for length in RUNS:
        at = at[at + length <= len(codes)]
        out.append((run(at, length).view(np.int64), at.astype(np.int32), np.full(len(at), length, np.int32)))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _parts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, part (tells the texts of one id apart) and text."""
    rows = id_text(docs, id_col, text_col).filter("doc_id is not null")
    return rows.select("doc_id", F.xxhash64("text").alias("part"), "text")


def seed_table(docs: DataFrame, full: bool, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """seed, doc_id and, if ``full``, part, pos and words (the run's length)."""

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow:
            found = [seeds(t) for t in batch.column("text").to_pylist()] or [seeds("")]
            n = [len(f[0]) for f in found][:batch.num_rows]
            seed, pos, words = (np.concatenate(c) for c in zip(*found, strict=True))
            cols = [seed, np.repeat(batch.column("doc_id").to_numpy(), n)]
            if full:
                cols += [np.repeat(batch.column("part").to_numpy(), n), pos, words]
            yield pa.record_batch([pa.array(c) for c in cols], ["seed", "doc_id", "part", "pos", "words"][:len(cols)])

    return _parts(docs, id_col, text_col).mapInArrow(run, "seed long, doc_id long" + ", part long, pos int, words int" * full)


def byte_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, part and bytes (a byte of each word's hash), once for each text of an id."""

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow:
            bytes_ = pa.array([word_bytes(t) for t in batch.column("text").to_pylist()], pa.binary())
            yield pa.record_batch([batch.column("doc_id"), batch.column("part"), bytes_], ["doc_id", "part", "bytes"])

    rows = _parts(docs, id_col, text_col).mapInArrow(run, "doc_id long, part long, bytes binary")
    return rows.dropDuplicates(["doc_id", "part"])


# --- chaining ------------------------------------------------------------------


def chains(x: np.ndarray, y: np.ndarray) -> list[list[int]]:
    """Chains of matches (x ascending) as index lists, each match in one chain at most.

    With score(i) = K + max(0, score(j) - GAP * (dx + dy)) over j before i in both
    coordinates, the value of j to its successors is score(j) + GAP * (x + y), so a
    Fenwick tree of prefix maxima over the ranks of y answers each query in
    O(log n). Matches with equal x wait until all of them have asked.
    """
    n = len(x)
    if n == 1:
        return [[0]]
    rank = np.unique(y, return_inverse=True)[1] + 1
    xs, ys, ranks = x.tolist(), y.tolist(), rank.tolist()
    size = max(ranks)
    best, who = [0.0] * (size + 1), [-1] * (size + 1)
    score, before = [float(K)] * n, [-1] * n
    i = 0
    while i < n:
        end = i
        while end < n and xs[end] == xs[i]:
            j, top, at = ranks[end] - 1, 0.0, -1
            while j > 0:
                if best[j] > top:
                    top, at = best[j], who[j]
                j &= j - 1
            gain = top - GAP * (xs[end] + ys[end])
            if at >= 0 and gain > 0:
                score[end], before[end] = K + gain, at
            end += 1
        for k in range(i, end):
            value, j = score[k] + GAP * (xs[k] + ys[k]), ranks[k]
            while j <= size:
                if value > best[j]:
                    best[j], who[j] = value, k
                j += j & -j
        i = end
    used, out = [False] * n, []
    for end in sorted(range(n), key=lambda k: (-score[k], k)):
        path, k = [], end
        while k >= 0 and not used[k]:
            used[k] = True
            path.append(k)
            k = before[k]
        if path:
            out.append(path[::-1])
    return out


def equal_words(a: bytes, b: bytes, la: int, lb: int) -> int:
    """Equal words in the best alignment of the next ``la`` and ``lb`` words, of which a and b hold the first ones."""
    a, b = a[:la], b[:lb]
    if la == lb and a == b:
        return len(a)
    row, band = [0] * (len(b) + 1), BAND + abs(len(a) - len(b))
    for i, c in enumerate(a, 1):
        first = max(1, i - band)
        if first > len(b):
            break
        diagonal = row[first - 1]
        for j in range(first, min(len(b), i + band) + 1):
            old = row[j]
            row[j] = max(old, row[j - 1], diagonal + (c == b[j - 1]))
            diagonal = old
    return max(row)


def _reach(a: bytes, b: bytes) -> int:
    """How far two strings go on while most of the words still agree."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    good = best = length = 0
    for n, (c, d) in enumerate(zip(a, b, strict=False), 1):
        good += 1 if c == d else -3
        if good > best:
            best, length = good, n
    return length


def _same(a: bytes, b: bytes) -> int:
    """Words that agree place by place."""
    return len(a) if a == b else sum(map(eq, a, b))


def align(path: list[int], x: list[int], y: list[int], words: list[int], mine: bytes, theirs: list[bytes]) -> list[tuple[int, int, int, int, int]]:
    """(first word, end, first word there, end there, equal words) of each part of a chain.

    A part with less than ``SIMILAR`` equal words is cut at the gap with the most unequal
    words, and both sides are tested again; equal stretches have no such gap, so they stay whole.
    """
    size, equal = [], []
    before = [min(BACK, y[i]) for i in path]
    for n, (i, j) in enumerate(zip(path, path[1:], strict=False)):
        dx, dy = x[j] - x[i], y[j] - y[i]
        seen = theirs[i][before[n]:]
        if dy > len(seen):  # the last words of the gap stand in front of the next match
            back = theirs[j][:before[n + 1]][-(dy - len(seen)):]
            tail = _same(mine[x[j] - min(len(back), dx):x[j]], back[max(len(back) - dx, 0):]) if back else 0
            rest = max(dx - len(back), 0)
        else:
            tail, rest = 0, dx
        same = equal_words(mine[x[i]:x[i] + min(rest, len(seen) + BAND)], seen, rest, dy) + tail
        size.append(max(dx, dy))
        equal.append(min(max(min(words[i], dx, dy), same), dx, dy))
    total = [0, *accumulate(equal)]
    unequal = [n - same for n, same in zip(size, equal, strict=True)]
    out, open_ = [], [(0, len(path) - 1)]
    while open_:
        s, e = open_.pop()
        first, last = path[s], path[e]
        f, g = x[first], before[s]
        front = _reach(mine[max(f - BACK, 0):f][::-1], theirs[first][:g][::-1])
        a, b = mine[x[last]:x[last] + SEEN], theirs[last][before[e]:]
        length = max(_reach(a, b), min(words[last], len(a), len(b)))
        same = total[e] - total[s] + _same(a[:length], b[:length])
        if front:
            same += _same(mine[f - front:f], theirs[first][g - front:g])
        part = f - front, x[last] + length, y[first] - front, y[last] + length, same
        if s == e or same >= SIMILAR * max(part[1] - part[0], part[3] - part[2]):
            out.append(part)
        else:
            worst = max(range(s, e), key=unequal.__getitem__)
            open_ += [(worst + 1, e), (s, worst)]
    return out


def joined(spans: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Spans with one counterpart (start, end, start there, end there, equal words): neighbours in
    both documents are joined where ``SIMILAR`` of the joined words are equal."""
    out: list[tuple[int, int, int, int, int]] = []
    for a, b, c, d, same in sorted(spans):
        if out:
            pa, pb, pc, pd, psame = out[-1]
            if b <= pb and c >= pc and d <= pd:
                continue
            if a <= pb + SPREAD and pc <= c <= pd + SPREAD and b >= pb and d >= pd:
                equal = psame + max(0, same - max(0, pb - a, pd - c))
                if equal >= SIMILAR * max(b - pa, d - pc):
                    out[-1] = (pa, b, pc, d, equal)
                    continue
        out.append((a, b, c, d, same))
    return out


def passages_of(x, other, y, words, mine, theirs) -> list[tuple]:
    """Passages of one document: (start, end, equal words, rep_id, rep_start, rep_end, all reps);
    matches sorted by the other document, then x. Each of ``MIN_WORDS`` words or more has its equal words in
    one counterpart; those of several counterparts are joined only where they overlap."""
    spans = []
    cut = np.flatnonzero(np.diff(other)) + 1
    for s, e in zip(np.concatenate(([0], cut)).tolist(), np.concatenate((cut, [len(x)])).tolist(), strict=True):
        parts, mx, my, mw, seen = [], x[s:e].tolist(), y[s:e].tolist(), words[s:e].tolist(), theirs[s:e]
        for path in chains(x[s:e], y[s:e]):
            parts += [p for p in align(path, mx, my, mw, mine, seen) if p[4] >= SIMILAR * max(p[1] - p[0], p[3] - p[2])]
        spans += [(a, b, same, int(other[s]), c, d) for a, b, c, d, same in joined(parts) if b - a >= MIN_WORDS]
    spans.sort()
    out: list[list] = []
    for a, b, same, rep, c, d in spans:
        if out and a < out[-1][1]:
            p = out[-1]
            equal = p[2] + max(0, same - (p[1] - a)) if b > p[1] else p[2]
            if equal >= SIMILAR * (max(b, p[1]) - p[0]):
                p[6].add(rep)
                p[1], p[2] = max(p[1], b), equal
                if same > p[7]:
                    p[3], p[4], p[5], p[7] = rep, c, d, same
                continue
        out.append([a, b, same, rep, c, d, {rep}, same])
    return [(*p[:6], sorted(p[6])) for p in out]


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per passage that an earlier document holds too: doc_id, start_word, end_word (exclusive), n_equal,
    rep_id, rep_start, rep_end (the longest counterpart) and rep_ids (all documents it was matched with)."""
    thin = seed_table(docs, False, id_col, text_col)
    shared = thin.groupBy("seed").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    shared = stage(shared.filter("least < most").select("seed"), "seeds")
    # both sides of each join are read from files and shuffled, so Spark can split a hot seed
    held = stage(seed_table(docs, True, id_col, text_col).join(shared, "seed"), "seed-matches")
    texts = stage(byte_table(docs, id_col, text_col), "word-bytes")
    first = F.min(F.struct(F.col("doc_id").alias("rep"), F.col("pos").alias("rep_pos"), F.col("part").alias("rep_part"), "words"))
    reps = stage(held.groupBy("seed").agg(first.alias("r")).select("seed", "r.*"), "seed-reps")
    # a run whose shorter run has the same representative adds nothing
    place = ["rep", "rep_part", "rep_pos"]
    reps = reps.join(reps.groupBy(*place).agg(F.min("words").alias("words")), [*place, "words"])
    of_rep = texts.select(F.col("doc_id").alias("rep"), F.col("part").alias("rep_part"), "bytes")
    front = F.least(F.col("rep_pos"), F.lit(BACK))
    around = F.substring("bytes", F.col("rep_pos") - front + 1, front + SEEN)
    reps = stage(reps.join(of_rep, ["rep", "rep_part"]).select("seed", "rep", "rep_pos", around.alias("seen")), "seed-words")
    pairs = held.join(reps, "seed").filter("doc_id <> rep").select("doc_id", "part", "pos", "words", "rep", "rep_pos", "seen")
    # the document's own words come first in its group, as a row of no words
    own = texts.select("doc_id", "part", F.lit(-1).alias("pos"), F.lit(0).alias("words"), F.col("doc_id").alias("rep"),
                       F.lit(0).alias("rep_pos"), F.col("bytes").alias("seen"))

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, part, pos, words, rep, there, seen in whole_groups(arrow, "doc_id", "part", "pos", "words", "rep", "rep_pos", "seen"):
            cut = np.flatnonzero(words == 0)
            out = []
            for s, e in zip(cut.tolist(), [*cut[1:].tolist(), len(ids)], strict=True):
                if e - s > 1:
                    m = slice(s + 1, e)
                    out += [(int(ids[s]), *p) for p in passages_of(pos[m], rep[m], there[m], words[m], seen[s], seen[m])]
            yield pa.RecordBatch.from_pylist([dict(zip(_NAMES, r, strict=True)) for r in out], schema=_SCHEMA)

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own_first = F.when(F.col("words") == 0, 0).otherwise(1)
    return (pairs.unionByName(own).repartition(n, "doc_id").withColumn("own", own_first)
                 .sortWithinPartitions("doc_id", "part", "own", "rep", "pos", "rep_pos").drop("own")
                 .mapInArrow(run, "doc_id long, start_word long, end_word long, n_equal long, rep_id long, "
                                  "rep_start long, rep_end long, rep_ids array<long>"))


_NAMES = ["doc_id", "start_word", "end_word", "n_equal", "rep_id", "rep_start", "rep_end", "rep_ids"]
_SCHEMA = pa.schema([(c, pa.int64()) for c in _NAMES[:-1]] + [("rep_ids", pa.list_(pa.int64()))])

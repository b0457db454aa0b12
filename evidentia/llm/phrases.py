"""Phrase collocations by dynamic itemset counting.

The corpus is written once as blocks of word codes (a block's own dictionary, and a break between
pieces), dealt over ``SHARDS`` shards. The shards are scanned in a cycle, one a stop, and phrases of
all lengths are counted side by side: words from the first stop on; a longer phrase becomes
active at the stop after both its subphrases (without its last, without its first word) have reached the
threshold in the counts so far, is counted at each stop until it has seen every shard once, and is
then complete: its count is exact. A phrase that completes its cycle below the threshold is dropped;
the scans end when no reached phrase can make another one active.

A scan finds the occurrences to count from a table of the reached phrases' stops, one byte a slot,
2 ** ``TABLE_BITS`` slots at every input size, broadcast in compressed pages. Phrases that share a slot can only make a scan
count too much: the numbers of a stop are summed with the state, the subphrases of each phrase that is new
there are joined with the reached phrases, which gives the exact stop from which it is active, and what isn't
active goes. A phrase of the state takes what is counted until its cycle ends. Occurrences are
counted inside a block by their words (never by a hash alone), so that only distinct phrases leave
a scan. The state (open and reached phrases) is a written table after each stop; the one before is then removed.

Score of a candidate (2 to ``LONGEST`` words, f >= ``THRESHOLD``): the least floor(1000 a n / (l r)) over its cuts, in
decimals of 38 digits, exact up to 1000 n n < 10 ** 38.

Defined results: a null text has no words; a null language counts as 'und'; words end at space and tab,
pieces at ``.,;:!?`` and line breaks, and no phrase spans two pieces or texts; long texts are read whole; repeated
rows count each; ties follow the phrase's UTF-8 bytes; an empty table gives no rows; other columns, whatever their
names, never reach the operator.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidentia.llm.common import remove, scratch, shared_path, stage

THRESHOLD = 100
LONGEST = 5
TOP = 2000
SHARDS = 3
#: Words of a block, about; a text is not cut.
BLOCK = 2**20
TABLE_BITS, PAGE_BITS = 24, 16
#: Reached phrases to broadcast at most in a join, if their bytes are few too.
MOST_REACHED, MOST_BYTES = 300_000, 2**25

_ENDS = b".,;:!?\n\x0b\x0c\r"
_MAP = bytes.maketrans(_ENDS + b"\t", b"\n" * len(_ENDS) + b" ")
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class _Codes(dict):
    """Words to codes from 1 on; nothing between two spaces is -1, a piece's end 0."""

    def __init__(self):
        super().__init__({b"": -1, b"\n": 0})

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self) - 1
        return code


def text_codes(text: str, codes: _Codes) -> np.ndarray:
    """The codes of a text's words, with a 0 at each end of a piece."""
    tokens = text.encode("utf-8", "surrogatepass").lower().translate(_MAP).replace(b"\n", b" \n ").split(b" ")
    c = np.fromiter(map(codes.__getitem__, tokens), np.int32, len(tokens))
    return np.append(c[c >= 0], np.int32(0))


def _blocks(docs: DataFrame, shards: int, lang_col: str, text_col: str, block: int) -> DataFrame:
    """Written, partitioned by shard: lang, words (the block's dictionary, joined by spaces), codes (4 bytes each), size (words)."""

    def cut(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[_Codes, list]] = {}
        n, turn = 0, TaskContext.get().partitionId()

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, (codes, parts) in held.items():
                c = np.concatenate(parts)
                if c.any():
                    words = b" ".join(list(codes)[2:]).decode("utf-8", "replace")
                    yield pa.record_batch([pa.array([turn % shards], pa.int32()), pa.array([lang]), pa.array([words], pa.string()),
                                           pa.array([c.astype("<i4").tobytes()], pa.binary()), pa.array([int((c > 0).sum())])],
                                          ["shard", "lang", "words", "codes", "size"])

        for batch in arrow:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                codes, parts = held.setdefault(lang, (_Codes(), []))
                parts.append(text_codes(text, codes))
                n += len(parts[-1])
                if n >= block:
                    yield from flush()
                    held, n, turn = {}, 0, turn + 1
        yield from flush()

    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    cut_rows = rows.mapInArrow(cut, "shard int, lang string, words string, codes binary, size long")
    path = shared_path(docs.sparkSession, "phrase-blocks")
    cut_rows.write.partitionBy("shard").option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(cut_rows.schema).parquet(path)


# --- hashes of phrases, for the table of reached ones ---------------------------


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _B
    return h ^ (h >> np.uint64(29))


def _word_hashes(words: pa.StringArray, long: int = 64, piece: int = 2**15) -> np.ndarray:
    """Of words: polynomials of their bytes, ``piece`` words at once; XXH64 of those over ``long`` bytes."""
    out = np.empty(len(words), np.uint64)
    power = np.cumprod(np.full(long, _A))
    for begin in range(0, len(words), piece):
        some = words[begin:begin + piece]
        size = pc.binary_length(some).to_numpy(zero_copy_only=False).astype(np.int64)
        over, h = size > long, np.empty(len(some), np.uint64)
        for i in np.flatnonzero(over).tolist():
            h[i] = xxhash.xxh64_intdigest(some[i].as_buffer())
        if over.any():
            some, size = some.filter(pa.array(~over)), size[~over]
        ends = np.cumsum(size)
        if total := int(size.sum()):
            first = np.frombuffer(some.buffers()[1], np.int32)[some.offset]
            data = np.frombuffer(some.buffers()[2], np.uint8)[first:first + total]
            terms = (data + np.uint64(1)) * power[np.arange(total) - np.repeat(ends - size, size)]
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms)))
            h[~over] = _mixed(sums[ends] - sums[ends - size])
        else:
            h[~over] = 0
        out[begin:begin + piece] = h
    return out


def _first(words: np.ndarray, lang: str) -> np.ndarray:
    """Hashes of one-word phrases of a language from the hashes of their words."""
    return _mixed(words + np.uint64(xxhash.xxh64_intdigest(lang.encode())))


def _longer(phrases: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one more word behind."""
    return _mixed(phrases * _A + words)


def _slots(h: np.ndarray, size: int) -> np.ndarray:
    """Places in a table of ``size`` (a power of two) slots."""
    return (h & np.uint64(size - 1)).astype(np.int64)


def _table(reached: DataFrame, bits: int) -> tuple[int, int, list[tuple[int, bytes]]]:
    """A byte a slot: the latest stop, plus 1, at which a phrase of that slot reached the threshold; 0: none.
    As (bits, bits of a page, the pages that are not empty, compressed): ``_opened`` makes the array of it."""
    low = min(PAGE_BITS, bits)

    def slots(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow:
            parts = pc.split_pattern(batch.column("phrase").cast(pa.string()), " ")
            words, size = _word_hashes(parts.flatten()), pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
            begin, langs = np.cumsum(size) - size, batch.column("lang").dictionary_encode()
            h = np.zeros(batch.num_rows, np.uint64)
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                own = langs.indices.to_numpy() == i
                h[own] = _first(words[begin[own]], lang)
            for k in range(1, int(size.max(initial=0))):
                own = np.flatnonzero(size > k)
                h[own] = _longer(h[own], words[begin[own] + k])
            at = _slots(h, 1 << bits)
            yield pa.record_batch([pa.array(at.astype(np.int32)), pc.cast(pc.add(batch.column("reach"), 1), pa.int32())], ["slot", "value"])

    def page(key: tuple, group: pa.Table) -> pa.Table:
        cells = np.zeros(1 << low, np.uint8)
        cells[group.column("slot").to_numpy() & ((1 << low) - 1)] = group.column("value").to_numpy()
        return pa.table({"page": pa.array([key[0].as_py()], pa.int32()), "cells": pa.array([zlib.compress(cells.tobytes(), 1)], pa.binary())})

    rows = reached.select("lang", "phrase", "reach").mapInArrow(slots, "slot int, value int")
    rows = rows.groupBy("slot").agg(F.max("value").alias("value"))  # a page has 2 ** PAGE_BITS rows at most
    pages = rows.groupBy(F.shiftright("slot", low).alias("page")).applyInArrow(page, "page int, cells binary").collect()
    return bits, low, [(number, bytes(cells)) for number, cells in pages]


def _opened(packed: tuple[int, int, list[tuple[int, bytes]]] | None) -> np.ndarray | None:
    if packed is None:
        return None
    bits, low, pages = packed
    table = np.zeros((1 << (bits - low), 1 << low), np.uint8)
    for number, cells in pages:
        table[number] = np.frombuffer(zlib.decompress(cells), np.uint8)
    return table.ravel()


# --- scans ------------------------------------------------------------------------


def _distinct(c: np.ndarray, at: np.ndarray, length: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(the codes of each distinct phrase of ``length`` codes that begins at ``at``, an array a place; its number)."""
    heads, rank = [], c[at].astype(np.int64)
    for k in range(1, length):
        keys = rank << 32 | c[at + k]
        if k < length - 1:
            found, rank = np.unique(keys, return_inverse=True)
        else:
            found, n = np.unique(keys, return_counts=True)
        head, code = found >> 32, found & 0xFFFFFFFF
        heads = [*(h[head] for h in heads), code] if heads else [head, code]
    return heads, n


def block_counts(lang: str, words: pa.StringArray, c: np.ndarray, table: np.ndarray | None, stop: int, shards: int,
                 longest: int = LONGEST) -> Iterator[tuple[pa.Array, int, np.ndarray]]:
    """(phrases, their length, their numbers) of a block at a stop: its words in the first cycle, and its phrases
    whose subphrases have reached the threshold and that have not seen all shards."""
    if stop < shards:
        n = np.bincount(c, minlength=len(words) + 1)[1:]
        some = np.flatnonzero(n)
        yield words.take(pa.array(some)), 1, n[some]
    if table is None:
        return
    by_word = np.concatenate((np.zeros(1, np.uint64), _word_hashes(words)))
    word_slot = table[_slots(_first(by_word, lang), len(table))]
    word_slot[0] = 0  # a break
    reach, h = word_slot[c], _first(by_word, lang)[c]
    for length in range(2, longest + 1):
        at = np.flatnonzero((reach[:-1] > 0) & (reach[1:] > 0))
        if not len(at):
            return
        start = np.maximum(reach[at], reach[at + 1]).astype(np.int64)
        active = at[stop < start + shards]
        if len(active):
            codes, n = _distinct(c, active, length)
            parts = [words.take(pa.array(k - 1)) for k in codes]
            yield pc.binary_join_element_wise(*parts, " "), length, n
        if length < longest:
            h_at = _longer(h[at], by_word[c[at + length - 1]])
            reach, h = np.zeros(len(c) - length + 1, np.uint8), h[:len(c) - length + 1].copy()
            reach[at], h[at] = table[_slots(h_at, len(table))], h_at


def _scan(blocks: DataFrame, shared: Broadcast, stop: int, shards: int, longest: int) -> DataFrame:
    """lang, phrase, n (words), c: what a stop counts in each block of its shard, too much where slots are shared."""

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _opened(shared.value)
        for batch in arrow:
            for i in range(batch.num_rows):
                lang, words = batch.column("lang")[i].as_py(), pc.split_pattern(batch.column("words")[i:i + 1].cast(pa.string()), " ").flatten()
                c = np.frombuffer(batch.column("codes")[i].as_py(), "<i4")
                for phrases, length, n in block_counts(lang, words, c, table, stop, shards, longest):
                    yield pa.record_batch([pa.repeat(pa.scalar(lang, pa.string()), len(n)), phrases.cast(pa.string()),
                                           pa.array(np.full(len(n), length, np.int32)), pa.array(n.astype(np.int64))], ["lang", "phrase", "n", "c"])

    return blocks.filter(F.col("shard") == stop % shards).select("lang", "words", "codes").mapInArrow(run, "lang string, phrase string, n int, c long")


def _head(phrase: str = "phrase", n=None):
    """A phrase without its last word."""
    return F.expr(f"substring_index({phrase}, ' ', n - 1)") if n is None else F.expr(f"substring_index({phrase}, ' ', {n})")


def _tail(phrase: str = "phrase"):
    """A phrase without its first word."""
    return F.expr(f"substring({phrase}, locate(' ', {phrase}) + 1)")


def _are_few(df: DataFrame) -> bool:
    """Whether the rows of ``df`` (written) and the bytes of its phrases are few enough for a broadcast."""
    rows, size = df.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("phrase") + F.octet_length("lang")), F.lit(0))).first()
    return rows <= MOST_REACHED and size <= MOST_BYTES


def _small(df: DataFrame) -> DataFrame:
    """``df`` (written) marked for a broadcast if it is small; the same rows either way."""
    return F.broadcast(df) if _are_few(df) else df


def _added(state: DataFrame, counted: DataFrame, reached: DataFrame | None, stop: int, shards: int) -> DataFrame:
    """``state`` with what was rightly counted at this stop. Numbers are summed first; a phrase of the state takes
    the sum until it has seen all shards, and only the others are joined with ``reached`` (null: only words
    were counted): they are new words, or phrases whose exact first stop, the one after both subphrases reached the
    threshold, is less than a cycle ago."""
    every = state.withColumn("more", F.lit(0).cast("long")).unionByName(counted.select(
        "lang", "phrase", "n", F.lit(0).cast("long").alias("c"), F.col("c").alias("more"), F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("reach")))
    rows = every.groupBy("lang", "phrase", "n").agg(*[F.sum(x).alias(x) for x in ("c", "more")], *[F.min(x).alias(x) for x in ("start", "reach")])
    start = F.when(F.col("n") == 1, F.lit(0))
    if reached is not None:
        broadcast = _are_few(reached)
        known = F.broadcast(reached) if broadcast else reached
        # rows that need no look-up: a broadcast join skips null keys, a shuffle would bring them to one task
        looked, own = F.col("start").isNull() & (F.col("n") > 1), F.lit(None).cast("string") if broadcast else F.col("phrase")
        rows = rows.withColumn("h", F.when(looked, _head()).otherwise(own)).withColumn("t", F.when(looked, _tail()).otherwise(own))
        for key, name in (("h", "reach_h"), ("t", "reach_t")):
            part = known.select(F.col("lang").alias("lang_p"), F.col("phrase").alias("part"), F.col("reach").alias(name))
            rows = rows.join(part, (F.col("lang") == F.col("lang_p")) & (F.col(key) == F.col("part")), "left").drop("lang_p", "part")
        both = F.col("reach_h").isNotNull() & F.col("reach_t").isNotNull()
        start = start.when(both, F.greatest("reach_h", "reach_t") + 1)
    first = F.coalesce("start", start)
    c = F.when(first + shards > stop, F.col("c") + F.col("more")).otherwise(F.col("c"))
    new = F.col("start").isNull()
    return rows.select("lang", "phrase", "n", c.alias("c"), first.alias("start"), "reach", new.alias("new")).filter(
        F.col("start").isNotNull() & (~F.col("new") | (F.col("start") + shards > stop))).drop("new")


def phrase_counts(blocks: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, shards: int = SHARDS,
                  table_bits: int = TABLE_BITS) -> DataFrame:
    """lang, phrase, n, c: every phrase of 1 to ``longest`` words that occurs ``threshold`` times or more, with its exact count."""
    spark = blocks.sparkSession
    schema = "lang string, phrase string, n int, c long, start int, reach int"
    state, table, stop, last = spark.createDataFrame([], schema), None, 0, shards - 1
    reached, before, deepest = None, [], 1
    while stop <= last:
        with scratch() as made:
            shared = spark.sparkContext.broadcast(table)
            counted = _scan(blocks, shared, stop, shards, deepest)
            sums = _added(state, counted, None if table is None else reached, stop, shards)
            sums = sums.withColumn("reach", F.coalesce("reach", F.when(F.col("c") >= threshold, F.lit(stop))))
            # a phrase that has seen all shards below the threshold is dropped
            state = stage(sums.filter(F.col("reach").isNotNull() | (F.col("start") + shards - 1 > stop)), f"phrase-state-{stop}", "zstd")
            reached = stage(state.filter("reach is not null"), f"phrase-reached-{stop}", "zstd")  # read several times, few beside the open ones
        shared.destroy()  # its copies on the executors too; what it served to count is written
        remove(spark, before)  # the state of the stop before
        before = made
        # at the next stop a phrase can only be active if a subphrase reached the threshold in the cycle before
        recent = F.when(F.col("reach") > stop - shards, F.col("n") + 1)
        latest, deepest = reached.filter(F.col("n") < longest).agg(F.max("reach"), F.coalesce(F.max(recent), F.lit(1))).first()
        if latest is not None:
            last = max(last, latest + shards)
            if latest == stop or table is None:
                table = _table(reached.filter(F.col("n") < longest), table_bits)
        stop += 1
    return reached.select("lang", "phrase", "n", "c")


def scored(counts: DataFrame, totals: DataFrame, top: int = TOP) -> DataFrame:
    """The best candidates of each language: lang, rank, phrase, a, l, r, n, score. ``counts``: what ``phrase_counts``
    returns; ``totals``: lang and its number of words."""
    known = _small(counts)
    part = known.select(F.col("lang").alias("lang_p"), F.col("phrase").alias("part"), F.col("c").alias("f"))
    cuts = counts.filter("n > 1").select("lang", "phrase", "n", F.col("c").alias("a"), F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
    cuts = cuts.withColumn("front", _head(n="k")).withColumn("rest", F.expr("substring(phrase, length(front) + 2)"))
    for side, name in (("front", "l"), ("rest", "r")):
        cuts = cuts.join(part, (F.col("lang") == F.col("lang_p")) & (F.col(side) == F.col("part"))).withColumn(name, F.col("f")).drop("lang_p", "part", "f")
    cuts = cuts.join(F.broadcast(totals.withColumnRenamed("n", "total")), "lang") if totals.count() <= MOST_REACHED else cuts.join(totals.withColumnRenamed("n", "total"), "lang")
    wide = "CAST({} AS DECIMAL(38, 0))"
    score = F.expr(f"CAST(({wide.format('1000')} * {wide.format('a')} * {wide.format('total')}) div ({wide.format('l')} * {wide.format('r')}) AS BIGINT)")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "n", "a", "total").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    # f never grows with a phrase, so a longer candidate of the same f has one of just one more word inside
    longer = counts.filter("n > 2")
    longer = longer.select("lang", F.explode(F.array(_head(), _tail())).alias("phrase"), "c").groupBy("lang", "phrase").agg(F.max("c").alias("within"))
    kept = best.join(longer, ["lang", "phrase"], "left").filter("within IS NULL OR within < a")
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "best.l", "best.r", F.col("total").alias("n"), "best.score")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, top: int = TOP, shards: int = SHARDS,
                 block: int = BLOCK, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score."""
    blocks = _blocks(docs, shards, lang_col, text_col, block)
    totals = stage(blocks.groupBy("lang").agg(F.sum("size").alias("n")), "phrase-totals")
    return scored(phrase_counts(blocks, threshold, longest, shards), totals, top)


ORACLE = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces),
g AS (
    SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
    FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM w, range(1, {LONGEST + 1}) AS s(size) WHERE len(w) >= size)
), totals AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
f AS (SELECT lang, phrase, size, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= {THRESHOLD}),
cuts AS (
    SELECT lang, phrase, size, f AS a, k, array_to_string(str_split(phrase, ' ')[:k], ' ') AS front, array_to_string(str_split(phrase, ' ')[k + 1:], ' ') AS rest
    FROM (SELECT *, unnest(range(1, size)) AS k FROM f WHERE size > 1)
), scores AS (
    SELECT c.lang, c.phrase, c.size, c.a, k, x.f AS l, y.f AS r, t.n, (1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f) AS score
    FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.front JOIN f y ON y.lang = c.lang AND y.phrase = c.rest JOIN totals t ON t.lang = c.lang
), best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
    SELECT lang, array_to_string(str_split(phrase, ' ')[i:i + part - 1], ' ') AS phrase, max(f) AS f
    FROM (SELECT *, unnest(range(1, size - part + 2)) AS i FROM f, range(2, {LONGEST}) AS p(part) WHERE part < size) GROUP BY ALL
), kept AS (SELECT b.* FROM best b LEFT JOIN inside i USING (lang, phrase) WHERE i.f IS NULL OR 100 * i.f < 100 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept QUALIFY rank <= {TOP}
"""

"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (lengths 3 to 6 of the lower-cased word between
boundary marks, hashed into 2 ** 17 rows); its vector is the mean of their embeddings, so a
misspelling that no label has seen shares most of its vector with the words it
comes from. A bag of words is the mean of its words' vectors, and a linear softmax over it gives
the two labels' probabilities. Embeddings and softmax are trained jointly in numpy, in one
task, by mini-batch gradient steps (Adagrad) on a bounded sample of the labelled rows
(``max_rows``, those with the smallest hash). A long text is read whole, in bags of ``BAG``
words, and scored by its most toxic bag, so that a few words are not diluted by the rest of the
text. A fifth of the sample is held out, and Platt's scaling on it turns scores into probabilities.
Documents are scored in Arrow batches: once trained, a word's vector is only needed
as its product with the softmax, one number, which each Python worker keeps.

Rows whose crc32(doc_id) mod 4 is ``HELD_OUT`` train nothing; only texts are scored, no other column.

Defined results: a text without words (null, empty) scores like a bag whose mean is nought; without
labelled rows of both labels every score is the share of label 1 (0 if there are none); labels other than 0
and 1, and rows whose document has no text, train nothing; of repeated labels of one document the
largest counts; repeated rows come back each; an empty table gives no rows; a null ``doc_id`` is
not held out and has no label; other columns, whatever their names, never reach the operator.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import id_text
from evidentia.llm.quality import platt

THRESHOLD = 0.3
MAX_ROWS = 4000
HELD_OUT = 2  # of crc32(doc_id) mod 4
BITS = 17
DIM = 8
SHORTEST, LONGEST = 3, 6
BAG = 1024
#: A bag of fewer words counts as one of so many.
LEAST = 32
#: The mean of a bag is taken times this before the softmax.
SCALE = 64.0
STEPS = 320
BATCH = 64
RATE, SOFTMAX_RATE = 0.5, 0.1
#: Word scores kept per Python worker; when full, the cache starts anew.
CACHE_WORDS = 500_000

EDGES = ".,;:!?\"'()[]{}<>|#*$%&"


class Model(NamedTuple):
    embeddings: np.ndarray  # 2 ** BITS x DIM
    softmax: np.ndarray  # DIM x 2
    slope: float  # Platt: probability = sigmoid(slope * score + offset)
    offset: float

    def word_weights(self) -> np.ndarray:
        """What an n-gram adds to the score of a word: embedding times softmax, one number a row."""
        return (SCALE * self.embeddings @ (self.softmax[:, 1] - self.softmax[:, 0])).astype(np.float32)


def words_of(text: str) -> list[str]:
    """The lower-cased words; the punctuation at their edges goes."""
    return [x for x in (w.strip(EDGES) for w in text.lower().split()) if x]


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(rows of all words' n-grams, one word after the other; where each word begins). Each word has some: '<a>'."""
    chars = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    size = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    word = np.repeat(np.arange(len(words)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(chars))  # characters from here to the word's end
    mix, step = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x100000001B3)
    h = np.zeros(len(chars) + 1, np.uint64)
    rows, owners = [], []
    for n in range(1, min(LONGEST, len(chars)) + 1):
        h = h[:-1] * step + chars[n - 1:]
        if n >= SHORTEST:
            whole = left[:len(h)] >= n
            rows.append(((h[whole] ^ np.uint64(n)) * mix >> np.uint64(64 - BITS)).astype(np.int32))
            owners.append(word[:len(h)][whole])
    if not rows:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    rows, owners = np.concatenate(rows), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return rows[order], np.searchsorted(owners[order], np.arange(len(words)))


def bag_scores(scores: np.ndarray) -> np.ndarray:
    """Means of bags of ``BAG`` word scores in turn; a short bag counts as ``LEAST`` words."""
    at = np.arange(0, len(scores), BAG)
    return np.add.reduceat(scores, at) / np.maximum(np.diff(np.append(at, len(scores))), LEAST)


def text_score(scores: np.ndarray) -> float:
    return float(bag_scores(scores).max()) if len(scores) else 0.0


def probability(s, model: Model):
    return 1 / (1 + np.exp(-np.clip(model.slope * s + model.offset, -500, 500)))


# --- training -----------------------------------------------------------------


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """At most ``max_rows`` labelled documents (text, toxic) that are not held out, those with the smallest hash, in one partition."""
    marks = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
                   .filter(F.col("toxic").isin(0, 1) & ~held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = id_text(docs, id_col, text_col, empty=False).filter("text is not null").join(F.broadcast(marks), "doc_id")
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(max_rows).select("text", "toxic")


def held_out(id_col: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def fit(texts: list[str], toxic: np.ndarray, steps: int = STEPS, seed: int = 0) -> Model:
    """Embeddings and softmax by mini-batch steps on four fifths of the rows, Platt's scaling on the others."""
    table = np.zeros((1 << BITS, DIM), np.float32)
    rng = np.random.default_rng(seed)
    softmax = rng.uniform(-0.5, 0.5, (DIM, 2)).astype(np.float32)
    if not len(texts) or toxic.min() == toxic.max():
        return Model(table, softmax, 0.0, 500.0 if len(texts) and toxic[0] else -500.0)
    known: dict[str, int] = {}
    docs = [np.array([known.setdefault(w, len(known)) for w in words_of(t)], np.int32) for t in texts]
    seen = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=len(known))
    rare = seen < max(2, len(docs) // 500)  # words of a few documents teach nothing of others; they count in a bag's length
    place = np.where(rare, -1, np.cumsum(~rare) - 1).astype(np.int32)
    words = [w for w, r in zip(known, rare, strict=True) if not r]
    docs = [place[d] for d in docs]
    rows, starts = subwords(words)
    sizes = np.diff(np.append(starts, len(rows)))

    def vectors(which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words' mean embeddings, the rows they come from, and how many each has."""
        n = sizes[which]
        first = np.cumsum(n) - n
        at = rows[np.repeat(starts[which] - first, n) + np.arange(n.sum())]
        return np.add.reduceat(table[at], first, axis=0) / n[:, None], at, n

    held = np.arange(len(docs)) % 5 == 4
    train = [i for i in np.flatnonzero(~held) if (docs[i] >= 0).any()]
    y = toxic.astype(np.float32)
    share = float(y[train].mean()) if train else 0.5
    balance = np.where(y > 0, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9))
    bias, g_bias = np.zeros(2, np.float32), np.full(2, 1e-6, np.float32)
    g_table, g_softmax = np.full(len(table), 1e-6, np.float32), np.full(softmax.shape, 1e-6, np.float32)
    deck: list[int] = []
    for _ in range(steps if train else 0):
        if len(deck) < BATCH:
            deck += rng.permutation(train).tolist()
        ids, deck = deck[:BATCH], deck[BATCH:]
        used, inverse = np.unique(np.concatenate([docs[i] for i in ids]), return_inverse=True)
        lost = int(used[0] == -1)
        v, at, n = vectors(used[lost:])
        v = np.concatenate([np.zeros((lost, DIM), v.dtype), v])
        scores = (v @ (softmax[:, 1] - softmax[:, 0]))[inverse]
        bag, weight, owner, first = [], [], [], 0
        for j, i in enumerate(ids):  # each text's most toxic bag, by the present scores
            k = int(bag_scores(scores[first:first + len(docs[i])]).argmax()) * BAG
            part = inverse[first + k:min(first + k + BAG, first + len(docs[i]))]
            first += len(docs[i])
            bag.append(part)
            owner.append(np.full(len(part), j))
            weight.append(np.full(len(part), SCALE / max(len(part), LEAST), np.float32))
        bag, owner, weight = np.concatenate(bag), np.concatenate(owner), np.concatenate(weight)
        mean = np.stack([np.bincount(owner, weights=v[bag, d] * weight, minlength=len(ids)) for d in range(DIM)], 1)
        z = mean @ softmax + bias
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(ids)), y[ids].astype(int)] -= 1
        p *= balance[ids, None] / len(ids)
        back = (p @ softmax.T)[owner] * weight[:, None]
        to_word = np.stack([np.bincount(bag, weights=back[:, d], minlength=len(used)) for d in range(DIM)], 1)[lost:]
        to_row = np.repeat(to_word / n[:, None], n, axis=0)
        some, where = np.unique(at, return_inverse=True)
        g = np.stack([np.bincount(where, weights=to_row[:, d], minlength=len(some)) for d in range(DIM)], 1).astype(np.float32)
        g_table[some] += (g * g).mean(1)
        table[some] -= RATE * g / np.sqrt(g_table[some])[:, None]
        gs, gb = (mean.T @ p).astype(np.float32), p.sum(0).astype(np.float32)
        g_softmax += gs * gs
        softmax -= SOFTMAX_RATE * gs / np.sqrt(g_softmax)
        g_bias += gb * gb
        bias -= SOFTMAX_RATE * gb / np.sqrt(g_bias)
    model = Model(table, softmax, 1.0, float(bias[1] - bias[0]))
    score = _Scorer(model.word_weights())
    s = np.array([score(t) for t, h in zip(texts, held, strict=True) if h])
    if not len(s) or y[held].min() == y[held].max():
        return model
    return model._replace(**dict(zip(("slope", "offset"), platt(s, y[held]), strict=True)))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The model, fitted in one task over the bounded sample; the driver gets the weights (4 MB) only."""

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, toxic = [], []
        for batch in arrow:
            texts += batch.column("text").to_pylist()
            toxic += batch.column("toxic").to_pylist()
        m = fit(texts, np.array(toxic, int))
        yield pa.record_batch([*(pa.array([x.astype(np.float32).tobytes()], pa.binary()) for x in m[:2]), *(pa.array([x], pa.float64()) for x in m[2:])],
                              ["embeddings", "softmax", "slope", "offset"])

    sample = labelled_sample(docs, labels, max_rows, id_col, text_col)
    rows = sample.coalesce(1).mapInArrow(run, "embeddings binary, softmax binary, slope double, offset double").collect()
    if not rows:
        return fit([], np.array([], int))
    r = rows[0]
    return Model(np.frombuffer(r["embeddings"], np.float32).reshape(-1, DIM), np.frombuffer(r["softmax"], np.float32).reshape(DIM, 2), r["slope"], r["offset"])


# --- scoring -------------------------------------------------------------------


class _Scorer:
    """Texts to scores. Each distinct word (as it stands in a lower-cased text) is scored once and kept."""

    def __init__(self, weights: np.ndarray, limit: int = CACHE_WORDS):
        self.weights, self.limit, self.known = weights, limit, {}

    def learn(self, raw: set[str]) -> None:
        if len(self.known) > self.limit:
            self.known.clear()
        raw = list(raw)
        words = [w.strip(EDGES) for w in raw]
        full = [w for w in words if w]
        values = iter(())
        if full:
            rows, starts = subwords(full)
            n = np.diff(np.append(starts, len(rows)))
            values = iter((np.add.reduceat(self.weights[rows].astype(np.float64), starts) / n).tolist())
        self.known.update((r, next(values) if w else np.nan) for r, w in zip(raw, words, strict=True))

    def __call__(self, text: str | None) -> float:
        words = (text or "").lower().split()
        if new := {w for w in words if w not in self.known}:
            self.learn(new)
            if len(new) < len(words) and not all(w in self.known for w in words):  # the cache was emptied
                self.learn(set(words))
        s = np.fromiter(map(self.known.__getitem__, words), np.float64, len(words))
        return text_score(s[~np.isnan(s)])


def toxicity(docs: DataFrame, labels: DataFrame, labelled: DataFrame | None = None, max_rows: int = MAX_ROWS,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score (probability of label 1) and predicted (1 from ``THRESHOLD`` on).
    ``labelled``: the documents that ``labels`` names, if others than ``docs``."""
    model = train(docs if labelled is None else labelled, labels, max_rows, id_col, text_col)
    weights = model.word_weights()
    model = model._replace(embeddings=None, softmax=None)

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _Scorer(weights)
        for batch in arrow:
            p = probability(np.array([score(t) for t in batch.column("text").to_pylist()], np.float64), model)
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))],
                                  ["doc_id", "held_out", "score", "predicted"])

    rows = id_text(docs, id_col, text_col, empty=False).select("doc_id", held_out("doc_id").alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")

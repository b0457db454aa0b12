"""Quality rules: fixed base rules, then a calibrated logistic regression on hashed n-grams.

Words and pairs of words, and character 3- and 4-grams, are hashed into
four tables of 2 ** 15 weights. A document's score is the bias plus, for each
table, the mean weight of its n-grams, so length does not matter. The weights are
fitted to a bounded sample of the labelled rows (``max_rows``, those with the
smallest hash), in one task; a fifth of the sample is held out, and Platt's
scaling on it turns scores into probabilities. Documents are scored in Arrow
batches over their whole texts; one is kept if it passes the base rules and its
probability is at least ``THRESHOLD``.

Defined results: a null text has no words (and so fails the base rules); rows of
``labels`` without a quality, or whose document has no text, train nothing; without
rows of both labels every document has probability 1 and the base rules
decide; repeated rows come back each; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import id_text

THRESHOLD = 0.5
MAX_ROWS = 3000
MIN_WORDS = 20
MAX_REPEATED = 30  # of 100 words
WINDOW = 8
BITS = 15
FAMILIES = 4
ROUNDS = 80
SYMBOLS = b"#*$%&|<>"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_WHITE = np.zeros(256, bool)
_WHITE[list(b" \t\n\x0b\x0c\r")] = True
_STARTS = (np.arange(256) & 0xC0) != 0x80  # bytes that start a code point


class Model(NamedTuple):
    weights: np.ndarray  # FAMILIES x 2 ** BITS
    bias: float
    slope: float  # Platt: probability = sigmoid(slope * score + offset)
    offset: float


def word_codes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


def grams(text: str, codes: np.ndarray) -> list[np.ndarray]:
    """The table places of a text's n-grams, one array per family."""
    chars = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint32)
    mix, top = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - BITS)
    out = [codes * mix >> top, (codes[:-1] * mix ^ codes[1:]) * mix >> top]
    few_bits = np.uint32(32 - BITS)
    a, b, c = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)
    three = chars[:-2] * a ^ chars[1:-1] * b ^ chars[2:] * c if len(chars) > 2 else chars[:0]
    four = (three[:-1] * b ^ chars[3:]) * a if len(chars) > 3 else chars[:0]
    return [*out, three * a >> few_bits, four >> few_bits]


def repeated_words(words: list[bytes], codes: np.ndarray) -> int:
    """Words in windows of eight words that occur twice or more in the text."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    h = np.zeros(n, np.uint64)
    for j in range(WINDOW):
        h = h * np.uint64(0x100000001B3) + codes[j:j + n]
    s = np.sort(h)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(twice):
        return 0
    places: dict[tuple, list[int]] = {}
    for i in np.flatnonzero(np.isin(h, twice)).tolist():  # equal hashes; the words decide
        places.setdefault(tuple(words[i:i + WINDOW]), []).append(i)
    step = np.zeros(len(words) + 1, np.int64)
    for at in places.values():
        if len(at) > 1:
            np.add.at(step, at, 1)
            np.add.at(step, np.array(at) + WINDOW, -1)
    return int((np.cumsum(step) > 0).sum())


def base_counts(raw: bytes, words: list[bytes], codes: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    b = np.frombuffer(raw, np.uint8)
    lines = [x for x in raw.split(b"\n") if x.strip()]  # bytes.strip() takes off the same white space
    return (len(words), int(np.count_nonzero(_STARTS[b] & ~_WHITE[b])), int(np.count_nonzero(_SYMBOL[b])),
            len(lines) - len(set(lines)), repeated_words(words, codes))


def score(text: str, codes: np.ndarray, model: Model) -> float:
    parts = [float(w[g].mean()) for w, g in zip(model.weights, grams(text, codes), strict=True) if len(g)]
    return model.bias + sum(parts)


def probability(s, model: Model):
    return 1 / (1 + np.exp(-np.clip(model.slope * s + model.offset, -500, 500)))


# --- training -----------------------------------------------------------------


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """At most ``max_rows`` labelled documents (text, quality), those with the smallest hash, in one partition."""
    marks = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
                   .filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality")))
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = id_text(docs, id_col, text_col, empty=False).filter("text is not null").join(F.broadcast(marks), "doc_id")
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(max_rows).select("text", "quality")


def fit(texts: list[str], quality: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Full-batch Adam on four fifths of the rows, Platt's scaling on the others."""
    size = FAMILIES << BITS
    even = Model(np.zeros((FAMILIES, 1 << BITS), np.float32), 0.0, 0.0, 500.0)
    if not len(texts) or quality.min() == quality.max():
        return even
    place, value, row = [], [], []
    for i, t in enumerate(texts):
        for f, g in enumerate(grams(t, word_codes(t.encode().split()))):
            if len(g):
                p, n = np.unique(g.astype(np.int32), return_counts=True)
                place.append(p + (f << BITS))
                value.append((n / len(g)).astype(np.float32))
                row.append(np.full(len(p), i, np.int32))
    place, value, row = (np.concatenate(x) for x in (place, value, row))
    n = len(texts)
    held = np.arange(n) % 5 == 4
    train = np.flatnonzero(~held)
    y = quality.astype(float)
    balance = np.where(y > 0, 0.5 / max(1e-9, y[train].mean()), 0.5 / max(1e-9, 1 - y[train].mean())) * ~held

    def scores(w, bias):
        return bias + np.bincount(row, weights=w[place] * value, minlength=n)

    w, bias = np.zeros(size), 0.0
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    for t in range(1, rounds + 1):
        r = (1 / (1 + np.exp(-np.clip(scores(w, bias), -500, 500))) - y) * balance / len(train)
        g, gb = np.bincount(place, weights=value * r[row], minlength=size) + 1e-6 * w, r.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        lr = 0.5 * np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
        w -= lr * m / (np.sqrt(v) + 1e-8)
        bias -= lr * mb / (np.sqrt(vb) + 1e-8)
    s = scores(w, bias)
    slope, offset = platt(s[held], y[held])
    return Model(w.reshape(FAMILIES, -1).astype(np.float32), float(bias), slope, offset)


def platt(s: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset by Newton's method, with Platt's smoothed targets."""
    n1, n0 = float((y > 0).sum()), float((y == 0).sum())
    if not n1 or not n0:
        return 1.0, 0.0
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = max(1e-9, float(np.abs(s).max()))
    x, a, b = s / scale, 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -500, 500)))
        d, h = p - t, p * (1 - p) + 1e-9
        ga, gb = (d * x).sum() + 1e-6 * a, d.sum()
        haa, hab, hbb = (h * x * x).sum() + 1e-6, (h * x).sum(), h.sum()
        det = haa * hbb - hab * hab
        if det <= 0:
            break
        a, b = a - (hbb * ga - hab * gb) / det, b - (haa * gb - hab * ga) / det
    return float(a / scale), float(b)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The model, fitted in one task over the bounded sample; the driver gets the weights only."""

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, quality = [], []
        for batch in arrow:
            texts += batch.column("text").to_pylist()
            quality += batch.column("quality").to_pylist()
        m = fit(texts, np.array(quality, int))
        yield pa.record_batch([pa.array([m.weights.tobytes()], pa.binary()), *(pa.array([x], pa.float64()) for x in m[1:])],
                              ["weights", "bias", "slope", "offset"])

    sample = labelled_sample(docs, labels, max_rows, id_col, text_col)
    rows = sample.coalesce(1).mapInArrow(run, "weights binary, bias double, slope double, offset double").collect()
    if not rows:
        return fit([], np.array([], int))
    r = rows[0]
    return Model(np.frombuffer(r["weights"], np.float32).reshape(FAMILIES, -1), r["bias"], r["slope"], r["offset"])


# --- scoring -------------------------------------------------------------------

_LONGS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def assess(text: str | None, model: Model) -> tuple:
    """The counts, base_failed, the probability and kept of one text."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    codes = word_codes(words)
    counts = base_counts(raw, words, codes)
    failed = counts[0] < MIN_WORDS or 100 * counts[4] > MAX_REPEATED * counts[0]
    p = float(probability(score(text, codes, model), model))
    return *counts, failed, p, not failed and p >= THRESHOLD


def _scored(rows: DataFrame, model: Model, schema: str, carried: list[str]) -> DataFrame:
    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow:
            out = list(zip(*(assess(t, model) for t in batch.column("text").to_pylist()), strict=True)) or [[]] * 8
            cols = [*(pa.array(c, pa.int64()) for c in out[:5]), pa.array(out[5], pa.bool_()), pa.array(out[6], pa.float64()), pa.array(out[7], pa.bool_())]
            yield pa.record_batch([*(batch.column(c) for c in carried), *cols], [*carried, *_LONGS, "base_failed", "probability", "kept"])

    return rows.mapInArrow(run, f"{schema}, " + ", ".join(f"{c} long" for c in _LONGS) + ", base_failed boolean, probability double, kept boolean")


def quality_rules(docs: DataFrame, labels: DataFrame, labelled: DataFrame | None = None, max_rows: int = MAX_ROWS,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, the five counts, base_failed, probability, kept.
    ``labelled``: the documents that ``labels`` names, if others than ``docs``."""
    model = train(docs if labelled is None else labelled, labels, max_rows, id_col, text_col)
    return _scored(id_text(docs, id_col, text_col, empty=False), model, "doc_id long", ["doc_id"])


def keep_good(docs: DataFrame, labels: DataFrame, labelled: DataFrame | None = None, max_rows: int = MAX_ROWS,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) without the documents that the rules reject; nothing is shuffled."""
    model = train(docs if labelled is None else labelled, labels, max_rows, id_col, text_col)
    names = docs.columns

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow:
            texts = batch.column(names.index(text_col)).to_pylist()
            yield batch.filter(pa.array([assess(t, model)[-1] for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

"""Toxicity scores."""

import random
import zlib

import numpy as np
import pytest

from evidentia.llm import toxicity as tx
from evidentia.llm.common import read

SCHEMA = "doc_id long, text string, lang string, score double, held_out string, toxic int, predicted int"
BAD = ["idiot", "moron", "pathetic", "worthless"]
UNSEEN = ["idiiot", "morron", "pathetiic", "worthlless", "idiots", "MORON!"]


def prose(rng, n):
    return [rng.choice(["the", "of", "and", "house", "river", "stone", "walks", "green", "letter", "evening"]) + rng.choice(["", "s", "ing", "er"]) for _ in range(n)]


def planted(rng, words, n, count=3):
    text = prose(rng, n)
    for _ in range(count):
        text.insert(rng.randrange(len(text)), rng.choice(words))
    return " ".join(text)


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", 1.0, "x", 0, 0) for i, t in rows], SCHEMA)


def test_misspellings_that_no_label_has_seen(spark):
    rng = random.Random(1)
    rows = [(i, planted(rng, BAD, rng.randrange(20, 200)) if i % 4 == 0 else " ".join(prose(rng, rng.randrange(5, 300)))) for i in range(600)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i, _ in rows], "doc_id long, quality int, toxic int")
    new = [(10_000 + i, planted(rng, UNSEEN, 60)) for i in range(40)]
    long = lambda: " ".join(prose(rng, 1500))
    buried = [(20_000 + i, f"{long()} {planted(rng, BAD, 300, 15)} {long()}") for i in range(20)]  # a toxic passage in a long clean text
    clean = [(30_000 + i, " ".join(prose(rng, rng.randrange(1, 2000)))) for i in range(60)]
    got = {r["doc_id"]: r for r in tx.toxicity(frame(spark, rows + new + buried + clean), labels).collect()}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) and r["held_out"] == held(i) for i, r in got.items())
    assert np.mean([got[i]["predicted"] for i, _ in new]) >= 0.9
    assert np.mean([got[i]["predicted"] for i, _ in buried]) >= 0.9
    assert np.mean([got[i]["predicted"] for i, _ in clean]) <= 0.05
    assert np.mean([got[i]["predicted"] == (i % 4 == 0) for i, _ in rows if held(i)]) >= 0.95


def test_held_out_accuracy_on_the_given_labels(spark):
    sf = "/root/testdata/sf0.1"
    labels = read(spark, sf, "labels")
    got = tx.toxicity(read(spark, sf), labels).join(labels, "doc_id").join(read(spark, sf), "doc_id").select("doc_id", "held_out", "score", "predicted", "toxic", "text").collect()
    out = [r for r in got if r["held_out"]]
    assert out and all(r["held_out"] == held(r["doc_id"]) for r in got)
    toxic, clean = [r for r in out if r["toxic"]], [r for r in out if not r["toxic"]]
    words = {"trash", "pathetic", "idiot", "disgusting", "worthless", "stupid", "clown", "loser", "scum", "moron"}
    said = [r for r in toxic if words & set(tx.words_of(r["text"]))]
    assert np.mean([r["predicted"] for r in said]) >= 0.95
    assert np.mean([r["predicted"] for r in toxic]) >= 0.65  # a part of the labels is on texts without a word of their own
    assert np.mean([r["predicted"] for r in clean]) <= 0.05
    share = np.mean([r["toxic"] for r in out])
    assert abs(np.mean([r["score"] for r in out]) - share) < 0.04  # calibrated


def test_held_out_labels_are_not_read(spark):
    rng = random.Random(2)
    rows = [(i, planted(rng, BAD, 40) if i % 3 == 0 else " ".join(prose(rng, 40))) for i in range(300)]
    label = lambda flip: spark.createDataFrame([(i, 1, int((i % 3 == 0) != (flip and held(i)))) for i, _ in rows], "doc_id long, quality int, toxic int")
    one, two = (sorted(tuple(r) for r in tx.toxicity(frame(spark, rows), label(f)).collect()) for f in (False, True))
    assert one == two


@pytest.mark.parametrize("marks", [[], [(0, 1, 0)], [(0, 1, None), (None, 1, 1), (99, 1, 1)], [(1, 1, 1), (3, 1, 7)]])
def test_odd_texts_and_few_labels(spark, marks):
    texts = [None, "", " \n\t ", "...", "a", "x" * 30_000, "word " * 20_000, "é 日本 😀 idiot\x00", "a", " "]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    docs = frame(spark, [*enumerate(texts), (None, "idiot"), (3, "again")])
    rows = tx.toxicity(docs, labels).collect()
    assert len(rows) == len(texts) + 2
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows}) == 1  # not both labels: the share of label 1
    assert tx.toxicity(docs.limit(0), labels).count() == 0


def test_word_scores_are_means_of_ngrams():
    weights = np.random.default_rng(0).normal(size=1 << tx.BITS).astype(np.float32)
    for limit in (2, 100):
        score = tx._Scorer(weights, limit)
        for text in ("one two, three!", "a (b) ... c", "one one two four five six", ""):
            means = []
            for w in tx.words_of(text):
                rows, _ = tx.subwords([w])
                assert len(rows) == sum(max(0, len(w) + 3 - n) for n in range(3, 7))
                means.append(weights[rows].mean())
            want = sum(means) / max(len(means), tx.LEAST) if means else 0.0
            assert score(text) == pytest.approx(want, abs=1e-5)

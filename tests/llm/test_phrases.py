"""Phrase collocations."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from evidentia.llm import phrases as ph
from evidentia.llm.common import read

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, phrase string, n int, c long, shard int"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "p", 1, 2, 3) for i, (lang, t) in enumerate(rows)], SCHEMA)


def brute_counts(rows, longest=5):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for size in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + size]) for i in range(len(w) - size + 1))
    return f, n


def brute(rows, threshold, top):
    f, n = brute_counts(rows)
    out = []
    for lang, counts in f.items():
        cands = {p: a for p, a in counts.items() if len(p) > 1 and a >= threshold}
        inside = defaultdict(int)
        for p, a in cands.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i:i + size]] = max(inside[p[i:i + size]], a)
        best = []
        for p, a in cands.items():
            if 100 * inside[p] >= 100 * a:
                continue
            cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            best.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def result(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = ["a", "B", "cc", "Dd", "e", "É", "日本", "f\x00", "g"]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", " ", ".", ",\n", " "]) for _ in range(rng.randrange(0, 80)))
        rows.append((rng.choice(["en", "en", "fr", None, ""]), text + rng.choice(["", "one two Three four five six! ", "one two three four five? x"])))
    late = [("en", "late words come last. " * 3)] * 12  # they reach the threshold in a late shard
    return [*rows, *late, ("en", None), ("fr", ""), ("en", " \t "), ("de", "one two"), ("en", "one two " * 3000)]


@pytest.mark.parametrize(("threshold", "top", "shards", "block"), [(5, 2000, 3, 300), (3, 7, 2, 10**6)])
def test_against_brute_force(spark, threshold, top, shards, block):
    rows = corpus(threshold)
    assert result(ph.collocations(frame(spark, rows), threshold, 5, top, shards, block)) == brute(rows, threshold, top)


def test_shared_slots_change_nothing(spark):
    rows = corpus(8, 30)
    blocks = ph._blocks(frame(spark, rows), 3, "lang", "text", 200)
    f, _ = brute_counts(rows, 4)
    want = sorted((lang, " ".join(p), len(p), c) for lang, counts in f.items() for p, c in counts.items() if c >= 6)
    got = sorted(tuple(r) for r in ph.phrase_counts(blocks, 6, 4, 3, table_bits=3).collect())
    assert got == want


def test_given_documents(spark):
    docs = read(spark, SF)
    rows = [(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()]
    assert result(ph.collocations(docs, threshold=20)) == brute(rows, 20, 2000)


def test_no_documents_and_no_phrases(spark):
    assert result(ph.collocations(frame(spark, []))) == []
    assert result(ph.collocations(frame(spark, [("en", None), (None, ""), ("en", "a b c")]))) == []


def test_a_scan_counts_what_is_active():
    codes = ph._Codes()
    c = ph.text_codes("A b a b, a B. c\td", codes)
    assert c.tolist() == [1, 2, 1, 2, 0, 1, 2, 0, 3, 4, 0]
    words = pa.array([w.decode() for w in list(codes)[2:]])
    assert {(p, k): n for ps, k, ns in ph.block_counts("en", words, c, None, 0, 2) for p, n in zip(ps.to_pylist(), ns)} == \
        {("a", 1): 3, ("b", 1): 3, ("c", 1): 1, ("d", 1): 1}
    full = np.full(8, 1, np.uint8)  # everything reached the threshold at stop 0
    got = {(p, k): n for ps, k, ns in ph.block_counts("en", words, c, full, 2, 2) for p, n in zip(ps.to_pylist(), ns)}
    assert got == {("a b", 2): 3, ("b a", 2): 1, ("c d", 2): 1, ("a b a", 3): 1, ("b a b", 3): 1, ("a b a b", 4): 1}
    assert not list(ph.block_counts("en", words, c, full, 3, 2))  # a cycle later all are complete


def test_scores_are_exact_beyond_64_bits(spark):
    big = 3 * 10**15
    counts = spark.createDataFrame([("en", "x", 1, big), ("en", "y", 1, big - 1), ("en", "x y", 2, big - 7)], "lang string, phrase string, n int, c long")
    totals = spark.createDataFrame([("en", 9 * 10**15)], "lang string, n long")
    row = ph.scored(counts, totals).first()
    assert row["score"] == 1000 * (big - 7) * 9 * 10**15 // (big * (big - 1))


def test_scans_go_no_deeper_than_may_be_active(spark, monkeypatch):
    """The first scan counts words only, the next pairs; and the joins look up summed phrases, not counts of blocks."""
    depths, plans, scan, added = [], [], ph._scan, ph._added
    monkeypatch.setattr(ph, "_scan", lambda *a: depths.append(a[4]) or scan(*a))

    def kept(*a):
        plans.append((out := added(*a))._jdf.queryExecution().optimizedPlan().toString())
        return out

    monkeypatch.setattr(ph, "_added", kept)
    rows = corpus(5, 20)
    blocks = ph._blocks(frame(spark, rows), 2, "lang", "text", 200)
    f, _ = brute_counts(rows, 3)
    want = sorted((lang, " ".join(p), len(p), c) for lang, counts in f.items() for p, c in counts.items() if c >= 9)
    assert sorted(tuple(r) for r in ph.phrase_counts(blocks, 9, 3, 2, table_bits=8).collect()) == want
    assert depths[:2] == [1, 2] and max(depths) == 3
    assert all(p.index("Join") < p.index("Aggregate") < p.index("MapInArrow") for p in plans[1:])


def test_word_hashes_are_of_the_words_alone():
    words = ["a", "b", "ab", "ba", "日本", "x" * 64, "x" * 65, "x" * 66, "f\x00", "f"]
    h = ph._word_hashes(pa.array(words))
    assert len(set(h.tolist())) == len(words)
    assert ph._word_hashes(pa.array(words)[3:]).tolist() == h[3:].tolist()
    assert ph._word_hashes(pa.array(words * 3), piece=4).tolist() == h.tolist() * 3
    assert ph._word_hashes(pa.array(["y" * 99, *words])).tolist()[1:] == h.tolist()
    assert ph._word_hashes(pa.array([], pa.string())).tolist() == []

"""Operators over the corpus: dedup, sharding, packing, BPE, passages, and the pipeline."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from evidentia.llm import byte_bpe, chunks, exact_dedup, packing, passages, pii, quality, sharding, simhash
from evidentia.llm.common import prefix_sums, read

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, digest int, part string, fp string, shard int, n long"
TEXTS = ["one two three four", None, "", "one two three four", "x", "x", "", "  ", "é 日本 😀", "a" * 50000, "w " * 20000, "\n\n a  b \t\n c "]
IDS = [3, 1, 2, 9, None, None, 7, 8, 8, 10, 11, 12]


def frame(spark, texts=TEXTS, ids=IDS):
    return spark.createDataFrame([(i, t, None, 1, "p", "f", 2, 3) for i, t in zip(ids, texts)], SCHEMA)


def test_prefix_sums(spark):
    df = spark.createDataFrame([(i * 3, i) for i in range(1, 50)], "k long, v long")
    got = {r["k"]: r["before"] for r in prefix_sums(df, "k", "v", block=10).collect()}
    assert got == {i * 3: sum(range(1, i)) for i in range(1, 50)}


# --- exact dedup -------------------------------------------------------------------


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i, n in Counter(ids).items():
            for copy in range(n):
                out[(i, keep, len(ids), i == keep and copy == 0, hashlib.sha256(t.encode()).hexdigest())] += 1
    return out


def test_exact_dedup(spark):
    rows = list(zip(IDS, TEXTS)) + [(9, "one two three four")]
    docs = frame(spark, [t for _, t in rows], [i for i, _ in rows])
    assert Counter(map(tuple, exact_dedup.exact_dedup(docs).collect())) == brute_exact(rows)
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    want = Counter((k[0], k[4]) for k in brute_exact(rows) if k[3])
    assert Counter((r["doc_id"], hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in kept.collect()) == want
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == 0
    assert exact_dedup.keep_first(docs.limit(0)).count() == 0


def test_digest_index_persists(spark, tmp_path):
    path = str(tmp_path / "index")
    first = exact_dedup.DigestIndex(spark, path, buckets=4)
    a = frame(spark, ["p", "q", "q"], [1, 2, 3])
    assert {r["doc_id"] for r in exact_dedup.keep_first(a, first).collect()} == {1, 3}
    again = exact_dedup.DigestIndex(spark, path, buckets=4)  # as a later session opens it
    assert again.rows().count() == 2
    b = frame(spark, ["q", "r", "p"], [4, 5, 6])
    assert {r["doc_id"] for r in exact_dedup.keep_first(b, again).collect()} == {5}
    assert {r["doc_id"] for r in exact_dedup.keep_first(a, again).collect()} == {1, 3}  # run again: the same decisions
    compact = again.compact()
    assert sorted(map(tuple, compact.rows().collect())) == sorted(map(tuple, again.rows().collect()))
    plan = a.select(exact_dedup.digest(a["text"]).alias("digest")).join(again.rows().hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "SortMergeJoin" in plan


# --- sharding ------------------------------------------------------------------------


def test_sharding(spark):
    docs = frame(spark, TEXTS * 7, [None if i is None else i + 100 * k for k in range(7) for i in IDS])
    placed = sharding.place(sharding.shuffle_records(docs, bucket_bytes=60000)).collect()
    assert Counter((r["doc_id"], r["text"]) for r in placed) == Counter((r["doc_id"], r["text"]) for r in docs.collect())
    assert len({r["bucket"] for r in placed}) > 3
    per = Counter(r["shard"] for r in placed)
    assert set(per) == set(range(16)) and max(per.values()) - min(per.values()) <= 1
    for s in per:
        assert sorted(r["slot"] for r in placed if r["shard"] == s) == list(range(per[s]))
    for r in placed:
        raw = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
    assert sharding.place(sharding.shuffle_records(docs.limit(0))).count() == 0
    assert [r["doc_id"] for r in sorted(placed, key=lambda r: (r["shard"], r["slot"]))] != [r["doc_id"] for r in docs.collect()]


def test_sharding_is_deterministic_and_written(spark, tmp_path):
    docs = read(spark, SF)
    a, b = ({(r["doc_id"], r["shard"], r["slot"]) for r in sharding.place(sharding.shuffle_records(docs, 100000)).collect()} for _ in range(2))
    assert a == b
    sharding.write_shards(docs, str(tmp_path / "s"), bucket_bytes=100000)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in back.collect()} == a


# --- packing and BPE --------------------------------------------------------------------


def odd_texts():
    rng = np.random.default_rng(7)
    bits = ["a", " ", "  ", "\n", "\t", "é", "日", "😀", "'s", "1", "!", " ", " ", "\x1c", "\x85", "The", "<|endoftext|>", "$$$", "\r\n", "ſ"]
    return ["".join(rng.choice(bits, size=rng.integers(0, 40))) for _ in range(600)]


def reference_ids(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(packing.vocabulary_path())
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_pieces_join_to_the_text():
    for t in odd_texts():
        assert " ".join(chunks.pieces(t)) == t


def test_packing_ids_are_the_tokenizers(spark):
    texts = odd_texts() + [r["text"] for r in read(spark, SF).collect()]
    got = packing._encoder(packing.vocabulary_path()).encode(texts)
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == reference_ids(texts)


def test_packing(spark):
    docs = read(spark, SF).select("doc_id", "text", "lang").union(spark.createDataFrame([(1000, None, "x"), (1001, "", "x"), (1001, "", "x")], "doc_id long, text string, lang string"))
    docs = docs.withColumnRenamed("lang", "start").repartition(5)
    pieces = packing.pack(docs, with_ids=True)
    rows = pieces.collect()
    ids = {}
    source = docs.collect()
    for r, x in zip(source, reference_ids([r["text"] or "" for r in source])):
        ids.setdefault(r["doc_id"], []).append([*x, 0])
    total = sum(len(x) for v in ids.values() for x in v)
    rows.sort(key=lambda r: (r["sequence_id"], r["offset"]))
    at, by = 0, {}
    for r in rows:
        assert r["sequence_id"] * 1024 + r["offset"] == at and r["length"] > 0
        at += r["length"]
        by.setdefault(r["doc_id"], []).append(r)
    assert at == total and max(r["offset"] + r["length"] for r in rows) <= 1024
    for doc, parts in by.items():
        if len(ids[doc]) > 1:
            assert [(p["start"], p["length"]) for p in parts] == [(0, 1)] * len(parts)
            continue
        whole = ids[doc][0]
        assert sorted((p["start"], p["start"] + p["length"]) for p in parts) == sorted(
            (a, b) for a, b in zip([0, *np.cumsum([p["length"] for p in parts])], np.cumsum([p["length"] for p in parts])))
        for p in parts:
            x = np.array(whole[p["start"]:p["start"] + p["length"]], "<u4").tobytes()
            assert zlib.crc32(x) == p["ids_crc32"] and p["doc_tokens"] == len(whole)
            assert p["crosses"] == (p["start"] + p["length"] < len(whole))
    seqs = packing.sequences(pieces).collect()
    assert sum(s["n_tokens"] for s in seqs) == total
    assert sorted(s["n_tokens"] for s in seqs)[1:] == [1024] * (len(seqs) - 1)
    assert packing.pack(docs.limit(0)).count() == 0


def test_bpe_is_tiktokens(spark):
    import tiktoken
    bpe = byte_bpe.byte_pairs()
    import public_tokenizers
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.rank, special_tokens={})
    texts = odd_texts() + ["ab" * 3000, "x" * 5000, "abcdefgh" * 700 + "!" * 3000, "ß" * 999]
    for t, ids in zip(texts, bpe.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == enc.encode_ordinary(t)
        assert bpe.decode(ids) == t.encode()
    docs = read(spark, SF).select("doc_id", "text").union(frame(spark).select("doc_id", "text"))
    got = Counter(map(tuple, byte_bpe.digests(docs).collect()))
    want = Counter()
    for r in docs.collect():
        ids = enc.encode_ordinary(r["text"] or "")
        want[(r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest())] += 1
    assert got == want
    back = {r["doc_id"]: r["text"] for r in byte_bpe.decode(byte_bpe.encode(read(spark, SF))).collect()}
    assert back == {r["doc_id"]: r["text"] for r in read(spark, SF).collect()}
    assert byte_bpe.digests(docs.limit(0)).count() == 0


# --- SimHash -----------------------------------------------------------------------------


def brute_simhash(text):
    import xxhash
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def brute_components(nodes, bits=3):
    label = {f: f for f in nodes}
    def find(x):
        while label[x] != x:
            label[x] = label[label[x]]
            x = label[x]
        return x
    ns = list(nodes)
    for i, a in enumerate(ns):
        for b in ns[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                label[find(a)] = find(b)
    return {f: find(f) for f in ns}


def check_simhash(spark, docs):
    rows = [(r["doc_id"], brute_simhash(r["text"])) for r in docs.collect()]
    roots = brute_components({f for _, f in rows})
    first = {}
    for i, f in rows:
        if i is not None:
            first[roots[f]] = min(i, first.get(roots[f], i))
    want = Counter((i, f"{f:016x}", first.get(roots[f])) for i, f in rows)
    assert Counter(map(tuple, simhash.simhash_dedup(docs).collect())) == want
    return len(set(roots.values()))


def test_simhash(spark):
    check_simhash(spark, frame(spark, TEXTS + ["One TWO three four", "z z z", "x"], IDS + [20, 21, 5]))
    check_simhash(spark, read(spark, "/root/testdata/sf0.01"))
    assert simhash.simhash_dedup(frame(spark).limit(0)).count() == 0


@pytest.mark.parametrize("block", [4096, 8])
def test_simhash_links_by_brute_force(spark, block):
    """Dense balls of fingerprints, chains and far ones, with cells cut into blocks or not."""
    rng = np.random.default_rng(4)
    made = {int(x) for x in rng.integers(0, 1 << 63, size=150)}
    for c in list(made)[:6]:
        for _ in range(40):
            f = c
            for b in rng.choice(64, size=rng.integers(1, 5), replace=False).tolist():
                f ^= 1 << b
            made.add(f)
    signed = [f - (1 << 64) if f >> 63 else f for f in made]
    points = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(3)
    edges = simhash.links(points, block=block)
    assert all(((r["a"] ^ r["b"]) & (1 << 64) - 1).bit_count() <= 3 for r in edges.collect())
    got = {r["fp"] & (1 << 64) - 1: r["root"] for r in simhash.components(points, edges).collect()}
    want = brute_components(made)
    groups = lambda d: {frozenset(k for k in d if d[k] == v) for v in set(d.values())}
    assert groups(got) == groups(want)


def test_components_of_long_chains(spark):
    n = 300
    nodes = spark.range(n + 5).selectExpr("id * 7919 % 1000003 as fp")
    edges = spark.range(n - 1).selectExpr("id * 7919 % 1000003 as a", "(id + 1) * 7919 % 1000003 as b")
    roots = Counter(r["root"] for r in simhash.components(nodes, edges).collect())
    assert sorted(roots.values()) == [1] * 5 + [n]


def test_simhash_keep_first(spark):
    texts = ["a b c d", "a b c d", None, "", "q", "a b c d", "r s t"]
    ids = [5, 2, 4, 9, None, 2, None]
    kept = simhash.keep_first(frame(spark, texts, ids))
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted([(2, "a b c d"), (4, None), (None, "q"), (None, "r s t")], key=str)
    assert kept.columns == frame(spark).columns


# --- passages ------------------------------------------------------------------------------


def words_of(rng, n):
    return ["".join(rng.choice(list("abcdefghijklmnop"), size=6)) for _ in range(n)]


def test_passages_are_found(spark):
    rng = np.random.default_rng(1)
    p, q = words_of(rng, 55), words_of(rng, 80)
    fuzzy = list(q)
    for i in (20, 41, 62):
        fuzzy[i] = "changed"
    del fuzzy[50]
    def doc(*parts):
        return " ".join(w for x in parts for w in x)
    texts = [doc(words_of(rng, 200), p, words_of(rng, 30)), doc(p, words_of(rng, 100)), doc(words_of(rng, 70), q), doc(words_of(rng, 10), fuzzy, words_of(rng, 9)),
             doc(words_of(rng, 500)), doc(words_of(rng, 400)), None, "", "short", doc(words_of(rng, 90), p[:20], words_of(rng, 90)), doc(words_of(rng, 3), [w.upper() for w in p]),
             doc(p, words_of(rng, 40), q, words_of(rng, 11))]
    rows = passages.repeated_passages(frame(spark, [*texts, doc(p)], [*range(len(texts)), None])).collect()
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], []).append((r["start_word"], r["end_word"], r["rep_id"]))
        assert r["rep_ids"] and all(i < r["doc_id"] for i in r["rep_ids"]) and r["rep_id"] in r["rep_ids"]
    assert set(got) == {1, 3, 10, 11}
    (a, b, rep), = got[1]
    assert rep == 0 and 0 <= a <= 15 and 55 <= b <= 56
    (a, b, rep), = got[3]
    assert rep == 2 and 10 <= a <= 25 and 86 <= b <= 92
    assert [r for *_, r in sorted(got[11])] == [0, 2]


def test_every_exact_repeat_of_50_words_is_found(spark):
    rng = np.random.default_rng(9)
    texts = []
    for _ in range(40):
        p = words_of(rng, 50)
        for _ in range(3):
            texts.append(" ".join([*words_of(rng, rng.integers(0, 60)), *p, *words_of(rng, rng.integers(0, 60))]))
    rows = passages.repeated_passages(frame(spark, texts, range(len(texts)))).collect()
    assert {(r["doc_id"], r["rep_id"]) for r in rows} == {(i, i - i % 3) for i in range(len(texts)) if i % 3}
    assert passages.repeated_passages(frame(spark).limit(0)).count() == 0


def covered(rows, doc_id):
    return {w for r in rows if r["doc_id"] == doc_id for w in range(r["start_word"], r["end_word"])}


def test_two_passages_of_a_document_pair_at_any_gap(spark):
    rng = np.random.default_rng(31)
    texts, want = [], {}
    for size in (60, 100, 200):
        for mine, theirs in [(0, 0), (0, 100), (20, 20), (50, 50), (80, 80), (100, 0), (200, 120), (400, 400)]:
            a, b = words_of(rng, size), words_of(rng, size)
            texts.append(" ".join([*a, *words_of(rng, theirs), *b]))
            want[len(texts)] = {*range(12, size - 12), *range(size + mine + 12, 2 * size + mine - 12)}
            texts.append(" ".join([*a, *words_of(rng, mine), *b]))
    rows = passages.repeated_passages(frame(spark, texts, range(len(texts)))).collect()
    for i, words in want.items():
        assert words <= covered(rows, i), (i, sorted(words - covered(rows, i)))


def test_stock_phrases_of_other_documents_are_no_passage(spark):
    """Every seed of a clean document is a phrase that some earlier document holds, each a different one."""
    rng = np.random.default_rng(37)
    texts, clean = [], []
    for _ in range(3):
        w = words_of(rng, 300)
        texts += [" ".join(w[p:p + passages.K]) for p in sorted(set(passages.seeds(" ".join(w))[1].tolist()))]
        clean.append(len(texts))
        texts.append(" ".join(w))
    rows = passages.repeated_passages(frame(spark, texts, range(len(texts)))).collect()
    assert rows == [], [(r["start_word"], r["end_word"], r["n_equal"]) for r in rows]


def test_a_smaller_document_with_the_inner_part_hides_no_outer_part(spark):
    rng = np.random.default_rng(43)
    texts, want = [], {}
    for outer, inner in [(20, 100), (50, 100), (20, 40), (25, 20), (50, 300), (15, 30)] * 3:
        p = words_of(rng, 2 * outer + inner)
        texts.append(" ".join([*words_of(rng, 30), *p[outer:outer + inner], *words_of(rng, 30)]))
        texts.append(" ".join([*words_of(rng, 40), *p, *words_of(rng, 10)]))
        texts.append(" ".join([*words_of(rng, 25), *p[outer:outer + inner], *words_of(rng, 5)]))
        want[len(texts)] = {*range(60 + 12, 60 + len(p) - 12)}
        texts.append(" ".join([*words_of(rng, 60), *p, *words_of(rng, 30)]))
    rows = passages.repeated_passages(frame(spark, texts, range(len(texts)))).collect()
    lost = {i: len(words - covered(rows, i)) for i, words in want.items() if words - covered(rows, i)}
    assert not lost, lost
    assert all(r["n_equal"] >= passages.SIMILAR * (r["end_word"] - r["start_word"]) for r in rows)


def test_chains_against_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(150):
        n = int(rng.integers(1, 25))
        x, y = np.sort(rng.integers(0, 40, n)), rng.integers(0, 40, n)
        score = [float(passages.K)] * n
        for i in range(n):
            for j in range(n):
                if x[j] < x[i] and y[j] < y[i]:
                    score[i] = max(score[i], passages.K + score[j] - passages.GAP * (x[i] - x[j] + y[i] - y[j]))
        found = passages.chains(x, y)
        assert sorted(k for c in found for k in c) == list(range(n))
        best = found[0]
        total = sum(passages.K - (passages.GAP * (x[b] - x[a] + y[b] - y[a]) if a is not None else 0) for a, b in zip([None, *best], best))
        assert abs(total - max(score)) < 1e-9
        assert all(x[a] < x[b] and y[a] < y[b] for c in found for a, b in zip(c, c[1:]))


# --- pipeline --------------------------------------------------------------------------------


def test_pipeline_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    model = quality.train(read(spark, sf), read(spark, sf, "labels"))
    rows = [(r["doc_id"], r["text"]) for r in read(spark, sf).collect()]
    rows = [(i, t) for i, t in rows if quality.assess(t, model)[-1]]
    last = {}
    for i, t in rows:
        last[t] = max(i, last.get(t, i))
    rows = [(i, t) for i, t in rows if last[t] == i]
    fps = {i: brute_simhash(t) for i, t in rows}
    roots = brute_components(set(fps.values()))
    first = {}
    for i, f in fps.items():
        first[roots[f]] = min(i, first.get(roots[f], i))
    rows = [(i, t) for i, t in rows if first[roots[fps[i]]] == i]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    redacted = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    tokens = {i: [*x, 0] for i, x in zip(redacted, reference_ids(list(redacted.values())))}
    got = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in got} == set(tokens)
    at = 0
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["sequence_id"] * 1024 + r["offset"] == at
        at += r["length"]
        x = np.array(tokens[r["doc_id"]][r["start"]:r["start"] + r["length"]], "<u4").tobytes()
        assert zlib.crc32(x) == r["ids_crc32"] and r["doc_tokens"] == len(tokens[r["doc_id"]])
    assert at == sum(map(len, tokens.values()))


def test_stages_keep_columns_and_take_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in zip(IDS, TEXTS)], "doc_id long, text string, lang string, source string, n_chars long")
    for docs_in in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs_in, SF)
            assert out.count() >= 0
            if name != "packing":
                assert out.columns == docs.columns


HOSTILE = ["__once", "__key_0", "__l__key_0", "__spans", "____spans_email", "copy", "digest", "row", "once", "key_0", "listed_0", "spans", "found", "root",
           "fp", "text_hash", "keep_id", "probability", "pii", "part", "n"]


def test_stages_leave_clashing_columns_alone(spark):
    """Extra columns with the operators' own names come back unchanged, whatever a stage does to the row."""
    prose = " ".join(f"word{i}" for i in range(30))
    rows = [(1, prose + " mail a@b.org", 1), (2, prose + " mail a@b.org", 2), (2, prose + " mail a@b.org", 3), (3, None, 4), (None, "one two", 5),
            (4, prose + " call +1 415 555 0100 now", 6), (5, "", 7), (5, "", 7)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), *[f"{c}{k}" for c in HOSTILE]) for i, t, k in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in HOSTILE))
    given = {tuple(r[c] for c in HOSTILE) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        kept = [tuple(r[c] for c in HOSTILE) for r in out.collect()]
        assert set(kept) <= given and len(kept) > 0 and all(r[0] == f"{HOSTILE[0]}{r[-1][len(HOSTILE[-1]):]}" for r in kept), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= 0
    redacted = {r["n"]: (r["text"], r["n_chars"]) for r in pii.redact(docs, length_col="n_chars").collect()}
    assert redacted["n1"] == (prose + " mail [EMAIL]", len(prose) + 13) and redacted["n4"] == (None, 0)
    # of the two rows of document 2 with one text, the same one stays in every order of the rows
    for some in (docs, docs.orderBy(F.desc("n"))):
        stays = sorted(r["n"] for r in exact_dedup.keep_first(some).collect() if r["doc_id"] == 2)
        assert stays == ["n2"]


def test_the_pipeline_leaves_its_last_result_only(spark):
    import os
    from evidentia.session import ensure_checkpoint_dir
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before, tables = set(os.listdir(folder)), {t.name for t in spark.catalog.listTables()}
    n = corpus_pipeline.run(spark, SF).count()
    left = [f for f in set(os.listdir(folder)) - before if f.startswith("llm-")]
    assert n > 0 and len(left) == 1 and left[0].startswith("llm-pipeline-packing")
    assert {t.name for t in spark.catalog.listTables()} == tables

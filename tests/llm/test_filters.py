"""Operators on single documents: quality rules, PII, secrets, licenses."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from evidentia.llm import licenses, pii, quality, secret_scan
from evidentia.llm.common import read

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, kept string, spans long, pii int, kind string"

ODD = [None, "", " \n\t ", "a", "x" * 30000, "7" * 40000, "1 " * 30000, "a@" + "b." * 20000 + "c", "+1" + " " * 20000, "a" * 20000 + "@b",
       "the same line\nthe same line\n\nthe same line", "é ü ñ 日本語 😀 a@b.co 😀 10.0.0.1   end"]


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, None, "x", 1, 2, "y") for i, t in zip(ids, texts)], SCHEMA)


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    hit = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), n < 20 or 100 * len(hit) > 30 * n)


def test_quality_counts_and_base(spark):
    docs = read(spark, SF)
    got = {r["doc_id"]: r for r in quality.quality_rules(docs, read(spark, SF, "labels")).collect()}
    assert len(got) == docs.count()
    for r in docs.collect():
        g = got[r["doc_id"]]
        assert (g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"], g["n_repeat_words"], g["base_failed"]) == brute_counts(r["text"])
        assert not (g["base_failed"] and g["kept"])


def test_quality_odd_texts_and_no_labels(spark):
    docs = frame(spark, ODD + ODD[:1])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = quality.quality_rules(docs, none).collect()
    assert len(rows) == len(ODD) + 1
    by = {r["doc_id"]: r for r in rows}
    for i, t in enumerate(ODD):
        assert (by[i]["n_words"], by[i]["word_chars"], by[i]["n_symbols"], by[i]["n_dup_lines"], by[i]["n_repeat_words"], by[i]["base_failed"]) == brute_counts(t)
        assert by[i]["kept"] == (not by[i]["base_failed"])
    assert quality.quality_rules(docs.limit(0), none).count() == 0
    kept = quality.keep_good(docs, none)
    assert kept.columns == docs.columns


def test_quality_held_out_accuracy(spark):
    """Trained on labelled documents with an even id, tested on the others."""
    sf = "/root/testdata/sf0.1"
    docs, labels = read(spark, sf), read(spark, sf, "labels")
    model = quality.train(docs, labels.filter("doc_id % 2 = 0"))
    rows = docs.join(labels.filter("doc_id % 2 = 1 and quality is not null"), "doc_id").select("text", "quality").collect()
    got = [quality.assess(r["text"], model) for r in rows]
    p, kept = np.array([g[6] for g in got]), np.array([g[7] for g in got])
    y, long_enough = np.array([r["quality"] for r in rows]), np.array([g[0] >= quality.MIN_WORDS for g in got])
    # pages of one word over and over are left to the base rules
    assert ((p >= quality.THRESHOLD) == (y > 0)).mean() > 0.95
    assert (p[y > 0] >= quality.THRESHOLD).mean() > 0.99
    assert (kept == (y > 0))[long_enough].mean() > 0.985
    for low, high in ((0.0, 0.1), (0.9, 1.01)):  # calibrated: the mean probability of a band is its share of good rows
        band = (p >= low) & (p < high)
        assert band.any() and abs(p[band].mean() - y[band].mean()) < 0.05, (low, p[band].mean(), y[band].mean())


# --- PII ------------------------------------------------------------------------

PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def py_luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute_pii(text):
    out = []
    for kind, p in PII.items():
        for m in re.finditer(p, text or "", re.ASCII):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")) or kind == "phone" and 8 <= len(d) <= 15 \
                    or kind == "card" and 16 <= len(d) <= 19 and py_luhn(d):
                out.append((kind, *m.span()))
    return out


def check_pii(rows, texts):
    for r in rows:
        base = brute_pii(texts[r["doc_id"]])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest(), (r, listed)
        assert [r[f"n_{k}"] for k in PII] == [sum(b[0] == k for b in base) for k in PII]
        assert r["spans"].startswith(listed)


PII_CASES = ["x@y.zz%a@c.de b@c..d@e.f", "1.2.3.400.5.6.7 1.2.3.4.5.6.7.8 001.02.3.255 9.9.9", "4111 1111 1111 1111 1", "4111-1111-1111-1111",
             "4111  1111111111111111", "5 4425414259157784", "+1 (319) 555-5132 +44 20 7946 0958)", "+1+1+12345678", "a@b.c@d.e", "a@b c.d@e.f.",
             "123-45-6789", "my ssn: 123-45-6789", "IBAN GB82 WEST 1234 5698 7654 32 ok", "GB82WEST12345698765433", "4012888888881881" * 2]


def test_pii_against_brute_force(spark):
    docs = read(spark, SF)
    check_pii(pii.find_pii(docs).collect(), {r["doc_id"]: r["text"] for r in docs.collect()})
    texts = [t for t in ODD if t is None or len(t) < 40000 or not t.startswith("1 ")] + PII_CASES
    rows = pii.find_pii(frame(spark, texts)).collect()
    assert len(rows) == len(texts)
    check_pii(rows, texts)


def test_pii_random(spark):
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("01 25.-+@ab()"), size=rng.integers(1, 120))) for _ in range(400)]
    check_pii(pii.find_pii(frame(spark, texts)).collect(), texts)


def test_pii_added_kinds_and_redaction(spark):
    texts = ["my ssn: 123-45-6789", "123-45-6789", "IBAN GB82 WEST 1234 5698 7654 32 ok", "GB82WEST12345698765433", "é😀 a@b.co, 10.0.0.1 x", None, ""]
    got = {r["doc_id"]: r["spans"] for r in pii.find_pii(frame(spark, texts)).collect()}
    assert got == {0: "ssn:8:19", 1: "", 2: "iban:5:32", 3: "", 4: "email:3:9,ip:11:19", 5: "", 6: ""}
    red = pii.redact(frame(spark, texts).withColumn("n_chars", F.lit(2).cast("long")), length_col="n_chars")
    out = {r["doc_id"]: (r["text"], r["n_chars"]) for r in red.collect()}
    assert out[4] == ("é😀 [EMAIL], [IP] x", 18) and out[0][0] == "my ssn: [SSN]" and out[5] == (None, 2) and out[6] == ("", 2)
    assert red.columns == [*frame(spark, []).columns, "n_chars"]
    assert pii.find_pii(frame(spark, [])).count() == 0


def test_ibans_before_capitals_codes_and_numbers(spark):
    numbers = ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947"]
    behind = [" The bank", " Danke", " BIC: COBADEFFXXX", " BIC COBADEFF", " 2024-01-05", " 12345 X", ", ok", "", " EUR 5"]
    cases = [(n, f"é IBAN {n}{b}", 7) for n in numbers for b in behind] + [(n, f"account {p} {n} A", 9 + len(p)) for n in numbers for p in ("AB12", "BE12")]
    cases += [(n, n + " Bank", 0) for n in numbers]
    got = {r["doc_id"]: r["spans"] for r in pii.find_pii(frame(spark, [t for _, t, _ in cases])).collect()}
    lost = [(t, got[i]) for i, (n, t, at) in enumerate(cases) if f"iban:{at}:{at + len(n)}" not in got[i].split(",")]
    assert not lost, (len(lost), len(cases), lost)


# --- secrets ----------------------------------------------------------------------

SECRETS = {"assign": r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
           "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+"}


def brute_secrets(text):
    out = []
    for n, (kind, p) in enumerate(SECRETS.items()):
        for m in re.finditer(p, text or ""):
            if (len(m[2]) >= 8) if kind == "assign" else len(m[0]) >= (16 if kind == "access" else 32):
                out.append((m.start(), n, kind, m.end()))
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(out)]


def test_secrets_against_brute_force(spark):
    rng = np.random.default_rng(3)
    made = ["".join(rng.choice(["token", "=", ": ", "'", "AKIA", "ABCDEFGHIJKL2345", "api_key", "PassWord", "0123abcd" * 2, "deadbeef" * 4, " ", "secret", "x"],
                               size=rng.integers(1, 14))) for _ in range(300)]
    docs = read(spark, SF).select("doc_id", "text").collect()
    texts = [t for t in ODD] + made + ["ſecret=abcdefgh1 toKen=abcdefgh1", "token: secret: abcdefghij"] + [r["text"] for r in docs]
    rows = secret_scan.find_secrets(frame(spark, texts)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute_secrets(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        spans = r["spans"].split(",") if r["spans"] else []
        assert [s for s in spans if not s.startswith("random")] == base
        assert len(spans) - len(base) == r["n_random"]
    assert secret_scan.find_secrets(frame(spark, [])).count() == 0


def test_random_strings_are_found_and_words_are_not(spark):
    rng = np.random.default_rng(11)
    b64 = list(secret_scan.ALPHABETS["base64"][:62])
    secrets = [f"see {''.join(rng.choice(b64, size=40))} there" for _ in range(60)]
    words = [f"see {w} there" for w in ["internationalizationprocess" * 2, "someVeryLongIdentifierNameInCode", "A" * 40, "1" * 30, "ab" * 20, "the_quick_brown_fox_jumps_over"] for _ in range(20)]
    rows = {r["doc_id"]: r["n_random"] for r in secret_scan.find_secrets(frame(spark, secrets + words)).collect()}
    assert sum(rows[i] for i in range(60)) >= 57
    assert sum(rows[i] for i in range(60, 60 + len(words))) == 0


def test_battery_accepts_random_and_rejects_patterns():
    rng = np.random.default_rng(2)
    alphabet = secret_scan.ALPHABETS["hex"]
    p = [secret_scan.battery("".join(rng.choice(list(alphabet), size=48)), alphabet) for _ in range(300)]
    assert np.mean([x < secret_scan.UNLIKELY for x in p]) < 0.01
    for s in ("0f" * 24, "0123456789abcdef" * 3, "a" * 48):
        assert secret_scan.battery(s, alphabet) < secret_scan.UNLIKELY


def test_long_random_strings_of_each_encoding_pass():
    rng = np.random.default_rng(17)
    letters = "abcdefghijklmnopqrstuvwxyz"
    alphabets = [letters + letters.upper() + "0123456789" + signs for signs in ("", "+/", "-_")] + [letters + "234567"]
    lost = {}
    for alphabet in alphabets:
        for n in (40, 400, 1600, 4000):
            texts = ["".join(rng.choice(list(alphabet), size=n)) for _ in range(40)]
            lost[len(alphabet), alphabet[-1], n] = sum([c[3] for c in secret_scan.candidates(t, [])] == [-1] for t in texts)
    assert all(x <= 1 for x in lost.values()), lost


# --- licenses -----------------------------------------------------------------------


def brute_licenses(texts):
    out = set()
    for t_id, (_, notice) in enumerate(licenses.TEMPLATES):
        t = [w for w in re.split("[^a-z0-9]+", notice.lower()) if w]
        want = {tuple(t[i:i + 5]) for i in range(len(t) - 4)}
        for i, text in enumerate(texts):
            w = [x for x in re.split("[^a-z0-9]+", (text or "").lower()) if x]
            grams = [tuple(w[j:j + 5]) for j in range(len(w) - 4)]
            reach = 1 << (len(t) - 5).bit_length() if len(t) > 5 else 1
            if any(len(want & set(grams[s:s + 2 * reach])) / len(want) >= 0.8 for s in range(0, max(1, len(grams)), reach)):
                out.add((i, t_id))
    return out


def test_licenses_against_brute_force(spark):
    notices = [n for _, n in licenses.TEMPLATES]
    filler = "lorem ipsum dolor sit amet " * 7
    texts = ODD + [filler + n + " " + filler for n in notices] + [n.upper().replace(" ", "\n--") for n in notices] \
        + [n.replace("software", "thing") for n in notices] + ["mit license", "licensed under the"] + [notices[0] + " x " + notices[2]] \
        + [r["text"] for r in read(spark, "/root/testdata/sf0.01").select("text").collect()]
    got = {(r["doc_id"], r["template_id"]) for r in licenses.scan_licenses(frame(spark, texts)).collect()}
    assert got == brute_licenses(texts)
    assert len(got) > 40
    assert licenses.scan_licenses(frame(spark, [])).count() == 0
    assert licenses.scan_licenses(frame(spark, texts[:5]), templates=(("none", "too short"),)).count() == 0


HEADERS = {
    "GPL-3.0-or-later": """# This program is free software: you can redistribute it and/or modify
        # it under the terms of the GNU General Public License as published by
        # the Free Software Foundation, either version 3 of the License, or
        # (at your option) any later version.""",
    "GPL-2.0-or-later": """ * This file is free software; you can redistribute it and/or modify it
         * under the terms of the GNU General Public License as published by the Free Software Foundation; either
         * version 2 of the License, or (at your option) any later version.""",
    "LGPL-2.1-or-later": """ * This library is free software; you can redistribute it and/or
         * modify it under the terms of the GNU Lesser General Public
         * License as published by the Free Software Foundation; either
         * version 2.1 of the License, or (at your option) any later version.""",
    "AGPL-3.0-or-later": """// This program is free software: you can redistribute it and/or modify it under the terms of the
        // GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License,
        // or (at your option) any later version.""",
    "Apache-2.0": """// Licensed under the Apache License, Version 2.0 (the "License");
        // you may not use this file except in compliance with the License.
        // You may obtain a copy of the License at
        //     http://www.apache.org/licenses/LICENSE-2.0""",
    "ISC": """/* Permission to use, copy, modify, and distribute this software for any
         * purpose with or without fee is hereby granted, provided that the above
         * copyright notice and this permission notice appear in all copies. */""",
    "BSD": """// Use of this source code is governed by a BSD-style license that can be
        // found in the LICENSE file.""",
}


def test_real_file_headers_are_found(spark):
    texts = ["Copyright (C) 2020 A. Person\n" + h + "\nimport os\n" * 40 for h in HEADERS.values()]
    rows = licenses.scan_licenses(frame(spark, texts)).collect()
    best = {}
    for r in rows:
        best.setdefault(r["doc_id"], set()).add(r["license"])
    lost = [name for i, name in enumerate(HEADERS) if name not in best.get(i, ())]
    assert not lost, lost


def test_a_passage_has_one_licence(spark):
    """Each header, and each template's own text, is reported as its own licence and as no other one."""
    mit = max((n for name, n in licenses.TEMPLATES if name == "MIT"), key=len)
    cases = [*HEADERS.items(), ("MIT", mit), ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
             *((name, n) for name, n in licenses.TEMPLATES if len(n.split()) >= 8)]
    texts = ["Copyright (C) 2020 A. Person\n" + n + "\nimport os\n" * 40 for _, n in cases]
    rows = licenses.scan_licenses(frame(spark, texts), one_per_passage=True).collect()
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], []).append((r["license"], r["n_passages"]))
    assert {i: got.get(i) for i in range(len(cases))} == {i: [(name, 1)] for i, (name, _) in enumerate(cases)}
    # two licences in one text, each twice, are both there
    apart = "\n" + "other words stand here " * 60 + "\n"
    both = apart.join([HEADERS["GPL-2.0-or-later"], HEADERS["ISC"]] * 2)
    assert {(r["license"], r["n_passages"]) for r in licenses.scan_licenses(frame(spark, [both]), one_per_passage=True).collect()} == \
        {("GPL-2.0-or-later", 2), ("ISC", 2)}
    empty = licenses.scan_licenses(frame(spark, ODD), one_per_passage=True)
    assert empty.columns == ["doc_id", "template_id", "license", "containment", "start_word", "n_passages"] and empty.count() == 0


@pytest.mark.parametrize("shingles", [["a b c d e", "b c d e f"], ["x y z v w", "a b c d e"]])
def test_key_words_meet_every_shingle(shingles):
    keys = set(licenses.key_words(shingles))
    assert all(keys & set(s.split()) for s in shingles)

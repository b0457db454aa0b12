"""Randomized checks of the text helpers against Python's string semantics."""

import random
import re
from pathlib import Path


from evidentia.functions.strings import py_split_words, py_strip
from evidentia.functions.text import estimate_tokens, file_stem, format_title, strip_markup
from evidentia.schema import TITLE_LOWERCASE_WORDS

ALPHABET = (list("abcXYZ_-./ <>") + ["the", "of", "AND", "in", "ai", "ß", "é", "İ", "ǆ", "1"]
            + ["\t", "\n", " ", " ", "　", "\x1c", "\x1f", "\x85", " "])


def _strings(seed, n=300, max_len=14):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, max_len))) for _ in range(n)]


def test_helpers_match_python(spark):
    for seed in range(3):
        vals = _strings(seed)
        df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
        rows = df.select("i", py_strip("v").alias("strip"), py_split_words("v").alias("split"),
                         estimate_tokens("v").alias("tok"), strip_markup("v").alias("mk")).collect()
        for r in rows:
            v = vals[r.i]
            assert r.strip == v.strip(), repr(v)
            assert r.split == v.split(), repr(v)
            assert r.tok == len(v) // 4
            assert r.mk == re.sub("<[^<]+?>", "", v), repr(v)


def test_names_match_python(spark):
    for seed in range(3):
        # bare file names, as a file listing yields them (paths are covered elsewhere)
        vals = [v.replace("/", "") for v in _strings(100 + seed)]
        vals = [v for v in vals if v not in ("", ".", "..")]
        df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
        rows = df.select("i", file_stem("v").alias("stem"), format_title("v").alias("title")).collect()
        for r in rows:
            v = vals[r.i]
            assert r.stem == Path(v).stem, repr(v)
            words = r.title.split(" ") if r.title else []
            assert "_" not in r.title and "-" not in r.title and all(words) == bool(r.title or not words)
            assert r.title.casefold() == " ".join(re.split(r"[\s_-]+", r.stem)).strip().casefold(), repr(v)
            assert all(w in TITLE_LOWERCASE_WORDS or w.lower() not in TITLE_LOWERCASE_WORDS for w in words[1:]), repr(v)

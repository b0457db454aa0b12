"""Sections and the token budget: expected texts worked out by hand, and properties on random papers."""

import random

import pytest

from evidentia.operators.context import SEPARATORS, fit_documents, split_sections
from evidentia.schema import MAX_CONTEXT_TOKENS, SECTION_MARKERS, TRUNCATION_TAG

ABSTRACT, METHODS, RESULTS = "a" * 400, "m" * 2000, "r" * 4000


def _fit(spark, text, max_tokens, mode):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    return fit_documents(df, max_tokens=max_tokens, mode=mode).first()


def _sections(spark, text, mode):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    return [(r.header, r.content) for r in split_sections(df, mode=mode).orderBy("section_no").collect()]


@pytest.mark.parametrize("mode", list(SEPARATORS))
def test_sections_by_hand(spark, mode):
    n = SEPARATORS[mode]
    text = n.join(["front", "ABSTRACT", "one", "two", " Methods and results ", "three", "Conclusion",
                   "a line that is much too long to be a header, method or not", "References", "", "last"])
    assert _sections(spark, text, mode) == [
        ("start", "front"), ("abstract", f"ABSTRACT{n}one{n}two"), ("method", f" Methods and results {n}three"),
        ("conclusion", f"Conclusion{n}a line that is much too long to be a header, method or not"),
        ("reference", f"References{n}{n}last")]
    assert _sections(spark, "", mode) == [("start", "")]


@pytest.mark.parametrize("mode", list(SEPARATORS))
def test_budget_by_hand(spark, mode):
    n = SEPARATORS[mode]
    text = n.join(["front", "Results", RESULTS, "Abstract", ABSTRACT, "Methods", METHODS, "References", "x"])
    two = f"{n}{n}Abstract{n}{ABSTRACT}{n}{n}Methods{n}{METHODS}"
    # 800 tokens of 1000 may be filled: two sections, and under 1000 characters left for a third
    got = _fit(spark, text, 1000, mode)
    assert got.text == two and got.truncated
    # 4800 characters at 1500 tokens: the results are cut where they run out
    left = 4800 - len(two)
    assert _fit(spark, text, 1500, mode).text == f"{two}{n}{n}{f'Results{n}{RESULTS}'[:left]}{n}{TRUNCATION_TAG}"
    whole = _fit(spark, text, len(text) // 4, mode)
    assert whole.text == text and not whole.truncated
    # a paper whose only section has no priority is cut at the front
    only = f"References{n}{'x' * 9000}"
    assert _fit(spark, only, 500, mode).text == only[:2000]


def test_random_papers_keep_order_and_budget(spark):
    rng = random.Random(7)
    heads = [m.title() for m in SECTION_MARKERS] + ["Something else"]
    docs = [(i, "\n".join(rng.choice(heads) if rng.random() < 0.35 else "w" * rng.randint(0, 2500)
                          for _ in range(rng.randint(1, 14)))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    parts = {}
    for r in split_sections(df, mode="newline").collect():
        parts.setdefault(r.doc_id, []).append((r.section_no, r.content))
    for i, text in docs:
        assert "\n".join(c for _, c in sorted(parts[i])) == text  # nothing lost, in order
    for max_tokens in (600, 2500, MAX_CONTEXT_TOKENS):
        for r in fit_documents(df, max_tokens=max_tokens, mode="newline").collect():
            text = docs[r.doc_id][1]
            assert (r.text == text) == (len(text) // 4 <= max_tokens) or r.text in text
            assert len(r.text) <= max(max_tokens * 4, int(max_tokens * 3.2) + len(TRUNCATION_TAG) + 3)


def test_many_sections_paper(spark):
    # a reference list where every short line reads as a section header
    lines = ["Abstract", "a" * 3000] + [f"Methods in Study {i}, 2001" for i in range(5000)]
    df = spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string")
    assert split_sections(df, mode="newline").count() == 5001
    got = fit_documents(df, max_tokens=20000, mode="newline").first().text
    assert got.startswith("\n\nAbstract\naaa") and "\n\nMethods in Study 0, 2001\n\nMethods in Study 1, 2001" in got
    assert 60000 < len(got) <= 64000 + len(TRUNCATION_TAG) + 3

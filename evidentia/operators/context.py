"""Sections and token-budget fitting, computed inside each paper's row.

The original tool splits on the two characters backslash + ``n`` (not a
newline), so ordinary text is a single ``start`` section; ``mode="compat"``
keeps that behaviour and ``mode="newline"`` splits on real newlines.

Nothing here shuffles: a paper's lines, sections and budget walk are array
expressions on its own row, so the paper text never crosses the network.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.functions.strings import col, let, py_strip
from evidentia.schema import (BUDGET_FILL, CHARS_PER_TOKEN, MAX_CONTEXT_TOKENS, MIN_PARTIAL_CHARS,
                              SECTION_MARKERS, SECTION_PRIORITY, START_SECTION, TRUNCATION_TAG)

SEPARATORS = {"compat": "\\n", "newline": "\n"}
MAX_HEADER_CHARS = 50
SECTION_TYPE = "array<struct<section_no:int,header:string,content:string>>"


def separator(mode: str) -> str:
    if mode not in SEPARATORS:
        raise ValueError(f"mode must be one of {sorted(SEPARATORS)}")
    return SEPARATORS[mode]


def _split_literal(text: Column, sep: str) -> Column:
    return F.split(text, "\\Q" + sep + "\\E", -1)


def header_of(line: Column) -> Column:
    """Section name a line opens (first marker it contains, if it is short), else null."""
    low = F.lower(py_strip(line))
    name = None
    for m in reversed(SECTION_MARKERS):
        hit = F.instr(low, m) > 0
        name = F.when(hit, F.lit(m)) if name is None else F.when(hit, F.lit(m)).otherwise(name)
    return F.when(F.length(low) < MAX_HEADER_CHARS, name)


def section_array(text, mode: str = "compat") -> Column:
    """array<struct<section_no, header, content>> in text order; text before
    the first header is section 0, ``start`` (absent if a header comes first).

    The lines, their header names and the header positions are each bound
    once (``let``) and shared by every section built from them."""
    sep = separator(mode)

    def build(lines, heads, hpos):
        n = F.size(lines)
        first = F.coalesce(F.get(hpos, 0), n)

        def sec(no, header, start0, stop0):
            return F.struct(no.alias("section_no"), header.alias("header"),
                            F.array_join(F.slice(lines, start0 + 1, stop0 - start0), sep)
                            .alias("content"))

        start = F.when(first > 0, F.array(sec(F.lit(0), F.lit(START_SECTION), F.lit(0), first)))
        rest = F.transform(hpos, lambda p, k: sec(k + 1, F.get(heads, p), p,
                                                  F.coalesce(F.get(hpos, k + 1), n)))
        return F.concat(F.coalesce(start, F.array().cast(SECTION_TYPE)), rest)

    def with_heads(lines):
        return let(F.transform(lines, header_of), lambda heads: let(
            F.filter(F.transform(heads, lambda h, i: F.when(h.isNotNull(), i)),
                     lambda p: p.isNotNull()),
            lambda hpos: build(lines, heads, hpos)))

    return let(_split_literal(col(text), sep), with_heads)


def split_sections(docs: DataFrame, key="doc_id", text="text", mode: str = "compat") -> DataFrame:
    """``(key, section_no, header, content)`` rows (a narrow explode)."""
    return docs.select(key, F.inline(section_array(text, mode)))


def fit_context(text, max_tokens: int = MAX_CONTEXT_TOKENS, mode: str = "compat",
                fill: float = BUDGET_FILL, min_partial: int = MIN_PARTIAL_CHARS) -> Column:
    """struct<text, truncated>: the paper text cut to the token budget.

    Under ``len // 4 <= max_tokens`` the text is kept. Otherwise sections are
    taken in priority order (abstract, introduction, method, result,
    discussion, start; then position) while ``len // 4 < 0.8 * max``; at the
    first one that does not fit, a cut piece is added if more than 1000
    chars remain, and the walk stops. Nothing eligible: the first
    ``4 * max`` chars.
    """
    sep = separator(mode)
    joiner = sep * 2
    limit = max_tokens * fill                      # compared with an int, as floats
    budget = int(max_tokens * CHARS_PER_TOKEN * fill)
    t = col(text)

    prio = F.create_map(*[x for i, h in enumerate(SECTION_PRIORITY) for x in (F.lit(h), F.lit(i))])
    ranked = F.array_sort(F.filter(
        F.transform(section_array(t, mode),
                    lambda s: F.struct(F.element_at(prio, s["header"]).alias("prio"),
                                       s["section_no"].alias("section_no"),
                                       s["content"].alias("content"))),
        lambda s: s["prio"].isNotNull()))

    # The walk carries scalars only (running length, sections kept, overflow
    # flag) - O(sections); the text is then cut once from the ranked array.
    init = F.struct(F.lit(0).cast("long").alias("cum"), F.lit(0).alias("kept"),
                    F.lit(False).alias("over"))

    def step(st, s):
        grown = st["cum"] + F.lit(len(joiner)) + F.length(s["content"])
        fits = F.floor(grown / F.lit(CHARS_PER_TOKEN)) < F.lit(limit)
        nxt = F.when(fits, F.struct(grown.alias("cum"), (st["kept"] + 1).alias("kept"),
                                    F.lit(False).alias("over"))) \
               .otherwise(F.struct(st["cum"].alias("cum"), st["kept"].alias("kept"),
                                   F.lit(True).alias("over")))
        return F.when(st["over"], st).otherwise(nxt)

    def assemble(ranked_arr, walk):
        kept = F.array_join(F.transform(F.slice(ranked_arr, F.lit(1), walk["kept"]),
                                        lambda x: F.concat(F.lit(joiner), x["content"])), "")
        remaining = F.lit(budget) - walk["cum"]
        first_out = F.get(ranked_arr, walk["kept"])["content"]
        cut = F.when(walk["over"] & (remaining > min_partial),
                     F.concat(F.lit(joiner), F.substr(first_out, F.lit(1), remaining.cast("int")),
                              F.lit(sep + TRUNCATION_TAG))).otherwise(F.lit(""))
        return F.when(walk["over"] | (walk["kept"] > 0), F.concat(kept, cut)) \
                .otherwise(F.substr(t, F.lit(1), F.lit(max_tokens * CHARS_PER_TOKEN)))

    chosen = let(ranked, lambda r: let(F.aggregate(r, init, step), lambda w: assemble(r, w)))
    fits_whole = F.floor(F.length(t) / F.lit(CHARS_PER_TOKEN)) <= F.lit(max_tokens)
    return F.struct(F.when(fits_whole, t).otherwise(chosen).alias("text"),
                    (~fits_whole).alias("truncated"))


def fit_documents(docs: DataFrame, key="doc_id", text="text", **kw) -> DataFrame:
    """``(key, text, truncated)`` with the text fitted to the budget."""
    return docs.select(key, fit_context(text, **kw).alias("_f")).select(key, "_f.*")

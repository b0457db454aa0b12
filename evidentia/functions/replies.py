"""Reply parsing as native Column expressions (no Python in the hot path).

A reply is split into stripped, non-blank lines. Every line is turned into one
*candidate* struct that says what each of the four accepted layouts would
write for the question the line belongs to:

====  =========================  ==================================  ==============
form  line                       answer                              on a set value
====  =========================  ==================================  ==============
1     ``**n. Field**: answer``   after first ``:``, ``**`` removed   overwrite
2     ``n. **Field**: answer``   after first ``**:``                 overwrite
3     ``n. Field: answer``       after first ``:``, ``*`` removed    only if unset
4     ``**n. Q**`` + ``**Answer**: x`` within the next 4 lines      only if unset
====  =========================  ==================================  ==============

The candidates of one question are then folded in line order with
``aggregate`` (one fold per question). A fold is needed rather than a "last
value" aggregate because the unset test reads the value *at that moment* and
an evidence string outlives later answer overwrites.

Everything stays inside one row: no explode, no shuffle.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from evidentia.functions.strings import (after_first, col, contains, let, py_strip, replace_all,
                                         starts_with)
from evidentia.schema import (ANSWER_MARKER, FIELD_COLUMNS, INCLUDE, INCLUDE_MARKER,
                              NOT_SPECIFIED, QUESTION_COLUMNS, QUESTION_STARTERS, QUESTIONS,
                              REASON_MARKER, EXCLUSION_REASON, SHORT_REPLY_CHARS, SOURCE_MARKER,
                              TITLE, source_column)

# A line belongs to question n when it starts with "**n." (bold) or "n." (plain),
# n in 1..12; "10." never reads as "1." and "1.5" reads as question 1.
ANY_NUM_RE = r"^(?:\*\*)?(1[0-2]|[1-9])\."
STARTER_RE = "^(?:" + "|".join(re.escape(s) for s in QUESTION_STARTERS) + ")"

LOOK_AHEAD = 4


def response_lines(response) -> Column:
    """Reply lines: split on newline, strip each, drop blanks."""
    return F.filter(F.transform(F.split(col(response), "\n"), py_strip),
                    lambda x: x != F.lit(""))


def is_question_echo(answer, strict: bool = True) -> Column:
    """True when an answer looks like the question repeated back.

    light: starts with one of the 13 question words (+ space);
    strict: also ends with '?' or mentions 'question' in under 50 chars.
    """
    a = col(answer)
    low = F.lower(a)
    echo = low.rlike(STARTER_RE)
    if strict:
        echo = echo | F.endswith(a, F.lit("?")) | (contains(low, "question") & (F.length(a) < 50))
    return echo


def screening_decision(lines) -> Column:
    """struct<include, reason>: text after the screening markers, last one wins."""
    lines = col(lines)

    def last_value(marker: str) -> Column:
        hit = F.try_element_at(F.filter(lines, lambda x: starts_with(x, marker)), F.lit(-1))
        return F.coalesce(py_strip(replace_all(hit, marker)), F.lit(NOT_SPECIFIED))

    return F.struct(last_value(INCLUDE_MARKER).alias("include"),
                    last_value(REASON_MARKER).alias("reason"))


def _first_ahead(facts: Column, i: Column, hit, depth: int = LOOK_AHEAD) -> Column:
    """Offset k (1..depth) of the first line after line i whose facts satisfy ``hit``."""
    expr = None
    for k in range(depth, 0, -1):
        cond = hit(F.get(facts, i + k))
        expr = F.when(cond, F.lit(k)) if expr is None else F.when(cond, F.lit(k)).otherwise(expr)
    return expr


def _marker_value(line: Column, marker: str) -> Column:
    return F.when(starts_with(line, marker), py_strip(replace_all(line, marker)))


def line_facts(x: Column) -> Column:
    """Per-line facts, computed once per line (one regex); look-aheads read these."""
    num = F.regexp_extract(x, ANY_NUM_RE, 1)
    n = F.when(num != F.lit(""), num.cast("int"))
    numbered = n.isNotNull()
    after_colon = py_strip(after_first(x, ":"))
    return F.struct(
        x.alias("line"),
        n.alias("n"),
        (numbered & starts_with(x, "**")).alias("bold"),
        contains(x, ":").alias("colon"),
        contains(x, "**").alias("stars"),
        _marker_value(x, SOURCE_MARKER).alias("src"),
        _marker_value(x, ANSWER_MARKER).alias("ans"),
        # answers, of numbered lines only; form 1: after the first ':', '**' removed; form 3: every '*' removed
        F.when(numbered, py_strip(replace_all(after_colon, "**"))).alias("a1"),
        F.when(numbered, py_strip(replace_all(after_colon, "*"))).alias("a3"),
        # form 2: after the first '**:'
        F.when(numbered, py_strip(after_first(x, "**:"))).alias("a2"),
    )


def line_candidate(facts: Column, f: Column, i: Column) -> Column:
    """What the four layouts would write for line ``f`` (index ``i`` in ``facts``)."""
    bold = f["bold"]
    plain = f["n"].isNotNull() & ~bold

    # form 1: first **Source**: within the next 4 lines, stop at the next **m.
    f1 = bold & f["colon"] & ~is_question_echo(f["a1"], strict=True) & (F.length(f["a1"]) > 3)
    k1 = _first_ahead(facts, i, lambda y: y["src"].isNotNull() | y["bold"])
    s1 = let(k1, lambda k: F.get(facts, i + k)["src"])

    # form 2: no filter, no evidence
    f2 = plain & contains(f["line"], "**:")

    # form 3: evidence on the very next line if it mentions 'source' and has ':'
    f3 = (plain & f["colon"] & (f["a3"] != F.lit("")) & ~is_question_echo(f["a3"], strict=False)
          & (F.length(f["a3"]) > 3))
    nxt = F.get(facts, i + 1)["line"]
    s3 = F.when(contains(F.lower(nxt), "source") & contains(nxt, ":"),
                py_strip(after_first(nxt, ":")))

    # form 4: **Answer**: within the next 4 lines (stop at any numbered line),
    # evidence on the line right after the answer
    k4 = _first_ahead(facts, i, lambda y: y["ans"].isNotNull() | y["n"].isNotNull())
    ahead = let(k4, lambda k: F.struct(F.get(facts, i + k)["ans"].alias("ans"), F.get(facts, i + k + 1)["src"].alias("src")))

    return let(ahead, lambda four: _candidate(f, i, f1, s1, f2, f3, s3, four))


def _candidate(f: Column, i: Column, f1, s1, f2, f3, s3, four: Column) -> Column:
    """The candidate of line ``f``; ``four``: form 4's answer and what stands behind it."""
    a4 = four["ans"]
    f4 = f["stars"] & (F.length(a4) > 3)
    s4 = F.when(a4.isNotNull(), four["src"])
    return F.struct(
        f["n"].alias("n"), i.alias("line_no"),
        F.coalesce(f1, F.lit(False)).alias("f1"), f["a1"].alias("a1"), s1.alias("s1"),
        F.coalesce(f2, F.lit(False)).alias("f2"), f["a2"].alias("a2"),
        F.coalesce(f3, F.lit(False)).alias("f3"), f["a3"].alias("a3"), s3.alias("s3"),
        F.coalesce(f4, F.lit(False)).alias("f4"), a4.alias("a4"), s4.alias("s4"),
    )


def reply_facts(lines) -> Column:
    """array<facts> for every line of a reply."""
    return F.transform(col(lines), line_facts)


def line_candidates(facts) -> Column:
    """array<candidate> for the numbered lines of a reply: their places first, then a candidate
    for each of these, so that lines of prose cost no more than a look at their number."""
    facts = col(facts)
    places = F.filter(F.transform(facts, lambda f, i: F.when(f["n"].isNotNull(), i)), lambda i: i.isNotNull())
    return F.transform(places, lambda i: let(F.get(facts, i), lambda f: line_candidate(facts, f, i)))


def _merge(state: Column, c: Column) -> Column:
    """One line's effect on (answer, source) of its question, forms 1..4 in order."""
    ns = F.lit(NOT_SPECIFIED)
    a, s = state["a"], state["s"]
    # form 1 and 2 overwrite
    a = F.when(c["f1"], c["a1"]).otherwise(a)
    s = F.when(c["f1"] & c["s1"].isNotNull(), c["s1"]).otherwise(s)
    a = F.when(c["f2"], c["a2"]).otherwise(a)
    # forms 3 and 4 fill only a value that is unset at that moment
    take3 = c["f3"] & (a == ns)
    a = F.when(take3, c["a3"]).otherwise(a)
    s = F.when(take3 & c["s3"].isNotNull(), c["s3"]).otherwise(s)
    take4 = c["f4"] & (a == ns)
    a = F.when(take4, c["a4"]).otherwise(a)
    s = F.when(take4 & c["s4"].isNotNull(), c["s4"]).otherwise(s)
    return F.struct(a.alias("a"), s.alias("s"))


def merge_answers(candidates, n: int) -> Column:
    """struct<a, s> for question ``n``: ordered fold over that question's candidates."""
    init = F.struct(F.lit(NOT_SPECIFIED).alias("a"), F.lit(NOT_SPECIFIED).alias("s"))
    return F.aggregate(F.filter(col(candidates), lambda c: c["n"] == F.lit(n)), init, _merge)


def is_short_response(response) -> Column:
    """Null, empty, or fewer than 10 chars once stripped: nothing is parsed."""
    r = col(response)
    return r.isNull() | (F.length(py_strip(r)) < SHORT_REPLY_CHARS)


def count_extracted(*fields) -> Column:
    """How many of the 24 answer/source fields differ from 'Not specified'."""
    names = fields or FIELD_COLUMNS
    return sum((F.col(f"`{c}`") != F.lit(NOT_SPECIFIED)).cast("int") for c in names)


def response_audit(response) -> Column:
    """struct<response_length, preview, is_empty> of a reply."""
    r = col(response)
    return F.struct(
        F.coalesce(F.length(r), F.lit(0)).cast("long").alias("response_length"),
        F.when(F.length(r) > 0, F.concat(F.substr(r, F.lit(1), F.lit(300)), F.lit("...")))
         .alias("preview"),
        (F.coalesce(F.length(r), F.lit(0)) == 0).alias("is_empty"),
    )


def answer_columns(folds: dict, short: Column, screening: Column) -> list:
    """The 26 non-title output columns from the folds, with the short-reply guard."""
    ns = F.lit(NOT_SPECIFIED)
    out = [F.when(short, ns).otherwise(screening["include"]).alias(INCLUDE),
           F.when(short, ns).otherwise(screening["reason"]).alias(EXCLUSION_REASON)]
    for n in QUESTIONS:
        name = QUESTION_COLUMNS[n]
        out.append(F.when(short, ns).otherwise(folds[n]["a"]).alias(name))
        out.append(F.when(short, ns).otherwise(folds[n]["s"]).alias(source_column(name)))
    return out


__all__ = [
    "response_lines", "is_question_echo", "screening_decision", "line_facts", "reply_facts",
    "line_candidate", "line_candidates", "merge_answers", "is_short_response", "count_extracted",
    "response_audit", "answer_columns", "TITLE",
]

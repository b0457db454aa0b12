"""Text preparation as Column expressions.

Only ``normalize_text`` leaves the JVM (Unicode NFKD has no Spark built-in);
it is a Python UDF on rows: a worker holds the 100 texts of a pickled batch,
not the 10,000 of an Arrow batch. Everything else is native.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidentia.functions.strings import col, py_split_words, py_strip
from evidentia.schema import (CHARS_PER_TOKEN, LAYOUT_MIN_CHARS, PLACEHOLDER_NOTE,
                              TITLE_LOWERCASE_WORDS)

MARKUP_RE = r"<[^<]+?>"


@F.udf(T.StringType(), useArrow=False)
def _nfkd(s):
    if s is None or s.isascii():
        return s
    # NFKD, then drop anything UTF-8 cannot encode (lone surrogates).
    return unicodedata.normalize("NFKD", s).encode("utf-8", errors="ignore").decode("utf-8")


def normalize_text(c) -> Column:
    """Unicode NFKD + lossy UTF-8 clean-up (Python UDF, small batches)."""
    return _nfkd(col(c))


def strip_markup(c) -> Column:
    """Delete ``<...>`` tags (tags only; script/style bodies and entities stay)."""
    return F.regexp_replace(col(c), MARKUP_RE, "")


def estimate_tokens(c) -> Column:
    """``len(text) // 4`` in code points."""
    return F.floor(F.length(col(c)) / F.lit(CHARS_PER_TOKEN)).cast("long")


def file_name_of(path) -> Column:
    """Last path component (``Path(p).name``)."""
    return F.regexp_extract(col(path), r"[^/]*$", 0)


def file_stem(name) -> Column:
    """``Path(name).stem``: drop the last ``.suffix`` unless the dot leads."""
    return F.regexp_replace(file_name_of(name), r"(?s)^(.+)\.[^.]+$", "$1")


def format_title(file_name) -> Column:
    """Title from a file name: stem, ``_``/``-`` to spaces, words capitalized,
    the fixed small words lower-cased unless first."""
    words = py_split_words(F.translate(file_stem(file_name), "_-", "  "))
    small = F.array(*[F.lit(w) for w in TITLE_LOWERCASE_WORDS])
    return F.array_join(
        F.transform(words, lambda w, i: F.when((i > 0) & F.array_contains(small, F.lower(w)),
                                               F.lower(w)).otherwise(F.initcap(w))),
        " ")


LAYOUT_TYPE = "array<struct<lines:array<struct<spans:array<struct<text:string>>>>>>"


def layout_from_json(c) -> Column:
    """Parse a page layout stored as JSON (``{"blocks": [...]}``) into the
    nested blocks array; absent keys read as null and are skipped later."""
    return F.from_json(col(c), f"struct<blocks:{LAYOUT_TYPE}>")["blocks"]


def layout_texts(blocks) -> Column:
    """The texts of all spans of all lines of all blocks, in order; missing levels and texts skipped."""
    def line_texts(line):
        return F.coalesce(F.transform(line["spans"], lambda s: s["text"]), F.array())

    def block_texts(block):
        return F.coalesce(F.flatten(F.transform(block["lines"], line_texts)), F.array())

    return F.filter(F.flatten(F.transform(col(blocks), block_texts)), lambda t: t.isNotNull())


def flatten_layout(blocks) -> Column:
    """blocks -> lines -> spans -> text, joined by one space; missing levels skipped."""
    return F.array_join(layout_texts(blocks), " ")


def _short(c: Column, n: int) -> Column:
    return c.isNull() | (F.length(py_strip(c)) < n)


def page_mode_chain(text, layout_text, html) -> Column:
    """Plain text; if under 20 stripped chars the layout text (even if empty);
    if still short and html is non-empty, the tag-stripped html."""
    t = F.when(_short(col(text), LAYOUT_MIN_CHARS), col(layout_text)).otherwise(col(text))
    h = col(html)
    return F.when(_short(t, LAYOUT_MIN_CHARS) & h.isNotNull() & (h != F.lit("")),
                  strip_markup(h)).otherwise(t)


def placeholder_text(file_name, is_pdf, title=None, author=None, page_count=None) -> Column:
    """Stand-in text for a PDF no method could read; ``""`` for a non-PDF."""
    def opt_line(label: str, v) -> Column:
        if v is None:
            return F.lit("")
        v = col(v)
        return F.when(v.isNotNull() & (v.cast("string") != F.lit("")),
                      F.concat(F.lit(f"\n{label}: "), v.cast("string"))).otherwise(F.lit(""))

    text = F.concat(F.lit("Title: "), file_stem(file_name),
                    opt_line("Extracted title", title), opt_line("Extracted author", author),
                    opt_line("Page count", page_count), F.lit("\n\n" + PLACEHOLDER_NOTE))
    return F.when(col(is_pdf), text).otherwise(F.lit(""))

"""Small string helpers with Python ``str`` semantics, as native Column exprs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from evidentia.schema import PY_WHITESPACE

# One regex class equal to str.isspace (Java's (?U)\s lacks U+001C..U+001F).
WS_CLASS = r"(?U)[\s\x1c-\x1f]"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """``str.strip()``: remove every Unicode whitespace char at both ends."""
    return F.btrim(col(c), F.lit(PY_WHITESPACE))


def py_split_words(c) -> Column:
    """``str.split()`` with no argument: runs of whitespace, no empty items."""
    return F.filter(F.split(py_strip(c), WS_CLASS + "+"), lambda w: w != F.lit(""))


def after_first(c, sep: str) -> Column:
    """``s.split(sep, 1)[1]``; null when ``sep`` does not occur."""
    c = col(c)
    pos = F.instr(c, sep)
    return F.when(pos > 0, F.substr(c, pos + F.lit(len(sep))))


def replace_all(c, search: str, repl: str = "") -> Column:
    """``s.replace(search, repl)`` (every occurrence, literal)."""
    return F.replace(col(c), F.lit(search), F.lit(repl))


def starts_with(c, prefix: str) -> Column:
    return F.startswith(col(c), F.lit(prefix))


def contains(c, needle: str) -> Column:
    return F.instr(col(c), needle) > 0


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a lambda variable.

    Lambda bodies get no common-subexpression elimination, so an array used
    several times inside one (e.g. a paper's lines, read once per section)
    would be recomputed at every use; binding it here computes it once.
    """
    return F.get(F.transform(F.array(value), body), 0)

"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust the score.

Native: everything is a column expression over one row, without a shuffle.

Kinds ``email``, ``ip``, ``card`` and ``phone`` are the base; their spans always
stay. ``iban`` (mod-97) and ``ssn`` are added where their score reaches
``THRESHOLD`` and they overlap no base span. A span's score is the prior of its
kind, plus the bonus of a passed checksum, plus the bonus of a context word
within ``NEAR`` characters, at most 1.

The patterns are written so that the regular-expression engine of the JVM
neither recurses nor backtracks over long runs: repeats are possessive, and a
match may start in a run of its first class only at the run's start or where the
last match ended (further inside, the same match would have begun earlier).

Defined results: a null text counts as '' (no spans; redaction leaves it null);
spans are in code points, the end exclusive; repeated rows come back each; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import id_text

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
THRESHOLD = 0.6
NEAR = 50

#: Lengths of account numbers by country code; a code that is not listed may have 15 to 34 characters.
IBAN_LENGTHS = {15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
                22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
                25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
                28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
                31: "MT SC", 32: "LC", 33: "RU"}
_IBANS = [rf"(?:{'|'.join(codes.split())})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, codes in IBAN_LENGTHS.items()]
_LISTED = "|".join(c for codes in IBAN_LENGTHS.values() for c in codes.split())

_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
_UP_TO_255 = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # a whole chain of digits with single separators between them, of 16 to 19 digits
    "card": r"[0-9](?<![0-9][0-9])(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # a look-ahead, so that a number inside a wrong candidate is proposed too
    "iban": rf"(?<![A-Za-z0-9])(?=((?:{'|'.join(_IBANS)}|(?!{_LISTED})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}}+)(?![A-Za-z0-9])))",
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
}
#: A text without this has no match; a plain search is cheaper than the pattern.
NEEDS = {"email": lambda t: t.contains("@"), "phone": lambda t: t.contains("+"),
         "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"), "card": lambda t: t.rlike(r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]"),
         "iban": lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}"), "ssn": lambda t: t.rlike(r"[0-9]{3}-[0-9]{2}-")}
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.3, "phone": 0.6, "iban": 0.3, "ssn": 0.3}
CHECKED, CONTEXT = 0.4, 0.3
WORDS = {"email": "e-?mail|contact|write to|reach", "ip": r"\bip\b|address|server|host", "card": "card|visa|master|amex|payment|credit",
         "phone": "phone|call|mobile|fax|tel", "iban": "iban|account|bank|transfer", "ssn": r"ssn|social security"}


def _matches(text, kind: str):
    """Array of (start, end, found) of a kind's matches, in code points."""
    p, ahead = F.lit(PATTERNS[kind]), kind == "iban"
    # a match of no width at the very start would not split: a line end is put in front
    found, between = F.regexp_extract_all(text, p, F.lit(int(ahead))), F.split(F.concat(F.lit("\n"), text) if ahead else text, PATTERNS[kind], -1)
    none = F.expr("cast(array() as array<struct<start:int,end:int,found:string>>)")

    def add(state, x):
        start = state["at"] + F.char_length(x["between"])
        end = start + F.char_length(x["found"])
        span = F.struct(start.alias("start"), end.alias("end"), x["found"].alias("found"))
        return F.when(x["found"].isNull(), state).otherwise(
            F.struct((start if ahead else end).alias("at"), F.concat(state["spans"], F.array(span)).alias("spans")))

    zipped = F.arrays_zip(between.alias("between"), found.alias("found"))
    walked = F.aggregate(zipped, F.struct(F.lit(-1 if ahead else 0).alias("at"), none.alias("spans")), add)["spans"]
    return F.when(NEEDS[kind](text), walked).otherwise(none)


def _digits(found):
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits):
    """Whether a string of digits passes the Luhn check."""
    back = F.reverse(digits)

    def add(total, i):
        d = F.substring(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return (F.length(digits) > 0) & (F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))), F.lit(0), add) % 10 == 0)


def mod97(found):
    """Whether an account number (letters, digits, spaces) leaves 1 under mod 97."""
    s = F.regexp_replace(found, " ", "")
    turned = F.concat(F.substring(s, F.lit(5), F.length(s)), F.substring(s, 1, 4))

    def add(rest, c):
        letter = F.ascii(c) > 57
        return (rest * F.when(letter, 100).otherwise(10) + F.ascii(c) - F.when(letter, 55).otherwise(48)) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), add) == 1


def _confirmed(kind: str, found):
    if kind == "ip":
        return found.rlike(rf"^{_UP_TO_255}(?:\.{_UP_TO_255}){{3}}$")
    if kind == "card":
        return luhn(_digits(found))
    if kind == "phone":
        return F.length(_digits(found)).between(8, 15)
    return mod97(found) if kind == "iban" else F.lit(True)


def _scored(text, kind: str, spans):
    """Confirmed spans with their kind and score."""

    def score(x):
        left = F.greatest(x["start"] - NEAR, F.lit(0))
        around = F.concat(F.substring(text, left + 1, x["start"] - left), F.lit(" "), F.substring(text, x["end"] + 1, F.lit(NEAR)))
        near = F.lower(around).rlike(WORDS[kind])
        checked = CHECKED if kind in ("card", "iban") else 0.0
        value = F.least(F.lit(PRIOR[kind] + checked) + F.when(near, CONTEXT).otherwise(0.0), F.lit(1.0))
        return F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["found"].alias("found"),
                        value.cast("double").alias("score"))

    confirmed = F.filter(spans, lambda x: _confirmed(kind, x["found"]))
    if kind == "iban":  # of two that overlap, the first
        confirmed = F.aggregate(confirmed, F.slice(confirmed, 1, 0), lambda kept, x: F.when(
            F.exists(kept, lambda y: x["start"] < y["end"]), kept).otherwise(F.concat(kept, F.array(x))))
    return F.transform(confirmed, score)


def with_spans(docs: DataFrame, text_col: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` with ``out``: array of (kind, start, end, found, score), by kind as in ``KINDS``, then start."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    part = {k: f"__{out}_{k}" for k in KINDS}
    df = docs.withColumns({part[k]: _matches(text, k) for k in KINDS})
    df = df.withColumns({part[k]: _scored(text, k, F.col(part[k])) for k in KINDS})
    df = df.withColumn(out, F.concat(*[F.col(part[k]) for k in BASE]))
    for k in KINDS[len(BASE):]:
        def new(x, y):
            return (x["start"] < y["end"]) & (y["start"] < x["end"])
        more = F.filter(F.col(part[k]), lambda x: (x["score"] >= THRESHOLD) & ~F.exists(F.col(out), lambda y: new(x, y)))
        df = df.withColumn(out, F.concat(F.col(out), more))
    return df.drop(*part.values())


def _listed(spans):
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores."""
    df = with_spans(id_text(docs, id_col, text_col))
    def of(kind):
        return F.size(F.filter("pii", lambda x: x["kind"] == kind)).cast("long")

    base = F.filter("pii", lambda x: x["kind"].isin(*BASE))
    return df.select("doc_id", *[of(k).alias(f"n_{k}") for k in BASE], F.sha2(_listed(base), 256).alias("base_sha256"),
                     _listed(F.col("pii")).alias("spans"),
                     F.array_join(F.transform("pii", lambda x: F.format_number(x["score"], 1)), ",").alias("scores"))


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with each span replaced by its kind in brackets (a span that begins
    inside an earlier one goes with it); ``length_col`` gets the new length."""
    # the user's columns travel as one struct, so that no name of theirs meets one of ours
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    df = with_spans(rows, "text", "spans")
    text = F.col("text")
    ordered = F.array_sort("spans", lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["end"] - a["end"]))

    def cut(state, x):
        inside = x["start"] < state["at"]
        kept = F.concat(state["out"], F.substring(text, state["at"] + 1, x["start"] - state["at"]), F.lit("["), F.upper(x["kind"]), F.lit("]"))
        return F.struct(F.greatest(state["at"], x["end"]).alias("at"), F.when(inside, state["out"]).otherwise(kept).alias("out"))

    done = F.aggregate(ordered, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), cut,
                       lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.char_length(text))))
    found = F.size("spans") > 0
    df = df.select("row", found.alias("found"), F.when(text.isNotNull() & found, done).otherwise(text).alias("text"))

    def column(c: str):
        if c == text_col:
            return F.col("text").alias(c)
        own = F.col("row")[c]
        if c == length_col:
            return F.when(F.col("found"), F.char_length("text").cast(docs.schema[c].dataType)).otherwise(own).alias(c)
        return own.alias(c)

    return df.select(*[column(c) for c in docs.columns])

"""Secret scan: base patterns, and a battery of randomness tests under false-discovery control.

Base kinds ``assign``, ``access`` and ``hex`` are patterns; their spans always
stay. Every other run of 20 or more characters of the base-64 alphabets is a
candidate of kind ``random``. A battery tests it as a random string of each encoding
whose alphabet holds it (hex, base32, base36, base62, base64, base64url, all signs):

* chi-squared: symbols, put into classes of known share (digits, vowels and
  other letters by case, signs), are as frequent as in uniform draws;
* runs: the number of runs of symbols above and below the alphabet's median
  (Wald and Wolfowitz);
* serial correlation of neighbouring symbols.

A string whose smallest p-value (times the number of tests) is below
``UNLIKELY`` in all of them is no random string. What is left needs evidence that it is no
word either: the p-value of the number of times its characters change class
(lower, upper, digit, sign), under a binomial law in which text changes class at
``TEXT_CHANGES`` of its places. That law has the length in it, so a short string
must change class much more often than a long one, and short and long strings
don't share one bar: the p-values of all documents are ranked within their
length class, and Benjamini and Hochberg's rule at rate ``RATE`` gives each class
its threshold. Counts by length class and p-value step (a table of fixed size)
are summed up over all documents.

Defined results: a null text counts as '' (no spans); spans are in code
points, the end exclusive; repeated rows come back each, and each counts in the
ranking; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidentia.llm.common import id_text, stage

RATE = 0.01
UNLIKELY = 0.001
TEXT_CHANGES = 0.08
#: Tenths of a power of ten: the steps in which p-values are counted.
STEPS = 400
LENGTH_CLASSES = (24, 32, 48, 64, 128, 256)

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
#: Runs of at least this length are the runs of any length that are kept: a run's first match takes all of it.
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
_BASE62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
#: Alphabets by encoding; a string is tested against each one that holds all of its symbols.
ALPHABETS = {"hex": "0123456789abcdef", "HEX": "0123456789ABCDEF", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
             "base32 lower": "abcdefghijklmnopqrstuvwxyz234567", "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
             "base36 upper": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", "base62": _BASE62, "base64": _BASE62 + "+/", "base64url": _BASE62 + "-_",
             "signs": _BASE62 + "+/-_"}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the base kinds, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def encodings_of(s: str) -> list[str]:
    symbols = set(s)
    return [name for name, alphabet in ALPHABETS.items() if symbols <= set(alphabet)]


def _class(c: str) -> int:
    """Digit, vowel or other letter by case, sign."""
    if c.isdigit():
        return 0
    return (1 + 2 * c.isupper() + (c in "aeiouAEIOU")) if c.isalpha() else 5


def chi_squared_tail(x: float, k: int) -> float:
    """P(X >= x) for k degrees of freedom (Wilson and Hilferty)."""
    if k < 1:
        return 1.0
    z = ((x / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))
    return 0.5 * math.erfc(z / math.sqrt(2))


def two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def battery(s: str, alphabet: str) -> float:
    """The smallest p-value of the tests, times their number: s as uniform draws from the alphabet."""
    n, size = len(s), len(alphabet)
    share, seen = [0] * 6, [0] * 6
    for c in alphabet:
        share[_class(c)] += 1
    for c in s:
        seen[_class(c)] += 1
    used = [i for i in range(6) if share[i]]
    x = sum((seen[i] - n * share[i] / size) ** 2 / (n * share[i] / size) for i in used)
    p = [chi_squared_tail(x, len(used) - 1)]
    place = {c: i for i, c in enumerate(alphabet)}
    at = [place[c] for c in s]
    high = [a >= size / 2 for a in at]
    n1 = sum(high)
    n0 = n - n1
    if n0 and n1:
        runs = 1 + sum(a != b for a, b in zip(high, high[1:], strict=False))
        mean = 2 * n0 * n1 / n + 1
        variance = (mean - 1) * (mean - 2) / (n - 1)
        p.append(two_sided((runs - mean) / math.sqrt(variance)) if variance > 0 else 1.0)
    else:
        p.append(2.0 ** (1 - n))
    mean = sum(at) / n
    spread = sum((a - mean) ** 2 for a in at)
    r = sum((a - mean) * (b - mean) for a, b in zip(at, at[1:], strict=False)) / spread if spread else 1.0
    p.append(two_sided(r * math.sqrt(n)))
    return min(1.0, len(p) * min(p))


def log_tail(n: int, k: int, q: float) -> float:
    """-log10 of P(X >= k), X binomial(n, q)."""
    if k <= 0:
        return 0.0
    top = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(q) + (n - i) * math.log1p(-q) for i in range(k, n + 1)]
    most = max(top)
    return max(0.0, -(most + math.log(sum(math.exp(t - most) for t in top))) / math.log(10))


def text_step(s: str) -> int:
    """The p-value of s's class changes as text: p <= 10 ** (-step / 10)."""
    kind = [0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 for c in s]
    changes = sum(a != b for a, b in zip(kind, kind[1:], strict=False))
    return min(STEPS, int(10 * log_tail(len(s) - 1, changes, TEXT_CHANGES)))


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(start, end, length class, step) of the candidates outside the base spans, and whether each passes as random:
    a step of -1 marks one that does not."""
    out, i = [], 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while i < len(base) and base[i][2] <= start:
            i += 1
        if any(b[0] < end and start < b[2] for b in base[i:i + 4]):
            continue
        s = m[0].rstrip("=")
        step = text_step(s)
        if step and all(battery(s, ALPHABETS[e]) < UNLIKELY for e in encodings_of(s)):
            step = -1
        out.append((start, end, sum(len(s) >= c for c in LENGTH_CLASSES), step))
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, base (start, kind, end) and found (start, end, length_class, step)."""

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow:
            base, found = [], []
            for t in batch.column("text").to_pylist():
                spans = base_spans(t)
                base.append([{"start": a, "kind": k, "end": b} for a, k, b in spans])
                found.append([{"start": a, "end": b, "length_class": c, "step": s} for a, b, c, s in candidates(t, spans)])
            yield pa.record_batch([batch.column("doc_id"), pa.array(base, _BASE), pa.array(found, _FOUND)], ["doc_id", "base", "found"])

    return id_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, base array<struct<start:long,kind:int,end:long>>, "
             "found array<struct<start:long,end:long,length_class:int,step:int>>")


_BASE = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
_FOUND = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("length_class", pa.int32()), ("step", pa.int32())]))


def thresholds(scanned: DataFrame, rate: float = RATE) -> DataFrame:
    """length_class, least: the smallest step that Benjamini and Hochberg's rule accepts.
    At most 7 rows. A candidate that is no random string counts with p-value 1."""
    c = scanned.select(F.explode("found").alias("c")).select("c.length_class", F.greatest("c.step", F.lit(0)).alias("step"))
    counts = c.groupBy("length_class", "step").agg(F.count(F.lit(1)).alias("n"))
    mine = Window.partitionBy("length_class")
    ranked = counts.withColumn("rank", F.sum("n").over(mine.orderBy(F.desc("step")))).withColumn("m", F.sum("n").over(mine))
    ok = F.pow(F.lit(10.0), -F.col("step") / 10) * F.col("m") <= rate * F.col("rank")
    return ranked.filter(ok & (F.col("step") > 0)).groupBy("length_class").agg(F.min("step").alias("least"))


def find_secrets(docs: DataFrame, rate: float = RATE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random."""
    scanned = stage(scan(docs, id_col, text_col), "secrets")  # spans only, a small share of the text
    least = [F.lit(x) for r in thresholds(scanned, rate).collect() for x in (r["length_class"], r["least"])]  # at most 7 rows
    bar = F.create_map(*least) if least else F.expr("cast(map() as map<int,int>)")
    random = F.filter("found", lambda x: x["step"] >= F.coalesce(bar[x["length_class"]], F.lit(STEPS + 1)))
    random = F.transform(random, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), x["end"].alias("end")))
    df = scanned.select("doc_id", "base", random.alias("random"))
    names = F.array(*[F.lit(k) for k in KINDS])

    def listed(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", names[x["kind"]], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def of(kind: str):
        return F.size(F.filter("base", lambda x: x["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    every = F.sort_array(F.concat("base", "random"))
    return df.select("doc_id", *[of(k) for k in KINDS[:3]], F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(every).alias("spans"),
                     F.size("random").cast("long").alias("n_random"))

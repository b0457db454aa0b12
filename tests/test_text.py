"""Text preparation functions against Python's own string semantics."""

import unicodedata

from pyspark.sql import functions as F

from evidentia.functions.text import (estimate_tokens, file_stem, flatten_layout, format_title,
                                      normalize_text, page_mode_chain, placeholder_text,
                                      strip_markup)
from evidentia.functions.strings import py_split_words, py_strip


def _col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_titles(spark):
    names = ["garden-tools_for-the_north.pdf", "a.b.PDF", ".pdf", "WINTER_and_OF.pdf", "dir/sub/x_in_y.pdf",
             "  spaced__out--name  .pdf", "ßtraße_über.pdf", "of_of_of.x", "3d-printing_at_home.v2.pdf"]
    assert _col(spark, names, format_title) == [
        "Garden Tools for the North", "A.b", ".pdf", "Winter and of", "X in Y", "Spaced Out Name", "Sstraße Über",
        "Of of of", "3d Printing at Home.v2"]


def test_stem_matches_pathlib(spark):
    from pathlib import Path
    names = ["a.pdf", "a.b.c", ".hidden", "a.", "..pdf", "noext", "x/y/z.tar.gz"]
    assert _col(spark, names, file_stem) == [Path(n).stem for n in names]


def test_strip_and_split_match_python(spark):
    vals = ["　 a b \x1c", "\t\n", "x", "", " a  b "]
    assert _col(spark, vals, py_strip) == [v.strip() for v in vals]
    assert _col(spark, vals, py_split_words) == [v.split() for v in vals]


def test_estimate_tokens(spark):
    vals = ["", "abc", "abcd", "é" * 9]
    assert _col(spark, vals, estimate_tokens) == [len(v) // 4 for v in vals]


def test_strip_markup(spark):
    import re
    vals = ["<p>a<b>b</b></p>", "<script>x<y</script>", "a < b > c", "<<a>>"]
    assert _col(spark, vals, strip_markup) == [re.sub("<[^<]+?>", "", v) for v in vals]


def test_normalize_text(spark):
    vals = ["café", "ﬁ ligature", "plain", None, "Å½", "ｆｕｌｌ　ｗｉｄｔｈ", "ế ộ", "a\u0323\u0302", "a\u0302\u0323"]
    want = [None if v is None else unicodedata.normalize("NFKD", v) for v in vals]
    assert _col(spark, vals, normalize_text) == want


def test_normalization_takes_rows_not_arrow_batches(spark):
    """A worker holds a small batch of texts, however many rows a task has (an Arrow batch has 10,000)."""
    from evidentia.plans.queries import _nfc
    vals = ["ﬁx é " * 500 + str(i) for i in range(250)] + [None]
    df = spark.createDataFrame([(v,) for v in vals], "v string").select(normalize_text("v").alias("n"), _nfc(normalize_text("v")).alias("c"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
    d = [None if v is None else unicodedata.normalize("NFKD", v) for v in vals]
    assert sorted(map(tuple, df.collect()), key=str) == sorted(((x, x and unicodedata.normalize("NFC", x)) for x in d), key=str)


def test_page_mode_chain(spark):
    rows = [("a long enough page text here", "layout", "<p>html</p>"),
            ("short", "layout text that is long", "<p>h</p>"),
            ("short", "tiny", "<p>html body</p>"),
            ("short", "tiny", ""),
            (None, None, None)]
    df = spark.createDataFrame(rows, "t string, l string, h string")
    got = [r[0] for r in df.select(page_mode_chain("t", "l", "h")).collect()]
    assert got == ["a long enough page text here", "layout text that is long", "html body",
                   "tiny", None]


def test_flatten_layout(spark):
    df = spark.createDataFrame(
        [([{"lines": [{"spans": [{"text": "a"}, {"text": None}, {"text": "b"}]}]},
           {"lines": None}, {"lines": [{"spans": None}, {"spans": [{"text": "c"}]}]}],)],
        "blocks array<struct<lines:array<struct<spans:array<struct<text:string>>>>>>")
    assert df.select(flatten_layout("blocks")).first()[0] == "a b c"


def test_placeholder_text(spark):
    df = spark.createDataFrame([("x/paper.one.pdf", True, "T", "", 3), ("b.pdf", False, None, None, None),
                                ("c.pdf", True, None, None, None)],
                               "f string, p boolean, t string, a string, n int")
    got = [r[0] for r in df.select(placeholder_text("f", "p", "t", "a", "n")).collect()]
    assert got[0].startswith("Title: paper.one\nExtracted title: T\nPage count: 3\n\nNote: ")
    assert got[1] == ""
    assert got[2].startswith("Title: c\n\nNote: This PDF appears")
    assert "including OCR" in got[2]


def test_layout_from_json(spark):
    from evidentia.functions.text import layout_from_json
    js = ('{"blocks": [{"lines": [{"spans": [{"text": "Deep"}, {"size": 9}]}, {"spans": [{"text": "nets"}]}]},'
          ' {"type": 1}, {"lines": [{"bbox": [0, 1]}]}]}')
    df = spark.createDataFrame([(js,), ("not json",)], "j string")
    got = [r[0] for r in df.select(flatten_layout(layout_from_json("j"))).collect()]
    assert got == ["Deep nets", None]

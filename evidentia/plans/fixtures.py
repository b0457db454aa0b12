"""Inputs derived from the driver tables, written once in SQL both engines run.

No table holds model replies, page candidates or file names, so they are
*derived* from ``documents`` / ``conversations`` by plain SQL that Spark SQL
and DuckDB evaluate identically (``||``, ``CASE``, ``split_part``, ``chr``,
``CAST .. AS STRING``). Every row of the source table is kept; the layout of a
generated reply is chosen by ``doc_id % 8`` so all eight reply layouts occur.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame

NL = " || chr(10) || "


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _lines(*parts: str) -> str:
    return "(" + NL.join(parts) + ")"


def _placeholder_sql() -> str:
    from evidentia.schema import PLACEHOLDER_NOTE
    return "'Title: web' || chr(10) || chr(10) || " + _q(PLACEHOLDER_NOTE)


# The papers: every document with its whole text, and a file for every row of
# ``pages`` (negative keys), so that each outcome occurs beside the documents:
# kind 0 has no text, 1 the stand-in text, 2 a failed call, 3 a short reply.
PAPER_COLUMNS = {
    "documents": ["doc_id", "text AS head", "text", "lang", "source", "n_chars", "-1 AS kind"],
    "pages": ["-1 - page_id AS doc_id", "'page file ' || CAST(page_id AS STRING) AS head",
              f"CASE page_id % 4 WHEN 0 THEN '' WHEN 1 THEN {_placeholder_sql()} ELSE html END AS text",
              "'en' AS lang", "'web' AS source", "CAST(length(html) AS BIGINT) AS n_chars",
              "CAST(page_id % 4 AS INT) AS kind"],
}
PAPERS_SQL = " UNION ALL ".join(f"SELECT {', '.join(c)} FROM {t}" for t, c in PAPER_COLUMNS.items())

S = "source"
G = "lang"
N = "CAST(n_chars AS STRING)"
T = "text"
# The k-th space-separated word of the name, by an anchored regex that stops at
# the k-th space instead of splitting the whole text.
W1 = "regexp_extract(head, '^([^ ]*)', 1)"
W2 = "regexp_extract(head, '^[^ ]* ([^ ]*)', 1)"
W3 = "regexp_extract(head, '^[^ ]* [^ ]* ([^ ]*)', 1)"

INC_Y = _q("**Include in Review**: Y")


def _said(label: str, *values: str) -> str:
    """``label`` followed by values of the paper."""
    return " || ".join([_q(label), *values])


# Each layout carries the paper's whole text: as an answer or a source, whose
# first line it then is, with the other lines as prose behind it.
REPLIES = {
    # bold number; one answer too short, one echoed question, one source missing
    0: _lines(INC_Y, _said("**Reason if excluded**: none in ", G), "''",
              _said("**1. A**: ", T), _said("**Source**: ", S), _said("**2. B**: ", S, "' / '", G),
              _said("**Source**: ", T), _said("**3. C**: ", N), _said("**Source**: ", G), _q("**4. D**: xy"),
              _said("**7. E**: What of ", G, "'?'"), _said("**Answer**: ", W1, "' '", N), _said("**Source**: ", W2),
              _said("**8. F**: ", W3, "' '", S), _said("**12. G**: ", N, "' characters'"), _said("**Source**: ", W1)),
    # number, bold field; an empty answer, a literal 'Not specified', plain evidence
    1: _lines(INC_Y, _said("1. **A**: ", S), _said("**Source**: ", W1), _q("2. **B**: Not specified"), _said("**Source**: ", N),
              _q("3. **C**: xy"), _q("4. **D**:"), _said("5. **E:** ", T), _said("Source: ", N), _said("6. **F**: ", W1, "' '", G)),
    # plain number and field
    2: _lines(INC_Y, _q("**Reason if excluded**: "), _said("1. A: ", S), _said("Source: ", N), _said("2. B: *", G, "'* '", W2),
              _said("Some source here: ", T), _q("3. C: What is it"), _said("5.2 E: ", T), _q("7. G: Are there any"),
              _said("9. I: ", W3, "' '", N), _said("10. J: ", G), _said("12. L: ", N, "' of '", S)),
    # echoed question, then answer and source
    3: _lines(INC_Y, _q("**1. A**: Who is it about?"), _said("**Answer**: ", T), _said("**Source**: ", W1),
              _q("**2. B**: Where was it?"), _said("**Answer**: ", S, "' in '", G), _said("**Source**: ", T),
              _q("**11. K**: How is it known?"), "''", _q("**12. L**: Which ones?"), _q("**Answer**: xyz"), _said("**Answer**: ", N, "' items'")),
    # excluded, the text as its reason
    4: _lines(_q("**Include in Review**: N"), _said("**Reason if excluded**: ", T)),
    # prose without any layout
    5: T,
    # repeated questions, late decisions
    6: _lines(INC_Y, _q("**1. A**: Not specified"), _q("**Source**: Not specified"), _said("**1. A**: ", S, "' '", G),
              _said("**3. C**: ", T), _said("**Source**: ", W2), _said("**3. C**: ", G, "' again'"), _said("**4. D**: ", S),
              _q("**Source:** wrong colon"), _q("**Include in Review**: Y")),
    # layouts mixed
    7: _lines(_said("1. A: ", T), _said("**2. B**: ", S), _said("3. **C**: ", G), _q("**6. F**: Does it?"), _said("**Answer**: ", T), INC_Y),
}
SHORT_REPLY = _said("N/A ", G)

RESPONSE_EXPR = (f"CASE kind WHEN 2 THEN NULL WHEN 3 THEN {SHORT_REPLY} ELSE CASE abs(doc_id) % 8 "
                 + " ".join(f"WHEN {k} THEN {v}" for k, v in REPLIES.items()) + " END END")
ERROR_EXPR = f"CASE WHEN kind = 2 THEN 'Request failed: timeout after ' || {N} || ' chars' END"

# A file name per paper: source, three leading words and the language.
FILE_NAME_EXPR = f"{S} || '_' || {W1} || '-' || {W2} || '_' || {W3} || '-' || {G} || '.pdf'"

AUDIT_ERROR_EXPR = "CASE WHEN kind = 2 THEN 'unreadable file' END"


def papers(documents, pages=None):
    """The rows of ``PAPERS_SQL``; without ``pages`` the documents only."""
    out = documents.selectExpr(*PAPER_COLUMNS["documents"])
    return out if pages is None else out.unionByName(pages.selectExpr(*PAPER_COLUMNS["pages"]))


def _papers(df):
    return df if "kind" in df.columns else papers(df)


def responses(documents):
    """Generated replies ``(doc_id, response, error)`` for every paper."""
    return _papers(documents).selectExpr("doc_id", f"{RESPONSE_EXPR} AS response",
                                         f"{ERROR_EXPR} AS error")


def named_documents(documents):
    """``(doc_id, file_name, text)`` for every paper."""
    return _papers(documents).selectExpr("doc_id", f"{FILE_NAME_EXPR} AS file_name", "text")


# ---------------------------------------------------------------- pages
# Three extraction modes of a web page: the plain text is the whole title,
# the layout text the whole advertising block, and the raw html.
PAGE_TITLE = "regexp_extract(html, '<title>(.*?)</title>', 1)"
PAGE_TEXT_EXPR = PAGE_TITLE
PAGE_LAYOUT_EXPR = "regexp_extract(html, '<div class=\"ad\">(.*?)</div>', 1)"

# Conversation turns stand for the pages of a paper (conv_id = paper,
# turn = page); the role decides which extraction method produced the page. A
# method that read nothing from a page is an empty row beside it.
CAND_METHOD_EXPR = ("CASE role WHEN 'system' THEN 'text_layer' WHEN 'user' THEN 'layout' "
                    "ELSE 'ocr' END")
CANDIDATES = [["conv_id AS doc_id", f"{CAND_METHOD_EXPR} AS method", "turn AS page_no", "text"],
              ["conv_id AS doc_id", "CASE role WHEN 'user' THEN 'text_layer_tolerant' WHEN 'system' THEN 'reader' "
               "ELSE 'cli' END AS method", "turn AS page_no", "CASE role WHEN 'assistant' THEN ' ' ELSE '' END AS text"]]
CANDIDATES_SQL = " UNION ALL ".join(f"SELECT {', '.join(c)} FROM conversations" for c in CANDIDATES)


def candidates(conversations):
    """``(doc_id, method, page_no, text)``: the rows of ``CANDIDATES_SQL``."""
    first, second = (conversations.selectExpr(*c) for c in CANDIDATES)
    return first.unionByName(second)


# The paper files these candidates belong to, those of the web pages, and for each page a scan (keys of their
# own) that no method read, so that the stand-in text and the missing text occur.
EXTRACT_FILES = [("conversations", ["DISTINCT conv_id AS doc_id", "'Talk_' || conv_id || '.pdf' AS file_name",
                                    "true AS is_pdf", "CAST(NULL AS STRING) AS title"]),
                 ("pages", ["-1 - page_id AS doc_id", "'Page_' || page_id || '.pdf' AS file_name",
                            "length(url) % 2 = 0 AS is_pdf", f"{PAGE_TITLE} AS title"]),
                 ("pages", ["-1000000000 - page_id AS doc_id", "'Scan_' || page_id || '.pdf' AS file_name",
                            "length(html) % 2 = 0 AS is_pdf", f"{PAGE_TITLE} AS title"])]
EXTRACT_FILES_SQL = " UNION ALL ".join(f"SELECT {', '.join(c)} FROM {t}" for t, c in EXTRACT_FILES)
PAGE_CANDIDATES = ["-1 - page_id AS doc_id", "'layout' AS method", "1 AS page_no", f"{PAGE_TEXT_EXPR} AS text",
                   f"{PAGE_LAYOUT_EXPR} AS layout_text", "html"]
EXTRACT_CANDIDATES = [[*c, "CAST(NULL AS STRING) AS layout_text", "CAST(NULL AS STRING) AS html"] for c in CANDIDATES]
# a turn's own text is also its layout text, so that the mode chain keeps it
EXTRACT_CANDIDATES[0][4] = "text AS layout_text"
EXTRACT_CANDIDATES_SQL = " UNION ALL ".join(
    [f"SELECT {', '.join(c)} FROM conversations" for c in EXTRACT_CANDIDATES] + [f"SELECT {', '.join(PAGE_CANDIDATES)} FROM pages"])


def extract_files(conversations, pages):
    """``(doc_id, file_name, is_pdf, title)``: the rows of ``EXTRACT_FILES_SQL``."""
    (_, (first, *rest)), *others = EXTRACT_FILES
    talks = conversations.selectExpr(first.removeprefix("DISTINCT "), *rest).distinct()
    return reduce(DataFrame.unionByName, [pages.selectExpr(*c) for _, c in others], talks)


def extract_candidates(conversations, pages):
    """``(doc_id, method, page_no, text, layout_text, html)``: the rows of ``EXTRACT_CANDIDATES_SQL``."""
    first, second = (conversations.selectExpr(*c) for c in EXTRACT_CANDIDATES)
    return first.unionByName(second).unionByName(pages.selectExpr(*PAGE_CANDIDATES))


# Metadata of a paper no method could read.
PH_IS_PDF = "lang <> 'de'"
PH_TITLE = f"CASE WHEN lang = 'en' THEN {W2} END"
PH_AUTHOR = "CASE WHEN doc_id % 3 = 0 THEN source END"
PH_PAGES = "CAST(floor(n_chars / 3000) AS BIGINT)"


# ---------------------------------------------------------------- sections
def injected_text_expr(sep_sql: str) -> str:
    """Paper text with section headers put between its lines, joined by ``sep_sql``."""
    first = "split_part(text, chr(10), 1)"
    rest = "CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END"
    parts = ["'Abstract'", first, "'Methods'", rest, "'Results and discussion'",
             "'Findings for ' || lang", "'Conclusion'", "'References'", "'Method reference list'"]
    return "(" + f" || {sep_sql} || ".join(parts) + ")"


SEP_SQL = {"newline": "chr(10)", "compat": "chr(92) || 'n'"}


# ---------------------------------------------------------------- requests
# Model per paper language (a literal map, so no join is needed).
MODEL_BY_LANG = {"en": "gpt-4o-mini", "fr": "gpt-5-mini", "de": "gpt-4-turbo", "es": "gpt-5"}


def demo_responder(request: dict) -> str:
    """A deterministic stand-in for a model: replies from the prompt length and
    fails (raises) for every prompt whose length is a multiple of 7."""
    prompt = request["messages"][-1]["content"]
    n = len(prompt)
    if n % 7 == 0:
        raise RuntimeError(f"simulated failure at {n} chars")
    return (f"**Include in Review**: Y\n**1. Primary Stakeholders**: Readers of a {n} "
            f"character prompt\n**Source**: {request['model']}")


# Pages sent as file content; pages on .net hosts carry a PDF signature.
FILE_CONTENT_EXPR = "CASE WHEN url LIKE '%.net%' THEN '%PDF-1.7 ' || html ELSE html END"

# The file each row of ``pages`` is written to; the default glob finds two of the three endings.
PAPER_FILE_EXPR = ("'page_' || page_id || CASE length(html) % 3 WHEN 0 THEN '.pdf' WHEN 1 THEN '.PDF' "
                   "ELSE '.html' END")


def write_paper_files(pages, folder: str) -> None:
    """Each row of ``pages`` as a file in ``folder``, written by the tasks; a retried task writes the
    same files again. ``folder`` is a path of the shared file system."""
    uri = folder.replace("file:/", "file:///", 1) if re.match("file:/(?!/)", folder) else folder

    def write(batches):
        from pyarrow import fs
        store, at = fs.FileSystem.from_uri(uri)
        store.create_dir(at, recursive=True)
        for batch in batches:
            for name, content in zip(batch["name"].to_pylist(), batch["content"].to_pylist(), strict=True):
                with store.open_output_stream(f"{at}/{name}") as f:
                    f.write(content.encode())
            yield batch.select(["name"])

    rows = pages.selectExpr(f"{PAPER_FILE_EXPR} AS name", f"{FILE_CONTENT_EXPR} AS content")
    rows.mapInArrow(write, "name string").write.format("noop").mode("overwrite").save()

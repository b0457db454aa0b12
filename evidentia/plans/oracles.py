"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

These are written independently of the Spark code: the reply parser here
explodes lines with their ordinal and folds each (paper, question) group with
``list_reduce``; the Spark side folds inside the row with ``aggregate``.
Data in the driver tables uses ASCII spaces, but the strip/split helpers below
still use Python's full whitespace set so both engines agree on any input.
"""

from __future__ import annotations

from evidentia.plans import fixtures
from evidentia.schema import (ANSWER_MARKER, CSV_COLUMNS, EXCLUSION_REASON, FAILED_INCLUDE,
                              PLACEHOLDER_NOTE,
                              FIELD_COLUMNS, INCLUDE, INCLUDE_MARKER, MAX_CONTEXT_TOKENS,
                              PLACEHOLDER_PHRASE, PROCESSING_FAILED, PY_WHITESPACE,
                              QUESTION_COLUMNS, QUESTION_STARTERS, QUESTIONS, REASON_MANUAL_REVIEW,
                              REASON_MARKER, REASON_NO_TEXT, SOURCE_MARKER, TITLE,
                              TITLE_LOWERCASE_WORDS, source_column)

WS = "(" + "||".join(f"chr({ord(c)})" for c in PY_WHITESPACE) + ")"
WS_RE = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in PY_WHITESPACE) + "]"
NS = "'Not specified'"
BOLD = r"'^\*\*(1[0-2]|[1-9])\.'"
PLAIN = r"'^(1[0-2]|[1-9])\.'"
ANYN = r"'^(\*\*)?(1[0-2]|[1-9])\.'"
STARTERS = "'^(" + "|".join(QUESTION_STARTERS) + ")'"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def ident(s: str) -> str:
    return '"' + s.replace('"', '""') + '"'


def strip(e: str) -> str:
    return f"trim({e}, {WS})"


def after(e: str, sep: str) -> str:
    return f"CASE WHEN strpos({e}, {q(sep)}) > 0 THEN substr({e}, strpos({e}, {q(sep)}) + {len(sep)}) END"


def echo(a: str, strict: bool) -> str:
    e = f"regexp_matches(lower({a}), {STARTERS})"
    if strict:
        e += f" OR ends_with({a}, '?') OR (contains(lower({a}), 'question') AND length({a}) < 50)"
    return f"({e})"


def format_title_sql(fn: str) -> str:
    name = f"regexp_extract({fn}, '[^/]*$', 0)"
    stem = f"regexp_replace({name}, '(?s)^(.+)\\.[^.]+$', '\\1')"
    spaced = f"translate({stem}, '_-', '  ')"
    words = f"list_filter(regexp_split_to_array({strip(spaced)}, '{WS_RE}+'), lambda w: w <> '')"
    small = "[" + ", ".join(q(w) for w in TITLE_LOWERCASE_WORDS) + "]"
    # Python's capitalize title-cases with full mappings (a leading sharp s -> 'Ss').
    cap = "CASE WHEN left(w, 1) = 'ß' THEN 'Ss' ELSE upper(left(w, 1)) END || lower(substr(w, 2))"
    return (f"array_to_string(list_transform({words}, lambda w, i: CASE WHEN i > 1 AND "
            f"list_contains({small}, lower(w)) THEN lower(w) ELSE {cap} END), ' ')")


def _lookahead(first_of: list, stop_re: str, depth: int = 4) -> str:
    """Offset of the first of n1..n<depth> starting with a marker or matching stop_re."""
    whens = []
    for k in range(1, depth + 1):
        hit = " OR ".join(f"starts_with(n{k}, {q(m)})" for m in first_of)
        whens.append(f"WHEN {hit} THEN {k} WHEN regexp_matches(n{k}, {stop_re}) THEN NULL")
    return "CASE " + " ".join(whens) + " END"


def _merge_sql() -> str:
    a, s = "st.a", "st.s"
    a = f"(CASE WHEN c.f1 THEN c.a1 ELSE {a} END)"
    s = f"(CASE WHEN c.f1 AND c.s1 IS NOT NULL THEN c.s1 ELSE {s} END)"
    a = f"(CASE WHEN c.f2 THEN c.a2 ELSE {a} END)"
    t3 = f"(c.f3 AND {a} = {NS})"
    a, s = (f"(CASE WHEN {t3} THEN c.a3 ELSE {a} END)",
            f"(CASE WHEN {t3} AND c.s3 IS NOT NULL THEN c.s3 ELSE {s} END)")
    t4 = f"(c.f4 AND {a} = {NS})"
    a, s = (f"(CASE WHEN {t4} THEN c.a4 ELSE {a} END)",
            f"(CASE WHEN {t4} AND c.s4 IS NOT NULL THEN c.s4 ELSE {s} END)")
    return f"{{'a': {a}, 's': {s}}}"


def parse_with(src: str) -> str:
    """The CTEs of the reply parser for ``src`` = (doc_id, title, response[, extra])."""
    get = lambda k: f"L[i + {k}]"
    look_src = _lookahead([SOURCE_MARKER], BOLD)
    look_ans = _lookahead([ANSWER_MARKER], ANYN)
    cand = f"""
    cand AS (
      SELECT doc_id, i, n,
        coalesce(bn IS NOT NULL AND strpos(x, ':') > 0 AND NOT {echo('a1', True)} AND length(a1) > 3, false) AS f1,
        a1, {strip(f"replace(L[i + ks], {q(SOURCE_MARKER)}, '')")} AS s1,
        coalesce(pn IS NOT NULL AND contains(x, '**:'), false) AS f2, a2,
        coalesce(pn IS NOT NULL AND strpos(x, ':') > 0 AND a3 <> '' AND NOT {echo('a3', False)}
                 AND length(a3) > 3, false) AS f3,
        a3,
        CASE WHEN contains(lower(n1), 'source') AND contains(n1, ':') THEN {strip(after('n1', ':'))} END AS s3,
        coalesce(n IS NOT NULL AND contains(x, '**') AND length(a4) > 3, false) AS f4,
        a4,
        CASE WHEN starts_with(L[i + ka + 1], {q(SOURCE_MARKER)})
             THEN {strip(f"replace(L[i + ka + 1], {q(SOURCE_MARKER)}, '')")} END AS s4
      FROM (
        SELECT *,
          {strip(f"replace({strip(after('x', ':'))}, '**', '')")} AS a1,
          {strip(after('x', '**:'))} AS a2,
          {strip(f"replace(replace({strip(after('x', ':'))}, '**', ''), '*', '')")} AS a3,
          CASE WHEN starts_with(L[i + ka], {q(ANSWER_MARKER)})
               THEN {strip(f"replace(L[i + ka], {q(ANSWER_MARKER)}, '')")} END AS a4
        FROM (
          SELECT *, CAST(coalesce(bn, pn) AS INTEGER) AS n,
            CASE WHEN starts_with(L[i + ({look_src})], {q(SOURCE_MARKER)}) THEN ({look_src}) END AS ks,
            ({look_ans}) AS ka
          FROM (
            SELECT doc_id, L, i, L[i] AS x,
              nullif(regexp_extract(L[i], {BOLD}, 1), '') AS bn,
              nullif(regexp_extract(L[i], {PLAIN}, 1), '') AS pn,
              {get(1)} AS n1, {get(2)} AS n2, {get(3)} AS n3, {get(4)} AS n4
            FROM ex)))
      WHERE n IS NOT NULL)"""
    folds = ",\n      ".join(
        f"max(CASE WHEN n = {n} THEN r.a END) AS a{n}, max(CASE WHEN n = {n} THEN r.s END) AS s{n}"
        for n in QUESTIONS)
    return f"""
WITH src AS ({src}),
ln AS (
  SELECT *, list_filter(list_transform(string_split(response, chr(10)), lambda x: {strip('x')}),
                        lambda x: x <> '') AS L,
         (response IS NULL OR length({strip('response')}) < 10) AS short
  FROM src),
ex AS (SELECT doc_id, L, unnest(range(1, len(L) + 1)) AS i FROM ln),
{cand.strip()},
folded AS (
  SELECT doc_id, n,
    list_reduce(list({{'f1': f1, 'a1': a1, 's1': s1, 'f2': f2, 'a2': a2, 'f3': f3, 'a3': a3,
                      's3': s3, 'f4': f4, 'a4': a4, 's4': s4}} ORDER BY i),
                lambda st, c: {_merge_sql()}, {{'a': {NS}, 's': {NS}}}) AS r
  FROM cand GROUP BY doc_id, n),
wide AS (
  SELECT doc_id,
      {folds}
  FROM folded GROUP BY doc_id),
scr AS (
  SELECT doc_id,
    arg_max(L[i], i) FILTER (WHERE starts_with(L[i], {q(INCLUDE_MARKER)})) AS inc_line,
    arg_max(L[i], i) FILTER (WHERE starts_with(L[i], {q(REASON_MARKER)})) AS rsn_line
  FROM ex GROUP BY doc_id)"""


def parse_sql(src: str, extra_cols: str = "") -> str:
    """Coded rows for ``src`` = a query giving (doc_id, title, response[, extra])."""
    fields = []
    for n in QUESTIONS:
        name = QUESTION_COLUMNS[n]
        fields.append(f"CASE WHEN short THEN {NS} ELSE coalesce(w.a{n}, {NS}) END AS {ident(name)}")
        fields.append(f"CASE WHEN short THEN {NS} ELSE coalesce(w.s{n}, {NS}) END AS {ident(source_column(name))}")
    fields = ",\n  ".join(fields)
    return parse_with(src) + f"""
SELECT ln.doc_id{extra_cols}, ln.title AS {ident(TITLE)},
  CASE WHEN short THEN {NS} ELSE coalesce({strip(f"replace(inc_line, {q(INCLUDE_MARKER)}, '')")}, {NS}) END
    AS {ident(INCLUDE)},
  CASE WHEN short THEN {NS} ELSE coalesce({strip(f"replace(rsn_line, {q(REASON_MARKER)}, '')")}, {NS}) END
    AS {ident(EXCLUSION_REASON)},
  {fields}
FROM ln LEFT JOIN scr USING (doc_id) LEFT JOIN wide w USING (doc_id)
"""


def generated_replies_src(title_expr: str = "'Paper ' || CAST(doc_id AS STRING)") -> str:
    return (f"SELECT doc_id, {title_expr} AS title, {fixtures.RESPONSE_EXPR} AS response "
            f"FROM ({fixtures.PAPERS_SQL})")


def route_sql(text: str) -> str:
    return (f"CASE WHEN ({text}) IS NULL OR ({text}) = '' THEN 'no_text' "
            f"WHEN contains(lower({text}), {q(PLACEHOLDER_PHRASE)}) THEN 'manual_review' ELSE 'code' END")


def code_documents_sql() -> str:
    """Route + title + parse + failure rows over ``documents`` with generated replies."""
    fn = fixtures.FILE_NAME_EXPR
    routed = f"""
      SELECT doc_id, file_name, rt,
        CASE WHEN rt = 'no_text' THEN file_name ELSE {format_title_sql('file_name')} END AS title,
        CASE WHEN rt = 'code' THEN response END AS response,
        CASE WHEN error IS NULL THEN NULL ELSE error END AS error
      FROM (
        SELECT doc_id, {fn} AS file_name, {fixtures.RESPONSE_EXPR} AS response,
               {fixtures.ERROR_EXPR} AS error,
               {route_sql('text')} AS rt
        FROM ({fixtures.PAPERS_SQL}))"""
    parsed = parse_sql(routed, extra_cols=", ln.rt, ln.error")
    failed = "(rt <> 'code' OR error IS NOT NULL)"
    reason = (f"CASE WHEN rt = 'no_text' THEN {q(REASON_NO_TEXT)} WHEN rt = 'manual_review' "
              f"THEN {q(REASON_MANUAL_REVIEW)} ELSE {q(PROCESSING_FAILED)} END")
    cols = [f"doc_id", ident(TITLE),
            f"CASE WHEN {failed} THEN {q(FAILED_INCLUDE)} ELSE {ident(INCLUDE)} END AS {ident(INCLUDE)}",
            f"CASE WHEN {failed} THEN {reason} ELSE {ident(EXCLUSION_REASON)} END AS {ident(EXCLUSION_REASON)}"]
    cols += [f"CASE WHEN {failed} THEN {q(PROCESSING_FAILED)} ELSE {ident(c)} END AS {ident(c)}"
             for c in FIELD_COLUMNS]
    return f"SELECT {', '.join(cols)} FROM ({parsed})"


assert len(CSV_COLUMNS) == 27


# ---------------------------------------------------------------- text preparation

def stem_sql(fn: str) -> str:
    return f"regexp_replace(regexp_extract({fn}, '[^/]*$', 0), '(?s)^(.+)\\.[^.]+$', '\\1')"


def assembled_sql(order: str, text: str) -> str:
    agg = (f"string_agg({text}, chr(10) ORDER BY {order}) "
           f"FILTER (WHERE {text} IS NOT NULL AND {text} <> '')")
    return f"coalesce({strip(agg)}, '')"


def nfkd_chars(e: str) -> str:
    """Code points of the NFKD form: one more for each character with an accent."""
    return (f"(length({e}) + len(list_filter(list_zip(string_split({e}, ''), "
            f"string_split(strip_accents({e}), '')), lambda p: p[1] <> p[2])))")


NORMALIZE_TEXT = f"""
SELECT doc_id, CAST({nfkd_chars('text')} AS BIGINT) AS nfkd_chars, md5(nfc_normalize(text)) AS nfc_md5
FROM documents"""

STRIP_MARKUP = """
SELECT page_id, md5(regexp_replace(html, '<[^<]+?>', '', 'g')) AS text_md5,
       CAST(length(regexp_replace(html, '<[^<]+?>', '', 'g')) AS BIGINT) AS text_len
FROM pages"""


def _short_sql(e: str, n: int) -> str:
    return f"({e} IS NULL OR length({strip(e)}) < {n})"


def page_mode_chain_sql() -> str:
    t1 = f"CASE WHEN {_short_sql('t0', 20)} THEN lay ELSE t0 END"
    t2 = (f"CASE WHEN {_short_sql('t1', 20)} AND html IS NOT NULL AND html <> '' "
          f"THEN regexp_replace(html, '<[^<]+?>', '', 'g') ELSE t1 END")
    return f"""
SELECT page_id, md5(t2) AS text_md5, CAST(length(t2) AS BIGINT) AS text_len
FROM (SELECT *, {t2} AS t2 FROM (SELECT *, {t1} AS t1 FROM (
  SELECT page_id, html, {fixtures.PAGE_TEXT_EXPR} AS t0, {fixtures.PAGE_LAYOUT_EXPR} AS lay
  FROM pages)))"""


FLATTEN_LAYOUT = """
SELECT conv_id, md5(t) AS text_md5, CAST(length(t) AS BIGINT) AS text_len
FROM (SELECT conv_id, string_agg(replace(text, chr(10), ' '), ' ' ORDER BY turn) AS t
      FROM conversations GROUP BY conv_id)"""


def assemble_pages_sql() -> str:
    return f"""
SELECT conv_id, md5(t) AS text_md5, CAST(length(t) AS BIGINT) AS text_len
FROM (SELECT conv_id, {assembled_sql('turn', 'text')} AS t FROM conversations GROUP BY conv_id)"""


def pick_page_strategy_sql() -> str:
    return f"""
SELECT conv_id, md5(t) AS text_md5, CAST(length(t) AS BIGINT) AS text_len
FROM (SELECT conv_id,
        coalesce(arg_min(text, turn) FILTER (WHERE length({strip('text')}) > 50),
                 arg_max_null(text, turn)) AS t
      FROM conversations GROUP BY conv_id)"""


def first_accepted_text_sql() -> str:
    return f"""
WITH rules(method, rank, min_page_chars, min_doc_chars) AS (VALUES
  ('text_layer', 1, NULL, NULL), ('text_layer_tolerant', 2, NULL, NULL), ('layout', 3, NULL, NULL),
  ('reader', 4, NULL, NULL), ('cli', 5, NULL, NULL), ('ocr', 6, 10, 100)),
cands AS ({fixtures.CANDIDATES_SQL}),
per_method AS (
  SELECT doc_id, c.method, r.rank, r.min_doc_chars, {assembled_sql('page_no', 'text')} AS text
  FROM cands c JOIN rules r ON c.method = r.method
  WHERE text IS NOT NULL AND text <> ''
    AND (r.min_page_chars IS NULL OR length({strip('text')}) > r.min_page_chars)
  GROUP BY doc_id, c.method, r.rank, r.min_doc_chars)
SELECT doc_id, arg_min(method, rank) AS method, CAST(min(rank) AS INTEGER) AS rank,
       md5(arg_min(text, rank)) AS text_md5, CAST(length(arg_min(text, rank)) AS BIGINT) AS text_len
FROM per_method
WHERE text <> '' AND (min_doc_chars IS NULL OR length(text) > min_doc_chars)
GROUP BY doc_id"""


def extract_papers_sql() -> str:
    """Texts stay composed here; what Spark decomposed is composed again before it is compared.
    The stand-in text holds the file's own title, which is not normalized."""
    html = "regexp_replace(html, '<[^<]+?>', '', 'g')"
    first = f"CASE WHEN method = 'layout' AND (text IS NULL OR {nfkd_chars(strip('text'))} < 20) THEN layout_text ELSE text END"
    mode = (f"CASE WHEN method = 'layout' AND (t IS NULL OR length({strip('t')}) < 20) "
            f"AND html IS NOT NULL AND html <> '' THEN {html} ELSE t END")
    return f"""
WITH rules(method, rank, min_page_chars, min_doc_chars) AS (VALUES
  ('text_layer', 1, NULL, NULL), ('text_layer_tolerant', 2, NULL, NULL), ('layout', 3, NULL, NULL),
  ('reader', 4, NULL, NULL), ('cli', 5, NULL, NULL), ('ocr', 6, 10, 100)),
pg AS (SELECT doc_id, method, page_no, {mode} AS text
       FROM (SELECT *, {first} AS t FROM ({fixtures.EXTRACT_CANDIDATES_SQL}))),
per_method AS (
  SELECT doc_id, pg.method, r.rank, r.min_doc_chars, {assembled_sql('page_no', 'text')} AS text
  FROM pg JOIN rules r ON pg.method = r.method
  WHERE text IS NOT NULL AND text <> ''
    AND (r.min_page_chars IS NULL OR {nfkd_chars(strip('text'))} > r.min_page_chars)
  GROUP BY doc_id, pg.method, r.rank, r.min_doc_chars),
acc AS (SELECT doc_id, arg_min(method, rank) AS method, arg_min(text, rank) AS text FROM per_method
        WHERE text <> '' AND (min_doc_chars IS NULL OR {nfkd_chars('text')} > min_doc_chars)
        GROUP BY doc_id),
papers AS (
  SELECT f.doc_id, f.file_name,
         CASE WHEN a.doc_id IS NOT NULL THEN a.method WHEN f.is_pdf THEN 'placeholder' END AS method,
         CASE WHEN a.doc_id IS NOT NULL THEN a.text
              WHEN f.is_pdf THEN 'Title: ' || {stem_sql('f.file_name')}
                || CASE WHEN f.title <> '' THEN chr(10) || 'Extracted title: ' || f.title ELSE '' END
                || chr(10) || chr(10) || {q(PLACEHOLDER_NOTE)}
              ELSE '' END AS text
  FROM ({fixtures.EXTRACT_FILES_SQL}) f LEFT JOIN acc a ON f.doc_id = a.doc_id)
SELECT doc_id, file_name, method, {route_sql('text')} AS route, md5(nfc_normalize(text)) AS nfc_md5,
       CAST(CASE method WHEN 'placeholder' THEN length(text) ELSE {nfkd_chars('text')} END AS BIGINT) AS text_chars
FROM papers"""


def placeholder_text_sql() -> str:
    fn = fixtures.FILE_NAME_EXPR
    body = (f"'Title: ' || {stem_sql('fn')} "
            f"|| CASE WHEN mt IS NOT NULL AND mt <> '' THEN chr(10) || 'Extracted title: ' || mt ELSE '' END "
            f"|| CASE WHEN au IS NOT NULL AND au <> '' THEN chr(10) || 'Extracted author: ' || au ELSE '' END "
            f"|| CASE WHEN pc IS NOT NULL THEN chr(10) || 'Page count: ' || CAST(pc AS VARCHAR) ELSE '' END "
            f"|| chr(10) || chr(10) || {q(PLACEHOLDER_NOTE)}")
    return f"""
SELECT doc_id, md5(t) AS text_md5, CAST(length(t) AS BIGINT) AS text_len
FROM (SELECT doc_id, CASE WHEN is_pdf THEN {body} ELSE '' END AS t
      FROM (SELECT doc_id, {fn} AS fn, {fixtures.PH_IS_PDF} AS is_pdf, {fixtures.PH_TITLE} AS mt,
                   {fixtures.PH_AUTHOR} AS au, {fixtures.PH_PAGES} AS pc FROM ({fixtures.PAPERS_SQL})))"""


def format_title_query_sql() -> str:
    return (f"SELECT doc_id, file_name, {format_title_sql('file_name')} AS title "
            f"FROM (SELECT doc_id, {fixtures.FILE_NAME_EXPR} AS file_name FROM ({fixtures.PAPERS_SQL}))")


ESTIMATE_TOKENS = "SELECT doc_id, CAST(length(text) // 4 AS BIGINT) AS tokens FROM documents"


# ---------------------------------------------------------------- sections and budget

def _sections_cte(mode: str, text_sql: str | None = None) -> str:
    from evidentia.schema import SECTION_MARKERS
    sep = fixtures.SEP_SQL[mode]
    text_sql = text_sql or fixtures.injected_text_expr(sep)
    low = f"lower({strip('line')})"
    name = "CASE " + " ".join(f"WHEN contains({low}, {q(m)}) THEN {q(m)}" for m in SECTION_MARKERS) + " END"
    return f"""
d AS (SELECT doc_id, {text_sql} AS text FROM documents),
ln AS (SELECT doc_id, unnest(string_split(text, {sep})) AS line,
              generate_subscripts(string_split(text, {sep}), 1) AS i FROM d),
hd AS (SELECT *, CASE WHEN length({low}) < 50 THEN {name} END AS h FROM ln),
sn AS (SELECT *, CAST(sum(CASE WHEN h IS NULL THEN 0 ELSE 1 END)
                     OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS INTEGER) AS section_no
       FROM hd),
secs AS (SELECT doc_id, section_no, coalesce(max(h), 'start') AS header,
                string_agg(line, {sep} ORDER BY i) AS content
         FROM sn GROUP BY doc_id, section_no)"""


def split_sections_sql(mode: str) -> str:
    return (f"WITH {_sections_cte(mode).strip()}\n"
            "SELECT doc_id, section_no, header, md5(content) AS content_md5, "
            "CAST(length(content) AS BIGINT) AS content_len FROM secs")


def fit_context_sql(mode: str, max_tokens: int, text_sql: str | None = None,
                    select: str | None = None) -> str:
    from evidentia.schema import SECTION_PRIORITY, TRUNCATION_TAG
    sep = fixtures.SEP_SQL[mode]
    sep_len = 2 if mode == "compat" else 1
    limit = max_tokens * 0.8
    budget = int(max_tokens * 4 * 0.8)
    prio = ", ".join(f"({q(h)}, {i})" for i, h in enumerate(SECTION_PRIORITY))
    return f"""
WITH {_sections_cte(mode, text_sql).strip()},
pr AS (SELECT s.*, p.prio FROM secs s JOIN (VALUES {prio}) p(header, prio) ON s.header = p.header),
cu AS (SELECT *, sum({2 * sep_len} + length(content)) OVER (PARTITION BY doc_id ORDER BY prio, section_no
                                                            ROWS UNBOUNDED PRECEDING) AS cum FROM pr),
fl AS (SELECT *, floor(cum / 4) < {limit} AS fits, cum - {2 * sep_len} - length(content) AS prev FROM cu),
walk AS (
  SELECT doc_id,
    coalesce(string_agg({sep} || {sep} || content, '' ORDER BY prio, section_no) FILTER (WHERE fits), '') AS kept,
    arg_min(CASE WHEN {budget} - prev > 1000
                 THEN {sep} || {sep} || substr(content, 1, CAST({budget} - prev AS INTEGER)) || {sep} || {q(TRUNCATION_TAG)}
                 ELSE '' END, prio * 1000000 + section_no) FILTER (WHERE NOT fits) AS cut,
    bool_or(NOT fits) AS over, bool_or(fits) AS any_kept
  FROM fl GROUP BY doc_id),
res AS (
  SELECT d.doc_id, d.text, length(d.text) // 4 <= {max_tokens} AS whole,
    CASE WHEN length(d.text) // 4 <= {max_tokens} THEN d.text
         WHEN coalesce(w.over, false) OR coalesce(w.any_kept, false) THEN w.kept || coalesce(w.cut, '')
         ELSE substr(d.text, 1, {max_tokens * 4}) END AS fitted
  FROM d LEFT JOIN walk w ON d.doc_id = w.doc_id)
{select or "SELECT doc_id, md5(fitted) AS text_md5, CAST(length(fitted) AS BIGINT) AS text_len, NOT whole AS truncated"}
FROM res"""


# ---------------------------------------------------------------- requests and replies

def _template() -> str:
    from evidentia.sources.files import default_prompt
    return default_prompt()


def _prompt_sql() -> str:
    bs_n = "chr(92) || 'n'"
    return f"{q(_template())} || {bs_n} || {bs_n} || 'RESEARCH PAPER:' || {bs_n} || fitted"


def build_prompt_sql() -> str:
    sel = f"SELECT doc_id, md5({_prompt_sql()}) AS prompt_md5, CAST(length({_prompt_sql()}) AS BIGINT) AS prompt_len"
    return fit_context_sql("compat", MAX_CONTEXT_TOKENS, text_sql="text", select=sel)


def _request_json_sql() -> str:
    from evidentia.schema import SYSTEM_MESSAGE
    msgs = (f"'[{{\"role\":\"system\",\"content\":' || to_json({q(SYSTEM_MESSAGE)}) || "
            f"'}},{{\"role\":\"user\",\"content\":' || to_json(prompt) || '}}]'")
    return ("'{\"model\":' || to_json(model) || ',\"messages\":' || " + msgs +
            " || CASE WHEN mct IS NOT NULL THEN ',\"max_completion_tokens\":' || CAST(mct AS VARCHAR) ELSE '' END"
            " || CASE WHEN mt IS NOT NULL THEN ',\"max_tokens\":' || CAST(mt AS VARCHAR) ELSE '' END"
            " || CASE WHEN temp IS NOT NULL THEN ',\"temperature\":' || to_json(temp) ELSE '' END || '}'")


def _requests_sql() -> str:
    models = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in fixtures.MODEL_BY_LANG.items())
    sel = (f"SELECT doc_id, {_prompt_sql()} AS prompt, "
           f"CASE lang {models} END AS model")
    base = fit_context_sql("compat", MAX_CONTEXT_TOKENS, text_sql="text",
                           select=sel + ", lang")
    base = base.replace("SELECT d.doc_id, d.text,", "SELECT d.doc_id, d.text, d.lang,")
    base = base.replace("d AS (SELECT doc_id, text AS text FROM documents)",
                        "d AS (SELECT doc_id, text AS text, lang FROM documents)")
    return f"""
SELECT *, {_request_json_sql()} AS request_json FROM (
  SELECT doc_id, prompt, model,
    CASE WHEN contains(model, 'gpt-5') OR contains(model, 'gpt-4o') THEN 2000 END AS mct,
    CASE WHEN NOT (contains(model, 'gpt-5') OR contains(model, 'gpt-4o')) THEN 2000 END AS mt,
    CASE WHEN NOT contains(model, 'gpt-5-mini') THEN CAST(0.0 AS DOUBLE) END AS temp
  FROM ({base}))"""


def build_requests_sql() -> str:
    return f"""
SELECT doc_id, model,
       CASE WHEN mct IS NOT NULL THEN 'max_completion_tokens' ELSE 'max_tokens' END AS cap_field,
       CAST(coalesce(mct, mt) AS INTEGER) AS cap, temp AS temperature, md5(request_json) AS request_md5,
       CAST(length(request_json) AS BIGINT) AS request_len
FROM ({_requests_sql()})"""


def apply_responder_sql() -> str:
    n = "length(prompt)"
    reply = ("'**Include in Review**: Y' || chr(10) || '**1. Primary Stakeholders**: Readers of a ' "
             f"|| CAST({n} AS VARCHAR) || ' character prompt' || chr(10) || '**Source**: ' || model")
    return f"""
SELECT doc_id, CASE WHEN {n} % 7 = 0 THEN NULL ELSE md5({reply}) END AS response_md5,
       CASE WHEN {n} % 7 = 0 THEN 'RuntimeError: simulated failure at ' || CAST({n} AS VARCHAR) || ' chars' END AS error
FROM ({_requests_sql()})"""


def attach_responses_sql() -> str:
    return f"""
SELECT d.doc_id, md5(r.response) AS response_md5,
       CASE WHEN r.doc_id IS NULL THEN 'no response recorded' ELSE r.error END AS error
FROM ({fixtures.PAPERS_SQL}) d LEFT JOIN (
  SELECT doc_id, {fixtures.RESPONSE_EXPR} AS response, {fixtures.ERROR_EXPR} AS error
  FROM ({fixtures.PAPERS_SQL}) WHERE kind >= 0 OR doc_id IN (SELECT doc_id FROM labels)) r ON d.doc_id = r.doc_id"""


def file_diagnostics_sql() -> str:
    c = f"({fixtures.FILE_CONTENT_EXPR})"
    return f"""
SELECT page_id, CAST(octet_length(encode({c})) AS BIGINT) AS size_bytes,
       hex(left({c}, 10)) AS header_hex, contains(left({c}, 1000), '%PDF') AS is_pdf,
       octet_length(encode({c})) / 1048576 AS size_mb
FROM pages"""


def scan_papers_sql() -> str:
    c = f"({fixtures.FILE_CONTENT_EXPR})"
    return f"""
SELECT name AS file_name, CAST(octet_length(encode(c)) AS BIGINT) AS length, hex(left(c, 10)) AS header_hex,
       contains(left(c, 1000), '%PDF') AS is_pdf, octet_length(encode(c)) / 1048576 AS size_mb
FROM (SELECT {fixtures.PAPER_FILE_EXPR} AS name, {c} AS c FROM pages)
WHERE name LIKE '%.pdf' OR name LIKE '%.PDF'"""


def write_coding_csv_sql() -> str:
    return f"SELECT {', '.join(map(ident, CSV_COLUMNS))} FROM ({code_documents_sql()})"


# ---------------------------------------------------------------- reply parsing pieces

def _replies_with(extra: str) -> str:
    return parse_with(generated_replies_src()) + extra


def response_lines_sql() -> str:
    return _replies_with("SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, L[i] AS line FROM ex")


def screening_sql() -> str:
    inc = strip(f"replace(inc_line, {q(INCLUDE_MARKER)}, '')")
    rsn = strip(f"replace(rsn_line, {q(REASON_MARKER)}, '')")
    return _replies_with(
        f"SELECT ln.doc_id, coalesce({inc}, {NS}) AS include, coalesce({rsn}, {NS}) AS reason "
        "FROM ln LEFT JOIN scr USING (doc_id)")


def question_echo_sql() -> str:
    a = strip(after("L[i]", ":"))
    return _replies_with(
        f"SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, answer, {echo('answer', True)} AS strict_echo, "
        f"{echo('answer', False)} AS light_echo FROM (SELECT *, {a} AS answer FROM ex "
        f"WHERE strpos(L[i], ':') > 0)")


def form_sql(form: int) -> str:
    cols = {1: "a1 AS answer, s1 AS source", 2: "a2 AS answer", 3: "a3 AS answer, s3 AS source",
            4: "a4 AS answer, s4 AS source"}[form]
    return _replies_with(
        f"SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, n, {cols} FROM cand WHERE f{form}")


def evidence_sql() -> str:
    return _replies_with(
        "SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, n, s1 AS source_form1, "
        "s3 AS source_form3, s4 AS source_form4 FROM cand")


def merge_answers_sql() -> str:
    parsed = parse_sql(generated_replies_src())
    parts = [f"SELECT doc_id, {n} AS n, {q(QUESTION_COLUMNS[n])} AS question, "
             f"{ident(QUESTION_COLUMNS[n])} AS answer, {ident(source_column(QUESTION_COLUMNS[n]))} AS source "
             f"FROM parsed" for n in QUESTIONS]
    return (f"WITH parsed AS ({parsed}) SELECT doc_id, CAST(n AS INTEGER) AS n, question, answer, source "
            f"FROM ({' UNION ALL '.join(parts)})")


def short_guard_sql() -> str:
    return (f"SELECT doc_id, (response IS NULL OR length({strip('response')}) < 10) AS is_short "
            f"FROM ({generated_replies_src()})")


def count_extracted_sql() -> str:
    s = " + ".join(f"CAST({ident(c)} <> {NS} AS INTEGER)" for c in FIELD_COLUMNS)
    return f"SELECT doc_id, CAST({s} AS INTEGER) AS extracted_count FROM ({code_documents_sql()})"


def response_audit_sql() -> str:
    return (f"SELECT doc_id, CAST(coalesce(length(response), 0) AS BIGINT) AS response_length, "
            f"CASE WHEN length(response) > 0 THEN substr(response, 1, 300) || '...' END AS preview, "
            f"coalesce(length(response), 0) = 0 AS is_empty FROM ({generated_replies_src()})")


# ---------------------------------------------------------------- results

def _routed_docs_sql() -> str:
    return f"""SELECT doc_id, rt AS route,
      CASE WHEN rt = 'no_text' THEN file_name ELSE {format_title_sql('file_name')} END AS title
    FROM (SELECT doc_id, {fixtures.FILE_NAME_EXPR} AS file_name,
                 {route_sql('text')} AS rt FROM ({fixtures.PAPERS_SQL}))"""


def route_documents_sql() -> str:
    return f"SELECT doc_id, route, title AS {ident(TITLE)} FROM ({_routed_docs_sql()})"


def _failed_cols(reason_sql: str | None) -> str:
    cols = [f"title AS {ident(TITLE)}", f"{q(FAILED_INCLUDE)} AS {ident(INCLUDE)}",
            f"{reason_sql} AS {ident(EXCLUSION_REASON)}"]
    cols += [f"{q(PROCESSING_FAILED)} AS {ident(c)}" for c in FIELD_COLUMNS]
    return ", ".join(cols)


def failed_rows_sql() -> str:
    return f"SELECT doc_id, {_failed_cols(q(PROCESSING_FAILED))} FROM ({_routed_docs_sql()})"


def assemble_results_sql() -> str:
    coded_src = (f"SELECT r.doc_id, r.title, {fixtures.RESPONSE_EXPR} AS response "
                 f"FROM ({_routed_docs_sql()}) r JOIN ({fixtures.PAPERS_SQL}) USING (doc_id) WHERE r.route = 'code'")
    coded = parse_sql(coded_src)
    cols = ", ".join(["doc_id"] + [ident(c) for c in CSV_COLUMNS])
    return (f"SELECT {cols} FROM ({coded}) UNION ALL "
            f"SELECT doc_id, {_failed_cols(q('nan'))} FROM ({_routed_docs_sql()}) WHERE route <> 'code'")


# ---------------------------------------------------------------- extraction audit

NON_WS_RE = "[^" + "".join(f"\\x{{{ord(c):x}}}" for c in PY_WHITESPACE) + "]+"


def _audit_sql() -> str:
    t = "text"
    ok = f"length({strip(t)}) > 0"
    return f"""SELECT file, status,
      CASE status WHEN 'SUCCESS' THEN CAST(length({t}) AS BIGINT) WHEN 'FAILED' THEN 0 END AS chars,
      CASE status WHEN 'SUCCESS' THEN CAST(len(regexp_extract_all({t}, '{NON_WS_RE}')) AS BIGINT)
                  WHEN 'FAILED' THEN 0 END AS words,
      CASE WHEN status <> 'ERROR' THEN size_bytes / 1048576 END AS size_mb,
      CASE WHEN status = 'SUCCESS' THEN {strip(f"replace(substr({t}, 1, 100), chr(10), ' ')")} END AS preview,
      error
    FROM (SELECT *, CASE WHEN error IS NOT NULL THEN 'ERROR' WHEN {ok} THEN 'SUCCESS' ELSE 'FAILED' END AS status
          FROM (SELECT {fixtures.FILE_NAME_EXPR} AS file, text,
                       octet_length(encode(text)) AS size_bytes, {fixtures.AUDIT_ERROR_EXPR} AS error
                FROM ({fixtures.PAPERS_SQL})))"""


def audit_extraction_sql() -> str:
    return ("SELECT file, status, CAST(chars AS DOUBLE) AS chars, CAST(words AS DOUBLE) AS words, "
            f"size_mb, preview, error FROM ({_audit_sql()})")


def audit_summary_sql() -> str:
    return f"""SELECT count(*) AS total, CAST(count_if(status = 'SUCCESS') AS BIGINT) AS successful,
      CAST(count_if(status <> 'SUCCESS') AS BIGINT) AS failed,
      round(count_if(status = 'SUCCESS') * 100.0 / nullif(count(*), 0), 1) AS success_rate,
      CAST(sum(chars) FILTER (WHERE status = 'SUCCESS') AS BIGINT) AS total_chars,
      avg(chars) FILTER (WHERE status = 'SUCCESS') AS avg_chars
    FROM ({_audit_sql()})"""


def audit_failures_sql() -> str:
    return f"SELECT file, status, error FROM ({_audit_sql()}) WHERE status <> 'SUCCESS'"

"""The query catalogue (one entry per operator of the inventory)."""

from __future__ import annotations

import unicodedata
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidentia.functions.text import (estimate_tokens, format_title, normalize_text, page_mode_chain,
                                      placeholder_text, strip_markup)
from evidentia.functions.replies import is_question_echo, is_short_response
from evidentia.functions.strings import after_first, py_strip
from evidentia.operators.coding import (answers_long, audit_responses, candidate_table, coded_rows,
                                        reply_lines, screening, with_extracted_count)
from evidentia.operators.audit import audit_extraction, audit_failures, audit_summary
from evidentia.operators.results import (ROUTE_CODE, assemble_by_route, failed_columns, failed_rows,
                                         route_documents)
from evidentia.operators.context import fit_context, fit_documents, split_sections
from evidentia.operators.requests import apply_responder, build_prompt, build_requests
from evidentia.plans.pipeline import attach_responses
from evidentia.schema import CSV_COLUMNS, MAX_CONTEXT_TOKENS
from evidentia.session import scratch_path
from evidentia.sources.files import file_diagnostics, load_prompt, scan_heads
from evidentia.sources.sinks import read_coding_csv, write_coding_csv
from evidentia.operators.pages import (assemble_pages, extraction_rules, first_accepted_text,
                                       flatten_layout_pages, pick_page_strategy)
from evidentia.plans import fixtures, oracles
from evidentia.plans.pipeline import code_documents, extract_papers
from evidentia.plans.registry import register, table

def _papers(spark, sf_dir):
    return fixtures.papers(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))


# ---------------------------------------------------------------- reply parsing


@register("coded_rows", oracles.parse_sql(oracles.generated_replies_src()))
def q_coded_rows(spark, sf_dir):
    replies = _papers(spark, sf_dir).selectExpr("doc_id", "'Paper ' || CAST(doc_id AS STRING) AS title",
                              f"{fixtures.RESPONSE_EXPR} AS response")
    return coded_rows(replies, response="response", title="title", keep=("doc_id",))


# ---------------------------------------------------------------- full run


@register("code_documents", oracles.code_documents_sql())
def q_code_documents(spark, sf_dir):
    src = _papers(spark, sf_dir)
    return code_documents(fixtures.named_documents(src), fixtures.responses(src))


# ---------------------------------------------------------------- text preparation

def _md5_len(df, key, text_col):
    return df.select(key, F.md5(text_col).alias("text_md5"),
                     F.length(text_col).cast("long").alias("text_len"))


@F.udf(T.StringType(), useArrow=False)
def _nfc(s):
    return None if s is None else unicodedata.normalize("NFC", s)


@register("normalize_text", oracles.NORMALIZE_TEXT)
def q_normalize_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    n = docs.select("doc_id", normalize_text("text").alias("n"))
    return n.select("doc_id", F.length("n").cast("long").alias("nfkd_chars"),
                    F.md5(_nfc("n")).alias("nfc_md5"))


@register("strip_markup", oracles.STRIP_MARKUP)
def q_strip_markup(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return _md5_len(pages, "page_id", strip_markup("html"))


@register("page_mode_chain", oracles.page_mode_chain_sql())
def q_page_mode_chain(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").selectExpr(
        "page_id", "html", f"{fixtures.PAGE_TEXT_EXPR} AS t0", f"{fixtures.PAGE_LAYOUT_EXPR} AS lay")
    return _md5_len(pages, "page_id", page_mode_chain("t0", "lay", "html"))


@register("flatten_layout", oracles.FLATTEN_LAYOUT)
def q_flatten_layout(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations")
    # one block per turn, one line per text line, one span per line
    lines = F.transform(F.split("text", "\n"),
                        lambda l: F.struct(F.array(F.struct(l.alias("text"))).alias("spans")))
    pages = conv.select("conv_id", "turn", F.array(F.struct(lines.alias("lines"))).alias("blocks"))
    return _md5_len(flatten_layout_pages(pages, key="conv_id", order="turn"), "conv_id", F.col("text"))


@register("assemble_pages", oracles.assemble_pages_sql())
def q_assemble_pages(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations")
    return _md5_len(assemble_pages(conv, key="conv_id", order="turn", text="text"), "conv_id",
                    F.col("text"))


@register("pick_page_strategy", oracles.pick_page_strategy_sql())
def q_pick_page_strategy(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations")
    picked = pick_page_strategy(conv, key="conv_id", order="turn", text="text")
    return _md5_len(picked, "conv_id", F.col("text"))


@register("first_accepted_text", oracles.first_accepted_text_sql())
def q_first_accepted_text(spark, sf_dir):
    cands = fixtures.candidates(table(spark, sf_dir, "conversations"))
    best = first_accepted_text(cands, extraction_rules(spark), key="doc_id")
    return best.select("doc_id", "method", "rank", F.md5("text").alias("text_md5"),
                       F.length("text").cast("long").alias("text_len"))


@register("extract_papers", oracles.extract_papers_sql())
def q_extract_papers(spark, sf_dir):
    src = table(spark, sf_dir, "conversations"), table(spark, sf_dir, "pages")
    papers = extract_papers(fixtures.extract_files(*src), fixtures.extract_candidates(*src), extraction_rules(spark),
                            layout="layout_text", html="html", title="title")
    return papers.select("doc_id", "file_name", "method", "route", F.md5(_nfc("text")).alias("nfc_md5"),
                         F.length("text").cast("long").alias("text_chars"))


@register("placeholder_text", oracles.placeholder_text_sql())
def q_placeholder_text(spark, sf_dir):
    docs = _papers(spark, sf_dir).selectExpr(
        "doc_id", f"{fixtures.FILE_NAME_EXPR} AS fn", f"{fixtures.PH_IS_PDF} AS is_pdf",
        f"{fixtures.PH_TITLE} AS mt", f"{fixtures.PH_AUTHOR} AS au", f"{fixtures.PH_PAGES} AS pc")
    return _md5_len(docs, "doc_id", placeholder_text("fn", "is_pdf", "mt", "au", "pc"))


@register("format_title", oracles.format_title_query_sql())
def q_format_title(spark, sf_dir):
    docs = fixtures.named_documents(_papers(spark, sf_dir))
    return docs.select("doc_id", "file_name", format_title("file_name").alias("title"))


@register("estimate_tokens", oracles.ESTIMATE_TOKENS)
def q_estimate_tokens(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", estimate_tokens("text").alias("tokens"))


# ---------------------------------------------------------------- sections and budget

FIT_MAX_TOKENS = 1000


def _injected(spark, sf_dir, mode):
    docs = table(spark, sf_dir, "documents")
    return docs.selectExpr("doc_id", f"{fixtures.injected_text_expr(fixtures.SEP_SQL[mode])} AS text")


def _register_context(mode):
    suffix = "" if mode == "compat" else f"_{mode}"     # compat is the default mode

    @register(f"split_sections{suffix}", oracles.split_sections_sql(mode))
    def q_split(spark, sf_dir):
        secs = split_sections(_injected(spark, sf_dir, mode), mode=mode)
        return secs.select("doc_id", "section_no", "header", F.md5("content").alias("content_md5"),
                           F.length("content").cast("long").alias("content_len"))

    @register(f"fit_context{suffix}", oracles.fit_context_sql(mode, FIT_MAX_TOKENS))
    def q_fit(spark, sf_dir):
        fitted = fit_documents(_injected(spark, sf_dir, mode), max_tokens=FIT_MAX_TOKENS, mode=mode)
        return fitted.select("doc_id", F.md5("text").alias("text_md5"),
                             F.length("text").cast("long").alias("text_len"), "truncated")


for _mode in ("newline", "compat"):
    _register_context(_mode)


# ---------------------------------------------------------------- requests and replies

def _requests(spark, sf_dir, with_model=True):
    docs = table(spark, sf_dir, "documents")
    fitted = docs.select("doc_id", "lang", fit_context("text", max_tokens=MAX_CONTEXT_TOKENS,
                                                        mode="compat")["text"].alias("fitted"))
    prompts = build_prompt(fitted, load_prompt(spark), text="fitted")
    models = F.create_map(*[F.lit(x) for kv in fixtures.MODEL_BY_LANG.items() for x in kv])
    return prompts, build_requests(prompts.withColumn("model", F.element_at(models, F.col("lang"))),
                                   model=F.col("model"))


@register("build_prompt", oracles.build_prompt_sql())
def q_build_prompt(spark, sf_dir):
    prompts, _ = _requests(spark, sf_dir)
    return prompts.select("doc_id", F.md5("prompt").alias("prompt_md5"),
                          F.length("prompt").cast("long").alias("prompt_len"))


@register("build_requests", oracles.build_requests_sql())
def q_build_requests(spark, sf_dir):
    _, reqs = _requests(spark, sf_dir)
    r = F.col("request")
    return reqs.select("doc_id", "request.model",
                       F.when(r["max_completion_tokens"].isNotNull(), F.lit("max_completion_tokens"))
                        .otherwise(F.lit("max_tokens")).alias("cap_field"),
                       F.coalesce(r["max_completion_tokens"], r["max_tokens"]).alias("cap"),
                       "request.temperature",
                       F.md5("request_json").alias("request_md5"),
                       F.length("request_json").cast("long").alias("request_len"))


@register("apply_responder", oracles.apply_responder_sql())
def q_apply_responder(spark, sf_dir):
    _, reqs = _requests(spark, sf_dir)
    replies = apply_responder(reqs, fixtures.demo_responder)
    return replies.select("doc_id", F.md5("response").alias("response_md5"), "error")


@register("attach_responses", oracles.attach_responses_sql())
def q_attach_responses(spark, sf_dir):
    docs = _papers(spark, sf_dir)
    labelled = docs.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    stored = fixtures.responses(labelled.unionByName(docs.where("kind >= 0")))
    joined = attach_responses(docs.select("doc_id"), stored)
    return joined.select("doc_id", F.md5("response").alias("response_md5"), "error")


# ---------------------------------------------------------------- sources and sinks

@register("file_diagnostics", oracles.file_diagnostics_sql())
def q_file_diagnostics(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    files = pages.select("page_id", F.encode(F.expr(fixtures.FILE_CONTENT_EXPR), "UTF-8")
                         .alias("content"))
    files = files.withColumn("length", F.octet_length("content").cast("long"))
    d = file_diagnostics(files)
    return d.select("page_id", F.col("length").alias("size_bytes"),
                    F.hex("header").alias("header_hex"), "is_pdf", "size_mb")


@register("scan_papers", oracles.scan_papers_sql())
def q_scan_papers(spark, sf_dir):
    folder = scratch_path(spark, f"paper-files-{uuid.uuid4().hex}")
    fixtures.write_paper_files(table(spark, sf_dir, "pages"), folder)
    files = file_diagnostics(scan_heads(spark, folder), content="head")
    return files.select("file_name", "length", F.hex("header").alias("header_hex"), "is_pdf",
                        "size_mb")


@register("write_coding_csv", oracles.write_coding_csv_sql())
def q_write_coding_csv(spark, sf_dir):
    coded = q_code_documents(spark, sf_dir)
    path = write_coding_csv(coded, scratch_path(spark, f"coding-csv-{uuid.uuid4().hex}"))
    return read_coding_csv(spark, path).select(*[F.col(f"`{c}`") for c in CSV_COLUMNS])


# ---------------------------------------------------------------- reply parsing pieces

def _replies(spark, sf_dir):
    return _papers(spark, sf_dir).selectExpr("doc_id", "'Paper ' || CAST(doc_id AS STRING) AS title",
                           f"{fixtures.RESPONSE_EXPR} AS response")


@register("response_lines", oracles.response_lines_sql())
def q_response_lines(spark, sf_dir):
    return reply_lines(_replies(spark, sf_dir))


@register("screening_decision", oracles.screening_sql())
def q_screening_decision(spark, sf_dir):
    return screening(_replies(spark, sf_dir))


@register("is_question_echo", oracles.question_echo_sql())
def q_is_question_echo(spark, sf_dir):
    lines = reply_lines(_replies(spark, sf_dir)).where(F.instr("line", ":") > 0)
    a = lines.select("doc_id", "line_no", py_strip(after_first("line", ":")).alias("answer"))
    return a.select("doc_id", "line_no", "answer",
                    is_question_echo("answer", strict=True).alias("strict_echo"),
                    is_question_echo("answer", strict=False).alias("light_echo"))


_FORM_COLS = {1: {"a1": "answer", "s1": "source"}, 2: {"a2": "answer"},
              3: {"a3": "answer", "s3": "source"}, 4: {"a4": "answer", "s4": "source"}}


def _register_form(form):
    @register(f"parse_form{form}", oracles.form_sql(form))
    def q_form(spark, sf_dir):
        c = candidate_table(_replies(spark, sf_dir))
        return c.where(F.col(f"f{form}")).select(
            "doc_id", "line_no", "n", *[F.col(k).alias(v) for k, v in _FORM_COLS[form].items()])


for _form in (1, 2, 3, 4):
    _register_form(_form)


@register("evidence", oracles.evidence_sql())
def q_evidence(spark, sf_dir):
    c = candidate_table(_replies(spark, sf_dir))
    return c.select("doc_id", "line_no", "n", F.col("s1").alias("source_form1"),
                    F.col("s3").alias("source_form3"), F.col("s4").alias("source_form4"))


@register("merge_answers", oracles.merge_answers_sql())
def q_merge_answers(spark, sf_dir):
    coded = coded_rows(_replies(spark, sf_dir), response="response", title="title")
    return answers_long(coded)


@register("short_response_guard", oracles.short_guard_sql())
def q_short_response_guard(spark, sf_dir):
    return _replies(spark, sf_dir).select("doc_id", is_short_response("response").alias("is_short"))


@register("count_extracted", oracles.count_extracted_sql())
def q_count_extracted(spark, sf_dir):
    coded = q_code_documents(spark, sf_dir)
    return with_extracted_count(coded).select("doc_id", "extracted_count")


@register("response_audit", oracles.response_audit_sql())
def q_response_audit(spark, sf_dir):
    return audit_responses(_replies(spark, sf_dir))


# ---------------------------------------------------------------- results

def _routed(spark, sf_dir):
    src = _papers(spark, sf_dir)
    return route_documents(fixtures.named_documents(src)), src


@register("route_documents", oracles.route_documents_sql())
def q_route_documents(spark, sf_dir):
    routed, _ = _routed(spark, sf_dir)
    return routed.select("doc_id", "route", "Title")


@register("failed_rows", oracles.failed_rows_sql())
def q_failed_rows(spark, sf_dir):
    routed, _ = _routed(spark, sf_dir)
    return failed_rows(routed, title="Title")


@register("assemble_results", oracles.assemble_results_sql())
def q_assemble_results(spark, sf_dir):
    src = _papers(spark, sf_dir)
    # route, title and the stored reply come from the same rows: one projection
    docs = src.selectExpr("doc_id", f"{fixtures.FILE_NAME_EXPR} AS file_name",
                          "text", f"{fixtures.RESPONSE_EXPR} AS response")
    # a reply of a paper that is not coded is not parsed
    routed = route_documents(docs).withColumn("response", F.when(F.col("route") == ROUTE_CODE, F.col("response")))
    failed = dict(zip(CSV_COLUMNS, failed_columns("Title"), strict=True))
    del failed["Exclusion Reason"]
    return assemble_by_route(coded_rows(routed, title="Title", keep=("doc_id", "route")), failed)


# ---------------------------------------------------------------- extraction audit

def _audit(spark, sf_dir, sort=True):
    docs = _papers(spark, sf_dir).selectExpr(
        f"{fixtures.FILE_NAME_EXPR} AS file", "text",
        "octet_length(text) AS size_bytes", f"{fixtures.AUDIT_ERROR_EXPR} AS error")
    return audit_extraction(docs, error="error", sort=sort)


@register("audit_extraction", oracles.audit_extraction_sql())
def q_audit_extraction(spark, sf_dir):
    # counts are absent (null) on ERROR rows; shown as doubles, as a table with
    # missing values holds them
    return _audit(spark, sf_dir).withColumn("chars", F.col("chars").cast("double")) \
                                .withColumn("words", F.col("words").cast("double"))


@register("audit_summary", oracles.audit_summary_sql())
def q_audit_summary(spark, sf_dir):
    return audit_summary(_audit(spark, sf_dir, sort=False))   # an aggregate needs no order


@register("audit_failures", oracles.audit_failures_sql())
def q_audit_failures(spark, sf_dir):
    return audit_failures(_audit(spark, sf_dir))

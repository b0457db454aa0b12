"""Command line: the coding run, request export, and the extraction audit.

    python -m evidentia.cli extract --files F --candidates C --out P [--chunk-pages N]
    python -m evidentia.cli requests --papers P --template T --out DIR [--model M]
    python -m evidentia.cli code --papers P --replies R --out DIR [--csv]
    python -m evidentia.cli run --papers P --responder module:function --replies R --out DIR [--csv]
    python -m evidentia.cli audit --papers P --out DIR

``papers`` is a Parquet table ``(doc_id, file_name, text)`` (the output of
``extract``); ``replies`` holds ``(doc_id, response, error)``. Results
are written to ``--out`` (Parquet, or CSV in the original format with
``--csv``); ``run`` asks the user's responder, a function from a request (the dict a chat API
takes) to the reply's text, for the papers without a stored reply and codes all of them. A run without
papers writes nothing. The audit writes its rows, summary and failures as Parquet and
prints the one-line summary.
"""

from __future__ import annotations

import argparse
import importlib
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("evidentia").getOrCreate()
    from evidentia.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    return spark


def cmd_extract(a) -> int:
    from evidentia.operators.pages import extraction_rules
    from evidentia.plans.pipeline import extract_papers
    spark = _session()
    candidates = spark.read.parquet(a.candidates)
    optional = {c: c for c in ("layout", "html", "strategy") if c in candidates.columns}
    papers = extract_papers(spark.read.parquet(a.files), candidates, extraction_rules(spark),
                            chunk_pages=a.chunk_pages, **optional)
    papers.write.mode("overwrite").parquet(a.out)
    return 0


def cmd_requests(a) -> int:
    from evidentia.plans.pipeline import request_documents
    from evidentia.sources.files import load_prompt
    spark = _session()
    papers = spark.read.parquet(a.papers)
    reqs = request_documents(papers, load_prompt(spark, a.template), model=a.model,
                             context_tokens=a.max_context_tokens, mode=a.mode,
                             max_tokens=a.max_tokens, temperature=a.temperature)
    reqs.select("doc_id", "request_json").write.mode("overwrite").parquet(a.out)
    return 0


def cmd_code(a) -> int:
    from evidentia.plans.pipeline import code_documents, read_replies
    from evidentia.sources.sinks import write_coding_csv
    spark = _session()
    papers = spark.read.parquet(a.papers)
    coded = code_documents(papers, read_replies(spark, a.replies))
    if papers.isEmpty():
        print("no papers: nothing is written")
    elif a.csv:
        print(write_coding_csv(coded, a.out))
    else:
        coded.write.mode("overwrite").parquet(a.out)
        print(a.out)
    return 0


def responder_of(name: str):
    """The function that ``module:function`` names; dots behind the colon go on inside it."""
    module, _, path = name.partition(":")
    if not module or not path:
        raise SystemExit(f"--responder takes module:function, not {name!r}")
    found = importlib.import_module(module)
    for part in path.split("."):
        found = getattr(found, part)
    return found


def cmd_run(a) -> int:
    from evidentia.plans.pipeline import run_coding
    from evidentia.sources.files import load_prompt
    spark = _session()
    papers = spark.read.parquet(a.papers)
    run_coding(papers, responder_of(a.responder), load_prompt(spark, a.template), a.replies, a.out, model=a.model,
               csv=a.csv, reuse_replies=not a.ask_again, retry_failed=a.retry_failed, batches=a.batches,
               context_tokens=a.max_context_tokens, mode=a.mode, max_tokens=a.max_tokens, temperature=a.temperature)
    print("no papers: nothing is written" if papers.isEmpty() else a.out)
    return 0


def cmd_audit(a) -> int:
    from evidentia.operators.audit import audit_extraction, audit_failures, audit_summary
    spark = _session()
    papers = spark.read.parquet(a.papers)
    cols = set(papers.columns)
    files = papers.select(
        F.col("file_name").alias("file"), "text",
        (F.col("size_bytes") if "size_bytes" in cols else F.octet_length("text")).alias("size_bytes"),
        (F.col("error") if "error" in cols else F.lit(None).cast("string")).alias("error"))
    audit = audit_extraction(files, error="error")
    audit.write.mode("overwrite").parquet(f"{a.out}/rows")
    rows = spark.read.parquet(f"{a.out}/rows")
    audit_failures(rows).write.mode("overwrite").parquet(f"{a.out}/failures")
    summary = audit_summary(rows)
    summary.write.mode("overwrite").parquet(f"{a.out}/summary")
    s = spark.read.parquet(f"{a.out}/summary").first()
    print(f"total={s.total} successful={s.successful} failed={s.failed} "
          f"success_rate={s.success_rate}% total_chars={s.total_chars} avg_chars={s.avg_chars}")
    return 0 if s.total and s.failed == 0 else 1


def _request_options(p) -> None:
    p.add_argument("--model", default=None)
    p.add_argument("--max-context-tokens", type=int, default=None)
    p.add_argument("--max-tokens", type=int, default=None, help="reply cap")
    p.add_argument("--temperature", type=float, default=None)
    p.add_argument("--mode", choices=["compat", "newline"], default="compat")


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="evidentia")
    sub = ap.add_subparsers(dest="cmd", required=True)
    e = sub.add_parser("extract", help="choose and assemble the papers' texts from page candidates")
    e.add_argument("--files", required=True, help="(doc_id, file_name, is_pdf)")
    e.add_argument("--candidates", required=True, help="(doc_id, method, page_no, text[, layout, html][, strategy])")
    e.add_argument("--out", required=True)
    e.add_argument("--chunk-pages", type=int, default=None)
    e.set_defaults(fn=cmd_extract)
    r = sub.add_parser("requests", help="fit texts, build prompts and model requests")
    r.add_argument("--papers", required=True)
    r.add_argument("--template", default=None, help="prompt template (default: the packaged one)")
    r.add_argument("--out", required=True)
    _request_options(r)
    r.set_defaults(fn=cmd_requests)
    c = sub.add_parser("code", help="parse stored replies into the coding table")
    c.add_argument("--papers", required=True)
    c.add_argument("--replies", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--csv", action="store_true")
    c.set_defaults(fn=cmd_code)
    w = sub.add_parser("run", help="ask a responder for every paper and code the replies")
    w.add_argument("--papers", required=True)
    w.add_argument("--responder", required=True, help="module:function, from a request (dict) to the reply's text")
    w.add_argument("--replies", required=True, help="folder of reply batches; replies that are there are not asked for again")
    w.add_argument("--out", required=True)
    w.add_argument("--template", default=None, help="prompt template (default: the packaged one)")
    w.add_argument("--csv", action="store_true")
    w.add_argument("--batches", type=int, default=1)
    w.add_argument("--retry-failed", action="store_true")
    w.add_argument("--ask-again", action="store_true", help="ask for all papers, whatever is stored")
    _request_options(w)
    w.set_defaults(fn=cmd_run)
    u = sub.add_parser("audit", help="extraction audit of the papers' texts")
    u.add_argument("--papers", required=True)
    u.add_argument("--out", required=True)
    u.set_defaults(fn=cmd_audit)
    a = ap.parse_args(argv)
    return a.fn(a)


if __name__ == "__main__":
    sys.exit(main())

"""evidentia: coding research papers into evidence tables with Spark.

The public operators, grouped as in the README:

* sources/sinks: ``scan_papers``, ``load_prompt``, ``file_diagnostics``,
  ``write_coding_csv``, ``read_coding_csv``, ``write_parquet``
* text: ``normalize_text``, ``assemble_pages``, ``pick_page_strategy``,
  ``page_mode_chain``, ``flatten_layout``, ``strip_markup``,
  ``first_accepted_text``, ``paper_text``, ``placeholder_text``,
  ``format_title``, ``estimate_tokens``, ``split_sections``, ``fit_context``
* requests: ``build_prompt``, ``build_requests``, ``apply_responder``,
  ``persist_responses``, ``attach_responses``
* replies: ``coded_rows``, ``answers_long``, ``candidate_table``,
  ``reply_lines``, ``screening``, ``audit_responses``
* results: ``route_documents``, ``failed_rows``, ``assemble_results``,
  ``code_documents``, ``code_replies``, ``code_routed_replies``, ``run_coding``,
  ``read_replies``
* audit: ``audit_extraction``, ``audit_summary``, ``audit_failures``
"""

from evidentia.functions.text import (estimate_tokens, flatten_layout, format_title,
                                      layout_from_json, normalize_text, page_mode_chain,
                                      placeholder_text, strip_markup)
from evidentia.operators.audit import audit_extraction, audit_failures, audit_summary
from evidentia.operators.coding import (answers_long, audit_responses, candidate_table,
                                        coded_rows, question_dim, reply_lines, screening)
from evidentia.operators.context import fit_context, fit_documents, split_sections
from evidentia.operators.pages import (assemble_pages, extraction_rules, first_accepted_text,
                                       paper_text, pick_page_strategy)
from evidentia.operators.requests import (apply_responder, build_prompt, build_requests,
                                          persist_responses)
from evidentia.operators.results import assemble_results, failed_rows, route_documents
from evidentia.plans.pipeline import (attach_responses, code_documents, code_replies,
                                      code_routed_replies, committed_reply_batches, read_replies, request_documents,
                                      run_coding)
from evidentia.schema import CSV_COLUMNS
from evidentia.sources.files import file_diagnostics, load_prompt, scan_heads, scan_papers
from evidentia.sources.sinks import read_coding_csv, write_coding_csv, write_parquet

__all__ = [n for n in dir() if not n.startswith("_")]

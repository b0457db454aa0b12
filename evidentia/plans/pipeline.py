"""The coding run as one lazy plan: route -> join replies -> parse -> 27 columns.

Shuffle budget: one key join between the *projected* papers (key, title,
route - the text never crosses the shuffle) and the replies. Everything else
is narrow. The three outcomes (no text / manual review / coded) and the
call-error failures are one projection with ``CASE``, not a filter + union,
so the inputs are scanned once.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.operators.coding import coded_rows
from evidentia.operators.pages import first_accepted_text, paper_text, pick_page_strategy
from evidentia.operators.results import ROUTE_CODE, ROUTE_NO_TEXT, route, routed_failure_reason
from evidentia.functions.strings import col
from evidentia.functions.text import format_title, normalize_text, page_mode_chain
from evidentia.session import scratch_path
from evidentia.sources import paths
from evidentia.schema import (CSV_COLUMNS, EXCLUSION_REASON, FAILED_INCLUDE, FIELD_COLUMNS,
                              INCLUDE, PROCESSING_FAILED, TITLE)

NO_REPLY_ERROR = "no response recorded"
REPLY_PREFIX = 64


def extract_papers(files: DataFrame, candidates: DataFrame, rules: DataFrame, key: str = "doc_id",
                   order: str = "page_no", text: str = "text", layout: str | None = None,
                   html: str | None = None, strategy: str | None = None, file_name: str = "file_name",
                   is_pdf: str = "is_pdf", title=None, author=None, page_count=None,
                   chunk_pages: int | None = None, by_method: bool = False) -> DataFrame:
    """``(key, file_name, method, text, route)``: the papers' texts from page candidates.

    ``files`` has one row per paper ``(key, file_name, is_pdf, ..)`` and ``candidates`` one per
    (paper, method, page): ``(key, method, page_no, text)``. Where one method read a page in
    several ways, ``strategy`` names the column that orders them; ``layout`` and ``html``
    name the other modes of a page of the method 'layout'. Each page's text is NFKD-normalized, the
    first accepted method wins, a PDF without one gets the stand-in text and any other file ''. A
    file without candidates stays; candidates without a file are left out. Pages are prepared (mode chain,
    strategy, NFKD) method by method, for the papers still without a text (``first_accepted_text``).
    """
    def prepare(pages: DataFrame) -> DataFrame:
        if layout and html:
            pages = pages.withColumn(text, F.when(F.col("method") == "layout", page_mode_chain(text, layout, html))
                                            .otherwise(F.col(text)))
        if strategy:
            pages = pick_page_strategy(pages, key=(key, "method", order), order=strategy, text=text) \
                .withColumnRenamed("text", text)
        return pages.select(key, "method", order, normalize_text(text).alias(text))

    used = [c for c in (key, "method", order, text, layout, html, strategy) if c]
    accepted = first_accepted_text(candidates.select(*used), rules, key, order, text, chunk_pages, prepare, by_method)
    papers = paper_text(files, accepted, key, file_name, is_pdf, title, author, page_count)
    return papers.withColumn("route", route("text"))


def attach_responses(docs: DataFrame, responses: DataFrame, key: str = "doc_id") -> DataFrame:
    """Left-join stored replies ``(key, response, error)``; a paper without a
    stored reply gets ``error = 'no response recorded'``."""
    r = responses.select(key, "response", "error", F.lit(True).alias("_has_reply"))
    j = docs.join(r, key, "left")
    return (j.withColumn("error", F.when(F.col("_has_reply").isNull(), F.lit(NO_REPLY_ERROR))
                         .otherwise(F.col("error")))
             .drop("_has_reply"))


def routed_papers(docs: DataFrame, text="text", file_name="file_name", key="doc_id") -> DataFrame:
    """``(key, route, Title)``: the only paper columns the coding step needs."""
    r = route(text)
    return docs.select(
        key, r.alias("route"),
        F.when(col(text).isNull() | (col(text) == F.lit("")), col(file_name))
         .otherwise(format_title(col(file_name))).alias(TITLE))


def code_documents(docs: DataFrame, responses: DataFrame, text="text", file_name="file_name",
                   key: str = "doc_id") -> DataFrame:
    """One coded row per paper: ``key`` + the 27 result columns.

    ``responses`` holds ``(key, response, error)``; ``error`` set means the
    model call failed for that paper only (failed row, Include 'N').

    Of several stored replies for one paper one counts (``one_parsed_reply``).

    Plan: the replies are parsed where they are read, the parsed answers reduced
    on the key and joined to the projected papers on the same partitioning, so neither
    paper text nor raw replies move. Papers routed away from coding get the failure values
    in the final projection.
    """
    papers = routed_papers(docs, text, file_name, key)
    joined = papers.join(one_parsed_reply(responses, key).drop(TITLE), key, "left")
    return finish_coded(joined, key)


def code_replies(docs: DataFrame, responses: DataFrame, text="text", file_name="file_name",
                 key: str = "doc_id") -> DataFrame:
    """Like ``code_documents`` but driven by the replies: one row per reply
    whose paper is known (inner join). This is the form a stream of replies
    can be joined in (stream on the left, static papers on the right)."""
    return code_routed_replies(routed_papers(docs, text, file_name, key), responses, key)


def code_routed_replies(routed: DataFrame, responses: DataFrame, key: str = "doc_id") -> DataFrame:
    """``code_replies`` on already routed papers ``(key, route, Title)``
    (``routed_papers``), e.g. a thin table staged once for a stream."""
    joined = _parsed_replies(responses, key).drop(TITLE).join(routed, key, "inner")
    return finish_coded(joined, key)


def _parsed_replies(responses: DataFrame, key: str, *keep: str) -> DataFrame:
    replies = responses.select(key, "response", "error", F.lit(True).alias("_has_reply"), *keep)
    return coded_rows(replies, response="response", title=F.lit(None).cast("string"),
                      keep=(key, "error", "_has_reply", *keep))


def finish_coded(joined: DataFrame, key: str) -> DataFrame:
    """Final projection: failure values for papers not routed to coding, for
    failed calls and for papers without a stored reply."""
    route_c = F.col("route")
    error = F.when(F.col("_has_reply").isNull(), F.lit(NO_REPLY_ERROR)).otherwise(F.col("error"))
    failed = (route_c != ROUTE_CODE) | error.isNotNull()
    reason = routed_failure_reason("route")
    out = [F.col(TITLE)]
    out.append(F.when(failed, F.lit(FAILED_INCLUDE)).otherwise(F.col(f"`{INCLUDE}`")).alias(INCLUDE))
    out.append(F.when(failed, reason).otherwise(F.col(f"`{EXCLUSION_REASON}`"))
                .alias(EXCLUSION_REASON))
    out += [F.when(failed, F.lit(PROCESSING_FAILED)).otherwise(F.col(f"`{c}`")).alias(c)
            for c in FIELD_COLUMNS]
    result = joined.select(key, *out)
    assert result.columns[1:] == CSV_COLUMNS
    return result


def one_parsed_reply(responses: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, error, _has_reply, <27 columns>)`` with one row per key: of several replies a success before a
    failure, then the smallest by its first ``REPLY_PREFIX`` characters, then by its SHA-256 digest. So the choice never
    needs the reply itself: replies are parsed in the projection that reads them, and what is reduced
    (map-side first, on the key the join uses) is the flag, the prefix, the digest and the parsed answers."""
    said = F.coalesce("response", "error", F.lit(""))
    order = F.struct(F.col("error").isNotNull().alias("f"), F.substring(said, 1, REPLY_PREFIX).alias("p"),
                     F.sha2(said, 256).alias("d"))
    parsed = _parsed_replies(responses.select(key, "response", "error", order.alias("_order")), key, "_order")
    rest = [F.col(f"`{c}`") for c in parsed.columns if c not in (key, "_order")]
    best = F.min_by(F.struct(*rest), F.col("_order")).alias("_r")
    return parsed.groupBy(key).agg(best).select(key, "_r.*")


def drop_done(docs: DataFrame, done: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` without the papers whose key is in ``done``; a paper without a
    key is never done. One anti join at every size: Spark broadcasts the keys while
    they are small."""
    return docs.join(done.select(key), key, "left_anti")


def request_documents(docs: DataFrame, template: str, model=None, key: str = "doc_id",
                      text: str = "text", context_tokens: int | None = None,
                      mode: str = "compat", skip: DataFrame | None = None,
                      max_tokens: int | None = None, temperature: float | None = None) -> DataFrame:
    """``(key, request, request_json)`` for the papers routed to coding: text
    fitted to the budget (``context_tokens``), prompt, request payload with the reply cap
    ``max_tokens`` and the ``temperature`` (all narrow).

    ``skip`` (a frame with ``key``) drops papers that already have a reply,
    before any text work (see ``drop_done``).
    """
    from evidentia.operators.context import fit_context
    from evidentia.operators.requests import build_requests, prompt_text
    from evidentia.schema import DEFAULT_MAX_TOKENS, DEFAULT_MODEL, DEFAULT_TEMPERATURE, MAX_CONTEXT_TOKENS
    if skip is not None:
        docs = drop_done(docs, skip, key)
    coded = docs.where(route(text) == F.lit(ROUTE_CODE))
    fitted = fit_context(text, max_tokens=context_tokens or MAX_CONTEXT_TOKENS, mode=mode)["text"]
    prompts = coded.select(key, prompt_text(template, fitted, mode).alias("prompt"))
    return build_requests(prompts, model=model or DEFAULT_MODEL, key=key,
                          max_tokens=DEFAULT_MAX_TOKENS if max_tokens is None else max_tokens,
                          temperature=DEFAULT_TEMPERATURE if temperature is None else temperature)


def committed_reply_batches(spark, replies_path: str) -> list[str]:
    """The committed reply batches under ``replies_path``: its sub-folders
    with a _SUCCESS marker (or the folder itself, when one committed output
    was written there directly). A batch whose job failed part-way has no
    marker and is ignored. Only folder metadata is listed on the driver."""
    if paths.committed(spark, replies_path):
        return [replies_path]
    return [d for d in paths.child_dirs(spark, replies_path) if paths.committed(spark, d)]


def read_replies(spark, replies_path: str, key: str = "doc_id") -> DataFrame:
    """Stored replies ``(key, response, error)``: the committed batches a
    ``run_coding`` folder holds, else the folder read as one Parquet table
    (replies written by another tool)."""
    batches = committed_reply_batches(spark, replies_path)
    if not batches:
        return spark.read.parquet(replies_path)
    return _one_reply_per_paper(spark, batches, key)


def _one_reply_per_paper(spark, batches: list[str], key: str) -> DataFrame:
    """The union of the batches, one row per paper. A paper appears in more
    than one batch only when an earlier call failed and was asked again
    (``retry_failed``): it keeps its successful reply, else its latest
    failure. Successful replies are never shuffled; only failure rows and
    the successful keys are (batch names sort by time)."""
    df = spark.read.parquet(*batches)
    if len(batches) == 1:
        return df
    cols = df.columns
    ok = df.where(F.col("error").isNull())
    failed = (df.where(F.col("error").isNotNull())
                .withColumn("_batch", F.col("_metadata.file_path"))
                .join(ok.select(key), key, "left_anti"))
    latest = failed.groupBy(key).agg(F.max_by(F.struct(*[c for c in cols if c != key]),
                                              F.col("_batch")).alias("_r"))
    return ok.unionByName(latest.select(key, "_r.*").select(*cols))


def run_coding(docs: DataFrame, responder, template: str, replies_path: str,
               output_path: str | None = None, key: str = "doc_id", text: str = "text",
               file_name: str = "file_name", model=None, csv: bool = False,
               reuse_replies: bool = True, retry_failed: bool = False, batches: int = 1,
               context_tokens: int | None = None, mode: str = "compat",
               max_tokens: int | None = None, temperature: float | None = None) -> DataFrame:
    """The whole run: requests -> responder -> replies written once to
    ``replies_path`` (a shared folder) -> coded rows -> optional sink.

    Writing the replies cuts the lineage before the expensive, non-repeatable
    step's consumers: a lost executor later on re-reads stored replies
    instead of calling the model again. ``replies_path`` holds one committed
    batch per run. With ``reuse_replies`` a rerun (after a failed job, a lost
    driver, or with papers added to ``docs``) reads the committed batches,
    calls the model only for papers that have no stored reply yet and commits
    those replies as a new batch; a batch whose write failed part-way commits
    nothing and its papers are simply asked again. Stored replies, failed
    calls included, are kept as they are unless ``retry_failed``: then only
    successful replies count as done, papers whose call failed are asked
    again, and a paper keeps its successful reply, else its latest failure.
    Without ``reuse_replies`` every paper is asked again, and only once all new
    replies are committed are the older batches removed.

    The requests are dealt by a hash of the paper's key into ``batches`` jobs, each
    committed on its own: a run that dies keeps the batches it finished, and
    the next one asks for the others only. With more than one batch the requests are written
    once, in the shared folder, and the papers read once, whatever the number of batches.
    """
    from evidentia.operators.requests import apply_responder, persist_responses
    spark = docs.sparkSession
    stored_batches = committed_reply_batches(spark, replies_path)
    if stored_batches == [replies_path]:
        # new batches cannot go inside another job's output folder
        raise ValueError(f"{replies_path} is one committed Parquet output, not a folder of "
                         "reply batches: read it with read_replies / code_documents, or "
                         "give run_coding another replies_path")
    if docs.isEmpty():  # nothing is asked and nothing written; an earlier output stays
        none = spark.createDataFrame([], f"{key} {docs.schema[key].dataType.simpleString()}, response string, error string")
        return code_documents(docs, none, text=text, file_name=file_name, key=key)
    reused = stored_batches if reuse_replies else []
    stored = spark.read.parquet(*reused) if reused else None
    if stored is not None and retry_failed:
        stored = stored.where(F.col("error").isNull())
    reqs = request_documents(docs, template, model=model, key=key, text=text, skip=stored, mode=mode,
                             context_tokens=context_tokens, max_tokens=max_tokens, temperature=temperature)
    new, dealt = [], None
    if batches > 1:
        # one pass over the papers: their requests are written dealt by key hash, and each job reads its own part only
        dealt = scratch_path(spark, f"requests-{uuid.uuid4().hex}")
        part_of = F.pmod(F.xxhash64(key), F.lit(batches)).cast("int").alias("_part")
        requests = reqs.select(key, "request_json", part_of)
        requests.write.partitionBy("_part").parquet(dealt)
        reqs = spark.read.schema(requests.schema).parquet(dealt)
    for i in range(batches):
        part = reqs if dealt is None else reqs.where(F.col("_part") == i)
        new.append(f"{replies_path.rstrip('/')}/batch-{int(time.time() * 1000)}-{uuid.uuid4().hex[:8]}")
        persist_responses(apply_responder(part, responder, key=key), new[-1])
    if dealt is not None:
        paths.delete(spark, dealt)
    if not reuse_replies:
        for old in stored_batches:
            paths.delete(spark, old)
    replies = _one_reply_per_paper(spark, [*reused, *new], key)
    coded = code_documents(docs, replies, text=text, file_name=file_name, key=key)
    if output_path:
        if csv:
            from evidentia.sources.sinks import write_coding_csv
            write_coding_csv(coded, output_path)
        else:
            coded.write.mode("overwrite").parquet(output_path)
    return coded

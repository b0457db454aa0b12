"""Plan-shape guards for the scale properties the design relies on."""

import re

from pyspark.sql import functions as F

from evidentia.operators.coding import coded_rows
from evidentia.operators.context import fit_documents
from evidentia.operators.pages import assemble_pages, extraction_rules, first_accepted_text
from evidentia.plans.pipeline import code_documents

SF = "/root/testdata/sf0.001"


def _formatted(df):
    mode = df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def _exchange_inputs(df, broadcasts=False):
    """Input column lists of every shuffle exchange (and broadcasts if asked)."""
    text = _formatted(df)
    out = []
    for block in re.split(r"\n\(\d+\) ", text):
        kinds = ("Exchange", "BroadcastExchange") if broadcasts else ("Exchange",)
        if block.split(" ")[0].split("\n")[0] in kinds:
            m = re.search(r"Input \[\d+\]: \[([^\]]*)\]", block)
            out.append(m.group(1) if m else "")
    return out


def _docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_parser_and_budget_do_not_shuffle(spark):
    docs = _docs(spark)
    replies = docs.select("doc_id", F.lit("t").alias("title"), F.col("text").alias("response"))
    assert _exchange_inputs(coded_rows(replies, title="title")) == []
    assert _exchange_inputs(fit_documents(docs, max_tokens=100, mode="newline")) == []


def test_coding_join_moves_no_text(spark):
    docs = _docs(spark).selectExpr("doc_id", "source AS file_name", "text")
    replies = _docs(spark).selectExpr("doc_id", "text AS response", "CAST(NULL AS STRING) AS error")
    inputs = _exchange_inputs(code_documents(docs, replies), broadcasts=True)
    assert inputs                     # a shuffle or a broadcast, whichever the sizes give
    for cols in inputs:
        assert not re.search(r"\b(text|response)#", cols), cols


def test_pages_shuffle_text_once(spark):
    conv = spark.read.parquet(f"{SF}/conversations.parquet")
    # one exchange, carrying the partial collect_list buffers (the page text)
    assert len(_exchange_inputs(assemble_pages(conv, "conv_id", "turn", "text"))) == 1
    # of the methods' pages, each in its own part, only those of open papers are assembled: the result is written texts
    cands = conv.selectExpr("conv_id AS doc_id", "'layout' AS method", "turn AS page_no", "text")
    assert _exchange_inputs(first_accepted_text(cands, extraction_rules(spark))) == []


def test_results_scan_each_input_once(spark):
    from evidentia.plans import queries
    plan = queries.q_assemble_results(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2          # documents and pages


def test_bucketed_inputs_code_without_shuffle(spark, tmp_path):
    from evidentia.plans import fixtures
    from evidentia.sources.sinks import write_bucketed
    src = _docs(spark)
    write_bucketed(fixtures.named_documents(src), "papers_b", buckets=4, path=str(tmp_path / "p"))
    write_bucketed(fixtures.responses(src), "replies_b", buckets=4, path=str(tmp_path / "r"))
    # large tables never broadcast; make the small test tables behave the same
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        coded = code_documents(spark.table("papers_b"), spark.table("replies_b"))
        assert _exchange_inputs(coded, broadcasts=True) == []
        assert coded.count() == src.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)

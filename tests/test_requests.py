"""Prompts, request payloads and the responder's failure isolation."""

import json

from evidentia.operators.requests import (apply_responder, build_prompt, build_requests,
                                          persist_responses)


def test_prompt_compat_and_newline(spark):
    df = spark.createDataFrame([(1, "TEXT")], "doc_id long, text string")
    assert build_prompt(df, "T").first().prompt == "T\\n\\nRESEARCH PAPER:\\nTEXT"
    assert build_prompt(df, "T", mode="newline").first().prompt == "T\n\nRESEARCH PAPER:\nTEXT"


def test_request_fields(spark):
    df = spark.createDataFrame([(1, "p", m) for m in
                                ["gpt-4o-mini", "gpt-5-mini", "gpt-4-turbo", "gpt-5"]],
                               "doc_id long, prompt string, model string")
    from pyspark.sql import functions as F
    rows = build_requests(df, model=F.col("model")).collect()
    js = {json.loads(r.request_json)["model"]: json.loads(r.request_json) for r in rows}
    assert js["gpt-4o-mini"]["max_completion_tokens"] == 2000 and js["gpt-4o-mini"]["temperature"] == 0.0
    assert "temperature" not in js["gpt-5-mini"] and "max_tokens" not in js["gpt-5-mini"]
    assert js["gpt-4-turbo"]["max_tokens"] == 2000 and "max_completion_tokens" not in js["gpt-4-turbo"]
    assert [m["role"] for m in js["gpt-5"]["messages"]] == ["system", "user"]


def test_responder_isolates_failures(spark, tmp_path):
    df = spark.createDataFrame([(i, f"p{i}") for i in range(20)], "doc_id long, prompt string")
    reqs = build_requests(df)

    def fn(req):
        text = req["messages"][1]["content"]
        if text.endswith("3"):
            raise ValueError("bad paper")
        return "reply " + text

    out = persist_responses(apply_responder(reqs, fn), str(tmp_path / "replies"))
    got = {r.doc_id: (r.response, r.error) for r in out.collect()}
    assert len(got) == 20
    assert got[3] == (None, "ValueError: bad paper") and got[13][1] == "ValueError: bad paper"
    assert got[4] == ("reply p4", None)


def test_responder_gets_api_shaped_request(spark):
    df = spark.createDataFrame([(1, "p")], "doc_id long, prompt string")
    reqs = build_requests(df, model="gpt-5-mini")
    seen = apply_responder(reqs, lambda r: ",".join(sorted(r))).first().response
    assert seen == "max_completion_tokens,messages,model"
    seen_struct = apply_responder(reqs, lambda r: ",".join(sorted(r)), request="request").first().response
    assert seen_struct == seen


def test_drop_done_keeps_papers_without_a_key(spark):
    from evidentia.plans.pipeline import drop_done
    docs = spark.createDataFrame([(i, "x") for i in [*range(20), None, None]], "doc_id long, text string")
    done = spark.createDataFrame([(i, "r") for i in [0, 3, 6, 6, None]], "doc_id long, response string")
    want = sorted([i for i in range(20) if i not in (0, 3, 6)])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in (old, "-1"):  # whichever join Spark takes
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        got = [r.doc_id for r in drop_done(docs, done).collect()]
        assert got.count(None) == 2 and sorted(i for i in got if i is not None) == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_request_settings_reach_the_request(spark):
    from evidentia.plans.pipeline import request_documents
    docs = spark.createDataFrame([(1, "word " * 900)], "doc_id long, text string")
    r = request_documents(docs, "T", model="gpt-4-turbo", max_tokens=77, temperature=0.5, context_tokens=100, mode="newline").first()
    js = json.loads(r.request_json)
    assert js["max_tokens"] == 77 and js["temperature"] == 0.5 and len(js["messages"][1]["content"]) < 600


def test_one_coded_row_per_paper_with_several_replies(spark):
    from evidentia.plans.pipeline import code_documents
    papers = spark.createDataFrame([(1, "a.pdf", "text"), (2, "b.pdf", "text"), (3, "c.pdf", "")], "doc_id long, file_name string, text string")
    replies = spark.createDataFrame([(1, None, "timeout"), (1, "4. D: second one", None), (1, "4. D: first one", None), (2, None, "b"), (2, None, "a")],
                                    "doc_id long, response string, error string")
    rows = {r.doc_id: r for r in code_documents(papers, replies).collect()}
    assert len(rows) == code_documents(papers, replies).count() == 3
    assert rows[1]["1.4 Tool/Platform"] == "first one" and rows[2]["1.4 Tool/Platform"] == "Processing failed"


def test_batches_commit_one_by_one(spark, tmp_path):
    import pytest
    from evidentia.plans import pipeline
    papers = spark.createDataFrame([(i, f"{i}.pdf", f"text {i}") for i in range(40)], "doc_id long, file_name string, text string")
    replies, calls = str(tmp_path / "replies"), []
    real = pipeline.time.time

    def dies():  # the driver is lost before the third batch
        calls.append(1)
        if len(calls) == 3:
            raise KeyboardInterrupt
        return real()
    pipeline.time.time = dies
    try:
        with pytest.raises(KeyboardInterrupt):
            pipeline.run_coding(papers, lambda r: "4. D: from the first run", "T", replies, batches=4)
    finally:
        pipeline.time.time = real
    kept = pipeline.read_replies(spark, replies).count()
    assert len(pipeline.committed_reply_batches(spark, replies)) == 2 and 0 < kept < 40
    coded = pipeline.run_coding(papers, lambda r: "4. D: from the second run", "T", replies, batches=4)
    said = [r["1.4 Tool/Platform"] for r in coded.collect()]
    assert said.count("from the first run") == kept and len(said) == 40
    again = pipeline.run_coding(papers, lambda r: "4. D: asked anew", "T", replies, reuse_replies=False)
    assert {r["1.4 Tool/Platform"] for r in again.collect()} == {"asked anew"}
    assert len(pipeline.committed_reply_batches(spark, replies)) == 1


def test_replies_hold_every_character_of_the_documents(spark):
    from evidentia.plans import fixtures
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = fixtures.papers(docs).selectExpr("doc_id", "text", f"{fixtures.RESPONSE_EXPR} AS response")
    assert r.where("response IS NULL OR instr(response, text) = 0").count() == 0
    named = fixtures.named_documents(docs)
    assert named.join(docs.select("doc_id", docs["text"].alias("t")), "doc_id").where("text <> t").count() == 0

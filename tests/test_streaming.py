"""The streaming coder gives the batch coder's rows for the replies that landed."""

from evidentia.plans import fixtures
from evidentia.plans.pipeline import (code_documents, committed_reply_batches, read_replies,
                                      request_documents, run_coding)
from evidentia.streaming.coding_stream import stream_code_replies

SF = "/root/testdata/sf0.001"


def test_stream_matches_batch(spark, tmp_path, capsys):
    src = spark.read.parquet(f"{SF}/documents.parquet")
    papers = fixtures.named_documents(src)
    replies = fixtures.responses(src)
    # two reply batches land in the folder
    replies.where("doc_id < 100").write.parquet(str(tmp_path / "in" / "b1"))
    replies.where("doc_id >= 100").write.parquet(str(tmp_path / "in" / "b2"))
    q = stream_code_replies(spark, str(tmp_path / "in" / "*"), papers, str(tmp_path / "out"),
                            checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    # a micro-batch reads the staged (key, route, Title) table, never paper text
    capsys.readouterr()
    q.explain()
    plan = capsys.readouterr().out
    assert "ReadSchema" in plan and "text:string" not in plan and "Title:string" in plan
    got = spark.read.parquet(str(tmp_path / "out"))
    want = code_documents(papers, replies)
    assert got.count() == want.count() == src.count()
    assert got.exceptAll(want.select(*[f"`{c}`" for c in got.columns])).count() == 0


def test_run_coding_end_to_end(spark, tmp_path):
    src = spark.read.parquet(f"{SF}/documents.parquet")
    papers = fixtures.named_documents(src)
    coded = run_coding(papers, fixtures.demo_responder, "Code this paper.",
                       str(tmp_path / "replies"), str(tmp_path / "coded"))
    out = spark.read.parquet(str(tmp_path / "coded"))
    assert out.count() == coded.count() == src.count()
    failed = out.where("`Include in Review (Y/N)` = 'N'").count()
    coded_ok = out.where("`1.1 Primary Stakeholders` LIKE 'Readers of a %'").count()
    assert failed > 0 and coded_ok > 0 and failed + coded_ok == src.count()


def test_stream_restart_codes_each_reply_once(spark, tmp_path):
    src = spark.read.parquet(f"{SF}/documents.parquet")
    papers = fixtures.named_documents(src)
    replies = fixtures.responses(src)
    inbox, out, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    replies.where("doc_id < 50").write.parquet(str(inbox / "b1"))
    stream_code_replies(spark, str(inbox / "*"), papers, out, checkpoint=ckpt).awaitTermination(300)
    first = spark.read.parquet(out).count()
    # more replies land while the job is down; the restart resumes from the checkpoint
    replies.where("doc_id >= 50").write.parquet(str(inbox / "b2"))
    stream_code_replies(spark, str(inbox / "*"), papers, out, checkpoint=ckpt).awaitTermination(300)
    done = spark.read.parquet(out)
    assert first == 50
    assert done.count() == src.count() == done.select("doc_id").distinct().count()


def test_run_coding_reuses_committed_replies(spark, tmp_path):
    src = spark.read.parquet(f"{SF}/documents.parquet")
    papers = fixtures.named_documents(src)
    replies = str(tmp_path / "replies")
    run_coding(papers, fixtures.demo_responder, "T", replies, str(tmp_path / "o1"))
    # a rerun must not call the model again: this responder would change every answer
    run_coding(papers, lambda req: "**1. X**: SECOND CALL", "T", replies, str(tmp_path / "o2"))
    a = spark.read.parquet(str(tmp_path / "o1"))
    b = spark.read.parquet(str(tmp_path / "o2"))
    assert b.where("`1.1 Primary Stakeholders` = 'SECOND CALL'").count() == 0
    assert a.exceptAll(b).count() == 0


def test_run_coding_asks_only_papers_without_a_stored_reply(spark, tmp_path):
    src = spark.read.parquet(f"{SF}/documents.parquet")
    papers = fixtures.named_documents(src)
    replies = str(tmp_path / "replies")
    first = papers.where("doc_id < 50")
    run_coding(first, fixtures.demo_responder, "T", replies, str(tmp_path / "o1"))
    # a batch folder without _SUCCESS (a write that failed part-way) is ignored
    first.limit(1).write.parquet(str(tmp_path / "replies" / "batch-broken"))
    (tmp_path / "replies" / "batch-broken" / "_SUCCESS").unlink()
    # all papers now: only the new ones reach the (different) responder
    run_coding(papers, lambda req: "**1. X**: SECOND CALL", "T", replies, str(tmp_path / "o2"))
    a = spark.read.parquet(str(tmp_path / "o1"))
    b = spark.read.parquet(str(tmp_path / "o2"))
    assert b.count() == src.count() == b.select("doc_id").distinct().count()
    second = b.where("`1.1 Primary Stakeholders` = 'SECOND CALL'").select("doc_id")
    assert second.where("doc_id < 50").count() == 0
    assert second.count() > 0
    assert a.exceptAll(b.where("doc_id < 50")).count() == 0
    # without reuse every paper is asked again
    run_coding(papers, lambda req: "**1. X**: THIRD CALL", "T", replies, str(tmp_path / "o3"),
               reuse_replies=False)
    c = spark.read.parquet(str(tmp_path / "o3"))
    assert c.count() == src.count()
    assert c.where("`1.1 Primary Stakeholders` = 'SECOND CALL'").count() == 0
    assert c.where("`1.1 Primary Stakeholders` = 'THIRD CALL'").count() > 0
    assert len(committed_reply_batches(spark, replies)) == 1
    stored = read_replies(spark, replies)
    asked = request_documents(papers, "T").select("doc_id")
    assert stored.count() == asked.count() == stored.select("doc_id").distinct().count()
    assert stored.select("doc_id").exceptAll(asked).count() == 0


def test_run_coding_retry_failed_asks_failed_papers_again(spark, tmp_path):
    src = spark.read.parquet(f"{SF}/documents.parquet")
    papers = fixtures.named_documents(src)
    replies = str(tmp_path / "replies")
    run_coding(papers, fixtures.demo_responder, "T", replies, str(tmp_path / "o1"))
    first = read_replies(spark, replies)
    failed_keys = {r.doc_id for r in first.where("error IS NOT NULL").select("doc_id").collect()}
    assert failed_keys
    run_coding(papers, lambda req: "**1. X**: SECOND CALL", "T", replies, str(tmp_path / "o2"),
               retry_failed=True)
    both = read_replies(spark, replies)
    assert len(committed_reply_batches(spark, replies)) == 2
    assert both.count() == first.count() == both.select("doc_id").distinct().count()
    assert both.where("error IS NOT NULL").count() == 0
    b = spark.read.parquet(str(tmp_path / "o2"))
    again = {r.doc_id for r in b.where("`1.1 Primary Stakeholders` = 'SECOND CALL'")
             .select("doc_id").collect()}
    assert again == failed_keys
    a = spark.read.parquet(str(tmp_path / "o1"))
    keep = ",".join(str(k) for k in sorted(failed_keys))
    assert a.where(f"doc_id NOT IN ({keep})").exceptAll(b.where(f"doc_id NOT IN ({keep})")).count() == 0


def test_read_replies_success_else_latest_failure(spark, tmp_path):
    schema = "doc_id long, response string, error string"
    root = tmp_path / "replies"
    batches = {
        "batch-0001-a": [(1, None, "e1"), (2, "r2", None)],
        "batch-0002-b": [(1, None, "e2"), (3, None, "e3")],
        "batch-0003-c": [(3, "r3", None)],
    }
    for name, rows in batches.items():
        spark.createDataFrame(rows, schema).write.parquet(str(root / name))
    got = {r.doc_id: (r.response, r.error) for r in read_replies(spark, str(root)).collect()}
    assert got == {1: (None, "e2"), 2: ("r2", None), 3: ("r3", None)}


def test_run_coding_refuses_a_plain_replies_folder(spark, tmp_path):
    import pytest
    src = spark.read.parquet(f"{SF}/documents.parquet")
    plain = str(tmp_path / "plain")
    fixtures.responses(src).write.parquet(plain)
    with pytest.raises(ValueError, match="not a folder of reply batches"):
        run_coding(fixtures.named_documents(src), fixtures.demo_responder, "T", plain)
    assert read_replies(spark, plain).count() == src.count()


def _stream_rows(spark, out):
    return sorted(tuple(r) for r in spark.read.parquet(out).collect())


def _batch_rows(papers, replies, columns):
    return sorted(tuple(r) for r in code_documents(papers, replies).select(*[f"`{c}`" for c in columns]).collect())


def test_stream_codes_a_reply_once_its_paper_comes(spark, tmp_path):
    """Replies of every paper land first; their papers come in two later starts, by folder."""
    src = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    papers, replies = fixtures.named_documents(src), fixtures.responses(src)
    inbox, shelf, out, ckpt = str(tmp_path / "in"), tmp_path / "papers", str(tmp_path / "out"), str(tmp_path / "ckpt")

    def run():
        stream_code_replies(spark, f"{inbox}/*", f"{shelf}/*", out, checkpoint=ckpt).awaitTermination(300)
        return spark.read.parquet(out)

    replies.where("doc_id < 40").write.parquet(f"{inbox}/b1")
    papers.where("doc_id < 10").write.parquet(str(shelf / "p1"))
    assert run().count() == 10                        # 30 replies wait
    papers.where("doc_id BETWEEN 10 AND 29").write.parquet(str(shelf / "p2"))
    replies.where("doc_id BETWEEN 40 AND 49").write.parquet(f"{inbox}/b2")
    assert run().count() == 30                        # the state outlives the restart
    papers.where("doc_id >= 30").write.parquet(str(shelf / "p3"))
    replies.where("doc_id >= 50").write.parquet(f"{inbox}/b3")
    done = run()
    assert _stream_rows(spark, out) == _batch_rows(papers, replies, done.columns)
    assert run().count() == 60                        # nothing twice


def test_stream_takes_papers_added_at_a_later_start(spark, tmp_path):
    src = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 40")
    papers, replies = fixtures.named_documents(src), fixtures.responses(src)
    inbox, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    replies.write.parquet(f"{inbox}/b1")
    first = stream_code_replies(spark, f"{inbox}/*", papers.where("doc_id < 15"), out, checkpoint=ckpt)
    first.awaitTermination(300)
    assert spark.read.parquet(out).count() == 15
    stream_code_replies(spark, f"{inbox}/*", papers, out, checkpoint=ckpt).awaitTermination(300)
    done = spark.read.parquet(out)
    assert _stream_rows(spark, out) == _batch_rows(papers, replies, done.columns)


def test_meeting_of_replies_and_papers():
    import pandas as pd

    from evidentia.streaming.coding_stream import _meet

    class State:
        exists, value = False, None

        @property
        def get(self):
            return self.value

        def update(self, value):
            self.exists, self.value = True, value

    def rows(*r):
        return pd.DataFrame(r, columns=["doc_id", "response", "error", "route", "Title", "is_paper"])

    def feed(state, *batches):
        return [tuple(r) for df in _meet((7,), iter(batches), state) for r in df.itertuples(index=False)]

    s = State()
    assert feed(s, rows((7, "a", None, None, None, False)), rows((7, None, "failed", None, None, False))) == []
    assert s.value == (None, None, [("a", None), (None, "failed")])
    # the paper comes twice in one batch, after one more reply: the smallest counts
    got = feed(s, rows((7, "b", None, None, None, False), (7, None, None, "code", "T2", True)), rows((7, None, None, "code", "T1", True)))
    assert got == [(7, "a", None, "code", "T1"), (7, None, "failed", "code", "T1"), (7, "b", None, "code", "T1")]
    assert s.value == ("code", "T1", [])
    # a later paper of the key changes nothing, a later reply passes through
    assert feed(s, rows((7, None, None, "no_text", "T0", True), (7, "c", None, None, None, False))) == [(7, "c", None, "code", "T1")]
    assert s.value == ("code", "T1", [])

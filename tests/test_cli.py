"""The command line runs the coding run, request export and audit end to end."""

from evidentia import cli
from evidentia.plans import fixtures
from evidentia.schema import CSV_COLUMNS

SF = "/root/testdata/sf0.001"


def _empty(spark, tmp_path):
    """A folder of papers without a row."""
    path = str(tmp_path / "no-papers")
    spark.createDataFrame([], "doc_id long, file_name string, text string").write.parquet(path)
    return path


def test_cli_round_trip(spark, tmp_path):
    src = fixtures.papers(*(spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "pages")))
    fixtures.named_documents(src).write.parquet(str(tmp_path / "papers"))
    fixtures.responses(src).write.parquet(str(tmp_path / "replies"))
    (tmp_path / "t.txt").write_text("Code this paper.\n")
    assert cli.main(["requests", "--papers", str(tmp_path / "papers"), "--template",
                     str(tmp_path / "t.txt"), "--out", str(tmp_path / "reqs")]) == 0
    reqs = spark.read.parquet(str(tmp_path / "reqs"))
    assert reqs.count() > 0 and reqs.columns == ["doc_id", "request_json"]
    assert cli.main(["code", "--papers", str(tmp_path / "papers"), "--replies",
                     str(tmp_path / "replies"), "--out", str(tmp_path / "out"), "--csv"]) == 0
    from evidentia.sources.sinks import read_coding_csv
    import glob
    csv_path = glob.glob(str(tmp_path / "out" / "literature_coding_results_*.csv"))[0]
    back = read_coding_csv(spark, csv_path)
    assert back.columns == CSV_COLUMNS and back.count() == src.count()
    conv, pages = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("conversations", "pages"))
    fixtures.extract_files(conv, pages).write.parquet(str(tmp_path / "files"))
    fixtures.candidates(conv).write.parquet(str(tmp_path / "candidates"))
    assert cli.main(["extract", "--files", str(tmp_path / "files"), "--candidates", str(tmp_path / "candidates"),
                     "--chunk-pages", "4", "--out", str(tmp_path / "texts")]) == 0
    texts = spark.read.parquet(str(tmp_path / "texts"))
    assert texts.columns == ["doc_id", "file_name", "method", "text", "route"]
    assert texts.count() == fixtures.extract_files(conv, pages).count()
    rc = cli.main(["audit", "--papers", str(tmp_path / "papers"), "--out", str(tmp_path / "audit")])
    assert rc == 1        # the fixture has papers without text
    assert cli.main(["audit", "--papers", _empty(spark, tmp_path), "--out", str(tmp_path / "none")]) == 1
    assert spark.read.parquet(str(tmp_path / "audit" / "summary")).first().total == src.count()


def test_run_asks_the_users_responder_and_codes(spark, tmp_path):
    src = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 40")
    fixtures.named_documents(src).write.parquet(str(tmp_path / "papers"))
    run = ["run", "--papers", str(tmp_path / "papers"), "--responder", "evidentia.plans.fixtures:demo_responder",
           "--replies", str(tmp_path / "replies"), "--out", str(tmp_path / "out"), "--batches", "3"]
    assert cli.main(run) == 0
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 40 and out.columns[1:] == CSV_COLUMNS
    assert out.where("`1.1 Primary Stakeholders` LIKE 'Readers of a %'").count() > 0
    # a second run finds every reply stored
    before = sorted(tuple(r) for r in out.collect())
    assert cli.main([*run[:-2], "--retry-failed"]) == 0
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == before


def test_runs_without_papers_write_nothing(spark, tmp_path):
    papers = _empty(spark, tmp_path)
    replies = str(tmp_path / "stored")
    spark.createDataFrame([(1, "a", None)], "doc_id long, response string, error string").write.parquet(replies)
    out = tmp_path / "out"
    for extra in ([], ["--csv"]):
        assert cli.main(["code", "--papers", papers, "--replies", replies, "--out", str(out), *extra]) == 0
        assert cli.main(["run", "--papers", papers, "--responder", "evidentia.plans.fixtures:demo_responder",
                         "--replies", str(tmp_path / "new"), "--out", str(out), *extra]) == 0
    assert not out.exists() and not (tmp_path / "new").exists()


def test_responder_names():
    import pytest
    assert cli.responder_of("evidentia.plans.fixtures:demo_responder") is fixtures.demo_responder
    with pytest.raises(SystemExit):
        cli.responder_of("evidentia.plans.fixtures")

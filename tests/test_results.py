"""Routing, failed rows, assembly and the end-to-end coding run."""

from evidentia.plans.pipeline import code_documents
from evidentia.schema import CSV_COLUMNS, PLACEHOLDER_NOTE

NS, PF = "Not specified", "Processing failed"


def test_code_documents_routes(spark):
    docs = spark.createDataFrame(
        [(1, "broken.pdf", ""), (2, "scan_of_it.pdf", "Title: scan\n\n" + PLACEHOLDER_NOTE),
         (3, "good_paper.pdf", "real text"), (4, "no_reply.pdf", "real text"),
         (5, "call-error.pdf", "real text")],
        "doc_id long, file_name string, text string")
    replies = spark.createDataFrame(
        [(1, "**1. X**: Ignored answer", None), (3, "**Include in Review**: Y\n**1. X**: Learners", None),
         (5, None, "TimeoutError: slow")],
        "doc_id long, response string, error string")
    out = {r.doc_id: r.asDict() for r in code_documents(docs, replies).collect()}
    assert list(out[1])[1:] == CSV_COLUMNS
    assert out[1]["Title"] == "broken.pdf" and out[1]["Include in Review (Y/N)"] == "N"
    assert out[1]["Exclusion Reason"].startswith("Text extraction failed")
    assert out[1]["1.1 Primary Stakeholders"] == PF
    assert out[2]["Title"] == "Scan of It"
    assert out[2]["Exclusion Reason"] == "PDF processing issues - requires manual review"
    assert out[3]["Title"] == "Good Paper" and out[3]["1.1 Primary Stakeholders"] == "Learners"
    assert out[3]["1.1 Primary Stakeholders - Source"] == NS
    assert out[4]["Exclusion Reason"] == PF and out[4]["Include in Review (Y/N)"] == "N"
    assert out[5]["Exclusion Reason"] == PF and out[5]["4.2 Measurement of agency"] == PF


def test_assemble_results_string_conversion(spark):
    from evidentia.operators.results import assemble_results
    full = spark.createDataFrame([tuple([1] + ["x"] * 27)],
                                 ", ".join(["doc_id long"] + [f"`{c}` string" for c in CSV_COLUMNS]))
    partial = spark.createDataFrame([(2, None, "N")], "doc_id long, Title string, `Include in Review (Y/N)` string")
    out = {r.doc_id: r.asDict() for r in assemble_results(full, partial).collect()}
    assert list(out[2])[1:] == CSV_COLUMNS
    assert out[2]["Title"] == "None" and out[2]["Include in Review (Y/N)"] == "N"
    assert out[2]["Exclusion Reason"] == "nan" and out[1]["Exclusion Reason"] == "x"

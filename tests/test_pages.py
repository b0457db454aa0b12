"""Page assembly, per-page strategy choice and ranked extraction methods."""

from pyspark.sql import functions as F

from evidentia.operators.pages import (assemble_pages, extraction_rules, first_accepted_text,
                                       flatten_layout_pages, hot_papers, pick_page_strategy)


def test_assemble_pages(spark):
    pages = spark.createDataFrame(
        [(1, 2, "second"), (1, 1, " first "), (1, 3, None), (1, 4, ""), (2, 1, ""), (3, 1, "  ")],
        "doc_id long, page_no int, text string")
    got = {r.doc_id: r.text for r in assemble_pages(pages).collect()}
    assert got == {1: "first \nsecond", 2: "", 3: ""}


def test_pick_page_strategy(spark):
    long = "x" * 60
    cands = spark.createDataFrame(
        [(1, 1, 1, "short"), (1, 1, 2, long), (1, 1, 3, long + "y"),
         (1, 2, 1, "a"), (1, 2, 2, "b"),
         (1, 3, 1, "a"), (1, 3, 2, None)],
        "doc_id long, page_no int, strategy int, text string")
    got = {r.page_no: r.text for r in pick_page_strategy(cands).collect()}
    assert got == {1: long, 2: "b", 3: None}


def test_first_accepted_text(spark):
    rules = extraction_rules(spark)
    cands = spark.createDataFrame(
        [(1, "text_layer", 1, ""), (1, "layout", 1, "found by layout"),
         (2, "ocr", 1, "tiny"), (2, "ocr", 2, "y" * 120),
         (3, "ocr", 1, "z" * 50),
         (4, "cli", 1, "cli text"), (4, "reader", 1, "reader text")],
        "doc_id long, method string, page_no int, text string")
    got = {r.doc_id: (r.method, r.text) for r in first_accepted_text(cands, rules).collect()}
    assert got[1] == ("layout", "found by layout")
    assert got[2] == ("ocr", "y" * 120)          # tiny OCR page dropped
    assert 3 not in got                           # OCR total must exceed 100 chars
    assert got[4] == ("reader", "reader text")    # lower rank wins


def test_paper_text_fallbacks(spark):
    from evidentia.operators.pages import paper_text
    files = spark.createDataFrame(
        [(1, "a.pdf", True), (2, "scan.pdf", True), (3, "notes.pdf", False)],
        "doc_id long, file_name string, is_pdf boolean")
    accepted = spark.createDataFrame([(1, "layout", "the text")], "doc_id long, method string, text string")
    got = {r.doc_id: (r.method, r.text) for r in paper_text(files, accepted).collect()}
    assert got[1] == ("layout", "the text")
    assert got[2][0] == "placeholder" and got[2][1].startswith("Title: scan\n\nNote: ")
    assert got[3] == (None, "")


def test_chunked_assembly_equals_single_step(spark):
    import random
    rng = random.Random(5)
    rows = []
    for doc in range(30):
        for p in rng.sample(range(500), rng.randint(1, 120)):
            rows.append((doc, p, rng.choice(["", None, " ", "a", "line\\n", f"page {p} "])))
    pages = spark.createDataFrame(rows, "doc_id long, page_no int, text string")
    one = {r.doc_id: r.text for r in assemble_pages(pages).collect()}
    for k in (1, 7, 64):
        two = {r.doc_id: r.text for r in assemble_pages(pages, chunk_pages=k).collect()}
        assert two == one, k


def test_first_accepted_text_chunked(spark):
    conv = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    cands = conv.selectExpr("conv_id AS doc_id",
                            "CASE role WHEN 'user' THEN 'layout' ELSE 'ocr' END AS method",
                            "turn AS page_no", "text")
    rules = extraction_rules(spark)
    one = sorted(first_accepted_text(cands, rules).collect())
    two = sorted(first_accepted_text(cands, rules, chunk_pages=2).collect())
    assert one == two and len(one) > 0


def test_extract_papers(spark):
    from evidentia.plans.pipeline import extract_papers
    files = spark.createDataFrame(
        [(1, "a.pdf", True), (2, "b.pdf", True), (3, "c.html", False), (4, "d.pdf", True), (5, "e.pdf", True)],
        "doc_id long, file_name string, is_pdf boolean")
    cands = spark.createDataFrame(
        [(1, "text_layer", 1, 1, "\ufb01rst caf\u00e9", None, None), (1, "text_layer", 2, 1, "second", None, None),
         (2, "layout", 1, 1, "short", "", "<p>from the markup of the page</p>"),
         (4, "text_layer", 1, 1, " \u00a0", None, None),          # only white space: the next method's turn
         (4, "ocr", 1, 1, "n" * 20, None, None), (4, "ocr", 1, 2, "y" * 120, None, None),
         (6, "cli", 1, 1, "no such file", None, None)],
        "doc_id long, method string, page_no int, strategy int, text string, layout string, html string")
    out = extract_papers(files, cands, extraction_rules(spark), layout="layout", html="html", strategy="strategy")
    got = {r.doc_id: (r.method, r.text, r.route) for r in out.collect()}
    assert got[1] == ("text_layer", "first cafe\u0301\nsecond", "code")
    assert got[2] == ("layout", "from the markup of the page", "code")
    assert got[3] == (None, "", "no_text")
    assert got[4] == ("ocr", "y" * 120, "code")
    assert got[5][0] == "placeholder" and got[5][2] == "manual_review"
    assert set(got) == {1, 2, 3, 4, 5}


def _hot_pages(spark):
    """A third of all pages in paper 0, and a second hot paper without a key."""
    return spark.range(30_000).selectExpr("CASE WHEN id < 10000 THEN 0 WHEN id < 16000 THEN NULL ELSE id END AS doc_id", "'cli' AS method",
                                          "CAST(IF(id < 16000, id, 1) AS INT) AS page_no", "IF(id % 7 = 0, '', 'p' || id) AS text")


def test_chunks_are_dealt_before_papers(spark):
    """With ``chunk_pages`` the ranges of every paper are joined in many tasks first."""
    plan = assemble_pages(_hot_pages(spark), chunk_pages=10)._jdf.queryExecution().executedPlan().toString()
    # the chunk number, named by the optimizer, is in the first key that any page is dealt by
    assert any("hashpartitioning" in line and "_groupingexpression" in line for line in plan.splitlines())


def test_hot_papers_are_found_and_split(spark):
    rows = _hot_pages(spark)
    assert {r.doc_id for r in hot_papers(rows).collect()} == {0, None}
    assert hot_papers(rows.where("doc_id > 0")) is None
    whole = {r.doc_id: r.text for r in assemble_pages(rows).collect()}
    assert whole == {r.doc_id: r.text for r in assemble_pages(rows, hot_pages=10**9).collect()}
    assert whole[0] == "\n".join(f"p{i}" for i in range(10_000) if i % 7)
    # without a setting of the caller's, no task of the assembly takes more than a range of the hot paper
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = rows.where("doc_id = 0")
        ranges = hot.groupBy("doc_id", F.floor(F.col("page_no") / 1024)).count()
        assert ranges.count() == 10 and max(r["count"] for r in ranges.collect()) <= 1024
        plan = assemble_pages(rows)._jdf.queryExecution().executedPlan().toString()
        assert any("hashpartitioning" in line and "_groupingexpression" in line for line in plan.splitlines())
        tasks = ranges.select(F.spark_partition_id().alias("t")).distinct().count()
        assert tasks >= 5
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_layout_pages_equal_whole_layouts(spark):
    """Pages flattened one by one and joined are the layout of the paper flattened at once, hot papers too."""
    from evidentia.functions.text import flatten_layout
    rows = [(d, p, [{"lines": [{"spans": [{"text": t} for t in ts]}]} if ts is not None else {"lines": None}])
            for d in range(6) for p, ts in enumerate([["a", "b"], [], None, [None, "c"], [""], ["d"]] * (200 if d == 0 else 1))]
    pages = spark.createDataFrame(rows, "doc_id long, page_no int, blocks array<struct<lines:array<struct<spans:array<struct<text:string>>>>>>")
    want = pages.groupBy("doc_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("page_no", "blocks"))), lambda x: x["blocks"])).alias("b"))
    want = {r.doc_id: r.t for r in want.select("doc_id", flatten_layout("b").alias("t")).collect()}
    for hot_pages in (10, 10**9):
        got = {r.doc_id: r.text for r in flatten_layout_pages(pages, hot_pages=hot_pages).collect()}
        assert got == want


def test_methods_are_tried_in_rank_order_for_open_papers_only(spark):
    """Each page is prepared once, and only for papers that no earlier method has settled."""
    cands = spark.createDataFrame(
        [(1, "text_layer", 1, "one"), (1, "layout", 1, "unused"), (1, "ocr", 1, "u" * 200),
         (2, "text_layer", 1, " "), (2, "layout", 1, "two"), (2, "cli", 1, "unused"),
         (3, "ocr", 1, "y" * 11), (3, "ocr", 2, "z" * 120), (4, "ocr", 1, "short"), (5, "other", 1, "no rule")],
        "doc_id long, method string, page_no int, text string")
    seen = []

    def prepare(pages):
        seen.append(sorted((r.doc_id, r.method, r.page_no) for r in pages.collect()))
        return pages.withColumn("text", F.upper("text"))

    got = {r.doc_id: (r.method, r.rank, r.text) for r in first_accepted_text(cands, extraction_rules(spark), prepare=prepare).collect()}
    assert got == {1: ("text_layer", 1, "ONE"), 2: ("layout", 3, "TWO"), 3: ("ocr", 6, "Y" * 11 + "\n" + "Z" * 120)}
    assert seen == [[(1, "text_layer", 1), (2, "text_layer", 1)], [], [(2, "layout", 1)], [], [], [(3, "ocr", 1), (3, "ocr", 2), (4, "ocr", 1)]]
    # candidates that are stored by method need no copy
    import tempfile
    path = tempfile.mkdtemp() + "/by-method"
    cands.write.partitionBy("method").parquet(path)
    stored = spark.read.parquet(path)
    again = first_accepted_text(stored, extraction_rules(spark), prepare=lambda p: p.withColumn("text", F.upper("text")), by_method=True)
    assert {r.doc_id: (r.method, r.rank, r.text) for r in again.collect()} == got


def test_every_page_reading_reaches_the_mode_chain(spark):
    """No page of the given tables is left out of the extraction's input, whatever its host."""
    from evidentia.plans import fixtures
    conv, pages = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("conversations", "pages"))
    cands = fixtures.extract_candidates(conv, pages).where("doc_id < 0")
    html = {r.doc_id: r.html for r in cands.collect()}
    assert html == {-1 - r.page_id: r.html for r in pages.collect()}
    assert pages.where("url LIKE '%.net%'").count() > 0

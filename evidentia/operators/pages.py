"""Page-level operators: assemble pages, pick a per-page strategy, choose the
first acceptable extraction method per paper.

The text of a paper is one value, but its pages need not meet in one task to make it: papers of more than
``HOT_PAGES`` pages are found from the keys alone and joined in ranges of ``CHUNK_PAGES`` pages
first. All other pages are shuffled once, on the paper key.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.functions.strings import col, py_strip
from evidentia.functions.text import layout_texts
from evidentia.schema import OCR_MIN_DOC_CHARS, OCR_MIN_PAGE_CHARS, PAGE_STRATEGY_MIN_CHARS
from evidentia.session import scratch_path
from evidentia.sources import paths

#: A paper of more pages is joined range by range.
HOT_PAGES = 4096
CHUNK_PAGES = 1024
#: Keys of hot papers to broadcast at most; more of them are joined as Spark sees fit.
MOST_HOT = 200_000


def _keys(key) -> list:
    return [key] if isinstance(key, str) else list(key)


def joined_pages(order, page: Column, sep: str) -> Column:
    """Aggregate: the pages that are not null, in page order, joined by ``sep``; null without any."""
    pages = F.array_sort(F.collect_list(F.when(page.isNotNull(), F.struct(col(order).alias("o"), page.alias("t")))))
    return F.when(F.size(pages) > 0, F.array_join(F.transform(pages, lambda p: p["t"]), sep))


def hot_papers(pages: DataFrame, key="doc_id", hot_pages: int = HOT_PAGES) -> DataFrame | None:
    """The keys of the papers of more than ``hot_pages`` pages, counted from the keys alone and written; None without any."""
    keys = _keys(key)
    hot = pages.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_pages).select(*keys)
    path = scratch_path(pages.sparkSession, f"hot-papers-{uuid.uuid4().hex}")
    hot.write.parquet(path)
    hot = pages.sparkSession.read.schema(hot.schema).parquet(path)
    n = hot.count()
    return None if not n else F.broadcast(hot) if n <= MOST_HOT else hot


def _join_pages(pages: DataFrame, keys: list, order, page: Column, sep: str, chunk_pages: int | None,
                hot_pages: int, hot) -> DataFrame:
    """``(keys.., text)``: ``joined_pages`` by paper, hot papers (or, with ``chunk_pages``, all) by page ranges first."""
    rows = pages.select(*keys, col(order).alias("_o"), page.alias("_t"))
    if chunk_pages:
        return _by_ranges(rows, keys, sep, chunk_pages)
    hot = hot_papers(pages, keys, hot_pages) if hot is False else hot
    if hot is None:
        return rows.groupBy(*keys).agg(joined_pages("_o", F.col("_t"), sep).alias("text"))
    rest = rows.join(hot, keys, "left_anti").groupBy(*keys).agg(joined_pages("_o", F.col("_t"), sep).alias("text"))
    return rest.unionByName(_by_ranges(rows.join(hot, keys, "left_semi"), keys, sep, CHUNK_PAGES))


def _by_ranges(rows: DataFrame, keys: list, sep: str, chunk_pages: int) -> DataFrame:
    """Each ``chunk_pages`` consecutive pages are joined in a task of their own, then a paper's few strings."""
    chunk = F.floor(F.col("_o") / F.lit(chunk_pages)).alias("_chunk")
    chunks = rows.groupBy(*keys, chunk).agg(joined_pages("_o", F.col("_t"), sep).alias("_c"))
    return chunks.groupBy(*keys).agg(joined_pages("_chunk", F.col("_c"), sep).alias("text"))


def assemble_pages(pages: DataFrame, key="doc_id", order="page_no", text="text", chunk_pages: int | None = None,
                   hot_pages: int = HOT_PAGES, min_page_chars: int | None = None, hot=False) -> DataFrame:
    """``(key.., text)``: one text per paper from its page rows: the non-empty page texts (of more than
    ``min_page_chars`` stripped characters, if given) in page order, a newline between them, the whole
    stripped. A paper whose pages are all empty gives ``""``.

    Papers of more than ``hot_pages`` pages are found by a count over the keys (``hot_papers``; hand in what it
    returned as ``hot`` to count once for several calls): ranges of their pages are joined in many tasks, and the
    last step only joins a paper's few strings. ``chunk_pages`` does so for every paper.
    """
    t = col(text)
    wanted = t.isNotNull() & (t != F.lit(""))
    if min_page_chars is not None:
        wanted = wanted & (F.length(py_strip(t)) > min_page_chars)
    keys = _keys(key)
    joined = _join_pages(pages, keys, order, F.when(wanted, t), "\n", chunk_pages, hot_pages, hot)
    return joined.select(*keys, F.coalesce(py_strip("text"), F.lit("")).alias("text"))


def flatten_layout_pages(pages: DataFrame, key="doc_id", order="page_no", blocks="blocks", hot_pages: int = HOT_PAGES) -> DataFrame:
    """``(key.., text)``: ``flatten_layout`` over the blocks of all pages of a paper, in page order. Each page is
    flattened where it is read; hot papers are joined by ranges, as in ``assemble_pages``."""
    keys = _keys(key)
    texts = pages.select(*keys, col(order).alias("_p"), layout_texts(blocks).alias("_x"))
    page = F.when(F.size("_x") > 0, F.array_join("_x", " "))
    joined = _join_pages(texts, keys, "_p", page, " ", None, hot_pages, False)
    return joined.select(*keys, F.coalesce("text", F.lit("")).alias("text"))


def pick_page_strategy(cands: DataFrame, key=("doc_id", "page_no"), order="strategy",
                       text="text", min_chars: int = PAGE_STRATEGY_MIN_CHARS) -> DataFrame:
    """Per page: the first strategy whose stripped text is longer than
    ``min_chars``; if none, the last strategy that returned (even if short,
    empty or null). Failed strategies are simply absent rows."""
    t, o = col(text), col(order)
    good = F.when(F.length(py_strip(t)) > min_chars, o)
    return cands.groupBy(*_keys(key)).agg(
        F.coalesce(F.min_by(t, good), F.max_by(t, o)).alias("text"))


def extraction_rules(spark: SparkSession) -> DataFrame:
    """The ranked extraction methods; OCR-type methods drop pages of <= 10
    stripped chars and need more than 100 chars in total. A literal table
    (JVM-side, no Python worker), broadcast where it is joined."""
    rows = [("text_layer", 1, None, None), ("text_layer_tolerant", 2, None, None),
            ("layout", 3, None, None), ("reader", 4, None, None), ("cli", 5, None, None),
            ("ocr", 6, OCR_MIN_PAGE_CHARS, OCR_MIN_DOC_CHARS)]
    return literal_table(spark, rows, ["method", "rank", "min_page_chars", "min_doc_chars"],
                         ["string", "int", "int", "int"])


def literal_table(spark: SparkSession, rows, names, types) -> DataFrame:
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, n, t in zip(r, names, types)])
               for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def first_accepted_text(cands: DataFrame, rules: DataFrame, key: str = "doc_id",
                        order: str = "page_no", text: str = "text", chunk_pages: int | None = None,
                        prepare=None, by_method: bool = False) -> DataFrame:
    """``(key, method, rank, text)``: per paper, the lowest-rank method whose
    assembled, stripped text is non-empty (and, for rules with ``min_doc_chars``, longer than that).

    The methods are tried in rank order, as a fall-back chain is: the pages of a method are read for the papers
    that no earlier method has settled (anti join), prepared (``prepare``: a function from a method's pages to
    its pages, e.g. the page mode chain and NFKD), assembled, and the accepted texts written. So a page of a
    method is prepared once, and only if its paper needs it.

    The candidates are scanned once, to deal their non-empty pages by method into the shared folder; with
    ``by_method`` they are stored like that already (Parquet partitioned by ``method``) and each method's
    scan reads its own part. Hot papers are counted once, from the keys (see ``assemble_pages``).
    """
    spark = cands.sparkSession
    ranked = rules.select("method", "rank", "min_page_chars", "min_doc_chars").orderBy("rank").collect()  # a handful
    dealt = None
    if not by_method:
        t = col(text)
        some = cands if prepare else cands.where(t.isNotNull() & (t != F.lit("")))
        some = some.where(F.col("method").isin(*[r["method"] for r in ranked]))
        dealt = scratch_path(spark, f"candidates-{uuid.uuid4().hex}")
        some.write.partitionBy("method").parquet(dealt)
        cands = spark.read.schema(some.schema).parquet(dealt)
    hot = None if chunk_pages else hot_papers(cands, [key, "method"])
    settled: list[DataFrame] = []
    for r in ranked:
        pages = cands.where(F.col("method") == r["method"])
        if settled:
            pages = pages.join(reduce(DataFrame.unionByName, settled).select(key), key, "left_anti")
        pages = prepare(pages) if prepare else pages
        texts = assemble_pages(pages, [key, "method"], order, text, chunk_pages, min_page_chars=r["min_page_chars"], hot=hot)
        enough = F.col("text") != F.lit("")
        if r["min_doc_chars"] is not None:
            enough = enough & (F.length("text") > r["min_doc_chars"])
        path = scratch_path(spark, f"accepted-{uuid.uuid4().hex}")
        found = texts.where(enough).select(key, "method", F.lit(r["rank"]).cast("int").alias("rank"), "text")
        found.write.parquet(path)
        settled.append(spark.read.schema(found.schema).parquet(path))
    if dealt is not None:
        paths.delete(spark, dealt)
    return reduce(DataFrame.unionByName, settled)


def paper_text(files: DataFrame, accepted: DataFrame, key: str = "doc_id",
               file_name: str = "file_name", is_pdf: str = "is_pdf", title=None, author=None,
               page_count=None) -> DataFrame:
    """``(key, file_name, method, text)``: the text of each paper file - the
    accepted method's text; else, for a PDF, the stand-in text; else ``""``
    (which later routes the paper to a failed row)."""
    from evidentia.functions.text import placeholder_text
    acc = accepted.select(key, F.col("method").alias("_method"), F.col("text").alias("_text"))
    j = files.join(acc, key, "left")
    stand_in = placeholder_text(file_name, is_pdf, title, author, page_count)
    return j.select(
        key, file_name,
        F.coalesce(F.col("_method"), F.when(col(is_pdf), F.lit("placeholder"))).alias("method"),
        F.coalesce(F.col("_text"), stand_in).alias("text"))

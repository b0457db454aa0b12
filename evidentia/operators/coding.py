"""Reply -> coded row operators (narrow: every step is a projection)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.functions.replies import (answer_columns, count_extracted, is_short_response,
                                         line_candidates, merge_answers, reply_facts,
                                         response_audit, response_lines, screening_decision)
from evidentia.functions.strings import col
from evidentia.schema import (CSV_COLUMNS, NOT_SPECIFIED, QUESTION_COLUMNS, QUESTIONS, TITLE,
                              source_column)


def _keep(keep) -> list:
    return [keep] if isinstance(keep, str) else list(keep or [])


_BUILT: dict = {}


def _once(name: str, build):
    """Build a Column list once per JVM: the parser is a few thousand expression
    nodes and re-creating them through py4j costs seconds per query."""
    from pyspark import SparkContext
    sc = SparkContext._active_spark_context
    key = (name, id(sc._gateway) if sc is not None else None)
    if key not in _BUILT:
        _BUILT[key] = build()
    return _BUILT[key]


def _parser_stages():
    facts = [is_short_response("_response").alias("_short"),
             screening_decision("_lines").alias("_screen"),
             reply_facts("_lines").alias("_facts")]
    cands = [line_candidates("_facts").alias("_cands")]
    folds = [merge_answers("_cands", n).alias(f"_q{n}") for n in QUESTIONS]
    final = answer_columns({n: F.col(f"_q{n}") for n in QUESTIONS},
                           F.col("_short"), F.col("_screen"))
    return facts, cands, folds, final


def coded_rows(df: DataFrame, response="response", title=TITLE, keep=("doc_id",)) -> DataFrame:
    """Parse replies into the 27-column coded row (plus the ``keep`` columns).

    Stacked projections: lines -> per-line facts -> candidates -> 12 folds ->
    columns. Each array is built once per reply and shared by the next stage
    (Catalyst does not collapse a project whose expensive outputs are used
    more than once). All narrow: no shuffle.
    """
    keep = _keep(keep)
    facts, cands, folds, final = _once("parser", _parser_stages)
    lines = df.select(*keep, col(title).alias(TITLE), col(response).alias("_response"),
                      response_lines(col(response)).alias("_lines"))
    s1 = lines.select(*keep, TITLE, *facts)
    s2 = s1.select(*keep, TITLE, "_short", "_screen", *cands)
    s3 = s2.select(*keep, TITLE, "_short", "_screen", *folds)
    return s3.select(*keep, F.col(TITLE), *final)


def answers_long(coded: DataFrame, keep=("doc_id",)) -> DataFrame:
    """Long form ``(keep.., n, question, answer, source)`` of a coded table."""
    keep = _keep(keep)
    items = F.array(*[
        F.struct(F.lit(n).alias("n"), F.lit(QUESTION_COLUMNS[n]).alias("question"),
                 F.col(f"`{QUESTION_COLUMNS[n]}`").alias("answer"),
                 F.col(f"`{source_column(QUESTION_COLUMNS[n])}`").alias("source"))
        for n in QUESTIONS])
    return (coded.select(*keep, F.inline(items)))


def with_extracted_count(coded: DataFrame, name: str = "extracted_count") -> DataFrame:
    return coded.withColumn(name, count_extracted())


def audit_responses(df: DataFrame, response="response", keep=("doc_id",)) -> DataFrame:
    """Reply length (0 when null), 300-char preview + '...', empty flag."""
    return df.select(*_keep(keep), response_audit(col(response)).alias("_a")).select(
        *_keep(keep), "_a.*")


def reply_lines(df: DataFrame, response="response", keep=("doc_id",)) -> DataFrame:
    """Exploded reply lines ``(keep.., line_no, line)`` (0-based line numbers)."""
    keep = _keep(keep)
    return df.select(*keep, F.posexplode(response_lines(col(response))).alias("line_no", "line"))


def screening(df: DataFrame, response="response", keep=("doc_id",)) -> DataFrame:
    """``(keep.., include, reason)`` from the screening lines (last one wins)."""
    keep = _keep(keep)
    return (df.select(*keep, screening_decision(response_lines(col(response))).alias("_s"))
              .select(*keep, "_s.include", "_s.reason"))


def candidate_table(df: DataFrame, response="response", keep=("doc_id",)) -> DataFrame:
    """Exploded per-line candidates of the four layouts (one row per numbered line)."""
    keep = _keep(keep)
    facts = df.select(*keep, reply_facts(response_lines(col(response))).alias("_facts"))
    return facts.select(*keep, F.inline(line_candidates("_facts")))


def question_dim(spark) -> DataFrame:
    """The 12 questions: ``(n, answer_column, source_column)`` (a fixed table;
    small enough to broadcast, or used as literals as the parser does)."""
    from evidentia.operators.pages import literal_table
    rows = [(n, QUESTION_COLUMNS[n], source_column(QUESTION_COLUMNS[n])) for n in QUESTIONS]
    return literal_table(spark, rows, ["n", "answer_column", "source_column"],
                         ["int", "string", "string"])

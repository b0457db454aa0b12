"""Routing papers to outcomes and assembling the 27-column result."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.functions.strings import col, contains
from evidentia.functions.text import format_title
from evidentia.schema import (CSV_COLUMNS, EXCLUSION_REASON, FAILED_INCLUDE, FIELD_COLUMNS,
                              INCLUDE, PLACEHOLDER_PHRASE, PROCESSING_FAILED, REASON_MANUAL_REVIEW,
                              REASON_NO_TEXT, TITLE)

ROUTE_NO_TEXT = "no_text"
ROUTE_MANUAL = "manual_review"
ROUTE_CODE = "code"


def failed_columns(title, reason=PROCESSING_FAILED) -> list:
    """27 columns of a failed row: Include 'N', the reason, 24 x 'Processing failed'."""
    reason_c = reason if isinstance(reason, Column) else F.lit(reason)
    return ([col(title).alias(TITLE), F.lit(FAILED_INCLUDE).alias(INCLUDE),
             reason_c.alias(EXCLUSION_REASON)]
            + [F.lit(PROCESSING_FAILED).alias(c) for c in FIELD_COLUMNS])


def failed_rows(df: DataFrame, title=TITLE, reason=PROCESSING_FAILED, keep=("doc_id",)) -> DataFrame:
    return df.select(*keep, *failed_columns(title, reason))


def route(text) -> Column:
    """(a) empty text -> no_text; (b) placeholder phrase -> manual_review; (c) code."""
    t = col(text)
    return (F.when(t.isNull() | (t == F.lit("")), F.lit(ROUTE_NO_TEXT))
             .when(contains(F.lower(t), PLACEHOLDER_PHRASE), F.lit(ROUTE_MANUAL))
             .otherwise(F.lit(ROUTE_CODE)))


def route_documents(df: DataFrame, text="text", file_name="file_name") -> DataFrame:
    """Adds ``route`` and ``Title`` (raw file name for route a, formatted otherwise)."""
    r = route(text)
    return (df.withColumn("route", r)
              .withColumn(TITLE, F.when(F.col("route") == ROUTE_NO_TEXT, col(file_name))
                          .otherwise(format_title(col(file_name)))))


def routed_failure_reason(route_col="route") -> Column:
    """Exclusion reason of a failed row: no text, manual review, or a failed call."""
    r = col(route_col)
    return (F.when(r == F.lit(ROUTE_NO_TEXT), F.lit(REASON_NO_TEXT))
             .when(r == F.lit(ROUTE_MANUAL), F.lit(REASON_MANUAL_REVIEW))
             .otherwise(F.lit(PROCESSING_FAILED)))


def assemble_results(*dfs: DataFrame, keep=("doc_id",)) -> DataFrame:
    """Union by name in the fixed column order, with the string conversion the
    CSV step applies: a missing column reads ``'nan'`` and a null value
    ``'None'`` (every coding path fills all 27, so these are edge cases)."""
    keep = list(keep or [])
    fixed = []
    for d in dfs:
        present = set(d.columns)
        fixed.append(d.select(*keep, *[
            F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("None")).alias(c) if c in present
            else F.lit("nan").alias(c) for c in CSV_COLUMNS]))
    return reduce(lambda a, b: a.unionByName(b), fixed)


def assemble_by_route(rows: DataFrame, failed: dict, route_col="route", keep=("doc_id",)) -> DataFrame:
    """Coded and failed papers in one projection: ``rows`` has the route and the 27 coded columns of every
    paper, ``failed`` the values of a failed row by column name. Which of them a row shows depends on its
    route, so the input is scanned once; the string conversion is that of ``assemble_results`` (a
    column that failed rows lack reads ``'nan'`` in them)."""
    is_coded = col(route_col) == F.lit(ROUTE_CODE)
    missing = F.lit("nan")

    def text(c) -> Column:
        return F.coalesce(c.cast("string"), F.lit("None"))

    return rows.select(*keep, *[
        F.when(is_coded, text(F.col(f"`{c}`"))).otherwise(text(failed[c]) if c in failed else missing).alias(c)
        for c in CSV_COLUMNS])

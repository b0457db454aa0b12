"""Extraction audit rows, summary and failures."""

from evidentia.operators.audit import audit_extraction, audit_failures, audit_summary


def test_audit(spark):
    files = spark.createDataFrame(
        [("b.pdf", " two\xa0words\n", 2 * 1048576, None), ("a.pdf", "   ", 1048576, None),
         ("c.pdf", None, 10, "stat failed")],
        "file string, text string, size_bytes long, error string")
    audit = audit_extraction(files, error="error")
    rows = audit.collect()
    assert [r.file for r in rows] == ["a.pdf", "b.pdf", "c.pdf"]
    a, b, c = rows
    assert (a.status, a.chars, a.words, a.size_mb) == ("FAILED", 0, 0, 1.0)
    assert (b.status, b.chars, b.words, b.size_mb, b.preview) == ("SUCCESS", 11, 2, 2.0, "two\xa0words")
    assert (c.status, c.chars, c.size_mb, c.error) == ("ERROR", None, None, "stat failed")
    s = audit_summary(audit).first()
    assert (s.total, s.successful, s.failed, s.success_rate, s.total_chars, s.avg_chars) == \
        (3, 1, 2, 33.3, 11, 11.0)
    assert {r.file for r in audit_failures(audit).collect()} == {"a.pdf", "c.pdf"}
    empty = audit_summary(audit.limit(0)).first()
    assert empty.total == 0 and empty.success_rate is None


def test_audit_sort_spreads_a_file_name_shared_by_many_copies(spark):
    """A third of the rows are copies of one file: the sorted report must not
    put them all into one task (and must stay sorted)."""
    from pyspark.sql import functions as F
    n = 3000
    files = (spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("copy.pdf"))
         .otherwise(F.format_string("f%05d.pdf", "id")).alias("file"),
        F.lit("same text").alias("text"), F.lit(10).cast("long").alias("size_bytes"))
        .repartition(8))
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        audit = audit_extraction(files)
        per_task = (audit.groupBy(F.spark_partition_id().alias("p")).count()
                    .agg(F.max("count")).first()[0])
        names = [r.file for r in audit.select("file").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert len(names) == n and names == sorted(names)
    assert names.count("copy.pdf") == n // 3
    assert per_task < n // 3

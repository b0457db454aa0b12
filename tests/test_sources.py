"""File scan, diagnostics, prompt loading and the CSV sink."""

import csv
import glob
import os

import pytest

from evidentia.schema import CSV_COLUMNS
from evidentia.sources.files import default_prompt, file_diagnostics, load_prompt, scan_heads, scan_papers
from evidentia.sources.sinks import read_coding_csv, write_coding_csv


def _part(folder):
    found, = glob.glob(f"{folder}/part-*.csv")
    return found


def test_scan_and_diagnostics(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.4 body")
    (tmp_path / "B.PDF").write_bytes(b"junk" * 10)
    (tmp_path / "c.txt").write_bytes(b"%PDF")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "d.pdf").write_bytes(b"%PDF")
    df = file_diagnostics(scan_papers(spark, str(tmp_path)))
    got = {r.file_name: (r.length, r.is_pdf, bytes(r.header)) for r in df.collect()}
    assert got == {"a.pdf": (13, True, b"%PDF-1.4 b"), "B.PDF": (40, False, b"junkjunkju")}
    assert scan_papers(spark, str(tmp_path / "missing")).count() == 0


def test_heads_are_read_without_the_files(spark, tmp_path):
    (tmp_path / "a b%20é.pdf").write_bytes(b"x" * 990 + b"%PDF-1.4 and more")
    (tmp_path / "empty.pdf").write_bytes(b"")
    (tmp_path / "late.PDF").write_bytes(b"x" * 997 + b"%PDF")          # the mark ends behind byte 1000
    with open(tmp_path / "huge.pdf", "wb") as f:                         # 3 GiB, all of it a hole
        f.write(b"%PDF-1.7")
        f.truncate(3 << 30)
    heads = scan_heads(spark, str(tmp_path))
    got = {r.file_name: r for r in file_diagnostics(heads, content="head").collect()}
    assert {k: (r.length, len(r.head), r.is_pdf) for k, r in got.items()} == {
        "a b%20é.pdf": (1007, 1000, True), "empty.pdf": (0, 0, False), "late.PDF": (1001, 1000, False),
        "huge.pdf": (3 << 30, 1000, True)}
    assert bytes(got["huge.pdf"].header) == b"%PDF-1.7\0\0"
    plan = heads._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_heads_through_the_binary_reader_are_the_same(spark, tmp_path):
    for i, size in enumerate((5, 1000, 5000)):
        (tmp_path / f"f{i}.pdf").write_bytes(bytes(range(256)) * 20 if size == 5000 else b"z" * size)
    opened, read = (sorted((r.file_name, r.length, bytes(r.head)) for r in scan_heads(spark, str(tmp_path), **k).collect())
                    for k in ({}, {"opened": {}}))
    assert opened == read and len(read) == 3
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "d.pdf").write_bytes(b"%PDF")
    (tmp_path / "x.txt").write_bytes(b"%PDF")
    (tmp_path / "_hidden.pdf").write_bytes(b"%PDF")
    assert scan_heads(spark, str(tmp_path)).count() == 3 == scan_papers(spark, str(tmp_path)).count()
    assert scan_heads(spark, str(tmp_path / "missing")).count() == 0


def test_a_file_that_cannot_be_opened_has_no_head(spark, tmp_path):
    from evidentia.sources.files import OPENED_SCHEMES, _head_of
    assert _head_of(f"file:{tmp_path}/gone.pdf", 10, {}, OPENED_SCHEMES) is None
    (tmp_path / "x.pdf").write_bytes(b"0123456789")
    assert _head_of(f"file:{tmp_path}/x.pdf", 4, {}, OPENED_SCHEMES) == b"0123"
    assert _head_of(f"file://{tmp_path}/x.pdf", 40, {}, OPENED_SCHEMES) == b"0123456789"


def test_default_prompt_needs_no_path(spark):
    assert load_prompt(spark) == default_prompt() and default_prompt()


def test_load_prompt(spark, tmp_path):
    p = tmp_path / "t.txt"
    p.write_text("\n  Hello\nWorld 　\n", encoding="utf-8")
    assert load_prompt(spark, str(p)) == "Hello\nWorld"
    with pytest.raises(FileNotFoundError):
        load_prompt(spark, str(tmp_path / "none.txt"))


def test_csv_round_trip(spark, tmp_path):
    rows = [tuple(f"v{i}-{j}" if j else f"Paper {i}" for j in range(27)) for i in range(3)]
    rows.append(tuple([' lead, "quoted"\nline ', ""] + ["x"] * 25))
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in CSV_COLUMNS))
    path = _part(write_coding_csv(df.coalesce(1), str(tmp_path), name="out.csv"))
    raw = open(path, encoding="utf-8").read()
    assert raw.startswith("﻿Title,Include in Review (Y/N),Exclusion Reason,")
    with open(path, encoding="utf-8-sig", newline="") as f:
        back = list(csv.reader(f))
    assert back[0] == CSV_COLUMNS and len(back) == 5
    assert back[4][0] == ' lead, "quoted"\nline ' and back[4][1] == ""
    spark_back = read_coding_csv(spark, path)
    assert spark_back.columns == CSV_COLUMNS
    assert sorted(map(tuple, spark_back.collect())) == sorted(rows)  # '' comes back as ''
    assert write_coding_csv(df.limit(0), str(tmp_path)) == ""


def test_csv_bytes_match_pandas(spark, tmp_path):
    import pandas as pd
    vals = [" lead", "trail ", "a,b", 'say "hi"', "multi\nline", "cr\rx", "", "#hash",
            "Not specified", "tab\there", "é ß", '"', ";semi"]
    rows = [tuple(vals[(i + j) % len(vals)] for j in range(27)) for i in range(len(vals))]
    pd.DataFrame(rows, columns=CSV_COLUMNS).to_csv(tmp_path / "p.csv", index=False,
                                                   encoding="utf-8-sig")
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in CSV_COLUMNS))
    path = _part(write_coding_csv(df.coalesce(1), str(tmp_path), name="s.csv"))
    assert open(path, "rb").read() == (tmp_path / "p.csv").read_bytes()


def test_csv_is_a_folder_of_part_files_at_every_size(spark, tmp_path):
    rows = [tuple(f"v{i}-{j}" for j in range(27)) for i in range(200)]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in CSV_COLUMNS)).repartition(4)
    for name, frame in (("big.csv", df), ("one.csv", df.limit(1))):
        path = write_coding_csv(frame, str(tmp_path), name=name)
        assert os.path.isdir(path) and read_coding_csv(spark, path).count() == frame.count()

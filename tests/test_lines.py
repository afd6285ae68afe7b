"""Numbers of lines in files of several splits, and cells of sparse sheets."""

from __future__ import annotations

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from loomtext.sources import lines, parsers, readers


def test_bad_lines_have_their_numbers_in_split_files(spark, tmp_path):
    bad = {"a.jsonl": {1: "nope", 777: '{"doc_id": "x", "stars": "many"}', 2999: '{"text": "t"}', 3000: "[1]"}, "b.jsonl": {1500: '{"doc_id": '}, "c.jsonl": {}}
    for name, lines_ in bad.items():
        with open(tmp_path / name, "w") as f:
            for k in range(1, 3001):
                f.write(lines_.get(k, "" if k % 10 == 0 else json.dumps({"doc_id": f"{name}{k}", "text": "wörds " * (k % 9)})) + ("\n" if k < 3000 else ""))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert lines._splits(spark, str(tmp_path)).select("split").distinct().count() > 12
        got = {(r.file.rsplit("/", 1)[1], r.line): (r.reason, r.text) for r in readers.rejected_documents(spark, str(tmp_path)).collect()}
        assert {k: t for k, (_, t) in got.items()} == {(n, k): t for n, v in bad.items() for k, t in v.items()}
        assert got["a.jsonl", 2999][0] == "no doc_id" and got["a.jsonl", 1][0] == "malformed" == got["a.jsonl", 777][0] == got["b.jsonl", 1500][0]
        with pytest.raises(ValueError, match="a.jsonl, line 1: malformed"):
            readers.read_jsonl(spark, str(tmp_path))
        assert readers.read_jsonl(spark, str(tmp_path), strict=False).count() == 3 * 2700 - 3  # the others take the place of blank lines
        assert readers.read_jsonl(spark, str(tmp_path / "c.jsonl")).count() == 2700
        every = lines.numbered_where(spark, str(tmp_path / "b.jsonl"), F.lit("all"))
        assert sorted(r.line for r in every.collect()) == list(range(1, 3000))  # the last one is blank and has no end
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def sheet(rows):
    cell = lambda ref, v: f'<c r="{ref}"><v>{v}</v></c>' if ref else f"<c><v>{v}</v></c>"
    body = "".join("<row>" + "".join(cell(r, v) for r, v in row) + "</row>" for row in rows)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", '<workbook><sheets><sheet name="S"/></sheets></workbook>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet><sheetData>{body}</sheetData></worksheet>")
    return out.getvalue()


def test_sparse_cells_stay_in_their_columns():
    assert parsers.parse_xlsx(sheet([[("A1", "a"), ("B1", "b"), ("C1", "c")], [("A2", 1), ("C2", 3)], [("B3", 2)]])) == "[SHEET S]\na: 1\nb: \nc: 3\n\na: \nb: 2\nc: "
    assert parsers.parse_xlsx(sheet([[("", "a"), ("", "b")], [("", 1), ("", 2)]])) == "[SHEET S]\na: 1\nb: 2"
    assert parsers.parse_xlsx(sheet([[("A1", "a"), ("AB1", "z")], [("AB2", 5)]])).endswith("column_27: \nz: 5")

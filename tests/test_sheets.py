"""Sheet source against Python's CSV parser, whole and split into many blocks."""

from __future__ import annotations

import csv
import io
import random

import pytest

from souk.sources import sheets


def plain(text: str, header_row: int):
    rows = [r for r in csv.reader(io.StringIO(text, newline="")) if r]
    head, body = rows[header_row], rows[header_row + 1 :]
    fit = lambda r: tuple((c or None) for c in [*r, *[""] * len(head)][: len(head)])
    return head, sorted(map(fit, body), key=repr)


def read(spark, path, header_row):
    out = sheets.sheet_csv_source(spark, str(path), header_row)
    return out.columns, sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("header_row", [0, 1])
def test_cells_with_line_feeds_and_rows_like_the_header(spark, tmp_path, header_row):
    path = tmp_path / "sheet.csv"
    top = ",,\n" if header_row else ""
    text = "\n" + top + 'a,"b, x",c\n1,"two\nlines",3\n,,\na,"b, x",c\n\n4,"say ""hi""\n\nagain",6\n7,,"9"\n'
    path.write_text(text)
    columns, rows = read(spark, path, header_row)
    head, want = plain(text, header_row)
    assert columns == head == ["a", "b, x", "c"] and rows == want
    assert (None, None, None) in rows and ("a", "b, x", "c") in rows and ("1", "two\nlines", "3") in rows


def test_split_file_equals_whole_parse(spark, tmp_path):
    rng = random.Random(8)
    cells = ["", "x", "a,b", 'q"q', "two\nlines", "\n", '"', "é\n\n,", "1"]
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(["one", "two", "three"])
    for k in range(1500):
        writer.writerow([rng.choice(cells), rng.choice(cells) * rng.randint(1, 30), f"r{k}"])
    path = tmp_path / "big.csv"
    path.write_text(out.getvalue())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        blocks = sheets.csv_records(spark, str(path)).select("block").distinct().count()
        columns, rows = read(spark, path, 0)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    head, want = plain(out.getvalue(), 0)
    assert blocks > 10 and columns == head and len(rows) == len(want) == 1500
    assert rows == want


def test_odd_sheets(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("\n\na,a,\r\n1,2,3\r\n")
    columns, rows = read(spark, path, 0)
    assert columns == ["a", "a_1", "unnamed_2"] and rows == [("1", "2", "3")]
    path.write_text("only\n")
    assert read(spark, path, 0) == (["only"], [])
    with pytest.raises(ValueError):
        read(spark, path, 1)
    path.write_text("")
    with pytest.raises(ValueError):
        read(spark, path, 0)

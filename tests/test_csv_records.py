"""CSV with quoted line breaks, cut into byte ranges, against Python's reader and the one-task read."""

from __future__ import annotations

import csv
import io
import random

import pytest

from tradeloom.sources import raw_csv
from tradeloom.sources.csv_records import examine, records


@pytest.fixture(params=[150, 1 << 20])
def ranges(spark, request):
    """Bytes of a range."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(request.param))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield request.param
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def soup(seed, n=20):
    """Rows with quotes, commas and line breaks anywhere, one value over many lines, and plain rows."""
    draw = random.Random(seed)
    parts = ["a", "b c", ",", "\n", '"', "\n\n", '""', "é", "x" * 20]
    rows = [(f"{i}", "".join(draw.choice(parts) for _ in range(draw.randrange(6))), str(2012 + i % 10)) for i in range(n)]
    rows[n // 2] = ("50", "line\n" * 12, "2015")
    return rows


def text_of(header, rows, line_end="\n"):
    out = io.StringIO()
    writer = csv.writer(out, quoting=csv.QUOTE_MINIMAL, lineterminator=line_end)
    writer.writerow(header)
    writer.writerows(rows)
    return out.getvalue()


def values(df, *names):
    return sorted(tuple(r[n] or "" for n in names) for r in df.collect())


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_any_cut_gives_the_same_rows(spark, tmp_path, ranges, line_end):
    rows = soup(ranges)
    path = tmp_path / "t.csv"
    path.write_bytes(text_of(["country_id", "note", "year"], rows, line_end).encode())
    found = raw_csv.csv_rows(spark, str(path))
    assert values(found, "country_id", "note", "year") == sorted(rows)
    one_task = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(str(path))
    assert values(found, "country_id", "note", "year") == values(one_task, "country_id", "note", "year")


def test_a_file_with_quoted_breaks_is_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(text_of(["country_id", "note", "year"], soup(1, 60)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = examine(spark, str(path))
        assert found.files[0].quoted_breaks and len(found.inside) > 1
        lines = records(spark, found)
        assert lines.count() == 60 and lines.rdd.getNumPartitions() > 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_files_of_one_folder_by_their_own_headers(spark, tmp_path, ranges):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    first, second = soup(3, 8), soup(4, 8)
    (folder / "a b%20c.csv").write_text(text_of(["country_id", "note", "year"], first))
    (folder / "b.csv").write_text("﻿" + text_of(["year", "country_id", "note"], [(y, i, t) for i, t, y in second]))
    (folder / "c.csv").write_text("country_id,year\n900,2015\n\n901,2016")
    (folder / "d.csv").write_text("")
    (folder / "e.csv").write_text("country_id,note,year\n")
    (folder / "f.csv").write_text('country_id,"two\nlines",year\n902,x,2017\n')
    found = raw_csv.csv_rows(spark, str(folder))
    expected = [(*r, "") for r in first + second] + [("900", "", "2015", ""), ("901", "", "2016", ""), ("902", "", "2017", "x")]
    assert values(found, "country_id", "note", "year", "two\nlines") == sorted(expected)


def test_landing_of_parts_with_other_column_orders(spark, tmp_path):
    source, landing = tmp_path / "in", tmp_path / "out"
    (source / "t.csv").mkdir(parents=True)
    (source / "t.csv" / "1.csv").write_text("country_id,export_value,import_value\n1,777,5\n")
    (source / "t.csv" / "2.csv").write_text("import_value,country_id,export_value,note\n5,2,777,more\n")
    report = raw_csv.land_csv(spark, str(source), str(landing)).collect()
    assert [(r.table_name, r.status) for r in report] == [("t", raw_csv.UPLOADED)] and report[0].seconds > 0
    found = raw_csv.read_raw_csv(spark, f"{landing}/t")
    rows = sorted((r.country_id, r.export_value, r.import_value, r.note) for r in found.collect())
    assert rows == [(1, 777.0, 5.0, None), (2, 777.0, 5.0, "more")]


def test_an_open_quote_ends_with_the_file(spark, tmp_path):
    (tmp_path / "t.csv").write_text('country_id,note\n1,fine\n2,"never\nclosed\n')
    assert sorted(r.country_id for r in raw_csv.csv_rows(spark, str(tmp_path / "t.csv")).collect()) == ["1", "2"]


def test_a_record_is_read_once(spark, tmp_path):
    """Not once for each of its columns: what lies inside of ranges, and what stands at their ends."""
    path = tmp_path / "t.csv"
    path.write_text(text_of(["country_id", "note", "year"], soup(3)))
    found = raw_csv.csv_rows(spark, str(path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv(") == plan.count("MapInArrow") == 2

from __future__ import annotations

import gzip
from pathlib import Path

import pytest
from compare import SMALL

from tradeloom import schema as S
from tradeloom.operators import ingest
from tradeloom.plans import build
from tradeloom.sources import raw_csv, tables
from tradeloom.streaming.incremental import ingest_new_files

HEADER = ",".join(S.FACT_COLUMNS)
TABLE = "hs_country_country_product_year_6"


@pytest.fixture
def database(spark, request):
    name = "db_" + "".join(c if c.isalnum() else "_" for c in request.node.name)
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def write_gz(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt") as out:
        out.write("\n".join(lines) + "\n")


def line(country, partner, product, year, exports=1.0, imports=1.0):
    partner = "" if partner is None else partner
    return f"{country},{partner},{product},{year},{exports},{imports},0.5,0.25,0.125"


def test_listing_takes_gzip_files_and_part_folders(spark, tmp_path):
    write_gz(tmp_path / "one.csv.gz", HEADER)
    write_gz(tmp_path / "two.gz", HEADER)
    write_gz(tmp_path / "three" / "part-0.csv.gz", HEADER)
    write_gz(tmp_path / "three" / "part-1.csv.gz", HEADER)
    (tmp_path / "four.csv").write_text(HEADER)
    listed = [r["table_name"] for r in raw_csv.list_raw_files(spark, str(tmp_path)).collect()]
    assert sorted(listed) == ["one", "three", "three", "two"]


def test_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "x.csv.gz"
    write_gz(path, "year,note,country_id,export_value", "2015,hello,7,1.5", "bad,,8,")
    rows = raw_csv.read_raw_csv(spark, str(path)).collect()
    assert [r.asDict() for r in rows] == [
        {"year": 2015, "note": "hello", "country_id": 7, "export_value": 1.5},
        {"year": None, "note": None, "country_id": 8, "export_value": None},
    ]


def test_identifiers_written_with_decimals(spark, tmp_path):
    path = tmp_path / "x.csv.gz"
    write_gz(path, "country_id,partner_country_id,year", "840.0,12.5,2015", "4,1e400,9e30")
    rows = [tuple(r) for r in raw_csv.read_raw_csv(spark, str(path)).collect()]
    assert rows == [(840, None, 2015), (4, None, None)]


def test_listed_names_are_kept_as_they_are(spark, tmp_path):
    write_gz(tmp_path / "raw" / "a b+c%20d" / "raw" / "part.csv.gz", HEADER)
    row = raw_csv.list_raw_files(spark, str(tmp_path) + "/raw/").first()
    assert row["path"].endswith("part.csv.gz")
    assert row["length"] > 0


def test_jagged_rows_and_quoted_newlines(spark, tmp_path):
    path = tmp_path / "x.csv.gz"
    write_gz(path, "country_id,note,year", '1,"two\nlines ""quoted""",2015', "2,short")
    rows = [tuple(r) for r in raw_csv.read_raw_csv(spark, str(path)).collect()]
    assert rows == [(1, 'two\nlines "quoted"', 2015), (2, "short", None)]


def test_landing_skips_what_is_there(spark, tmp_path):
    source, landing = tmp_path / "csv", tmp_path / "landing"
    source.mkdir()
    (source / "one.csv").write_text(f"{HEADER}\n{line(1, 2, 3, 2015)}\n")
    first = raw_csv.land_csv(spark, str(source), str(landing)).collect()
    assert [(r["table_name"], r["status"]) for r in first] == [("one", raw_csv.UPLOADED)]
    assert first[0]["landed_bytes"] > 0
    (source / "two.csv").write_text(f'{HEADER}\n{line(1, 2, 3, 2015)}\n{line(1, 2, 4, 2015)}\n')
    second = raw_csv.land_csv(spark, str(source), str(landing)).collect()
    assert [r["status"] for r in second] == [raw_csv.ALREADY_EXISTS, raw_csv.UPLOADED]
    assert raw_csv.read_raw_csv(spark, f"{landing}/two").count() == 2


def test_landing_leaves_out_nested_files(spark, tmp_path):
    source = tmp_path / "csv"
    (source / "old").mkdir(parents=True)
    (source / "old" / "one.csv").write_text(f"{HEADER}\n")
    (source / "two.csv").write_text(f"{HEADER}\n{line(1, 2, 3, 2015)}\n")
    report = raw_csv.land_csv(spark, str(source), str(tmp_path / "landing")).collect()
    assert [(r["table_name"], r["status"]) for r in report] == [("two", raw_csv.UPLOADED)]


def test_landing_of_nothing(spark, tmp_path):
    source = tmp_path / "csv"
    source.mkdir()
    assert raw_csv.land_csv(spark, str(source), str(tmp_path / "landing")).count() == 0


def test_landing_keeps_text_whole(spark, tmp_path):
    source, landing = tmp_path / "csv", tmp_path / "landing"
    source.mkdir()
    (source / "t.csv").write_text('note,year\n" a ""b""\nc ",2015\n')
    (source / "u.csv").write_text('note,year\n"a ""b"" c",2015\n')
    raw_csv.land_csv(spark, str(source), str(landing))
    assert tuple(raw_csv.read_raw_csv(spark, f"{landing}/u").first()) == ('a "b" c', 2015)
    assert tuple(raw_csv.read_raw_csv(spark, f"{landing}/t").first()) == (' a "b"\nc ', 2015)


def test_load_appends_unless_told_to_overwrite(spark, tmp_path, database):
    write_gz(tmp_path / f"{TABLE}.csv.gz", HEADER, line(1, 2, 3, 2015))
    report = raw_csv.load_raw_tables(spark, str(tmp_path), database).collect()
    assert [tuple(r)[:5] for r in report] == [(TABLE, 1, 1, 0, raw_csv.LOADED)]
    raw_csv.load_raw_tables(spark, str(tmp_path), database)
    assert spark.table(f"{database}.{TABLE}").count() == 2
    raw_csv.load_raw_tables(spark, str(tmp_path), database, mode="overwrite")
    assert spark.table(f"{database}.{TABLE}").count() == 1


def test_load_reports_what_fails(spark, tmp_path, database):
    write_gz(tmp_path / "good.csv.gz", HEADER, line(1, 2, 3, 2015))
    write_gz(tmp_path / "not-a-name.csv.gz", HEADER, line(1, 2, 3, 2015))
    report = raw_csv.load_raw_tables(spark, str(tmp_path), database)
    status = {r["table_name"]: r["status"] for r in report.collect()}
    assert status == {"good": raw_csv.LOADED, "not-a-name": raw_csv.ERROR}
    assert tuple(raw_csv.load_summary(report).first()) == (2, 1, 0, 1)


def test_empty_landing_folder(spark, tmp_path, database):
    report = raw_csv.load_raw_tables(spark, str(tmp_path), database)
    assert tuple(raw_csv.load_summary(report).first()) == (0, 0, 0, 0)
    with pytest.raises(LookupError):
        tables.source_tables(spark, database)


def test_discovery_by_name_and_level(spark, database):
    for name in (TABLE, "hs_country_country_product_year_4", "other"):
        spark.range(1).write.saveAsTable(f"{database}.{name}")
    tables.replace_view(spark.range(1), "view_of_country_country_product_year")
    assert len(tables.source_tables(spark, database)) == 2
    assert tables.source_tables(spark, database, level="6") == [TABLE]
    with pytest.raises(LookupError):
        tables.source_tables(spark, database, level="2")


def test_table_status(spark, database):
    spark.range(0).write.saveAsTable(f"{database}.empty")
    spark.range(1).write.saveAsTable(f"{database}.full")
    assert tables.table_status(spark, f"{database}.absent") == (False, False)
    assert tables.table_status(spark, f"{database}.empty") == (True, False)
    assert tables.table_status(spark, f"{database}.full") == (True, True)


def test_fact_table_is_pruned_by_year(spark, database, fact_of):
    fact = fact_of(*[(1, 2, p, y, 1.0, 1.0) for p in range(3) for y in (2015, 2016)])
    stored = tables.write_fact_table(fact, f"{database}.fact")
    assert stored.schema == S.FACT_SCHEMA
    plan = stored.filter("year = 2016")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_build_then_merge(spark, tmp_path, database):
    write_gz(
        tmp_path / f"{TABLE}.csv.gz",
        HEADER,
        *[line(c, 9, p, y, 1.0 + c * p) for c in (1, 2) for p in (3, 4) for y in (2015, 2016)],
        line(1, None, 3, 2015),
    )
    raw_csv.load_raw_tables(spark, str(tmp_path), database)
    built = build.build_all(spark, database)
    assert built["combined_trade_data"].count() == 9
    assert built["v_global_yearly_metrics"].count() == 2
    # Another session reads the views by their full name.
    other = spark.newSession()
    assert other.table(f"{database}.v_portfolio_evolution").count() == 2
    assert "v_portfolio_evolution" not in [t.name for t in spark.catalog.listTables("default")]
    # Again: nothing new but the row without a partner, which matches nothing.
    assert build.build_combined(spark, database).count() == 10
    assert build.build_combined(spark, database, null_safe=True).count() == 10


def test_stream_takes_new_files_once(spark, tmp_path, database):
    landing, progress = tmp_path / "landing", str(tmp_path / "progress")
    table = f"{database}.fact"
    write_gz(landing / "one.csv.gz", HEADER, line(1, 2, 3, 2015), line(1, None, 3, 2015))

    def run():
        ingest_new_files(spark, str(landing), table, progress).awaitTermination()
        return tables.fact_in(spark, table)

    assert run().count() == 2
    assert run().count() == 2
    write_gz(
        landing / "two.csv.gz", HEADER, line(1, 2, 3, 2015, 9.0), line(1, None, 3, 2015),
        line(5, 6, 7, 2016), line(5, 6, 7, 2011), line(5, 6, 8, 2016, -1.0),
    )
    assert sorted((r["country_id"], r["export_value"]) for r in run().collect()) == [
        (1, 1.0), (1, 1.0), (5, 1.0)]


def test_stream_equals_combined(spark, tmp_path, database, bench):
    landing = tmp_path / "landing"
    for i, raw in enumerate(bench.raw):
        raw_csv.write_raw_csv(raw, str(landing / f"part{i}"))
    table = f"{database}.fact"
    ingest_new_files(
        spark, str(landing), table, str(tmp_path / "progress"), max_files=1
    ).awaitTermination()
    expected = ingest.combined_trade_data(bench.raw)
    found = tables.fact_in(spark, table)
    assert found.exceptAll(expected).count() == 0
    assert expected.exceptAll(found).count() == 0


def test_header_order_of_each_part(spark, tmp_path):
    """Parts with the same columns in another order, and with a column of their own."""
    for name, text in {
        "a": "country_id,export_value,import_value,year\n1,10,20,2015\n",
        "b": "year,import_value,country_id,export_value,note\n2016,21,2,11,n\n",
    }.items():
        (tmp_path / f"{name}.csv.gz").write_bytes(gzip.compress(text.encode()))
    rows = raw_csv.read_raw_csv(spark, str(tmp_path)).collect()
    found = {r["country_id"]: (r["export_value"], r["import_value"], r["year"], r["note"]) for r in rows}
    assert found == {1: (10.0, 20.0, 2015, None), 2: (11.0, 21.0, 2016, "n")}


def test_unreadable_values_are_counted_and_broken_files_reported(spark, tmp_path, database):
    header = "country_id,partner_country_id,product_id,year,export_value,import_value\n"
    good = gzip.compress((header + '1,2,3,2015,"1,000",5\n1,2,4,2015,7,\n').encode())
    (tmp_path / "good_country_country_product_year_6.csv.gz").write_bytes(good)
    random_rows = "".join(f"{i},2,3,2015,{i * 7919 % 1000003},{i * 104729 % 1000003}\n" for i in range(5000))
    cut = gzip.compress((header + random_rows).encode())
    (tmp_path / "cut_country_country_product_year_6.csv.gz").write_bytes(cut[: len(cut) // 2])
    report = {r["table_name"][:4]: r for r in raw_csv.load_raw_tables(spark, str(tmp_path), database).collect()}
    assert (report["good"]["status"], report["good"]["rows"], report["good"]["rejected"]) == ("loaded", 2, 1)
    assert report["cut_"]["status"] == "error" and len(report["cut_"]["message"]) > 20


def test_a_half_landed_table_is_landed_again(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "t.csv").write_text("a,b\n1,2\n3,4\n")
    half = tmp_path / "out" / "t"
    half.mkdir(parents=True)
    (half / "part-0.csv.gz").write_bytes(gzip.compress(b"a,b\n1,2\n"))
    land = lambda: raw_csv.land_csv(spark, str(tmp_path / "in"), str(tmp_path / "out")).first()["status"]
    assert land() == "uploaded"
    assert raw_csv.read_raw_csv(spark, str(half)).count() == 2
    assert land() == "already_exists"


def test_a_second_build_leaves_nothing_behind(spark, tmp_path, database):
    """What the steps store on the way goes when they are done; databases of queries are dropped."""
    from tradeloom.plans import queries
    from tradeloom.plans.workbench import Workbench
    from tradeloom.sources.shared import shared_folder

    def left():
        folder = Path(shared_folder(spark).removeprefix("file:"))
        return sorted(p.name for p in folder.iterdir()), len(spark.catalog.listDatabases())

    write_gz(tmp_path / f"{TABLE}.csv.gz", HEADER, line(1, 2, 3, 2015), line(1, 2, 3, 2016))
    raw_csv.load_raw_tables(spark, str(tmp_path), database)
    build.build_all(spark, database)
    before = left()
    build.build_all(spark, database)
    assert left() == before
    bench = Workbench(spark, SMALL)
    queries.load_report(bench)
    before = left()
    queries.load_counts(bench).collect()
    queries.full_build(bench).collect()
    assert left()[1] == before[1] and left()[0] == before[0]


@pytest.mark.parametrize(
    "values,kind",
    [
        (["1", "-20", "+3"], "bigint"), (["1", "2.5", "1e3", ".5"], "double"), (["true", "FALSE", ""], "boolean"), (["true", "1"], "string"),
        (["2015-02-28", "2016-02-29"], "date"), (["2015-02-29"], "string"), (["2015-02-28", "2015-02-28 10:11:12.5"], "timestamp"),
        (["2015-02-28", "12"], "string"), (["", None], "string"), (["9999999999999999999"], "double"), (["1", "x"], "string"), ([], "string"), ([" 1"], "string"),
    ],
)
def test_narrowest_type_of_all_values(spark, values, kind):
    text = spark.createDataFrame([(v, "5") for v in values], "a string, year string")
    found = raw_csv.detected_types(text)
    assert [tuple(r) for r in found.collect()] == [("a", kind, sum(bool(v) for v in values))]
    assert dict(raw_csv.with_types(text, found).dtypes)["a"] == kind


def test_read_with_detected_types(spark, tmp_path):
    (tmp_path / "x.csv").write_text("year,note,weight\n2015,7,1.5\n2016,,2\n")
    rows = raw_csv.read_raw_csv(spark, str(tmp_path / "x.csv"), detect=True)
    assert dict(rows.dtypes) == {"year": "bigint", "note": "bigint", "weight": "double"}
    assert sorted(tuple(r) for r in rows.collect()) == [(2015, 7, 1.5), (2016, None, 2.0)]

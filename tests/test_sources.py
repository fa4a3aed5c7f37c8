"""Workbook files, tables, views and exports."""

import time
from datetime import datetime
from pathlib import Path

import pytest
from grids import cells_frame, standard_sheet, workbook_bytes
from pyspark.sql import functions as F
from sheetloom.plans import jobs
from sheetloom.plans.silver import clean
from sheetloom.sources.folder import grid_preview, list_files, workbook_catalog
from sheetloom.operators import facts
from sheetloom.operators.facts import wide_names
from sheetloom.plans import gold
from sheetloom.session import durable, shared_folder
from sheetloom.sources import tables
from sheetloom.sources.tables import (
    CSV, Layout, create_layers, export_workbooks, save_table, table_version, write_csv,
)
from sheetloom.sources.xlsx import read_workbooks

STYLES = ('<xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/>'
          '<xf numFmtId="166"/><xf numFmtId="20"/>')
FORMATS = ('<numFmt numFmtId="164" formatCode="[h]:mm"/>'
           '<numFmt numFmtId="165" formatCode="&quot;days&quot; 0.00"/>'
           '<numFmt numFmtId="166" formatCode="[$-409]d\\-mmm\\-yy;@"/>')
SHEET = """
<row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c><c r="AA1" t="inlineStr"><is><t>in</t></is></c></row>
<row r="3"><c r="A3"><v>5</v></c><c r="B3"><v>0.1</v></c><c r="C3" s="1"><v>46085</v></c>
<c r="D3" s="5"><v>0.3125</v></c><c r="E3" t="b"><v>1</v></c><c r="F3" t="e"><v>#N/A</v></c>
<c r="G3" t="str"><f>A3&amp;"x"</f><v>5x</v></c><c r="H3" s="2"><v>1.5</v></c><c r="I3" s="3"><v>2.5</v></c>
<c r="J3" s="4"><v>46085.25</v></c><c r="K3" s="1"/></row>
<row><c><v>1E3</v></c><c><v>-2</v></c></row>
"""


def test_workbook_decoding(spark, tmp_path):
    data = workbook_bytes({"One": SHEET, "Void": ""}, ["<t>RT</t>", "<r><t>a</t></r><r><t> b</t></r><rPh><t>z</t></rPh>"],
                          FORMATS, STYLES)
    (tmp_path / "Lab A+1.xlsx").write_bytes(data)
    (tmp_path / "notes.txt").write_text("x")
    rows = read_workbooks(spark, str(tmp_path)).collect()
    (tmp_path / "_Lab A+1%20.XLSX").write_bytes(data)
    again = read_workbooks(spark, str(tmp_path)).collect()
    assert {r.workbook for r in again} == {"Lab A+1.xlsx", "_Lab A+1%20.XLSX"}
    assert len(again) == 2 * len(rows)
    assert {r.workbook for r in rows} == {"Lab A+1.xlsx"}
    assert [(r.sheet, r.sheet_pos) for r in rows if r.kind == "x"] == [("One", 1), ("Void", 2)]
    got = {(r.row, r.col): (r.kind, r.raw) for r in rows if r.kind != "x"}
    assert got == {
        (1, 1): ("s", "RT"), (1, 3): ("s", "a b"), (1, 27): ("s", "in"), (3, 1): ("n", "5"),
        (3, 2): ("n", "0.1"), (3, 3): ("dt", "2026-03-04 00:00:00"), (3, 4): ("t", "07:30:00"),
        (3, 5): ("b", "True"), (3, 6): ("s", "#N/A"), (3, 7): ("s", "5x"),
        (3, 8): ("s", "1 day, 12:00:00"), (3, 9): ("n", "2.5"), (3, 10): ("dt", "2026-03-04 06:00:00"),
        (4, 1): ("n", "1000.0"), (4, 2): ("n", "-2")}
    dated = next(r for r in rows if (r.row, r.col) == (3, 10))
    assert dated.dt == datetime(2026, 3, 4, 6)


def test_listing(spark, tmp_path):
    for name in ("b.XLSX", "a.xlsx", ".hidden.xlsx", "c.csv", "_u.xlsx"):
        (tmp_path / name).write_bytes(b"abc")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "d.xlsx").write_bytes(b"abc")
    got = list_files(spark, str(tmp_path), ".xlsx", site="Lab").collect()
    assert [(r.name, r.size_bytes, r.site) for r in got] == [
        ("_u.xlsx", 3, "Lab"), ("a.xlsx", 3, "Lab"), ("b.XLSX", 3, "Lab")]
    assert [r.name for r in list_files(spark, str(tmp_path)).collect()] == ["_u.xlsx", "a.xlsx", "b.XLSX", "c.csv"]


def test_catalog_and_preview(spark):
    cells = cells_frame(spark, {("a.xlsx", "z"): {(1, 1): "x", (2, 3): 5}, ("a.xlsx", "y"): {}})
    row = workbook_catalog(cells).first()
    assert (row.sheet_count, row.sheet_names, row.source_path) == (2, ["z", "y"], None)
    top = grid_preview(cells, "a.xlsx", "z", rows=3).collect()
    assert [tuple(r) for r in top] == [(1, "x", None, None), (2, None, None, "5"), (3, None, None, None)]
    assert grid_preview(cells, "a.xlsx", "absent", rows=3).count() == 3


def cells_xml(grid) -> str:
    rows = {}
    for (r, c), v in sorted(grid.items()):
        letters = chr(64 + c)
        body = (f'<c r="{letters}{r}" t="inlineStr"><is><t xml:space="preserve">{v}</t></is></c>'
                if isinstance(v, str) else f'<c r="{letters}{r}"><v>{v}</v></c>')
        rows.setdefault(r, []).append(body)
    return "".join(f'<row r="{r}">{"".join(cs)}</row>' for r, cs in rows.items())


def test_whole_run_from_files(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    for name, n in (("one.xlsx", 3), ("two.xlsx", 2)):
        grid = standard_sheet(["Impurity-1", "TFMBA"], [{1: i + 1, 5: f"#{i}", 12: 0.01 * i, 13: " 0.5"}
                                                        for i in range(n)])
        (source / name).write_bytes(workbook_bytes({"S": cells_xml(grid)}, styles="<xf numFmtId='0'/>"))
    jobs.run_all(spark, str(source), str(target))
    catalog = spark.table("bronze.raw_workbooks").orderBy("workbook").collect()
    assert [(r.workbook, r.sheet_count, r.size_bytes > 0, r.source_path.endswith(r.workbook))
            for r in catalog] == [("one.xlsx", 1, True, True), ("two.xlsx", 1, True, True)]
    assert spark.table("silver.observations_long").count() == 10
    assert spark.table("silver.dq_issues").count() == 5
    assert spark.table("gold.fact_observation").count() == 10
    assert spark.table("gold.dim_batch").count() == 5
    view = spark.newSession().table("silver.quarantine_review")
    assert view.count() == 0 and view.columns == [
        "reason", "workbook", "sheet", "row_seq", "column", "metric", "note"]
    assert spark.table("silver.unanswered_sheets").count() == 0
    assert sorted(p.name for p in (target / "observations").glob("export_name=*")) == [
        "export_name=one_CLEAN.xlsx", "export_name=two_CLEAN.xlsx"]
    exported = spark.read.parquet(str(target / "observations")).where("export_name = 'one_CLEAN.xlsx'")
    assert exported.count() == 6


def test_csv_values(spark, tmp_path):
    df = spark.createDataFrame([(True, 0.0001, None, 'say "x", y'), (None, 2.0, "t", " pad ")],
                               "f boolean, v double, s string, q string")
    write_csv(df.coalesce(1), str(tmp_path / "csv"))
    text = next((tmp_path / "csv").glob("*.csv")).read_text()
    assert text == 'f,v,s,q\ntrue,0.0001,,"say ""x"", y"\n,2.0,t, pad \n'


def test_export_order(spark, tmp_path):
    grid = standard_sheet(["TFMBA", "Impurity"], [{1: 9 - i, 5: "#", 12: 1} for i in range(5)])
    done = clean(cells_frame(spark, {("w.xlsx", "s"): grid}))
    export_workbooks({"observations": done.observations, "misc": done.misc_rows}, str(tmp_path))
    parts = sorted(Path(tmp_path / "observations" / "export_name=w_CLEAN.xlsx").glob("part-*"))
    order = [(r.row_seq, r.analyte) for p in parts for r in spark.read.parquet(str(p)).collect()]
    assert order == sorted(order) and len(order) == 10


def test_prefix_and_format(spark, tmp_path):
    grid = standard_sheet(["TFMBA"], [{1: i + 1, 5: "#", 12: " 0.5" if i else 1} for i in range(4)])
    layout = Layout(catalog="spark_catalog", prefix="lab_", table_format="orc")
    cells = cells_frame(spark, {("B.XLSX", "s"): grid, ("B.XLSX", "t"): grid})
    jobs.run_silver(cells, layout=layout)
    jobs.run_gold(spark, layout=layout)
    version = table_version(spark, "gold", "fact_observation", layout)
    detail = spark.sql(f"DESCRIBE EXTENDED spark_catalog.lab_gold.{version}").collect()
    assert any(r.col_name == "Provider" and r.data_type.lower() == "orc" for r in detail)
    assert spark.newSession().table("lab_silver.quarantine_review").count() == 0
    jobs.run_export(spark, str(tmp_path), "csv", layout=layout)
    rows = (spark.read.options(**CSV).csv(str(tmp_path / "observations")))
    assert {r.export_name for r in rows.collect()} == {"B_CLEAN.xlsx"}
    issues = spark.read.options(**CSV).csv(str(tmp_path / "dq_issues")).collect()
    assert {r.raw_value for r in issues} == {" 0.5"}
    assert (tmp_path / "misc").exists()


def test_cells_at_one_address_and_wide_names(spark):
    grid = standard_sheet(["TFMBA"], [{1: 1, 5: "#", 12: 1}])
    cells = cells_frame(spark, {("w.xlsx", "s"): grid})
    assert clean(cells.union(cells)).observations.count() == 1
    assert wide_names(["NOTES", "Notes", "sheet", "notes_2"]) == ["NOTES", "Notes_2", "sheet_2", "notes_2_2"]


def test_intermediate_folder(spark):
    folder = shared_folder(spark)
    assert spark.sparkContext.applicationId in folder and shared_folder(spark) == folder


def versions(spark, table, layer="bronze"):
    return sorted(r.tableName for r in spark.sql(f"SHOW TABLES IN {layer} LIKE '{table}__v*'").collect())


def test_a_failed_write_leaves_the_old_table(spark):
    create_layers(spark)
    save_table(spark.range(10).withColumnRenamed("id", "a"), "bronze", "kept")
    reader = spark.table("bronze.kept")
    broken = spark.range(0, 1000, 1, 4).select(
        F.when(F.col("id") < 990, F.col("id")).otherwise(F.raise_error(F.lit("midway")).cast("long")).alias("b"))
    with pytest.raises(Exception, match="midway"):
        save_table(broken, "bronze", "kept")
    assert spark.table("bronze.kept").columns == ["a"] and spark.table("bronze.kept").count() == 10
    assert len(versions(spark, "kept")) == 1
    # another schema, while an earlier reader goes on with the old rows
    assert save_table(spark.range(3).selectExpr("id as b", "'x' as c"), "bronze", "kept").columns == ["b", "c"]
    assert reader.count() == 10 and spark.newSession().table("bronze.kept").count() == 3


def test_a_table_is_rewritten_from_itself(spark):
    create_layers(spark)
    save_table(spark.range(4), "bronze", "own")
    for n in (5, 6, 7):
        grown = spark.table("bronze.own").unionByName(spark.range(100 + n, 101 + n))
        assert save_table(grown, "bronze", "own").count() == n
    assert len(versions(spark, "own")) == 2         # the one shown and the one before
    assert table_version(spark, "bronze", "own") == versions(spark, "own")[-1]


def test_a_run_that_started_earlier_may_end_later(spark, monkeypatch):
    create_layers(spark)
    save_table(spark.range(1), "bronze", "raced")
    slow, now = spark.range(2), time.time_ns()
    real = tables._point_to

    def overtaken(session, layer, table, version, layout):
        monkeypatch.setattr(tables, "_point_to", real)
        save_table(spark.range(3), layer, table)            # a later run ends first
        assert spark.table("bronze.raced").count() == 3
        real(session, layer, table, version, layout)

    monkeypatch.setattr(tables, "_point_to", overtaken)
    assert save_table(slow, "bronze", "raced").count() == 2
    assert spark.table("bronze.raced").count() == 2 and now > 0


def test_a_plain_table_makes_room_and_empty_results_do_not_replace(spark):
    create_layers(spark)
    spark.range(5).write.saveAsTable("bronze.plain")
    assert table_version(spark, "bronze", "plain") is None and table_version(spark, "bronze", "absent") is None
    assert save_table(spark.range(2), "bronze", "plain").count() == 2
    save_table(spark.range(0), "bronze", "plain", skip_empty=True)
    assert spark.table("bronze.plain").count() == 2


def test_flat_rows_have_the_columns_of_their_workbook(spark, tmp_path):
    def flat(labels, values):
        return {(2, c): n for c, n in enumerate(labels, 1)} | {
            (3 + i, c): v for i, row in enumerate(values) for c, v in enumerate(row, 1)}

    grids = {("a.xlsx", "s"): flat(["B", "A", "x,y", "Z"], [["1", "2", 'say "x"', "two\nlines"], ["3", "4", "5", None]]),
             ("a.xlsx", "t"): flat(["Q", "A", "B", "C"], [["q", "a", "b", "NULL"]]),
             ("b.xlsx", "s"): flat(["one", "two", "three", "four"], [[" 1", "2", "3", "4"]])}
    done = clean(cells_frame(spark, grids))
    export_workbooks({"misc": done.misc_rows}, str(tmp_path), "csv")

    def read(book):
        return (spark.read.options(**CSV, multiLine=True).csv(str(tmp_path / "misc" / f"export_name={book}_CLEAN.xlsx")))

    a, b = read("a"), read("b")
    assert a.columns == ["workbook", "sheet", "row_seq", "A", "B", "C", "Q", "Z", "x,y"]
    assert b.columns == ["workbook", "sheet", "row_seq", "four", "one", "three", "two"]
    assert [tuple(r)[1:] for r in a.orderBy("sheet", "row_seq").collect()] == [
        ("s", "1", "2", "1", None, None, "two\nlines", 'say "x"'), ("s", "2", "4", "3", None, None, None, "5"),
        ("t", "1", "a", "b", None, "q", None, None)]
    assert [tuple(r) for r in b.collect()] == [("b.xlsx", "s", "1", "4", "1", "3", "2")]


def test_each_file_of_a_workbook_has_the_header_and_the_order(spark, tmp_path):
    rows = spark.range(3000).selectExpr("'w.xlsx' as workbook", "'s' as sheet", "id as row_seq",
                                        "map('k', cast(id as string)) as fields")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        tables.write_misc(rows.repartition(7), str(tmp_path / "misc"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted((tmp_path / "misc").rglob("part-*"))
    texts = [f.read_text().splitlines() for f in files]
    assert len(files) > 1 and all(t[0] == "workbook,sheet,row_seq,k" for t in texts)
    assert [int(line.split(",")[2]) for t in texts for line in t[1:]] == list(range(3000))


def test_a_union_of_fifty_thousand_labels(spark):
    rows = spark.range(500).selectExpr(
        "'w' as workbook", "'s' as sheet", "id as row_seq",
        "map_from_entries(transform(sequence(0, 99), i -> struct(concat(if(i = 5, 'it''s \"', 'its \"'), id * 100 + i, '\"'), "
        "if(i % 10 = 3, null, cast(i as string))))) as fields")
    assert facts.misc_label_table(rows).count() == 50_000
    union = durable(facts.misc_union(rows))
    got = union.where("row_seq in (0, 7)").select("row_seq", *[
        facts.field_of(f'{it} "{n}"').alias(f"c{n}") for it, n in (("it's", 5), ("its", 3), ("its", 706))]).orderBy("row_seq").collect()
    assert [tuple(r) for r in got] == [(0, "5", None, None), (7, None, None, "6")]


def test_sums_do_not_depend_on_the_order(spark):
    import random
    rng = random.Random(4)
    values = [rng.choice([1e-12, 0.1, 12.3456, 9e8, 3e12, 4.5e17, -7e19]) * rng.random() for _ in range(4000)]
    found = set()
    for n in (1, 3, 8):
        rng.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(n)
        found.add(tuple(df.agg(gold.exact_sum(F.col("v")), gold.exact_avg(F.col("v"))).first()))
    assert len(found) == 1
    small = spark.createDataFrame([(v,) for v in [0.1] * 10 + [None]], "v double")
    assert tuple(small.agg(gold.exact_sum(F.col("v")), gold.exact_avg(F.col("v"))).first()) == (1.0, 0.1)
    odd = spark.createDataFrame([(1e300,), (1.0,), (float("nan"),)], "v double")
    assert str(odd.agg(gold.exact_sum(F.col("v"))).first()[0]) == "nan"
    assert tuple(small.where("v is null").agg(gold.exact_sum(F.col("v")), gold.exact_avg(F.col("v"))).first()) == (None, None)
    times = small.where("v is not null").agg(gold.exact_sum(F.col("v"), F.lit(3).cast("long"))).first()[0]
    assert times == 3.0


def test_batches_are_folded_without_a_sort(spark):
    from sheetloom.contracts import OBSERVATION_COLUMNS
    grid = standard_sheet(["TFMBA"], [{1: 1, 5: "#", 12: 1}])
    observations = clean(cells_frame(spark, {("w.xlsx", "s"): grid})).observations_keyed
    stored = durable(observations)
    assert "SortAggregate" not in gold.dim_batch(stored)._jdf.queryExecution().executedPlan().toString()
    assert set(OBSERVATION_COLUMNS) < set(stored.columns)


def test_a_hundred_thousand_files_are_listed_by_a_task(spark, tmp_path, monkeypatch):
    for name in ("many", "few"):
        (tmp_path / name).mkdir()
    for i in range(100_000):
        (tmp_path / "many" / f"b{i}.xlsx").touch()
    for name in ("x.XLSX", ".hidden.xlsx", "_y.xlsx", "z.csv"):
        (tmp_path / "few" / name).write_bytes(b"12")
    (tmp_path / "few" / "sub.xlsx").mkdir()
    sent = []
    real = type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **k: sent.append(data) or real(self, data, *a, **k))
    both = list_files(spark, [str(tmp_path / "many"), str(tmp_path / "few")], ".xlsx", site="Lab")
    assert both.count() == 100_002 and [len(rows) for rows in sent] == [2]
    few = both.where("folder like '%few'").collect()
    assert [(r.name, r.size_bytes, r.site) for r in few] == [("_y.xlsx", 2, "Lab"), ("x.XLSX", 2, "Lab")]
    assert few[0].path == f"file:{tmp_path}/few/_y.xlsx"
    with pytest.raises(FileNotFoundError):
        list_files(spark, str(tmp_path / "none"))

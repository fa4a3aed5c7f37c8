"""Cells tables derived from the given tables, so that grids grow with the data.

``orders`` become workbooks of standard sheets, ``events`` flat sheets and
``part`` sheets of unusable layouts.  A row's sheet and position follow from its
key alone: no ranking, no shuffle, and more data means more sheets.  Dirt depends
on the key too, so that a result can be stated straight from the source table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from sheetloom.contracts import CELLS, MARKER_KIND
from sheetloom.session import shared_folder

ADDRESS = ["workbook", "sheet", "sheet_pos"]
ORDERS_PER_SHEET, SHEETS_PER_ORDERS_BOOK = 500, 10
EVENTS_PER_SHEET, SHEETS_PER_EVENTS_BOOK = 600, 5
PARTS_PER_SHEET, SHEETS_PER_PART_BOOK = 100, 5
DATA_ROW = 13

FIELD_LABELS = {
    1: "Entry", 2: "Date of Sampling", 3: "Time of sampling", 4: "Time of Reporting",
    5: "Batch No.", 6: "Instrument ID", 7: "Stage", 8: "Sample Characteristic",
    10: "Appearance",
    11: "Appearance of 30% solution in methanol (read next day)",
}
# column: (label, bound, spec, internal spec, sub-unit); a None label is a gap in the band
EVEN_BAND = {
    12: ("Impurity-1", "Max", 0.1, 0.08, "w/w"),
    13: ("2-chloro benzamide", "Max", 0.1, 0.08, "w/w"),
    14: ("Impurity-1", "Max", 0.1, 0.08, "w/w"),
    15: ("TFMBA", "Min", 99.0, 99.0, "w/w"),
    16: ("Impurity", "Max", 0.1, 0.08, "w/w"),
    17: (None, None, None, None, None),
    18: ("5-chloro TFMBA", "Max ", " 0.1 ", 0.08, "w/w"),
    19: ("Peak-A", "Max", 0.1, 0.08, None),
    20: ("TFMBA Acid", "Max", 0.1, 0.08, "w/w"),
}
ODD_BAND = {
    12: ("Impurity-1", "Max", 0.1, 0.08, "w/w"),
    13: ("Impurity-3", "Max", 0.1, 0.08, "w/w"),
    14: ("TFMBA", "Min", 99.0, 99.0, "w/w"),
    15: ("Late peak 1.7", "Max", 0.1, 0.08, "w/w"),
    16: ("TFMBA Acid", "Max", 0.1, 0.08, None),
}


def _sql(kind: str, raw: str, *, num: str = "NULL", dt: str = "NULL", tm: str = "NULL") -> str:
    """Expression text of a cell struct."""
    return (f"named_struct('kind', '{kind}', 'num', CAST({num} AS DOUBLE), "
            f"'dt', CAST({dt} AS TIMESTAMP_NTZ), 'tm', CAST({tm} AS STRING), 'raw', {raw})")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _by_sheet(rows: DataFrame) -> DataFrame:
    """Source rows of a sheet together, as a decoding job leaves its cells.

    Sheets are of one bounded size here, and the narrow source rows are moved
    before they are spread into cells.
    """
    return rows.repartition(*ADDRESS)


def _spread(rows: DataFrame, cells: dict[int, str]) -> DataFrame:
    """One output row per cell; a text cell without text is no cell."""
    listed = ", ".join(f"named_struct('col', {col}, 'cell', {cell})" for col, cell in cells.items())
    return (rows.selectExpr(*ADDRESS, "row", f"inline(array({listed}))")
            .where("cell.raw IS NOT NULL")
            .select(*ADDRESS, "row", "col", "cell.*"))


def _header(sheets: DataFrame, grid: dict[tuple[int, int], str | float]) -> DataFrame:
    """Constant cells of every sheet; one expression text, as there are many."""
    def entry(row: int, col: int, value: str | float) -> str:
        kind, num = ("s", "CAST(NULL AS DOUBLE)") if isinstance(value, str) else ("n", f"{value}D")
        return (f"named_struct('row', {row}, 'col', {col}, 'kind', '{kind}', 'num', {num}, "
                f"'dt', CAST(NULL AS TIMESTAMP_NTZ), 'tm', CAST(NULL AS STRING), 'raw', '{value}')")

    listed = ", ".join(entry(r, c, v) for (r, c), v in grid.items())
    return sheets.select(*ADDRESS, F.expr(f"inline(array({listed}))"))


def _marker(sheets: DataFrame) -> DataFrame:
    marker = _sql(MARKER_KIND, "CAST(NULL AS STRING)")
    return (sheets.selectExpr(*ADDRESS, "0 AS row", "0 AS col", f"{marker} AS cell")
            .select(*ADDRESS, "row", "col", "cell.*"))


def _union(*parts: DataFrame) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.select(*[F.col(f.name).cast(f.dataType) for f in CELLS.fields])


# --- standard sheets from orders ------------------------------------------------

def _band_header(band: dict) -> dict[tuple[int, int], object]:
    grid: dict[tuple[int, int], object] = {
        (3, 1): "Inprocess sheet", (3, 10): "Analysis",
        **{(4, c): label for c, label in FIELD_LABELS.items()},
        (5, 1): "RT", (6, 1): "RRT", (7, 1): "Unit", (7, 11): "a longer note on the unit",
        (9, 1): "Specification", (9, 11): "0.0000", (11, 1): "Internal SRF Specification",
    }
    for col, (label, bound, spec, internal, sub_unit) in band.items():
        if label is None:
            continue
        rt = 0.5 + 0.25 * (col - 12)
        grid.update({(4, col): label, (5, col): rt, (6, col): rt / 2, (7, col): "%",
                     (9, col): bound, (10, col): spec, (11, col): internal})
        if sub_unit:
            grid[(8, col)] = sub_unit
    return grid


MEASURED_KIND = """CASE WHEN dirt IN (0, 1, 2, 3, 4, 5, 6, 10, 11) THEN 's' WHEN dirt = 9 THEN 'b'
  ELSE 'n' END"""
MEASURED_NUMBER = "CASE dirt WHEN 8 THEN -(v + 1) WHEN 9 THEN 1D ELSE v END"
# u / 10000 has no exponent in its text from 0.001 on
MEASURED_PLAIN = "CASE WHEN NOT minimum AND u < 10 THEN concat('0.000', u) ELSE string(v) END"
MEASURED_RAW = """CASE dirt WHEN 0 THEN concat(' ', plain) WHEN 1 THEN concat(plain, ' ')
  WHEN 2 THEN 'NULL' WHEN 3 THEN '?' WHEN 4 THEN '' WHEN 5 THEN concat('-', plain)
  WHEN 6 THEN 'n.d.' WHEN 8 THEN string(num) WHEN 9 THEN 'True' WHEN 10 THEN '1_0'
  WHEN 11 THEN '-' ELSE plain END"""


def _measured(rows: DataFrame) -> DataFrame:
    """Measured cells of every order, with their dirt."""
    def listed(band: dict) -> str:
        return ", ".join(f"named_struct('col', {col}, 'minimum', {str(spec[1] == 'Min').lower()})"
                         for col, spec in band.items())

    return (
        rows.selectExpr(
            *ADDRESS, "row", "k", "o_totalprice",
            f"inline(IF(sheet_pos % 2 = 0, array({listed(EVEN_BAND)}), array({listed(ODD_BAND)})))")
        .selectExpr("*", "(k + 11 * col) % 37 AS dirt",
                    "(bigint(floor(o_totalprice * 100 + 0.5D)) * col + k) % 1300 + 1 AS u")
        .where("dirt <> 7")
        .selectExpr("*", "IF(minimum, 98D + (u % 200) / 100D, u / 10000D) AS v")
        .selectExpr("*", f"{MEASURED_KIND} AS kind", f"{MEASURED_NUMBER} AS num",
                    f"{MEASURED_PLAIN} AS plain")
        .selectExpr(*ADDRESS, "row", "col", "kind", "IF(kind = 's', NULL, num) AS num",
                    "CAST(NULL AS TIMESTAMP_NTZ) AS dt", "CAST(NULL AS STRING) AS tm",
                    f"{MEASURED_RAW} AS raw")
    )


def orders_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standard sheets: each order is a data row."""
    rows = _table(spark, sf_dir, "orders").withColumn("k", F.col("o_orderkey")).select(
        "*",
        F.expr(f"concat('orders_', k div {ORDERS_PER_SHEET * SHEETS_PER_ORDERS_BOOK}, '.xlsx')")
        .alias("workbook"),
        F.expr(f"cast((k div {ORDERS_PER_SHEET}) % {SHEETS_PER_ORDERS_BOOK} + 1 as int)")
        .alias("sheet_pos"),
        F.expr(f"cast({DATA_ROW} + k % {ORDERS_PER_SHEET} as int)").alias("row"),
    ).withColumn("sheet", F.expr("concat(sheet_pos, '. R-', 2100 + sheet_pos)"))
    rows = _by_sheet(rows)

    def clock(shift: int) -> str:
        text = (f"CASE (k + {shift}) % 25 WHEN 1 THEN '27:00.0' WHEN 2 THEN '8.30' "
                "WHEN 3 THEN '??:??' WHEN 4 THEN '' WHEN 5 THEN '8:05 PM' END")
        native = (f"concat(lpad((k + {shift}) % 24, 2, '0'), ':', lpad(k * 7 % 60, 2, '0'), ':00')")
        return (f"CASE WHEN (k + {shift}) % 25 = 6 THEN {_sql('dt', at, dt='o_orderdate')} "
                f"WHEN (k + {shift}) % 25 BETWEEN 1 AND 5 THEN {_sql('s', text)} "
                f"ELSE {_sql('t', native, tm=native)} END")

    at = "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')"
    serial = "IF(k % 101 <> 7 AND k % 89 = 3, k, k + 1)"
    dirty_day = ("CASE k % 40 WHEN 1 THEN date_format(o_orderdate, 'dd/MM/yyyy') "
                 "WHEN 2 THEN date_format(o_orderdate, 'MMM dd yyyy') WHEN 3 THEN '' "
                 "WHEN 4 THEN '31/31/2020' WHEN 5 THEN 'NULL' "
                 "WHEN 6 THEN date_format(o_orderdate, 'yyyy-MM-dd') END")
    cells = {
        1: f"""CASE WHEN k % 97 = 5 THEN {_sql('s', "'see note'")}
            WHEN k % 101 = 7 THEN {_sql('n', "concat(k + 1, '.5')", num='k + 1.5D')}
            ELSE {_sql('n', f"string({serial})", num=serial)} END""",
        2: f"""CASE WHEN k % 40 = 7 THEN NULL WHEN k % 40 BETWEEN 1 AND 6 THEN {_sql('s', dirty_day)}
            ELSE {_sql('dt', at, dt='o_orderdate')} END""",
        3: clock(0),
        4: clock(7),
        5: _sql("s", "CASE WHEN k % 31 = 7 THEN NULL WHEN k % 37 = 2 "
                     "THEN concat(' #', k div 3, ' ') ELSE concat('#', k div 3) END"),
        6: _sql("s", "concat('HPLC-0', o_custkey % 5 + 1, '/KF-12')"),
        7: _sql("s", "o_orderpriority"),
        8: _sql("s", "CASE o_orderstatus WHEN 'F' THEN 'Solid' WHEN 'O' THEN 'Liquid' "
                     "ELSE '  Slurry' END"),
        9: _sql("s", "CASE WHEN sheet_pos % 2 = 0 THEN NULL WHEN k % 4 = 0 "
                     "THEN concat('R', k div 3) WHEN k % 4 = 1 THEN 'NULL' END"),
        10: _sql("s", "CASE k % 20 WHEN 0 THEN 'white powder' WHEN 1 THEN ' White Powder ' "
                      "WHEN 2 THEN 'WHITE POWDER' WHEN 3 THEN '' WHEN 4 THEN 'NULL' "
                      "WHEN 5 THEN 'off-white McDonald cake' ELSE 'White Powder' END"),
        11: _sql("s", "CASE k % 23 WHEN 0 THEN 'Ok' WHEN 1 THEN ' OK ' WHEN 2 THEN 'NULL' "
                      "WHEN 3 THEN '?' WHEN 4 THEN '' WHEN 5 THEN 'fail' WHEN 6 THEN 'maybe' "
                      "WHEN 7 THEN 'out of spec' ELSE 'OK' END"),
    }
    sheets = rows.select(*ADDRESS).distinct()
    even_header = _band_header(EVEN_BAND)
    odd_header = {**_band_header(ODD_BAND), (4, 9): "Batch number"}
    return _union(
        # in two parts, as one would be a method too large to be compiled
        _spread(rows, {c: cell for c, cell in cells.items() if c <= 3}),
        _spread(rows, {c: cell for c, cell in cells.items() if c > 3}), _measured(rows),
        _header(sheets.where("sheet_pos % 2 = 0"), even_header),
        _header(sheets.where("sheet_pos % 2 = 1"), odd_header),
        _marker(sheets))


# --- flat sheets from events -------------------------------------------------------

FLAT_LABELS = ["Row", "Date", "What", "Run", "Outcome", "Checked by", "Remarks", "Remarks"]


def events_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat sheets: each event is a row of a log; some rows are blank."""
    rows = _table(spark, sf_dir, "events").withColumn("k", F.col("event_id")).select(
        "*",
        F.expr(f"concat('events_', k div {EVENTS_PER_SHEET * SHEETS_PER_EVENTS_BOOK}, '.xlsx')")
        .alias("workbook"),
        F.expr(f"cast((k div {EVENTS_PER_SHEET}) % {SHEETS_PER_EVENTS_BOOK} + 1 as int)")
        .alias("sheet_pos"),
        F.expr(f"cast(4 + k % {EVENTS_PER_SHEET} as int)").alias("row"),
        F.date_trunc("second", F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("at"),
    ).withColumn("sheet", F.expr("concat('MISC ', sheet_pos)"))
    rows = _by_sheet(rows)

    blank = f"(k % 50 = 9 OR k % {EVENTS_PER_SHEET} = 0)"
    at = "date_format(at, 'yyyy-MM-dd HH:mm:ss')"
    dirty_day = "CASE k % 15 WHEN 1 THEN date_format(at, 'dd/MM/yyyy') WHEN 2 THEN 'NULL' END"
    filled = {
        1: _sql("n", "string(k + 1)", num="k + 1"),
        2: f"IF(k % 15 IN (1, 2), {_sql('s', dirty_day)}, {_sql('dt', at, dt='at')})",
        3: _sql("s", "IF(k % 9 = 4, concat(' ', event_type, ' '), event_type)"),
        4: _sql("s", "concat('QA-', 1000 + user_id)"),
        5: _sql("s", "CASE k % 8 WHEN 0 THEN 'Pass' WHEN 1 THEN 'Fail' WHEN 2 THEN 'Review' "
                     "WHEN 3 THEN 'OK' WHEN 4 THEN 'NULL' WHEN 5 THEN '' WHEN 6 THEN '?' END"),
        6: _sql("s", "concat('user ', user_id % 7)"),
        7: _sql("s", "IF(k % 11 = 3, '', props)"),
        8: _sql("s", "IF(k % 5 = 0, 'late', NULL)"),
    }
    cells = {col: f"IF({blank}, NULL, {cell})" for col, cell in filled.items()}
    empty = _sql("s", "''")
    cells[2] = f"IF({blank}, IF(k % 100 = 9, {empty}, NULL), {filled[2]})"
    sheets = rows.select(*ADDRESS).distinct()
    header = {(1, 1): "Event log", **{(3, c): label for c, label in enumerate(FLAT_LABELS, 1)}}
    return _union(_spread(rows, cells), _header(sheets, header), _marker(sheets))


# --- unusable sheets from part ------------------------------------------------------

def parts_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five sorts of sheet that no layout fits, and one empty sheet per workbook."""
    base = _table(spark, sf_dir, "part").withColumn("k", F.col("p_partkey")).select(
        "*",
        F.expr(f"concat('part_', k div {PARTS_PER_SHEET * SHEETS_PER_PART_BOOK}, '.xlsx')")
        .alias("workbook"),
        F.expr(f"cast((k div {PARTS_PER_SHEET}) % {SHEETS_PER_PART_BOOK} + 1 as int)")
        .alias("sheet_pos"),
        F.expr(f"cast(k % {PARTS_PER_SHEET} as int)").alias("n"),
    ).withColumn("sheet", F.expr("concat('S', sheet_pos)"))
    base = _by_sheet(base)

    def at(pos: int, first_row: int, cells: dict[int, str]) -> DataFrame:
        rows = base.where(F.col("sheet_pos") == pos).withColumn("row", F.col("n") + first_row)
        return _spread(rows, cells)

    sheets = base.select(*ADDRESS).distinct()
    serial, name = _sql("n", "string(k)", num="k"), _sql("s", "p_name")
    price = _sql("n", "string(p_retailprice)", num="p_retailprice")
    long_text = _sql("s", "concat_ws(' ', p_name, p_brand, p_type, 'made to drawing')")
    no_rt = {k: v for k, v in _band_header(ODD_BAND).items() if k[0] != 5 or k[1] == 1}
    empty = (sheets.select("workbook").distinct()
             .select("workbook", F.lit("Empty").alias("sheet"),
                     F.lit(SHEETS_PER_PART_BOOK + 1).alias("sheet_pos")))
    return _union(
        at(1, 1, {1: name}),
        at(2, DATA_ROW, {1: serial, 12: price}),
        _header(sheets.where("sheet_pos = 2"),
                {(5, 1): "RT", (5, 12): 0.5, (9, 1): "Specification"}),
        at(3, 1, {c: long_text for c in range(1, 6)}),
        at(4, 8, {1: name, 2: _sql("s", "p_brand")}),
        _header(sheets.where("sheet_pos = 4"),
                {(1, 1): "name", (1, 2): "brand", (1, 3): "type", (1, 4): "size",
                 (1, 13): "a remark that is far too long for a label"}),
        at(5, DATA_ROW, {1: serial, 12: price}),
        _header(sheets.where("sheet_pos = 5"), no_rt),
        _marker(sheets), _marker(empty))


GRIDS = {"orders": orders_grid, "events": events_grid, "part": parts_grid}


def all_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _union(*[grid(spark, sf_dir) for grid in GRIDS.values()])


_written: dict[tuple, str] = {}


def source_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Identity of the session and of the source files as they are now."""
    files = [
        tuple(spark.read.format("binaryFile").load(f"{sf_dir}/{name}.parquet").agg(
            F.count("*"), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first())
        for name in GRIDS]
    return (spark.sparkContext.applicationId, sf_dir, *files)


def cells_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells of all grids as a Parquet table, as a decoding job would leave it.

    Written once per session and state of the source files, under the session's
    checkpoint folder.
    """
    key = source_state(spark, sf_dir)
    if key not in _written:
        folder = f"{shared_folder(spark)}/sheetloom-cells-{uuid.uuid4().hex}"
        all_grids(spark, sf_dir).write.parquet(folder)
        _written[key] = folder
    return spark.read.schema(CELLS).parquet(_written[key])

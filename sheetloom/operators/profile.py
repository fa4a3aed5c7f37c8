"""Sheet profiling: find the layout, header band and columns of every sheet.

Two pruned scans fold each header row and, without its texts, the whole body into a few
integers.  Those partial aggregates run before the shuffle, so a sheet of any height
reaches the second step as at most 28 small rows.  Flat sheets are read once more: the
filled rows of a column are bits, 64 rows to a word.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sheetloom.contracts import (
    HEADER_FIELDS, LAYOUT_FLAT, LAYOUT_STANDARD, LAYOUT_UNKNOWN, NUMERIC_KINDS,
    PROFILE_COLUMNS, SHEET_COLUMN_COLUMNS,
)
from sheetloom.functions.text import header_label, strict_double, text_or_null
from sheetloom.session import broadcast_if_small, broadcast_within, durable

SHEET = ["workbook", "sheet"]

# Column-A labels that anchor the header band.
ANCHORS = {
    "rt": "rt_row",
    "rrt": "rrt_row",
    "unit": "unit_row",
    "specification": "spec_bound_row",
    "internal srf specification": "internal_spec_row",
}
# Texts of which a field-label row contains at least four.
FIELD_LABELS = [
    "date of sampling", "time of sampling", "time of reporting",
    "batch no.", "batch no", "batch number",
    "instrument id", "stage", "sample characteristic", "sample characteristics",
    "appearance", "appearance of 30% solution",
]
# Texts that mark a process-label row.
PROCESS_LABELS = ["inprocess", "analysis"]

# Reach of the header search.
SCAN_ROWS = 25           # rows searched for anchors and field labels
FLAT_ROWS = 7            # rows searched for a flat header
FLAT_COLUMNS = 12        # columns that decide whether a sheet looks flat
FLAT_MIN_LABELS = 4
FLAT_LABEL_LENGTH = 24
FIELD_LABEL_HITS = 4
PROCESS_REACH = 3        # rows above the field labels that may hold the process label

# A header row can lie two rows below the last anchor (the spec value sits under
# its bound, the data under that); everything lower is body.
HEADER_ROWS = SCAN_ROWS + 2

# Rows of a sheet are handled in blocks of this height wherever a sheet-level
# fact has to meet the cells, so that a huge sheet spreads over many tasks.
ROWS_PER_BLOCK = 8192
WORD = 32                # rows to a word of a bitmap; no bit of it is the sign of a long

NOTE_SMALL = "sheet too small to profile"
NOTE_NO_BAND = "could not locate quality_standard header band"
NOTE_NO_MEASURED = "could not locate measured columns"
NOTE_FLAT_LOST = "misc_flat detector tripped but header row not isolated"
NOTE_NOTHING = "no anchors and no flat header detected"


def is_numeric(kind: Column) -> Column:
    return kind.isin(*NUMERIC_KINDS)


def block_of(row: Column) -> Column:
    return F.floor(row / ROWS_PER_BLOCK).cast("int")


def _flag_bits(flags: list[Column]) -> Column:
    """Several booleans as one integer, so that they fold with bit_or."""
    bits = [F.when(flag, 1 << i).otherwise(0) for i, flag in enumerate(flags)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def row_facts(cells: DataFrame) -> DataFrame:
    """One row per (sheet, header row), plus one for the body of the sheet.

    Two scans: the first rows with their text, and the rest with what it takes to find
    the sheet's extent and its serials.
    """
    header = _header_facts(cells.where(F.col("row") <= HEADER_ROWS))
    body = _body_facts(cells.where(F.col("row") > HEADER_ROWS))
    return header.unionByName(body, allowMissingColumns=True)


def _extent() -> list[Column]:
    in_a = (F.col("col") == 1) & is_numeric(F.col("kind"))
    return [
        F.max("row").alias("max_row"),
        F.max("col").alias("max_col"),
        F.min(F.when(in_a, F.col("row"))).alias("first_serial_row"),
        F.count(F.when(in_a, 1)).alias("serials"),
    ]


def _body_facts(cells: DataFrame) -> DataFrame:
    return (cells.groupBy(*SHEET).agg(*_extent())
            .withColumn("hrow", F.lit(HEADER_ROWS + 1)))


def _header_facts(cells: DataFrame) -> DataFrame:
    label = F.col("label")      # a column, for each of many flags would make it anew
    scanned = F.col("row") <= SCAN_ROWS
    in_a = F.col("col") == 1
    real = F.col("col") >= 1
    numeric = is_numeric(F.col("kind"))
    short = F.length(label).between(1, FLAT_LABEL_LENGTH)
    anchor = label.isin(list(ANCHORS))
    near = F.col("col") <= FLAT_COLUMNS
    flat_row = real & (F.col("row") <= FLAT_ROWS)
    zero = F.lit(0)
    return (
        cells.withColumns({"hrow": F.col("row"), "label": header_label(F.col("raw"))})
        .groupBy(*SHEET, "hrow")
        .agg(
            F.max("sheet_pos").alias("sheet_pos"),
            *_extent(),
            F.bit_or(F.when(scanned & in_a, _flag_bits([label == a for a in ANCHORS]))
                     .otherwise(zero)).alias("anchor_bits"),
            F.bit_or(F.when(scanned, _flag_bits([label.contains(t) for t in FIELD_LABELS]))
                     .otherwise(zero)).alias("label_bits"),
            F.max(F.when(scanned, reduce(lambda a, b: a | b,
                                         [label.contains(t) for t in PROCESS_LABELS])))
            .alias("is_process"),
            F.min(F.when(scanned & numeric, F.col("col"))).alias("first_num_col"),
            F.max(F.when(scanned & numeric, F.col("col"))).alias("last_num_col"),
            F.count(F.when(flat_row & near, 1)).alias("near_cells"),
            F.min(F.when(flat_row & near, short & ~anchor)).alias("near_ok"),
            F.count(F.when(flat_row, 1)).alias("all_cells"),
            F.min(F.when(flat_row, short)).alias("all_ok"),
        )
    )


def sheet_facts(cells: DataFrame) -> DataFrame:
    """One row per sheet: its extent and its header rows as a short array."""
    return (
        row_facts(cells)
        .groupBy(*SHEET)
        .agg(
            F.max("sheet_pos").alias("sheet_pos"),
            F.max("max_row").alias("max_row"),
            F.max("max_col").alias("max_col"),
            F.array_sort(F.collect_list(F.struct(
                "hrow", "anchor_bits", "label_bits", "is_process", "first_num_col",
                "last_num_col", "first_serial_row", "serials", "near_cells", "near_ok",
                "all_cells", "all_ok"))).alias("rows"),
        )
    )


def _first_row(condition) -> Column:
    """Lowest header row that satisfies a condition over its facts."""
    return F.array_min(F.transform(F.filter("rows", condition), lambda r: r["hrow"]))


def _has_bit(bits: str, position: int):
    return lambda r: r[bits].bitwiseAND(F.lit(1 << position)) != 0


def header_bands(cells: DataFrame) -> DataFrame:
    """Every detector's outcome side by side, one row per sheet."""
    facts = sheet_facts(cells)
    anchors = {field: _first_row(_has_bit("anchor_bits", i))
               for i, field in enumerate(ANCHORS.values())}
    found = facts.select(
        *SHEET, "sheet_pos", "max_row", "max_col", "rows",
        *[c.alias(name) for name, c in anchors.items()],
        _first_row(lambda r: F.bit_count(r["label_bits"]) >= FIELD_LABEL_HITS)
        .alias("field_label_row"),
        F.coalesce(F.exists("rows", lambda r: (r["near_cells"] >= FLAT_MIN_LABELS) & r["near_ok"]),
                   F.lit(False)).alias("looks_flat"),
        _first_row(lambda r: (r["all_cells"] >= FLAT_MIN_LABELS) & r["all_ok"])
        .alias("flat_header_row"),
    )
    label_row = F.col("field_label_row")
    at_rt = F.filter("rows", lambda r: r["hrow"] == F.col("rt_row"))
    return found.select(
        "*",
        _first_row(lambda r: r["is_process"] & (r["hrow"] >= label_row - PROCESS_REACH)
                   & (r["hrow"] < label_row)).alias("process_label_row"),
        F.get(at_rt, 0)["first_num_col"].alias("first_col"),
        F.get(at_rt, 0)["last_num_col"].alias("last_col"),
        (F.col("spec_bound_row") + 1).alias("spec_value_row"),
        (F.coalesce("internal_spec_row", F.col("spec_bound_row") + 1, "rt_row") + 1)
        .alias("seek_from"),
    )


def _serial_start(seek_from: Column) -> Column:
    """First row from ``seek_from`` on whose column A is numeric, else ``seek_from``."""
    below = F.filter("rows", lambda r: r["first_serial_row"] >= seek_from)
    return F.coalesce(F.array_min(F.transform(below, lambda r: r["first_serial_row"])), seek_from)


def _serial_count(start: Column) -> Column:
    """Numeric column-A cells from ``start`` on; the start is never inside the
    body group unless it is that group's own first serial."""
    return F.aggregate(
        F.filter("rows", lambda r: r["first_serial_row"] >= start),
        F.lit(0).cast("bigint"), lambda total, r: total + r["serials"])


def classify(bands: DataFrame) -> DataFrame:
    """Decide each sheet's layout and, for standard sheets, its data rows."""
    small = (F.col("max_row") < 3) | (F.col("max_col") < 2)
    anchored = F.col("rt_row").isNotNull() & F.col("spec_bound_row").isNotNull()
    no_band = F.col("field_label_row").isNull()
    no_measured = F.col("first_col").isNull()
    flat_lost = F.col("flat_header_row").isNull()
    note = (
        F.when(small, NOTE_SMALL)
        .when(anchored & no_band, NOTE_NO_BAND)
        .when(anchored & no_measured, NOTE_NO_MEASURED)
        .when(anchored, F.lit(None))
        .when(F.col("looks_flat") & flat_lost, NOTE_FLAT_LOST)
        .when(F.col("looks_flat"), F.lit(None))
        .otherwise(NOTE_NOTHING)
    )
    layout = (F.when(note.isNotNull(), LAYOUT_UNKNOWN)
              .when(anchored, LAYOUT_STANDARD).otherwise(LAYOUT_FLAT))
    start = _serial_start(F.col("seek_from"))
    return (
        bands.withColumn("layout", layout)
        .withColumn("notes", F.when(note.isNull(), F.array().cast("array<string>"))
                    .otherwise(F.array(note)))
        .withColumn("data_start_row", F.when(F.col("layout") == LAYOUT_STANDARD, start))
        .withColumn("n_data_rows", F.when(F.col("layout") == LAYOUT_STANDARD,
                                          _serial_count(F.col("data_start_row"))))
    )


def labelled_columns(cells: DataFrame, classified: DataFrame) -> DataFrame:
    """One row per labelled column of a flat sheet, with the row of its label."""
    flat = (classified.where(F.col("layout") == LAYOUT_FLAT)
            .select(*SHEET, F.col("flat_header_row").alias("header_row")))
    header = cells.where((F.col("row") <= FLAT_ROWS) & (F.col("col") >= 1)
                         & text_or_null(F.col("raw")).isNotNull())
    return (
        header.select(*SHEET, F.col("row").alias("header_row"), "col")
        .join(broadcast_if_small(flat, classified), [*SHEET, "header_row"])
        .distinct()
    )


def filled_rows(cells: DataFrame) -> DataFrame:
    """The filled rows of every column as bitmaps: one word for 32 rows.

    Words are folded before the shuffle, so that a column of any height moves one small
    row for 32 cells.
    """
    return (
        cells.where((F.col("col") >= 1) & (F.col("raw") != ""))
        .groupBy(*SHEET, "col", F.floor(F.col("row") / WORD).cast("int").alias("word"))
        .agg(F.bit_or(F.call_function(
            "shiftleft", F.lit(1).cast("long"), F.col("row") % WORD)).alias("bits"))
    )


def flat_extents(cells: DataFrame, classified: DataFrame) -> DataFrame:
    """Data start and non-empty row count of flat sheets.

    The bitmaps of the labelled columns, from below the header on, are joined per
    (sheet, column) and united per sheet; rows are bits, and counting them is counting bits.
    """
    flat = classified.where(F.col("layout") == LAYOUT_FLAT).select(*SHEET, "flat_header_row", "max_row")
    few = broadcast_within(flat.select(*SHEET), F.lit(1))
    body = cells if few is None else cells.join(few, SHEET, "left_semi")    # other sheets need no bitmaps
    below = F.col("header_row") - F.col("word") * WORD + 1      # bits of the word that lie above the data
    bits = (F.when(below <= 0, F.col("bits")).when(below >= WORD, F.lit(0).cast("long"))
            .otherwise(F.col("bits").bitwiseAND(
                F.call_function("shiftleft", F.lit(-1).cast("long"), below))))
    lowest = F.col("bits").bitwiseAND(-F.col("bits"))
    rows = (
        filled_rows(body).join(labelled_columns(cells, classified), [*SHEET, "col"])
        .groupBy(*SHEET, "word").agg(F.bit_or(bits).alias("bits"))
        .where("bits != 0")
        .groupBy(*SHEET).agg(
            F.min(F.col("word") * WORD + F.bit_count(lowest - 1)).alias("start"),
            F.sum(F.bit_count("bits")).alias("rows"))
    )
    return flat.join(rows, SHEET, "left").select(
        *SHEET,
        F.coalesce("start", F.greatest(F.col("max_row"), F.col("flat_header_row")) + 1).cast("int").alias("flat_start"),
        F.coalesce("rows", F.lit(0)).cast("bigint").alias("flat_rows"))


def profile_frames(cells: DataFrame, cut=durable) -> DataFrame:
    """Profiles with the working columns (band limits, extent) kept.

    The classification has one row per sheet and three readers, each of which
    would otherwise scan the cells again; ``cut`` stores it once.
    """
    classified = cut(classify(header_bands(cells)))
    extents = flat_extents(cells, classified)
    standard = F.col("layout") == LAYOUT_STANDARD
    flat = F.col("layout") == LAYOUT_FLAT
    joined = classified.join(extents, SHEET, "left")
    header = {
        name: F.when(standard, F.col(name)).alias(name)
        for name in HEADER_FIELDS if name not in ("field_label_row", "data_start_row")
    }
    return joined.select(
        *SHEET, "sheet_pos", "layout",
        *header.values(),
        F.when(standard, F.col("field_label_row")).when(flat, F.col("flat_header_row"))
        .alias("field_label_row"),
        F.when(standard, F.col("data_start_row")).when(flat, F.col("flat_start"))
        .alias("data_start_row"),
        F.when(standard, F.col("n_data_rows")).when(flat, F.col("flat_rows"))
        .otherwise(F.lit(0).cast("bigint")).alias("n_data_rows"),
        "notes",
        F.when(standard, F.col("first_col")).alias("first_col"),
        F.when(standard, F.col("last_col")).alias("last_col"),
        "max_row",
    )


def sheet_profiles(cells: DataFrame, cut=durable) -> DataFrame:
    return profile_frames(cells, cut).select(*PROFILE_COLUMNS)


def sheet_columns(cells: DataFrame, profiles: DataFrame) -> DataFrame:
    """Row-level and measured columns of every profiled sheet.

    ``profiles`` is :func:`profile_frames`.  A skeleton row per band column keeps
    the columns that have no header cell at all.
    """
    wanted = profiles.where(F.col("layout") != LAYOUT_UNKNOWN).select(
        *SHEET, "layout", "field_label_row", "rt_row", "rrt_row", "unit_row",
        "spec_bound_row", "spec_value_row", "internal_spec_row", "first_col", "last_col")
    header = (cells.where((F.col("row") <= HEADER_ROWS) & (F.col("col") >= 1))
              .select(*SHEET, "row", "col", "kind", "num", "raw"))
    values = _band_values()
    names = [name for name, _, _ in values]
    about = ["layout", "first_col", "last_col"]
    # cells of other rows have nothing to tell: column A and the band are in the skeleton
    telling = reduce(lambda a, b: a | b, [
        F.coalesce(F.col("row") == at, F.lit(False)) for at in [F.col("field_label_row"), *[at for _, at, _ in values]]])
    found = header.join(broadcast_if_small(wanted, profiles), SHEET).where(telling).select(
        *SHEET, *about, F.col("col").alias("column_index"),
        F.when(F.col("row") == F.col("field_label_row"), text_or_null(F.col("raw")))
        .alias("label"),
        *[F.when(F.col("row") == at, value).alias(name) for name, at, value in values],
    )
    skeleton = wanted.where(F.col("layout") == LAYOUT_STANDARD).select(
        *SHEET, *about,
        F.explode(F.array_union(F.array(F.lit(1)), F.sequence("first_col", "last_col")))
        .alias("column_index"),
        *[F.lit(None).cast(found.schema[n].dataType).alias(n) for n in ["label", *names]])
    columns = (
        found.unionByName(skeleton)
        .groupBy(*SHEET, "column_index")
        .agg(*[F.max(n).alias(n) for n in [*about, "label", *names]])
    )
    standard = F.col("layout") == LAYOUT_STANDARD
    measured = standard & F.col("column_index").between(F.col("first_col"), F.col("last_col"))
    kind = F.when(measured, "analyte").when(~standard | (F.col("column_index") < F.col("first_col")),
                                            "meta")
    label = F.coalesce(
        "label",
        F.when(measured, F.concat(F.lit("col_"), F.col("column_index").cast("string")))
        .when(standard & (F.col("column_index") == 1), "S.No"))
    only_measured = [F.when(measured, F.col(n)).alias(n) for n in names]
    return (
        columns.select(*SHEET, "column_index", kind.alias("kind"), label.alias("raw_label"),
                       *only_measured)
        .where(F.col("kind").isNotNull() & F.col("raw_label").isNotNull())
        .select(*SHEET_COLUMN_COLUMNS)
    )


def _band_values():
    """(attribute, name of its row, how the cell reads) of a measured column."""
    number = F.when(is_numeric(F.col("kind")), F.col("num")).when(
        F.col("kind") == "s", strict_double(F.col("raw")))
    text = text_or_null(F.col("raw"))
    return [
        ("rt", F.col("rt_row"), number),
        ("rrt", F.col("rrt_row"), number),
        ("unit", F.col("unit_row"), text),
        ("sub_unit", F.col("unit_row") + 1, text),
        ("spec_bound", F.col("spec_bound_row"), text),
        ("spec_value", F.col("spec_value_row"), number),
        ("internal_spec_value", F.col("internal_spec_row"), number),
    ]

"""Schemas of the tables that cross module boundaries."""

from __future__ import annotations

from pyspark.sql import types as T

# A cell as it is carried inside packed rows.
CELL = T.StructType([
    T.StructField("kind", T.StringType()),   # n number, b bool, s text, d date, dt datetime, t time
    T.StructField("num", T.DoubleType()),
    T.StructField("dt", T.TimestampNTZType()),
    T.StructField("tm", T.StringType()),
    T.StructField("raw", T.StringType()),    # text as an auditor would read it
])

# The grid of every sheet of every workbook, one row per non-null cell.  Each
# sheet also has one marker row (row 0, col 0, kind x), so that a sheet without
# any cell still exists.
CELLS = T.StructType([
    T.StructField("workbook", T.StringType()),
    T.StructField("sheet", T.StringType()),
    T.StructField("sheet_pos", T.IntegerType()),
    T.StructField("row", T.IntegerType()),
    T.StructField("col", T.IntegerType()),
    *CELL.fields,
])

CELL_FIELDS = [f.name for f in CELL.fields]
MARKER_KIND = "x"
NUMERIC_KINDS = ("n", "b")

LAYOUT_STANDARD = "quality_standard"
LAYOUT_FLAT = "misc_flat"
LAYOUT_UNKNOWN = "unknown"

HEADER_FIELDS = [
    "process_label_row", "field_label_row", "rt_row", "rrt_row", "unit_row",
    "spec_bound_row", "spec_value_row", "internal_spec_row", "data_start_row",
]

PROFILE_COLUMNS = ["workbook", "sheet", "sheet_pos", "layout", *HEADER_FIELDS,
                   "n_data_rows", "notes"]

SHEET_COLUMN_COLUMNS = [
    "workbook", "sheet", "column_index", "kind", "raw_label", "rt", "rrt", "unit",
    "sub_unit", "spec_bound", "spec_value", "internal_spec_value",
]

# Published column order of the three silver tables (fixed values).
MAPPING_COLUMNS = ["workbook", "sheet", "column_index", "raw_label", "role",
                   "canonical", "confidence", "rationale", "source"]

DQ_COLUMNS = ["workbook", "sheet", "row_seq", "column", "rule",
              "severity", "raw_value", "repaired_value", "note"]

OBSERVATION_COLUMNS = [
    "workbook", "sheet", "row_seq", "sample_date", "sample_time", "report_time",
    "batch_no", "instrument_id", "stage", "sample_form", "appearance",
    "appearance_solution", "analyte", "analyte_canonical", "rt", "rrt",
    "value", "unit", "spec_min", "spec_max", "spec_internal_min",
    "spec_internal_max", "pass", "raw_value", "mapping_confidence",
]

# (workbook, sheet, row_seq, analyte) is not unique in real sheets: serials and
# labels repeat.  The physical address is.
OBSERVATION_KEY = ["row", "column_index"]

FACT_COLUMNS = [c for c in OBSERVATION_COLUMNS
                if c not in ("sample_time", "report_time", "raw_value")]

# Canonical row-level fields with their published types.
META_TYPES = {
    "sample_date": "date",
    "sample_time": "string",
    "report_time": "string",
    "batch_no": "string",
    "instrument_id": "string",
    "stage": "string",
    "sample_form": "string",
    "appearance": "string",
    "appearance_solution": "boolean",
}

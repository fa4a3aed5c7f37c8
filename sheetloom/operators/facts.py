"""Data rows, observations, flat rows and the data-quality log.

The cells are shuffled once, by (workbook, sheet, block of rows), and packed into rows.
Stored in that partitioning, in buckets, they serve every output without moving
again.  A sheet's plan holds what is known of its columns as arrays addressed by the column
itself: each cell of a row finds its column's entry in one step, and the planned columns
that a row lacks come from one set difference, so the time for a row is linear in its
width.  A block bounds what any one task gets, however tall a single sheet is, and a row
holds no more cells than a spreadsheet has columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sheetloom.contracts import (
    CELL_FIELDS, DQ_COLUMNS, LAYOUT_FLAT, LAYOUT_STANDARD, META_TYPES, OBSERVATION_COLUMNS,
    OBSERVATION_KEY,
)
from sheetloom.functions.coerce import (
    META_COERCIONS, Text, audit_text, by_family, clarity_text, coerce_float_cell, coerce_str,
    compose_unit, evaluate_pass, small, spec_limits, with_texts,
)
from sheetloom.functions.text import double_text, quoted
from sheetloom.operators.profile import block_of, is_numeric
from sheetloom.session import broadcast_within, partitions_for

SHEET = ["workbook", "sheet"]
BLOCK = [*SHEET, "block"]
MAX_COLUMNS = 16_384        # columns of a spreadsheet

DUPLICATE_RULE = "duplicate_address"
DUPLICATE_NOTE = "another cell at this address counts"


def sheet_plans(profiles: DataFrame, mapped: DataFrame) -> DataFrame:
    """Everything a data row needs to know about its sheet, one row per sheet.

    ``mapped`` holds one row per mapping, with the column attributes alongside.
    Where a column is mapped twice in one role, the later mapping counts; where
    two columns map to one field, the later column does.

    ``analytes``, ``metas`` and ``labels`` have one entry per column from 1 on (null where
    the column has none); ``measured`` and ``labelled`` list the columns of analytes and
    those that supply a label of flat rows.
    """
    limits = spec_limits(F.col("spec_bound"), F.col("spec_value"), F.col("internal_spec_value"))
    analyte = F.struct(
        F.col("sheet_label").alias("label"), "canonical", "confidence",
        "rt", "rrt", compose_unit(F.col("unit"), F.col("sub_unit")).alias("unit"),
        *[c.alias(n) for n, c in limits.items()])
    meta = F.struct(F.coalesce("raw_label", F.lit("None")).alias("label"), "canonical")
    is_analyte = (F.col("role") == "analyte") & (F.col("kind") == "analyte")
    is_meta = F.col("role") == "meta"
    at = F.col("position")

    mappings = mapped.where("column_index is not null").select(
        *SHEET, "column_index", at, F.when(is_analyte, analyte).alias("analyte"),
        meta.alias("label"), is_meta.alias("is_meta"))
    inside = F.col("column_index").between(1, MAX_COLUMNS)
    width = mappings.groupBy(*SHEET).agg(F.max(F.when(inside, F.col("column_index"))).alias("width"))
    # a row for every column up to the last one, so that places are columns
    every = width.where("width is not null").select(
        *SHEET, F.explode(F.sequence(F.lit(1), "width")).alias("column_index"),
        *[F.lit(None).cast(mappings.schema[n].dataType).alias(n)
          for n in ("position", "analyte", "label", "is_meta")])
    by_column = mappings.unionByName(every).groupBy(*SHEET, "column_index").agg(
        F.max_by("analyte", F.when(F.col("analyte").isNotNull(), at)).alias("analyte"),
        F.max_by("label", F.when(F.col("is_meta"), at)).alias("meta"),
        F.min(F.when(F.col("is_meta"), at)).alias("meta_place"),
        F.max_by("label", at).alias("label"),
        F.min(at).alias("place"))
    same_label = Window.partitionBy(*SHEET, "label.label")
    columns = by_column.withColumn("last_place", F.max("place").over(same_label)).select(
        "*", F.when(F.col("label").isNotNull(), F.struct(
            "label.label", (F.col("place") == F.col("last_place")).alias("counts"))).alias("entry"))
    c = F.col("column_index")

    def dense(name: str) -> Column:
        placed = F.array_sort(F.collect_list(F.when(inside, F.struct(c.alias("c"), F.col(name).alias("e")))))
        return F.transform(placed, lambda p: p["e"])

    by_sheet = columns.groupBy(*SHEET).agg(
        dense("analyte").alias("analytes"), dense("meta").alias("metas"), dense("entry").alias("labels"),
        F.collect_list(F.when(inside & F.col("analyte").isNotNull(), c)).alias("measured"),
        F.collect_list(F.when(inside & F.col("entry.counts"), c)).alias("labelled"),
        *[F.max(F.when(F.col("meta.canonical") == field, F.struct("meta_place", c.alias("c"))))["c"]
          .alias(f"col_{field}") for field in META_TYPES])
    return (
        profiles.where(F.col("layout").isin(LAYOUT_STANDARD, LAYOUT_FLAT))
        .select(*SHEET, "layout", "data_start_row", "max_row").join(by_sheet, SHEET))


def packed_rows(cells: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row per grid row: its cells as an array in no particular order.

    ``partitions`` says over how many the cells are dealt; as many as fit their stored size
    where none is given.

    Of several cells at one address (a file loaded twice) the last in order of its
    fields counts; the others go to ``lost``, which is null in all other rows.
    """
    # A cell is made a struct before it moves, so that collecting it copies bytes.  A number sorts
    # first: rows of a sheet lie together, and texts are compared only for cells of one row.
    number = F.call_function("shiftleft", F.xxhash64(*SHEET), F.lit(24)).bitwiseOR(
        F.col("row").bitwiseAND(F.lit((1 << 24) - 1)).cast("long"))
    blocks = (
        cells.where(F.col("col") >= 1)
        .select(*SHEET, block_of(F.col("row")).alias("block"), "row", F.struct("col", *CELL_FIELDS).alias("cell"))
        .repartition(partitions or partitions_for(cells), *BLOCK)
        .withColumn("number", number)
    )
    rows = blocks.groupBy("number", *BLOCK, "row").agg(F.collect_list("cell").alias("found"))
    single = F.size(F.array_distinct(F.col("found")["col"])) == F.size("found")
    judged = rows.select(*BLOCK, "row", "found", F.when(~single, F.array_sort("found")).alias("sorted"))

    def is_last(cell: Column, i: Column) -> Column:
        return F.coalesce(F.get("sorted", i + 1)["col"] != cell["col"], F.lit(True))

    def beaten(cell: Column) -> Column:
        same = F.filter("sorted", lambda o: o["col"] == cell["col"])
        return F.struct(*[cell[f].alias(f) for f in ("col", *CELL_FIELDS)],
                        F.element_at(same, -1)["raw"].alias("kept"))

    cells_of = F.when(F.col("sorted").isNull(), F.col("found")).otherwise(F.filter("sorted", is_last))
    settled = judged.select(
        *BLOCK, "row", cells_of.alias("cells"),
        F.when(F.col("sorted").isNotNull(), F.transform(
            F.filter("sorted", lambda c, i: ~is_last(c, i)), beaten)).alias("lost"))
    first = F.get("cells", _place_of(F.col("cells")["col"], F.lit(1)))
    serial = F.when(is_numeric(first["kind"]), first["num"])
    # behind an explode, as a filter on the serial would settle the cells a second time
    return settled.select("*", F.explode(F.array(serial)).alias("serial")).select(
        *BLOCK, "row", "serial", "cells", "lost")


def _place_of(columns: Column, column: Column) -> Column:
    """Where a row's cells have a column, from 0, and -1 where they lack it; compiled, as no lambda is."""
    return F.array_position(columns, column).cast("int") - 1


def planned_rows(packed: DataFrame, plans: DataFrame) -> DataFrame:
    """Packed rows of the data area beside their sheet's plan.

    Plans are sent to all tasks if few; many are dealt like the rows, once per block.
    """
    few = broadcast_within(plans, F.size("analytes") + F.size("metas") + F.size("labels") + 1)
    if few is not None:
        joined = packed.join(few.drop("max_row"), SHEET)
    else:
        first, last = block_of(F.col("data_start_row")), block_of(F.col("max_row"))
        dealt = plans.withColumn("block", F.explode(F.sequence(F.least(first, last), last)))
        joined = packed.join(dealt.drop("max_row").hint("shuffle_hash"), BLOCK)
    return joined.where(F.col("row") >= F.col("data_start_row"))


def _entry(entries: str, column: Column) -> Column:
    """What a plan says of a column."""
    return F.get(entries, column - 1)


def _lacking(columns: str) -> Column:
    """Planned columns without a cell in the row."""
    return F.array_except(columns, F.transform("cells", lambda c: c["col"]))


def data_rows(planned: DataFrame) -> DataFrame:
    """Rows of standard sheets with a numeric column A; its integer part numbers
    the row, and may repeat."""
    return (
        planned.where((F.col("layout") == LAYOUT_STANDARD) & F.col("serial").isNotNull())
        .withColumn("row_seq", F.col("serial").try_cast("bigint"))
    )


def _with_meta(rows: DataFrame, *kept: str) -> DataFrame:
    """Coerce the row-level fields, once per row.

    Looking cells up, stripping texts and coercing are separate projections: each
    step is computed once, and none grows too large to be compiled.
    """
    own = F.col("cells")["col"]
    places = F.array(*[F.when(F.col(f"col_{c}").between(1, MAX_COLUMNS), _place_of(own, F.col(f"col_{c}")))
                       for c in META_TYPES])
    placed = rows.withColumn("places", places)
    # a lambda, so that what follows is a method of its own
    looked_up = placed.withColumn("of_row", F.transform("places", lambda i: F.get("cells", i))).select(
        *SHEET, "row", "row_seq", *kept, *[F.get("of_row", F.lit(i)).alias(f"{c}_cell") for i, c in enumerate(META_TYPES)])
    native = F.col("sample_date_cell")["kind"].isin("d", "dt")
    readings = {
        "sample_date": {"date": ~native},
        **{c: {"time": ~F.col(f"{c}_cell")["kind"].isin("t", "dt")}
           for c in ("sample_time", "report_time")},
        "appearance": {"titled": F.lit(True)}}
    texts = with_texts(looked_up, {c: (F.col(f"{c}_cell")["raw"], readings.get(c, {}))
                                   for c in META_TYPES})
    return texts.select(*SHEET, "row", "row_seq", *kept, *[
        META_COERCIONS[c](F.col(f"{c}_cell"), Text.column(F.col(f"{c}_cell")["raw"], c))["value"]
        .alias(c) for c in META_TYPES])


def row_meta(rows: DataFrame) -> DataFrame:
    """Row-level fields of every data row, one column per canonical field."""
    return _with_meta(rows)


def observations(rows: DataFrame) -> DataFrame:
    """One row per data row and measured column, empty cells included."""
    # A row's columns: those of its cells, in their order, then the measured ones that it lacks.
    # Opened as outer, for of an inner one Spark makes a filter that lists them all once more.
    own = F.col("cells")["col"]
    opened = rows.withColumn("columns", F.concat(own, F.array_except("measured", own)))
    read = _with_meta(opened, "cells", "columns", "analytes").select(
        "*", F.posexplode_outer("columns").alias("place", "column_index")).select(
        *SHEET, "row", "row_seq", *META_TYPES, "column_index",
        F.get("cells", F.col("place")).alias("cell"), _entry("analytes", F.col("column_index")).alias("a")
    ).where(F.col("a").isNotNull())
    a, cell = F.col("a"), F.col("cell")
    texts = with_texts(read, {"cell": (F.when(cell["kind"] != "n", cell["raw"]),
                                       {"number": cell["kind"] != "n"})})
    value = coerce_float_cell(cell, Text.column(cell["raw"], "cell"))["value"]
    limits = ("spec_min", "spec_max", "spec_internal_min", "spec_internal_max")
    # A reader's filter on the value or the verdict stays behind an explode; below it, it would
    # spell out all that the value is made of, in a method too large to be compiled.
    valued = texts.select(
        *SHEET, "row_seq",
        *[F.col(c) for c in META_TYPES if c != "appearance_solution"],
        clarity_text(F.col("appearance_solution")).alias("appearance_solution"),
        a["label"].alias("analyte"), a["canonical"].alias("analyte_canonical"),
        a["rt"].alias("rt"), a["rrt"].alias("rrt"), value.alias("made"), a["unit"].alias("unit"),
        *[a[n].alias(n) for n in limits], cell["raw"].alias("raw_value"),
        a["confidence"].alias("mapping_confidence"), "row", "column_index",
    ).select("*", F.explode(F.array("made")).alias("value"))
    return valued.withColumn("pass", evaluate_pass(F.col("value"), F.col("spec_min"), F.col("spec_max"))
    ).select(*OBSERVATION_COLUMNS, *OBSERVATION_KEY)


META, MEASURED, LABEL, LOST = range(4)      # what a logged cell is to its row


def _logged_cells(rows: DataFrame) -> DataFrame:
    """The cells that may fire a rule, a row each, beside their row's address.

    Cells are opened first and find their column's entries afterwards, in compiled code.  A
    non-negative number in a measured column fires nothing and is left out.
    """
    kept = ["layout", "analytes", "metas", "labels"]
    standard = F.col("layout") == LAYOUT_STANDARD
    cell, what = F.col("c"), F.col("what")
    meta, analyte, label = (_entry(plan, cell["col"]) for plan in ("metas", "analytes", "labels"))
    none = F.lit(None).cast("string")

    def logged(name: Column, canonical: Column, kept_text: Column) -> list[Column]:
        return [*SHEET, "row", "row_seq", F.struct(
            what.alias("what"), cell["col"].alias("column_index"), name.alias("label"), canonical.alias("canonical"),
            *[cell[f].alias(f) for f in CELL_FIELDS], kept_text.alias("kept")).alias("cell")]

    opened = rows.select(*SHEET, "row", "row_seq", *kept, F.explode("cells").alias("c")).select(
        "*", F.explode(F.when(standard, F.array(F.lit(META), F.lit(MEASURED)))
                       .otherwise(F.array(F.lit(LABEL)))).alias("what"))
    own = opened.where(
        F.when(what == META, meta.isNotNull())
        .when(what == MEASURED, analyte.isNotNull() & ~((cell["kind"] == "n") & (cell["num"] >= 0)))
        .otherwise(label.isNotNull())).select(*logged(
            F.when(what == META, meta["label"]).when(what == MEASURED, analyte["label"]).otherwise(label["label"]),
            F.when(what == META, meta["canonical"]).when(what == MEASURED, analyte["canonical"]), none))
    lost = rows.where(F.col("lost").isNotNull()).select(
        *SHEET, "row", "row_seq", *kept, F.explode("lost").alias("c"), F.lit(LOST).alias("what"))
    number = F.concat(F.lit("col_"), cell["col"].cast("string"))
    name = F.when(standard, F.coalesce(analyte["label"], meta["canonical"], number)).otherwise(
        F.coalesce(label["label"], number))
    return own.unionByName(lost.select(*logged(name, none, cell["kept"])))


def dq_issues(planned: DataFrame) -> DataFrame:
    """The whole data-quality log, with the physical address of each cell.

    Besides the rules that coercions fire there is one for cells that gave way to another
    at their address, a warning where the texts differ.  The cells of data rows and flat rows
    are opened in one explode, those that gave way in another.
    """
    serial = F.col("serial").try_cast("bigint")
    rows = planned.where((F.col("layout") == LAYOUT_FLAT) | F.col("serial").isNotNull()).withColumn(
        "row_seq", F.when(F.col("layout") == LAYOUT_STANDARD, serial).otherwise(_flat_number()))
    opened = _logged_cells(rows).select(*SHEET, "row", "row_seq", "cell", "cell.column_index")
    cell, canonical = F.col("cell"), F.col("cell.canonical")
    is_meta, is_measured, is_lost = (cell["what"] == w for w in (META, MEASURED, LOST))
    is_date = F.coalesce(is_meta & (canonical == "sample_date"), F.lit(False))
    is_time = F.coalesce(is_meta & canonical.isin("sample_time", "report_time"), F.lit(False))
    # native dates and times fire nothing
    quiet = (is_date & cell["kind"].isin("d", "dt")) | (is_time & cell["kind"].isin("t", "dt"))
    texts = with_texts(opened.where(~quiet), {"cell": (cell["raw"], {
        "number": is_measured & (cell["kind"] != "n"), "date": is_date, "time": is_time,
        "titled": is_meta & (canonical == "appearance")})})
    text = Text.column(cell["raw"], "cell")
    rule = (F.when(is_lost, DUPLICATE_RULE).when(is_measured, coerce_float_cell(cell, text)["rule"])
            .otherwise(by_family(canonical, lambda coercion: coercion(cell, text)["rule"])))
    figure = F.when(is_measured, small(double_text, coerce_float_cell(cell, text)["value"]))
    repaired = (F.when(is_lost, cell["kept"])
                .when(is_measured, F.col("figure"))
                .otherwise(by_family(canonical, lambda coercion: audit_text(coercion(cell, text)["value"], coercion))))
    warns = (F.when(is_lost, ~cell["raw"].eqNullSafe(cell["kept"]))
             .when(is_measured, F.col("rule").isin("negative_value", "non_numeric"))
             .when(is_meta, F.col("rule").startswith("malformed")))
    note = (F.when(is_lost, DUPLICATE_NOTE)
            .when(is_measured, F.concat(F.lit("analyte="), F.coalesce(canonical, F.lit("None"))))
            .when(is_meta, F.concat(F.lit("raw label was "), quoted(cell["label"]))).otherwise(""))
    # A filter on a computed column would be moved below the projections that compute
    # it, repeating all of them in one condition; it stays behind an explode.  The figure's
    # lambda keeps the rules and the repairs from one method too large to be compiled.
    judged = texts.withColumns({"judged": rule, "figure": figure}).withColumn(
        "rule", F.explode(F.array("judged"))).where(F.col("rule").isNotNull())
    return judged.select(
        *SHEET, "row_seq", F.when(is_meta, canonical).otherwise(cell["label"]).alias("column"), "rule",
        F.when(warns, "warning").otherwise("info").alias("severity"), cell["raw"].alias("raw_value"),
        repaired.alias("repaired_value"), note.alias("note"), "row", "column_index")


def _flat_number() -> Column:
    """Number of a flat row, from the first data row on (blank rows count)."""
    return (F.col("row") - F.col("data_start_row") + 1).cast("bigint")


def flat_rows(planned: DataFrame) -> DataFrame:
    """Rows of flat sheets."""
    return planned.where(F.col("layout") == LAYOUT_FLAT).withColumn("row_seq", _flat_number())


def misc_rows(planned: DataFrame) -> DataFrame:
    """Flat rows as maps from label to cleaned text; of two columns with one
    label, the later counts.  Fully blank rows are dropped."""
    rows = flat_rows(planned).where(F.exists("cells", lambda c: F.coalesce(
        (c["raw"] != "") & _entry("labels", c["col"]).isNotNull(), F.lit(False))))

    def field(column: Column, text: Column) -> Column:
        return F.struct(_entry("labels", column)["label"].alias("label"), text.alias("text"))

    present = F.transform(
        F.filter("cells", lambda c: F.coalesce(_entry("labels", c["col"])["counts"], F.lit(False))),
        lambda c: field(c["col"], coerce_str(c["raw"])["value"]))
    absent = F.transform(_lacking("labelled"), lambda k: field(k, F.lit(None).cast("string")))
    return rows.select(*SHEET, "row_seq", F.map_from_entries(F.concat(present, absent)).alias("fields"))


def misc_union(rows: DataFrame) -> DataFrame:
    """Flat rows of all sheets as one table, whatever their labels: ``fields`` is a VARIANT
    object with the row's own labels.  :func:`misc_label_table` lists them all."""
    return rows.select(*SHEET, "row_seq", F.parse_json(
        F.to_json("fields", {"ignoreNullFields": "false"})).alias("fields"))


def misc_label_table(rows: DataFrame) -> DataFrame:
    """``label`` and in how many rows it stands: the header of the union, as a table."""
    return rows.select(F.explode(F.map_keys("fields")).alias("label")).groupBy("label").agg(
        F.count("*").alias("n_rows"))


def field_of(label: str, kind: str = "string") -> Column:
    """A label's value in rows of :func:`misc_union`; null where a row lacks it."""
    for quote in ("'", '"'):
        if quote not in label:
            return F.try_variant_get("fields", f"$[{quote}{label}{quote}]", kind)
    # a path has no escapes
    return F.try_element_at(F.try_variant_get("fields", "$", f"map<string, {kind}>"), F.lit(label))


MAX_LABELS = 16_384         # columns of a spreadsheet, and of the wide form


def misc_labels(columns: DataFrame) -> list[str]:
    """Distinct labels over all flat sheets, sorted: the header of the wide form.

    ``columns`` is the mapping log (or sheet_columns) of the flat sheets.  More than
    ``MAX_LABELS`` are refused: the caller then names the labels of interest.
    """
    labels = [r["raw_label"] for r in columns.select("raw_label").distinct()
              .orderBy("raw_label").limit(MAX_LABELS + 1).collect()]
    if len(labels) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels: give misc_wide a list of those wanted")
    return labels


def wide_names(labels: list[str]) -> list[str]:
    """Column names for labels: a label that differs only by case from a name before it,
    or from a key column, gets ``_2``, ``_3`` and so on."""
    taken, names = {*SHEET, "row_seq"}, []
    for label in labels:
        name, n = label, 1
        while name.lower() in taken:
            n += 1
            name = f"{label}_{n}"
        taken.add(name.lower())
        names.append(name)
    return names


def misc_wide(rows: DataFrame, labels: list[str]) -> DataFrame:
    """Flat rows under one shared header; a label that a row lacks is null."""
    return rows.select(*SHEET, "row_seq", *[F.col("fields")[label].alias(name)
                                            for label, name in zip(labels, wide_names(labels))])


def published_issues(issues: DataFrame) -> DataFrame:
    return issues.select(*DQ_COLUMNS)

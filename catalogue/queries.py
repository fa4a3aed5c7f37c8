"""One query per operator, over the whole given tables or grids derived from them."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from catalogue import stages
from catalogue.grids import cells_table
from sheetloom.contracts import (
    LAYOUT_FLAT, LAYOUT_STANDARD, MAPPING_COLUMNS, OBSERVATION_COLUMNS,
)
from sheetloom.functions import coerce
from sheetloom.functions.text import double_text
from sheetloom.operators import facts, mapping, responses
from sheetloom.operators.profile import header_bands, sheet_columns as columns_of
from sheetloom.plans import gold, jobs, reports
from sheetloom.plans.silver import clean
from sheetloom.sources.canonical import load_names
from sheetloom.sources.folder import grid_preview, workbook_catalog
from sheetloom.session import shared_folder
from sheetloom.sources.tables import CSV, Layout, serialized, write_csv

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(key: str, modulus: int, cases: dict[int, Column], default: Column) -> Column:
    """Dirt by remainder of a key."""
    out = None
    for remainder, value in cases.items():
        hit = F.col(key) % modulus == remainder
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(default)


def _outcome(df: DataFrame, keys: list[str], text: Column, rule, *readings: str) -> DataFrame:
    """``readings`` are what the rule reads a text as; each is computed once per row."""
    staged = coerce.with_texts(df.select(*keys, text.alias("input")),
                               {"t": (F.col("input"), {r: F.lit(True) for r in readings})})
    return (staged.withColumn("r", rule(coerce.Text.column(F.col("input"), "t")))
            .select(*keys, F.col("r.value").alias("value"), F.col("r.rule").alias("rule")))


# --- coercion ---------------------------------------------------------------------

@query
def coerce_str(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    text = _case("doc_id", 13, {
        0: F.lit("NULL"), 1: F.concat(F.lit(" \t"), F.col("text")), 2: F.lit("?"), 3: F.lit(""),
        4: F.concat(F.col("text"), F.lit("\n ")), 5: F.lit(" n/a "), 6: F.lit(None).cast("string"),
        7: F.lit("   "), 8: F.lit("--")}, F.col("text"))
    return _outcome(docs, ["doc_id"], text, coerce.coerce_str)


@query
def coerce_appearance(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    name = F.col("p_name")
    text = _case("p_partkey", 11, {
        0: F.upper(name), 1: F.concat(F.lit(" "), name), 2: F.initcap(name), 3: F.lit("NULL"),
        4: F.lit(""), 5: F.concat(F.lit("off-white McDonald  "), F.col("p_type")),
        6: F.concat(F.initcap(name), F.lit("  "), F.col("p_brand"))}, name)
    return _outcome(parts, ["p_partkey"], text, coerce.coerce_appearance, "titled")


@query
def coerce_pass_fail(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    text = _case("event_id", 17, {
        0: F.lit("OK"), 1: F.lit(" ok "), 2: F.lit("Passed"), 3: F.lit("Out of Spec"),
        4: F.lit("n"), 5: F.lit("NULL"), 6: F.lit(""), 7: F.lit("TRUE"), 8: F.lit("complies"),
        9: F.lit(" OOS"), 10: F.lit("?"), 11: F.lit("No")}, F.col("event_type"))
    return _outcome(events, ["event_id"], text, coerce.coerce_pass_fail)


DATE_TEXTS = {   # remainder of the order key: how its date is written
    0: "yyyy-MM-dd", 1: "yyyy/M/d", 2: "dd/MM/yyyy", 3: "d-M-yyyy", 6: "MMM dd yyyy",
    7: "d MMM yyyy", 8: "MMMM d yyyy", 9: "dd MMMM yyyy", 10: "d-MMM-yyyy", 11: "dd-MMMM-yyyy",
}


@query
def coerce_date(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    at = F.col("o_orderdate")
    cases = {r: F.date_format(at, p) for r, p in DATE_TEXTS.items()}
    cases |= {
        4: F.concat(F.date_format(at, "MM"), F.lit("/28/"), F.date_format(at, "yyyy")),
        5: F.concat(F.date_format(at, "MM"), F.lit("-28-"), F.date_format(at, "yyyy")),
        12: F.lit("NULL"), 13: F.lit(" "), 14: F.lit("31/02/2021"),
        15: F.concat(F.lit("\t"), F.upper(F.date_format(at, "MMM  dd   yyyy"))),
        16: F.date_format(at, "yyyy-MM-dd HH:mm:ss"), 17: F.date_format(at, "dd/MM/yy"),
        18: F.lit("005/03/2021"),
        19: F.concat(F.date_format(at, "MM"), F.lit("/ 5/"), F.date_format(at, "yyyy")),
        20: F.concat(F.date_format(at, "yyyy-MM"), F.lit("- 5")),
        21: F.concat(F.date_format(at, "yyyy/MM"), F.lit("/ 5"))}
    return _outcome(orders, ["o_orderkey"], _case("o_orderkey", 22, cases, F.lit("soon")),
                    coerce.coerce_date, "date")


@query
def coerce_time(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    at = F.col("ts")
    text = _case("event_id", 17, {
        0: F.date_format(at, "HH:mm:ss"), 1: F.date_format(at, "H:m"),
        2: F.date_format(at, "h:mm a"), 3: F.lower(F.date_format(at, "hh:mm:ss  a")),
        4: F.lit("27:00.0"), 5: F.lit("??:??"), 6: F.lit("NULL"), 7: F.lit(""), 8: F.lit("24:00"),
        9: F.lit("0:05 PM"), 10: F.lit("8:05PM"), 11: F.lit(" 7:5:9 "),
        12: F.col("event_type")}, F.date_format(at, "HH:mm"))
    return _outcome(events, ["event_id"], text, coerce.coerce_time, "time")


@query
def coerce_float(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn(
        "k", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    price = double_text(F.col("l_extendedprice"))
    text = _case("k", 23, {
        0: F.concat(F.lit(" "), price), 1: F.concat(price, F.lit("\t")), 2: F.lit("NULL"),
        3: F.lit(""), 4: F.concat(F.lit("-"), price), 5: F.concat(price, F.lit("d")),
        6: F.lit("1_000.5"), 7: F.lit("0x1p3"), 8: F.lit("1e3"), 9: F.lit(".5"), 10: F.lit("5."),
        11: F.concat(F.lit("+"), price), 12: F.col("l_returnflag"), 13: F.lit("1__0"),
        14: F.lit("-"), 15: F.lit("1,5"), 16: F.lit("-0.5e-1")}, price)
    counted = _outcome(lines, ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"], text,
                       coerce.coerce_float, "number")
    return counted


@query
def evaluate_pass(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    value = F.when(F.col("l_linenumber") != 7, F.col("l_quantity"))
    low = F.when(F.col("l_returnflag") != "A", F.col("l_discount") * 200)
    high = F.when(F.col("l_returnflag") != "R", F.lit(20.0) + F.col("l_tax") * 200)
    high = F.when(F.col("l_linestatus") == "F", high)
    return lines.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                        coerce.evaluate_pass(value, low, high).alias("pass"))


@query
def spec_bounds(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    bound = _case("p_partkey", 7, {
        0: F.lit("Min"), 1: F.lit("MIN."), 2: F.lit("Max"), 3: F.lit(None).cast("string"),
        4: F.lit("minimum"), 5: F.lit("NMT")}, F.col("p_type"))
    spec = F.when(F.col("p_size") > 5, F.col("p_retailprice"))
    limits = coerce.spec_limits(bound, spec, F.col("p_retailprice") / 2)
    return parts.select("p_partkey", *[c.alias(n) for n, c in limits.items()])


@query
def compose_unit(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    unit = _case("p_partkey", 5, {0: F.lit(None).cast("string"), 1: F.lit("")}, F.col("p_type"))
    sub = _case("p_partkey", 3, {0: F.lit(None).cast("string"), 1: F.lit("")}, F.col("p_brand"))
    return parts.select("p_partkey", coerce.compose_unit(unit, sub).alias("unit"))


@query
def serialize_values(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    odd = F.col("o_orderkey") % 3 == 1
    return serialized(orders.select(
        "o_orderkey",
        F.when(~odd, F.col("o_orderstatus")).alias("status"),
        F.when(odd, F.col("o_totalprice") > 100000).alias("flag"),
        F.col("o_orderdate").cast("date").alias("day"),
        (F.col("o_totalprice") * 1000).alias("large"),
        F.when(odd, F.col("o_orderkey") / 65536.0).alias("small")))


# --- profiling --------------------------------------------------------------------

def _bands(spark, sf_dir) -> DataFrame:
    return header_bands(cells_table(spark, sf_dir))


@query
def detect_anchors(spark, sf_dir):
    return _bands(spark, sf_dir).select("workbook", "sheet", "rt_row", "rrt_row", "unit_row",
                                        "spec_bound_row", "internal_spec_row")


@query
def detect_field_label_row(spark, sf_dir):
    return _bands(spark, sf_dir).select("workbook", "sheet", "field_label_row")


@query
def detect_process_label_row(spark, sf_dir):
    return _bands(spark, sf_dir).select("workbook", "sheet", "process_label_row")


@query
def detect_analyte_band(spark, sf_dir):
    return _bands(spark, sf_dir).select("workbook", "sheet", "first_col", "last_col")


@query
def looks_like_flat(spark, sf_dir):
    return _bands(spark, sf_dir).select("workbook", "sheet", "looks_flat")


def _profiles(spark, sf_dir) -> DataFrame:
    from sheetloom.operators.profile import sheet_profiles as profiles_of
    return profiles_of(cells_table(spark, sf_dir))


@query
def detect_data_start(spark, sf_dir):
    return (_profiles(spark, sf_dir).where(F.col("layout") == LAYOUT_STANDARD)
            .select("workbook", "sheet", "data_start_row"))


@query
def flat_profiles(spark, sf_dir):
    return (_profiles(spark, sf_dir).where(F.col("layout") == LAYOUT_FLAT)
            .select("workbook", "sheet", "field_label_row", "data_start_row", "n_data_rows"))


@query
def sheet_profiles(spark, sf_dir):
    return _profiles(spark, sf_dir).withColumn("notes", F.array_join("notes", "; "))


@query
def sheet_columns(spark, sf_dir):
    done = stages.sheets(spark, sf_dir)
    return columns_of(cells_table(spark, sf_dir), done.profile_frame).select(
        "workbook", "sheet", "column_index", "kind", "raw_label")


@query
def analyte_columns(spark, sf_dir):
    done = stages.sheets(spark, sf_dir)
    return (columns_of(cells_table(spark, sf_dir), done.profile_frame)
            .where(F.col("kind") == "analyte").drop("kind"))


@query
def bronze_raw_workbooks(spark, sf_dir):
    return workbook_catalog(cells_table(spark, sf_dir)).select(
        "workbook", "sheet_count", F.array_join("sheet_names", "|").alias("sheet_names"))


@query
def grid_preview_top(spark, sf_dir):
    return grid_preview(cells_table(spark, sf_dir))


# --- label mapping ------------------------------------------------------------------

def _labels(spark, sf_dir, cases) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    return parts.select(_case("p_partkey", 9, cases, F.col("p_name")).alias("raw_label")).distinct()


@query
def map_meta_labels(spark, sf_dir):
    labels = _labels(spark, sf_dir, {
        0: F.concat(F.lit("Batch "), F.col("p_brand")), 1: F.lit("Date of  Sampling"),
        2: F.concat(F.lit("Stage "), F.col("p_type"), F.lit(" "), F.col("p_name")),
        3: F.lit("SAMPLE TIME"), 4: F.concat(F.lit("Appearance - "), F.col("p_name")),
        5: F.lit(" Instrument\tID "), 6: F.concat(F.lit("Form "), F.col("p_size").cast("string")),
        7: F.lit("st")})
    return mapping.match_meta(labels)


@query
def map_analyte_labels(spark, sf_dir):
    labels = _labels(spark, sf_dir, {
        0: F.concat(F.lit("Impurity-"), F.col("p_size").cast("string")),
        1: F.concat(F.lit("TFMBA "), F.col("p_type")), 2: F.lit("imp_1"),
        3: F.lit("5-Chloro_TFMBA"), 4: F.concat(F.lit("2-chlorobenzamide "), F.col("p_name")),
        5: F.col("p_brand"), 6: F.lit("im"), 7: F.lit("TFMBA -  acid")})
    return mapping.match_analyte(labels)


SITE_WORDS = ["plant {}", "{} plant", "site {}", "{} site", "lab {}", "{} lab", "{} works", "{} unit", "{}"]


@query
def map_own_aliases(spark, sf_dir):
    """Names of one's own, read from a file: more aliases than are tried one by one."""
    folder = f"{shared_folder(spark)}/names-{uuid.uuid4().hex}"
    nations = table(spark, sf_dir, "nation").orderBy("n_nationkey")
    aliases = F.array(*[F.format_string(w.replace("{}", "%s"), F.lower("n_name")) for w in SITE_WORDS])
    listed = nations.agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name", aliases.alias("a")))).alias("l"))
    listed.select(F.concat(F.lit('{"synonyms": {'), F.array_join(F.transform("l", lambda e: F.concat(
        F.lit('"'), e["n_name"], F.lit('": ["'), F.array_join(e["a"], '", "'), F.lit('"]'))), ", "),
        F.lit("}}"))).coalesce(1).write.text(folder)
    own = load_names(f"{folder}/*.txt", spark)
    sites = table(spark, sf_dir, "supplier").join(
        F.broadcast(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    label = _case("s_suppkey", 8, {
        0: F.concat(F.lit("Plant  "), F.col("n_name")), 1: F.concat(F.col("n_name"), F.lit("\tsite")),
        2: F.concat(F.lit("our "), F.lower("n_name"), F.lit(" lab no. "), F.col("s_suppkey").cast("string")),
        3: F.substring("n_name", 1, 2), 4: F.concat(F.lit("lant "), F.substring("n_name", 1, 3)),
        5: F.lit("elsewhere"), 6: F.concat(F.col("n_name"), F.lit(" works and unit"))}, F.col("s_name"))
    return mapping.match_meta(sites.select(label.alias("raw_label")).distinct(), own)


@query
def slug_fallback(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    label = F.concat(F.lit(" ("), F.col("p_name"), F.lit(") - "), F.col("p_brand"), F.lit("_# "))
    return parts.select("p_partkey", mapping.slug(label).alias("canonical"))


@query
def column_mapping_log(spark, sf_dir):
    done = stages.sheets(spark, sf_dir)
    columns = columns_of(cells_table(spark, sf_dir), done.profile_frame)
    return mapping.mapping_log(mapping.map_columns_deterministic(columns))


@query
def mapping_confidence(spark, sf_dir):
    return reports.mapping_confidence(stages.sheets(spark, sf_dir).mappings)


@query
def lowest_confidence_topk(spark, sf_dir):
    return reports.lowest_confidence(stages.sheets(spark, sf_dir).mappings)


@query
def mapping_review(spark, sf_dir):
    return reports.mapping_review(stages.sheets(spark, sf_dir).mappings)


@query
def mapping_review_digest(spark, sf_dir):
    return reports.mapping_review_digest(stages.sheets(spark, sf_dir).mappings)


@query
def mapping_requests(spark, sf_dir):
    done = stages.sheets(spark, sf_dir)
    return responses.mapping_requests(done.columns, done.profile_frame)


def _replies(done) -> DataFrame:
    """Raw replies for all mapped sheets, good and bad by sheet position."""
    sheets = done.profile_frame.select("workbook", "sheet", "sheet_pos")
    mapped = done.mappings.join(sheets, ["workbook", "sheet"])
    col = F.col("column_index")
    sloppy = F.col("sheet_pos") % 6 == 5

    def field(name: str, text: Column) -> Column:
        return F.concat(F.lit(f'"{name}": '), text)

    def quoted(text: Column) -> Column:
        return F.coalesce(F.concat(F.lit('"'), text, F.lit('"')), F.lit("null"))

    number = col.cast("string")
    parts = [
        F.when(~sloppy | (col % 5 != 0), field("raw", quoted(F.col("raw_label")))),
        field("col", F.when(sloppy & (col % 5 == 1), F.lit('"2.7"'))
              .when(sloppy & (col % 5 == 2), F.concat(F.lit('"'), number, F.lit('"')))
              .when(sloppy & (col % 5 == 4), F.concat(number, F.lit(".9"))).otherwise(number)),
        field("role", F.when(sloppy & (col % 5 == 4), F.lit("null"))
              .otherwise(quoted(F.col("role")))),
        field("canonical", quoted(F.col("canonical"))),
        F.when(~sloppy | (col % 5 != 2), field("confidence", F.when(
            sloppy & (col % 5 == 3), F.lit("null")).otherwise(F.lit("0.75")))),
    ]
    item = F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*parts)), ", "), F.lit("}"))
    lists = mapped.groupBy("workbook", "sheet", "sheet_pos").agg(
        F.array_sort(F.collect_list(F.struct(col, item.alias("item")))).alias("items"))
    listing = F.concat(F.lit("["), F.array_join(F.transform("items", lambda i: i["item"]), ", "),
                       F.lit("]"))
    variant = F.col("sheet_pos") % 6
    return lists.select("workbook", "sheet", (
        F.when(variant == 1, F.concat(F.lit('{"columns": '), listing, F.lit("}")))
        .when(variant == 2, F.concat(F.lit('{"result": '), listing, F.lit("}")))
        .when(variant == 3, F.lit("I could not map these columns."))
        .when(variant == 4, F.lit(None).cast("string")).otherwise(listing)).alias("response"))


@query
def parse_mapping_responses(spark, sf_dir):
    done = stages.sheets(spark, sf_dir)
    return responses.map_columns_by_replies(done.columns, _replies(done)).select(*MAPPING_COLUMNS)


@query
def observations_by_replies(spark, sf_dir):
    """Facts from a model's replies that are kept: even measured columns mapped twice, and
    of the row-level ones the batch only.  The later mapping of a column counts."""
    def respond(requests):
        import json     # in the worker

        replies = []
        for request in requests:
            items = []
            for column in json.loads(request[request.index("Columns: ") + 9:]):
                col, wanted = column["col"], column["col"] % 2 == 0
                if column["kind"] == "analyte" and wanted:
                    items += [{"raw": "?", "col": col, "role": "analyte", "canonical": "early"},
                              {"raw": "?", "col": str(col), "role": "analyte", "canonical": f"M{col}",
                               "confidence": col / 32}]
                elif column["raw"] == "Batch No.":
                    items.append({"raw": "?", "col": col, "role": "meta", "canonical": "batch_no"})
            replies.append(json.dumps({"columns": items}))
        return replies

    done = clean(cells_table(spark, sf_dir), responder=respond,
                 replies=f"{shared_folder(spark)}/replies-{abs(hash(stages.state(spark, sf_dir)))}")
    return done.observations_keyed.select(
        "workbook", "sheet", "row", "column_index", "batch_no", "stage", "analyte", "analyte_canonical", "value",
        "pass", "raw_value", "mapping_confidence")


# --- rows and facts -------------------------------------------------------------------

@query
def data_rows(spark, sf_dir):
    return facts.data_rows(stages.silver(spark, sf_dir).planned).select(
        "workbook", "sheet", "row", "row_seq")


@query
def row_meta(spark, sf_dir):
    return stages.silver(spark, sf_dir).row_meta


@query
def observations_long(spark, sf_dir):
    return stages.silver(spark, sf_dir).observations_keyed


@query
def dq_issues(spark, sf_dir):
    return stages.silver(spark, sf_dir).issues


@query
def export_text(spark, sf_dir):
    """Observations and issues as exported CSV text, read back as texts."""
    observations = stages.observations(spark, sf_dir).select(
        "workbook", "sheet", "row_seq", F.col("analyte").alias("name"), "raw_value",
        F.col("value").alias("number"), F.col("pass").alias("passed"))
    issues = facts.published_issues(stages.issues(spark, sf_dir)).select(
        "workbook", "sheet", "row_seq", F.col("column").alias("name"), "raw_value",
        F.lit(None).cast("double").alias("number"), F.lit(None).cast("boolean").alias("passed"))
    folder = f"{shared_folder(spark)}/export-{uuid.uuid4().hex}"
    write_csv(observations.unionByName(issues), folder)
    texts = spark.read.options(**CSV, multiLine=True).csv(folder)
    return texts.select(*[F.coalesce(c, F.lit("")).alias(c) for c in texts.columns])


@query
def misc_rows(spark, sf_dir):
    entries = F.array_sort(F.map_entries("fields"))
    return stages.silver(spark, sf_dir).misc_rows.select(
        "workbook", "sheet", "row_seq",
        F.array_join(F.transform(entries, lambda e: F.concat(
            e["key"], F.lit("="), F.coalesce(e["value"], F.lit("")))), "; ").alias("fields"))


@query
def misc_wide(spark, sf_dir):
    return stages.silver(spark, sf_dir).misc_wide()


@query
def misc_union_fields(spark, sf_dir):
    """Fields of flat rows, read from the union of all sheets."""
    return stages.silver(spark, sf_dir).misc_union.select(
        "workbook", "sheet", "row_seq", facts.field_of("Row").alias("s_no"), facts.field_of("Run").alias("test_id"),
        facts.field_of("Outcome").alias("result"), facts.field_of("absent").alias("absent"),
        F.size(F.json_object_keys(F.to_json("fields"))).alias("n_labels"))


@query
def misc_label_table(spark, sf_dir):
    return stages.silver(spark, sf_dir).misc_labels


@query
def medallion_tables(spark, sf_dir):
    """Rows of every table and view after a whole run into layers of its own, read by name."""
    layout = Layout(prefix=f"run_{uuid.uuid4().hex[:8]}_")
    jobs.run_silver(cells_table(spark, sf_dir), layout=layout)
    jobs.run_gold(spark, layout=layout)
    names = {"silver": ["sheet_profiles", "column_mapping_log", "unanswered_sheets", "observations_long", "dq_issues",
                        "misc_rows", "quarantine_review"],
             "gold": ["fact_observation", "dim_batch", "dim_analyte", "mv_batch_pass_rate", "mv_impurity_trend",
                      "mv_spec_violations"]}
    counted = [spark.table(layout.name(layer, name)).agg(F.count("*").alias("n")).select(
        F.lit(layer).alias("layer"), F.lit(name).alias("name"), "n") for layer, found in names.items() for name in found]
    return reduce(DataFrame.unionByName, counted)


# --- marts and reports ------------------------------------------------------------------

@query
def quarantine_review(spark, sf_dir):
    return gold.quarantine_review(stages.silver(spark, sf_dir).mappings,
                                  stages.issues(spark, sf_dir))


@query
def dim_batch(spark, sf_dir):
    return gold.dim_batch(stages.observations(spark, sf_dir))


@query
def dim_analyte(spark, sf_dir):
    out = gold.dim_analyte(stages.observations_once(spark, sf_dir))
    return out.withColumns({
        "raw_label_variants": F.array_join("raw_label_variants", "|"),
        "units_seen": F.array_join("units_seen", "|")})


@query
def fact_observation(spark, sf_dir):
    return gold.fact_observation(stages.observations_once(spark, sf_dir))


@query
def mv_batch_pass_rate(spark, sf_dir):
    return gold.mv_batch_pass_rate(stages.observations_once(spark, sf_dir))


@query
def mv_impurity_trend(spark, sf_dir):
    return gold.mv_impurity_trend(stages.observations_once(spark, sf_dir))


@query
def mv_spec_violations(spark, sf_dir):
    return gold.mv_spec_violations(stages.observations_once(spark, sf_dir))


@query
def compliance_summary(spark, sf_dir):
    return gold.compliance_summary(stages.observations_once(spark, sf_dir))


@query
def compliance_three_state(spark, sf_dir):
    return reports.compliance_three_state(stages.observations_once(spark, sf_dir))


@query
def dq_breakdown(spark, sf_dir):
    return reports.dq_breakdown(stages.issues(spark, sf_dir))


@query
def rule_counts(spark, sf_dir):
    return reports.rule_counts(stages.issues(spark, sf_dir))


@query
def dq_warning_sample(spark, sf_dir):
    return reports.dq_warning_sample(stages.issues(spark, sf_dir))


@query
def violations_topk(spark, sf_dir):
    return reports.first_violations(stages.observations_once(spark, sf_dir))


@query
def dashboard_pass_rate(spark, sf_dir):
    return reports.dashboard_pass_rate(gold.mv_batch_pass_rate(stages.observations_once(spark, sf_dir)))


@query
def dashboard_trend(spark, sf_dir):
    return reports.dashboard_trend(gold.mv_impurity_trend(stages.observations_once(spark, sf_dir)))


@query
def dashboard_violations(spark, sf_dir):
    return reports.dashboard_violations(gold.mv_spec_violations(stages.observations_once(spark, sf_dir)))


@query
def per_workbook_summary(spark, sf_dir):
    done = stages.silver(spark, sf_dir)
    return reports.per_workbook_summary(
        done.profile_frame, stages.observations(spark, sf_dir), stages.issues(spark, sf_dir),
        done.mappings)


@query
def export_manifest(spark, sf_dir):
    return reports.export_manifest(
        stages.observations(spark, sf_dir), stages.issues(spark, sf_dir),
        stages.silver(spark, sf_dir).mappings)


@query
def cells_to_pass_rate(spark, sf_dir):
    """Everything from cells to the pass-rate mart in one plan."""
    done = clean(cells_table(spark, sf_dir))
    return gold.mv_batch_pass_rate(gold.fact_observation(
        done.observations_keyed.select(*OBSERVATION_COLUMNS)))

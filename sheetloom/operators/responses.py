"""Mapping by an external model: one request per sheet, one raw reply back."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheetloom.contracts import SHEET_COLUMN_COLUMNS
from sheetloom.functions.text import FLOAT_TEXT, INT_TEXT, strip
from sheetloom.operators.mapping import map_columns_deterministic
from sheetloom.sources.canonical import CanonicalNames, DEFAULT_NAMES
from sheetloom.session import durable

SHEET = ["workbook", "sheet"]
SOURCE_MODEL = "llm"
DEFAULT_CONFIDENCE = 0.5
ATTRIBUTES = SHEET_COLUMN_COLUMNS[5:]

# A batch of request texts in, as many replies out (None where there is none).
Responder = Callable[[Sequence[str]], Sequence[str | None]]


def mapping_requests(columns: DataFrame, profiles: DataFrame,
                     names: CanonicalNames = DEFAULT_NAMES) -> DataFrame:
    """One request text per sheet: the allowed names and its columns as JSON."""
    measured = F.col("kind") == "analyte"
    item = F.when(measured, F.to_json(
        F.struct(F.col("raw_label").alias("raw"), "kind", F.col("column_index").alias("col"),
                 "rt", "rrt", "spec_bound", F.col("spec_value").alias("spec")),
        {"ignoreNullFields": "false"})
    ).otherwise(F.to_json(
        F.struct(F.col("raw_label").alias("raw"), "kind", F.col("column_index").alias("col"))))
    listed = (
        columns.groupBy(*SHEET)
        .agg(F.array_sort(F.collect_list(F.struct(measured.alias("after"), "column_index",
                                                  item.alias("item")))).alias("items"))
        .withColumn("columns_json", F.concat(
            F.lit("["), F.array_join(F.transform("items", lambda i: i["item"]), ", "), F.lit("]")))
    )
    request = F.concat(
        F.lit("Assign a canonical name to every column of this laboratory sheet.\n"),
        F.lit("Sheet: "), F.col("sheet"), F.lit("\nLayout: "), F.col("layout"),
        F.lit("\nNames for columns of kind meta: " + ", ".join(names.synonyms)),
        F.lit("\nNames for columns of kind analyte: " + ", ".join(names.analytes)),
        F.lit("\nUse canonical null and role 'ignored' where no name fits."),
        F.lit("\nAnswer with a JSON list of objects {raw, col, role, canonical, confidence, "
              "rationale}; confidence lies between 0 and 1.\nColumns: "),
        F.col("columns_json"))
    return (
        listed.join(profiles.select(*SHEET, "layout"), SHEET)
        .select(*SHEET, F.size("items").alias("n_columns"), request.alias("request"))
    )


def ask(requests: DataFrame, responder: Responder) -> DataFrame:
    """Run the responder over request batches, where the requests are."""
    def answer(batches):
        for batch in batches:
            replies = list(responder(batch["request"].tolist()))
            yield pd.DataFrame({"workbook": batch["workbook"], "sheet": batch["sheet"],
                                "response": pd.Series(replies, index=batch.index, dtype=object)})

    return requests.select(*SHEET, "request").mapInPandas(
        answer, "workbook string, sheet string, response string")


KEPT = "request_key string, response string, answered_at timestamp"


def request_key(request: Column) -> Column:
    """What a reply is kept under: the request's own text, digested."""
    return F.sha2(request, 256)


def kept_replies(spark: SparkSession, folder: str) -> DataFrame:
    """``request_key, response`` of the table of replies in a folder, one row per request.

    Where two runs asked the same at once, the first reply counts.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "request_key string, response string")
    first = F.min(F.struct("answered_at", "response"))
    return (spark.read.schema(KEPT).parquet(folder).groupBy("request_key").agg(first.alias("first"))
            .select("request_key", "first.response"))


def ask_once(requests: DataFrame, responder: Responder, folder: str, waves: int = 4) -> DataFrame:
    """``workbook, sheet, response``, from the table of replies in ``folder``.

    Only requests whose text has no reply there are asked, each text once however many
    sheets send it; what comes back is added to the table.  They are asked in ``waves``, each
    added when it is done, so that a lost run loses one wave's replies at most, and an
    unchanged sheet costs nothing in a later run.  A request that got no reply is asked
    again next time.
    """
    spark = requests.sparkSession
    keyed = durable(requests.select(*SHEET, "request", request_key(F.col("request")).alias("request_key")))
    new = durable(keyed.select("request_key", "request").dropDuplicates(["request_key"])
                  .join(kept_replies(spark, folder), "request_key", "left_anti"))
    if not new.isEmpty():
        for wave in range(waves):
            part = new.where(F.pmod(F.xxhash64("request_key"), F.lit(waves)) == wave)
            # the key travels in place of a sheet's address
            asked = ask(part.select(F.col("request_key").alias("workbook"), F.lit("").alias("sheet"), "request"),
                        responder)
            (asked.where("response is not null")
             .select(F.col("workbook").alias("request_key"), "response", F.current_timestamp().alias("answered_at"))
             .write.mode("append").parquet(folder))
    return keyed.join(kept_replies(spark, folder), "request_key").select(*SHEET, "response")


def _kind_of(value: Column) -> Column:
    return F.schema_of_variant(value)


def _text_of(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _is_text(value: Column) -> Column:
    return _kind_of(value) == "STRING"


def _whole_number(value: Column) -> Column:
    """int(): numbers lose their fraction, texts must be integers already."""
    text = strip(_text_of(value))
    return (F.when(_is_text(value),
                   F.when(text.rlike(INT_TEXT),
                          F.replace(text, F.lit("_"), F.lit("")).try_cast("int")))
            .otherwise(F.try_variant_get(value, "$", "int")))


def _real_number(value: Column) -> Column:
    text = strip(_text_of(value))
    return (F.when(_is_text(value),
                   F.when(text.rlike(FLOAT_TEXT),
                          F.replace(text, F.lit("_"), F.lit("")).try_cast("double")))
            .otherwise(F.try_variant_get(value, "$", "double")))


def _present(item: Column, key: str) -> Column:
    """Variant under a key: SQL null when the key is absent, variant null when null."""
    return F.try_variant_get(item, f"$.{key}", "variant")


def read_replies(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split raw replies into mappings and the sheets that need the fallback.

    A reply counts as a list, or as an object with a list under ``columns``.  An
    object without that key, or plain text, maps nothing.  Anything else that
    cannot be walked (no reply, invalid JSON, null, a number) falls back.
    """
    parsed = responses.select(*SHEET, F.try_parse_json("response").alias("v"))
    kind = _kind_of(F.col("v"))
    wrapped = _present(F.col("v"), "columns")
    body = F.when(kind.startswith("OBJECT") & wrapped.isNotNull(), wrapped).otherwise(F.col("v"))
    judged = parsed.select(*SHEET, body.alias("body")).withColumn("kind", _kind_of(F.col("body")))
    walkable = (F.col("kind").startswith("ARRAY") | F.col("kind").startswith("OBJECT")
                | (F.col("kind") == "STRING"))
    judged = judged.withColumn("walkable", F.coalesce(walkable, F.lit(False)))
    fallback = judged.where(~F.col("walkable")).select(*SHEET)
    items = (
        judged.where(F.col("walkable") & F.col("kind").startswith("ARRAY"))
        .select(*SHEET, F.posexplode(
            F.try_variant_get("body", "$", "array<variant>")).alias("position", "item"))
        .where(_kind_of(F.col("item")).startswith("OBJECT"))
    )
    item = F.col("item")
    raw, col, role = _present(item, "raw"), _present(item, "col"), _present(item, "role")
    confidence = _present(item, "confidence")
    mapped = items.select(
        *SHEET, "position",
        raw.isNotNull().alias("has_raw"),
        _text_of(raw).alias("raw_label"),
        _whole_number(col).alias("column_index"),
        F.coalesce(F.nullif(_text_of(role), F.lit("")), F.lit("ignored")).alias("role"),
        _text_of(_present(item, "canonical")).alias("canonical"),
        F.when(confidence.isNull(), DEFAULT_CONFIDENCE).otherwise(_real_number(confidence))
        .alias("confidence"),
        F.when(_present(item, "rationale").isNull(), "")
        .otherwise(_text_of(_present(item, "rationale"))).alias("rationale"),
        F.lit(SOURCE_MODEL).alias("source"),
    )
    valid = mapped.where(F.col("has_raw") & F.col("column_index").isNotNull()
                         & F.col("confidence").isNotNull()).drop("has_raw")
    return valid, fallback


def map_columns_by_replies(columns: DataFrame, responses: DataFrame,
                           names: CanonicalNames = DEFAULT_NAMES) -> DataFrame:
    """Mappings from raw replies, with the deterministic mapper as fallback.

    Sheets that sent no reply row at all fall back too.
    """
    valid, fallback = read_replies(responses)
    attributes = columns.select(*SHEET, "column_index", "kind", *ATTRIBUTES,
                                F.col("raw_label").alias("sheet_label"))
    by_model = valid.join(attributes, [*SHEET, "column_index"], "left")
    answered = responses.select(*SHEET).join(fallback, SHEET, "left_anti")
    rest = columns.join(answered, SHEET, "left_anti")
    by_rule = map_columns_deterministic(rest, names).withColumn("sheet_label", F.col("raw_label"))
    return by_model.unionByName(by_rule)


def map_columns(columns: DataFrame, profiles: DataFrame,
                names: CanonicalNames = DEFAULT_NAMES,
                responder: Responder | None = None, cut=durable,
                replies: str | None = None) -> DataFrame:
    """Deterministic mapping, or a model's where a responder is given.

    Setting MOCK_LLM to 1, true or yes ignores the responder.  Replies are stored
    before they are parsed, since asking again could answer differently: in the table of
    replies in the folder ``replies``, which outlives the run (:func:`ask_once`), else
    for this application only.
    """
    mocked = os.environ.get("MOCK_LLM", "").lower() in ("1", "true", "yes")
    if responder is None or mocked:
        return map_columns_deterministic(columns, names).withColumn(
            "sheet_label", F.col("raw_label"))
    requests = mapping_requests(columns, profiles, names)
    answers = cut(ask(requests, responder)) if replies is None else ask_once(requests, responder, replies)
    return map_columns_by_replies(columns, answers, names)

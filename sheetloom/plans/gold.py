"""Star schema and marts over the silver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sheetloom.contracts import FACT_COLUMNS, OBSERVATION_KEY
from sheetloom.operators.mapping import REVIEW_BELOW


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def _rate(scale: float, digits: int) -> Column:
    """Share of passing among decided observations."""
    return F.round(F.avg(F.when(F.col("pass"), scale).when(~F.col("pass"), 0.0)), digits)


def quarantine_review(mappings: DataFrame, issues: DataFrame) -> DataFrame:
    """Uncertain mappings and warning-level issues, for a person to look at."""
    doubtful = mappings.where((F.col("confidence") < REVIEW_BELOW) & (F.col("role") != "ignored"))
    warnings = issues.where(F.col("severity") == "warning")
    return doubtful.select(
        F.lit("mapping_low_confidence").alias("reason"), "workbook", "sheet",
        F.lit(None).cast("bigint").alias("row_seq"), F.col("raw_label").alias("column"),
        F.col("confidence").alias("metric"), F.col("rationale").alias("note"),
    ).unionByName(warnings.select(
        F.lit("dq_warning").alias("reason"), "workbook", "sheet", "row_seq", "column",
        F.lit(None).cast("double").alias("metric"),
        F.concat("rule", F.lit(": "), "note").alias("note")))


def quarantine_sql(mappings: str, issues: str) -> str:
    """``quarantine_review`` as SQL over the stored tables of these names."""
    return f"""
        SELECT 'mapping_low_confidence' AS reason, workbook, sheet, CAST(NULL AS BIGINT) AS row_seq,
               raw_label AS column, confidence AS metric, rationale AS note
        FROM {mappings} WHERE confidence < {REVIEW_BELOW} AND role <> 'ignored'
        UNION ALL
        SELECT 'dq_warning', workbook, sheet, row_seq, column, CAST(NULL AS DOUBLE), concat(rule, ': ', note)
        FROM {issues} WHERE severity = 'warning'"""


def exact_sum(value: Column, times: Column | None = None) -> Column:
    """Sum of doubles that does not depend on their order.

    Numbers below 1e9 are added as decimals of 18 places, those below 1e20 as decimals of
    6; only what is larger yet, or no number, is added as it is.  ``times`` counts how
    often a row's value occurs.
    """
    times = F.lit(1).cast("long") if times is None else times
    size = F.abs(value)
    fine = F.when(size < 1e9, value.cast("decimal(27,18)"))
    coarse = F.when((size >= 1e9) & (size < 1e20), value.cast("decimal(26,6)"))
    rest = F.when(~(size < 1e20), value * times)
    many = times.cast("decimal(11,0)")
    fine_sum, coarse_sum, rest_sum = [F.coalesce(F.sum(p).cast("double"), F.lit(0.0)) for p in (
        (fine * many).cast("decimal(38,18)"), (coarse * many).cast("decimal(38,6)"), rest)]
    return F.when(F.count(value) > 0, fine_sum + coarse_sum + rest_sum)


def exact_avg(value: Column) -> Column:
    """Mean by :func:`exact_sum`, divided once; null without a value."""
    return exact_sum(value) / F.nullif(F.count(value), F.lit(0))


def dim_batch(observations: DataFrame) -> DataFrame:
    """One row per batch on a sheet.

    Stage and instrument come from the batch's first observation in sheet order,
    nulls included, which needs the physical key of ``observations_keyed``: the least
    address is found as a number, and its texts are looked up.
    """
    row, column = OBSERVATION_KEY
    named = observations.where(F.col("batch_no").isNotNull()).select(
        "batch_no", "workbook", "sheet", "sample_date", "stage", "instrument_id",
        (F.col(row).cast("long") * 65_536 + F.col(column)).alias("address"))
    batch = ["batch_no", "workbook", "sheet"]
    spans = named.groupBy(*batch).agg(
        F.min("address").alias("address"), F.min("sample_date").alias("first_seen"),
        F.max("sample_date").alias("last_seen"))
    texts = named.select(*batch, "address", "stage", "instrument_id")
    return spans.join(texts, [*batch, "address"]).select(
        *batch, "stage", "instrument_id", "first_seen", "last_seen")


def dim_analyte(observations: DataFrame) -> DataFrame:
    """One row per canonical analyte with its label variants and averages.

    Equal rows of attributes are counted first (a column's are the same in all its rows),
    so that the sets are collected and the averages are made of few.
    """
    averaged = ["rt", "rrt", "spec_max", "spec_min"]
    per_column = (
        observations.where(F.col("analyte_canonical").isNotNull())
        .groupBy("analyte_canonical", "analyte", "unit", *averaged).agg(F.count("*").alias("n")))
    n = F.col("n")
    return per_column.groupBy("analyte_canonical").agg(
        F.array_sort(F.collect_set("analyte")).alias("raw_label_variants"),
        F.array_sort(F.collect_set("unit")).alias("units_seen"),
        *[(exact_sum(F.col(c), n) / F.nullif(F.sum(F.when(F.col(c).isNotNull(), n)), F.lit(0))).alias(f"avg_{c}")
          for c in averaged])


def fact_observation(observations: DataFrame) -> DataFrame:
    return observations.select(*FACT_COLUMNS)


def mv_batch_pass_rate(facts: DataFrame) -> DataFrame:
    return (
        facts.where(F.col("pass").isNotNull())
        .groupBy("workbook", "sheet", "batch_no")
        .agg(F.count("*").alias("observations"),
             count_if(F.col("pass")).alias("passing"),
             count_if(~F.col("pass")).alias("failing"),
             _rate(1.0, 3).alias("pass_rate"))
    )


def mv_impurity_trend(facts: DataFrame) -> DataFrame:
    return (
        facts.where(F.col("analyte_canonical").isNotNull() & F.col("sample_date").isNotNull())
        .groupBy("analyte_canonical", "sample_date")
        .agg(F.count("*").alias("n_observations"), exact_avg(F.col("value")).alias("avg_value"),
             F.max("value").alias("max_value"), F.min("spec_max").alias("spec_max"))
    )


def mv_spec_violations(facts: DataFrame) -> DataFrame:
    return (
        facts.where(~F.col("pass"))
        .groupBy("analyte_canonical", "workbook", "sheet")
        .agg(F.count("*").alias("violation_count"),
             exact_avg(F.col("value")).alias("avg_violating_value"),
             exact_avg(F.col("value") - F.col("spec_max")).alias("avg_overshoot"))
    )


def compliance_summary(facts: DataFrame) -> DataFrame:
    return facts.agg(
        F.count("*").alias("total_obs"),
        count_if(F.col("pass")).alias("passing"),
        count_if(~F.col("pass")).alias("failing"),
        _rate(100.0, 2).alias("pass_rate_pct"))

"""Dashboard datasets, walkthrough listings and run summaries.

Sorting happens where a report is read, never when a mart is stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sheetloom.operators.mapping import REVIEW_BELOW
from sheetloom.plans.gold import count_if
from sheetloom.sources.tables import export_name

# Ties in the reference order are settled by the rest of the row.
MAPPING_TIES = ["workbook", "sheet", "column_index", "role", "raw_label"]


def dashboard_pass_rate(batch_pass_rate: DataFrame) -> DataFrame:
    return batch_pass_rate.select(
        "batch_no", "sheet", "workbook", "observations", "passing", "failing", "pass_rate"
    ).orderBy("pass_rate", "workbook", "sheet", "batch_no")


def dashboard_trend(impurity_trend: DataFrame) -> DataFrame:
    return impurity_trend.select(
        "analyte_canonical", "sample_date", "avg_value", "max_value", "spec_max"
    ).orderBy("sample_date", "analyte_canonical")


def dashboard_violations(spec_violations: DataFrame) -> DataFrame:
    return spec_violations.select(
        "analyte_canonical", "workbook", "sheet", "violation_count", "avg_overshoot"
    ).orderBy(F.desc("violation_count"), "workbook", "sheet", "analyte_canonical")


def dq_breakdown(issues: DataFrame) -> DataFrame:
    return (issues.groupBy("rule", "severity").agg(F.count("*").alias("issue_count"))
            .orderBy(F.desc("issue_count"), "rule", "severity"))


def rule_counts(issues: DataFrame) -> DataFrame:
    return (issues.groupBy("rule").agg(F.count("*").alias("issue_count"))
            .orderBy(F.desc("issue_count"), "rule"))


def mapping_confidence(mappings: DataFrame) -> DataFrame:
    return (mappings.where(F.col("role") != "ignored")
            .orderBy("confidence", *MAPPING_TIES)
            .select("sheet", "raw_label", "canonical", "role", "confidence", "rationale", "source"))


def lowest_confidence(mappings: DataFrame, limit: int = 30) -> DataFrame:
    return (mappings.orderBy("confidence", *MAPPING_TIES).limit(limit)
            .select("sheet", "raw_label", "role", "canonical", "confidence", "rationale", "source"))


def dq_warning_sample(issues: DataFrame, limit: int = 20) -> DataFrame:
    return (issues.where(F.col("severity") == "warning")
            .orderBy("workbook", "sheet", "row_seq", "column", "rule", "raw_value", "note")
            .limit(limit)
            .select("sheet", "row_seq", "column", "rule", "raw_value", "repaired_value", "note"))


def first_violations(facts: DataFrame, limit: int = 20) -> DataFrame:
    return (facts.where(~F.col("pass"))
            .orderBy("workbook", "sheet", "batch_no", "row_seq", "analyte_canonical", "analyte",
                     "value")
            .limit(limit)
            .select("batch_no", "sheet", "analyte_canonical", "value", "spec_max", "pass"))


def compliance_three_state(observations: DataFrame) -> DataFrame:
    """Shares of all observations, the undecided included."""
    total = F.greatest(F.count("*"), F.lit(1))

    def states(name: str, n):
        return [n.alias(f"{name}_count"), F.round(n * 100.0 / total, 1).alias(f"{name}_pct")]

    return observations.agg(
        *states("pass", count_if(F.col("pass"))),
        *states("fail", count_if(~F.col("pass"))),
        *states("na", count_if(F.col("pass").isNull())))


def mapping_review(mappings: DataFrame) -> DataFrame:
    """Mappings below the review threshold, most urgent first."""
    return (
        mappings.where((F.col("confidence") < REVIEW_BELOW) & (F.col("role") != "ignored"))
        .select("sheet", "raw_label", "canonical", "confidence", "workbook", "column_index", "role")
        .orderBy("confidence", *MAPPING_TIES)
    )


def mapping_review_digest(mappings: DataFrame, shown: int = 5) -> DataFrame:
    """How many mappings need review, beside the first few in sheet order."""
    flagged = mapping_review(mappings)
    total = flagged.agg(F.count("*"))
    return (flagged.orderBy("workbook", "sheet", "column_index").limit(shown)
            .select("sheet", "raw_label", "canonical", "confidence",
                    total.scalar().alias("flagged")))


def unanswered_sheets(profiles: DataFrame, mappings: DataFrame) -> DataFrame:
    """Profiled sheets without a single mapping: a model's reply that named no
    column leaves such a sheet without facts."""
    return (profiles.where(F.col("layout") != "unknown").select("workbook", "sheet")
            .join(mappings.select("workbook", "sheet").distinct(), ["workbook", "sheet"],
                  "left_anti"))


def _per_workbook(frames: dict[str, DataFrame]) -> DataFrame:
    """Row counts of several tables side by side, one row per workbook.

    Each table is folded to its counts before the counts are put together.
    """
    counts = None
    for name, frame in frames.items():
        part = frame.groupBy("workbook").agg(F.count("*").alias("n")).select(
            "workbook", *[(F.col("n") if other == name else F.lit(0)).cast("bigint").alias(other)
                          for other in frames])
        counts = part if counts is None else counts.unionByName(part)
    return counts.groupBy("workbook").agg(*[F.sum(n).alias(n) for n in frames])


def per_workbook_summary(workbooks: DataFrame, observations: DataFrame, issues: DataFrame,
                         mappings: DataFrame) -> DataFrame:
    """Counts per processed workbook, zero where a table has no row of it.

    ``workbooks`` holds a row per sheet of every workbook processed.
    """
    counted = _per_workbook({"sheets": workbooks, "observations": observations,
                             "dq_issues": issues, "mappings": mappings})
    return counted.drop("sheets")


def export_manifest(observations: DataFrame, issues: DataFrame, mappings: DataFrame) -> DataFrame:
    """What an export holds: one entry per workbook that has observations."""
    counted = _per_workbook({"observations": observations, "dq_issues": issues,
                             "mappings": mappings})
    return counted.where(F.col("observations") > 0).select(
        "workbook",
        export_name(F.col("workbook")).alias("export_name"),
        "observations", "dq_issues", "mappings")

"""Canonical names and their aliases.

The order of names and aliases is part of the data: ties between equally good
matches go to the earlier alias.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Published canonical fields with their aliases.
SYNONYMS = {
    "sample_date": ["date of sampling", "sampling date", "date sampled", "samp date"],
    "sample_time": ["time of sampling", "sample time", "samp time"],
    "report_time": ["time of reporting", "report time", "reported at"],
    "batch_no": ["batch no", "batch no.", "batch number", "batch #", "batch"],
    "instrument_id": ["instrument id", "instrument", "instr id", "hplc id"],
    "stage": ["stage", "process stage", "step"],
    "sample_form": ["sample characteristic", "sample characteristics", "sample form", "form"],
    "appearance": ["appearance"],
    "appearance_solution": ["appearance of 30% solution in methanol", "30% solution clarity",
                            "methanol clarity"],
}
# Known analytes with their aliases.
ANALYTES = {
    "Impurity_1": ["impurity-1", "impurity 1", "imp-1", "imp 1"],
    "Impurity_2": ["impurity-2", "impurity 2", "imp-2"],
    "Impurity_generic": ["impurity"],
    "TFMBA": ["tfmba"],
    "TFMBA_Acid": ["tfmba acid", "tfmba-acid"],
    "Chloro_Benzamide_2": ["2-chloro benzamide", "2 chloro benzamide", "2-chlorobenzamide"],
    "Chloro_TFMBA_5": ["5-chloro tfmba", "5 chloro tfmba", "5-chlorotfmba"],
}


@dataclass(frozen=True)
class CanonicalNames:
    """Ordered alias dictionaries for row-level fields and for analytes."""

    synonyms: dict[str, list[str]]
    analytes: dict[str, list[str]]

    @staticmethod
    def flatten(names: dict[str, list[str]]) -> list[tuple[str, str, int]]:
        pairs = [(canonical, alias) for canonical, aliases in names.items() for alias in aliases]
        return [(canonical, alias, ord_) for ord_, (canonical, alias) in enumerate(pairs)]

    @classmethod
    def frame(cls, spark: SparkSession, names: dict[str, list[str]]) -> DataFrame:
        """A dictionary as (canonical, alias, ord) rows."""
        return spark.createDataFrame(cls.flatten(names), "canonical string, alias string, ord int")


DEFAULT_NAMES = CanonicalNames(SYNONYMS, ANALYTES)


def load_names(path: str | Path, spark: SparkSession | None = None) -> CanonicalNames:
    """Read ``synonyms`` and ``analytes`` from a YAML or JSON schema file.

    With a session the path may lie in any store that Spark reads.  JSON needs no YAML
    package; a YAML file without one is refused by name.
    """
    if spark is None:
        text = Path(path).read_text(encoding="utf-8")
    else:
        text = spark.read.text(str(path), wholetext=True).first()["value"]
    try:
        tree = json.loads(text)
    except ValueError:
        try:
            import yaml
        except ImportError:
            raise ValueError(f"{path} is no JSON, and PyYAML is not installed") from None
        tree = yaml.safe_load(text)
    return CanonicalNames(tree.get("synonyms") or {}, tree.get("analytes") or {})

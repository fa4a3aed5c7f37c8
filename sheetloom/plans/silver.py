"""Cells in, cleaned tables out: the whole silver step as one set of DataFrames."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from sheetloom.contracts import LAYOUT_FLAT, OBSERVATION_COLUMNS, PROFILE_COLUMNS
from sheetloom.operators import facts
from sheetloom.operators.mapping import mapping_log
from sheetloom.operators.profile import profile_frames, sheet_columns
from sheetloom.operators.responses import Responder, map_columns
from sheetloom.session import broadcast_within, durable, durable_in_buckets, partitions_for
from sheetloom.sources.canonical import CanonicalNames, DEFAULT_NAMES


@dataclass
class SilverTables:
    """Results over all workbooks.  ``frames`` keep working columns.

    Each output packs the cells it reads, unless :meth:`keep_rows` has stored them once.
    """

    profile_frame: DataFrame
    columns: DataFrame
    mapped: DataFrame
    plans: DataFrame
    cells: DataFrame
    rows: DataFrame | None = None

    @property
    def packed(self) -> DataFrame:
        """Packed rows; cells of sheets without a plan go first where the plans are few."""
        few = broadcast_within(self.plans.select(*facts.SHEET), F.lit(1))
        return facts.packed_rows(
            self.cells if few is None else self.cells.join(few, facts.SHEET, "left_semi"),
            partitions_for(self.cells))

    def keep_rows(self) -> SilverTables:
        """Store the packed rows in buckets, which every output reads without moving them."""
        return replace(self, rows=durable_in_buckets(
            self.packed, *facts.BLOCK, buckets=partitions_for(self.cells)))

    @cached_property
    def planned(self) -> DataFrame:
        return facts.planned_rows(self.packed if self.rows is None else self.rows, self.plans)

    @property
    def profiles(self) -> DataFrame:
        return self.profile_frame.select(*PROFILE_COLUMNS)

    @property
    def mappings(self) -> DataFrame:
        return mapping_log(self.mapped)

    @property
    def row_meta(self) -> DataFrame:
        return facts.row_meta(facts.data_rows(self.planned))

    @property
    def observations_keyed(self) -> DataFrame:
        """Observations with the physical row and column as key."""
        return facts.observations(facts.data_rows(self.planned))

    @property
    def observations(self) -> DataFrame:
        return self.observations_keyed.select(*OBSERVATION_COLUMNS)

    @property
    def issues_keyed(self) -> DataFrame:
        return facts.dq_issues(self.planned)

    @property
    def issues(self) -> DataFrame:
        return facts.published_issues(self.issues_keyed)

    @property
    def misc_rows(self) -> DataFrame:
        return facts.misc_rows(self.planned)

    @property
    def misc_union(self) -> DataFrame:
        """Flat rows of all sheets with their own labels, as VARIANT objects."""
        return facts.misc_union(self.misc_rows)

    @property
    def misc_labels(self) -> DataFrame:
        return facts.misc_label_table(self.misc_rows)

    def misc_wide(self, labels: list[str] | None = None) -> DataFrame:
        """Flat rows as columns: those of ``labels``, or all (bounded) labels there are."""
        if labels is not None:
            return facts.misc_wide(self.misc_rows, labels)
        flat = self.profile_frame.where(F.col("layout") == LAYOUT_FLAT).select("workbook", "sheet")
        labels = facts.misc_labels(self.mapped.join(flat, ["workbook", "sheet"], "left_semi"))
        return facts.misc_wide(self.misc_rows, labels)


def clean(cells: DataFrame, *, names: CanonicalNames = DEFAULT_NAMES,
          responder: Responder | None = None, replies: str | None = None,
          cut=durable) -> SilverTables:
    """Profile, map and plan every sheet, and bind the rows to the plans.

    A responder's replies are kept in the folder ``replies``, where one is named, for
    later runs too.  The sheet-level results are small beside the cells and have many readers;
    ``cut`` stores them once (``lambda df: df`` keeps everything lazy).
    """
    profiles = cut(profile_frames(cells, cut))
    columns = sheet_columns(cells, profiles)
    mapped = cut(map_columns(columns, profiles, names, responder, cut, replies))
    plans = cut(facts.sheet_plans(profiles, mapped))
    return SilverTables(profiles, columns, mapped, plans, cells)

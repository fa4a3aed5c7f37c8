"""Workbook cleaning as Spark jobs.

Spreadsheets enter as one long DataFrame of cells; layout detection, label
mapping, value coercion, reshaping, quality logging and reporting are DataFrame
operators over it.  See README.md for the tour.
"""

from sheetloom.plans.silver import SilverTables, clean

__all__ = ["SilverTables", "clean"]

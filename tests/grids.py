"""Hand-written grids and workbook files."""

from __future__ import annotations

import io
import zipfile
from datetime import datetime, time

from sheetloom.contracts import CELLS

META_LABELS = {
    1: "Entry", 2: "Date of Sampling", 3: "Time of sampling", 4: "Time of Reporting",
    5: "Batch No.", 6: "Instrument ID", 7: "Stage", 8: "Sample Characteristic",
    10: "Appearance", 11: "Appearance of 30% solution in methanol (read next day)",
}


def cell(value) -> tuple:
    if isinstance(value, bool):
        return ("b", float(value), None, None, str(value))
    if isinstance(value, (int, float)):
        return ("n", float(value), None, None, str(value))
    if isinstance(value, datetime):
        return ("dt", None, value, None, str(value))
    if isinstance(value, time):
        return ("t", None, None, str(value), str(value))
    return ("s", None, None, None, value)


def cells_frame(spark, sheets: dict[tuple[str, str], dict[tuple[int, int], object]]):
    """{(workbook, sheet): {(row, col): value}} as a cells DataFrame."""
    rows, positions = [], {}
    for (workbook, sheet), grid in sheets.items():
        positions[workbook] = positions.get(workbook, 0) + 1
        address = (workbook, sheet, positions[workbook])
        rows.append((*address, 0, 0, "x", None, None, None, None))
        rows += [(*address, r, c, *cell(v)) for (r, c), v in grid.items() if v is not None]
    return spark.createDataFrame(rows, CELLS)


def standard_sheet(labels, data_rows, bounds=None) -> dict:
    """Header band of the standard layout plus data rows given as {column: value}."""
    bounds = bounds or {}
    grid = {(3, 1): "Inprocess sheet", (3, 10): "Analysis", (5, 1): "RT", (6, 1): "RRT",
            (7, 1): "Unit", (7, 11): "long description", (9, 1): "Specification",
            (9, 11): "0.0000", (11, 1): "Internal SRF Specification"}
    grid |= {(4, c): label for c, label in META_LABELS.items()}
    for i, label in enumerate(labels):
        bound, spec, internal = bounds.get(label, ("Max", 0.1, 0.08))
        c = 12 + i
        grid |= {(4, c): label, (5, c): 1.0 + i, (6, c): 0.5 + i, (7, c): "%", (8, c): "w/w",
                 (9, c): bound, (10, c): spec, (11, c): internal}
    for i, row in enumerate(data_rows):
        grid |= {(13 + i, c): v for c, v in row.items()}
    return grid


def _xml(body: str) -> bytes:
    return f'<?xml version="1.0" encoding="UTF-8"?>{body}'.encode()


MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def workbook_bytes(sheets: dict[str, str], strings=(), extra_formats="", styles="") -> bytes:
    """A minimal workbook file; ``sheets`` holds the sheetData content per sheet."""
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        listed = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>'
                         for i, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", _xml(f"<workbook {MAIN} {REL}><sheets>{listed}</sheets></workbook>"))
        links = "".join(f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>'
                        for i in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", _xml(f"<Relationships>{links}</Relationships>"))
        items = "".join(f"<si>{s}</si>" for s in strings)
        z.writestr("xl/sharedStrings.xml", _xml(f"<sst {MAIN}>{items}</sst>"))
        z.writestr("xl/styles.xml", _xml(
            f"<styleSheet {MAIN}><numFmts>{extra_formats}</numFmts><cellXfs>{styles}</cellXfs></styleSheet>"))
        for i, data in enumerate(sheets.values(), 1):
            z.writestr(f"xl/worksheets/sheet{i}.xml",
                       _xml(f"<worksheet {MAIN}><sheetData>{data}</sheetData></worksheet>"))
    return buffer.getvalue()

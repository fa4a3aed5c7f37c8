"""Workbook files → cells.

Spark lists the files, splits them over tasks and owns the output; inside a task
one workbook at a time is read as a stream of cells, batch by batch.  Formula
cells give their stored value.
"""

from __future__ import annotations

import io
import posixpath
import re
import sys
import zipfile
from collections.abc import Iterator
from datetime import datetime, time, timedelta
from urllib.parse import quote, unquote, urlparse
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from sheetloom.contracts import CELLS, MARKER_KIND
from sheetloom.sources.folder import list_files

# The decoder travels with the task: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BATCH = 50_000
COLUMNS = [f.name for f in CELLS.fields]

# Built-in number formats of the file format that show a date or
# time, and those that show a duration.
DATE_FORMAT_IDS = {*range(14, 23), *range(27, 37), 45, 47, *range(50, 59)}
DURATION_FORMAT_IDS = {46}
EPOCH_1900, EPOCH_1904 = datetime(1899, 12, 30), datetime(1904, 1, 1)

_LITERALS = re.compile(r'"[^"]*"|\\.|_.|\[(?!(?:hh?|mm?|ss?)\])[^\]]*\]', re.IGNORECASE)
_DURATION = re.compile(r"\[(hh?|mm?|ss?)\]", re.IGNORECASE)
_DATE_TOKEN = re.compile(r"[dmhys]", re.IGNORECASE)
_CELL_REF = re.compile(r"([A-Z]+)(\d+)")


def read_workbooks(spark: SparkSession, folder: str) -> DataFrame:
    """Cells of every ``.xlsx`` file directly in a folder.

    Spark's file readers hide names that start with an underscore; those workbooks are
    opened by their path in the tasks.
    """
    def cells_of(path: str, content: bytes) -> Iterator[pd.DataFrame]:
        name = unquote(posixpath.basename(urlparse(path).path))
        pending = []
        for cell in workbook_cells(name, content):
            pending.append(cell)
            if len(pending) >= BATCH:
                yield _frame(pending)
                pending = []
        yield _frame(pending)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                yield from cells_of(path, content)

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            for path in batch["path"]:
                uri = quote(path, safe="/:")
                if "://" not in uri:                # Hadoop writes local paths as file:/...
                    uri = uri.replace(":/", ":///", 1)
                store, place = fs.FileSystem.from_uri(uri)
                with store.open_input_stream(place, compression=None) as stream:
                    yield from cells_of(uri, stream.read())

    files = (spark.read.format("binaryFile").option("pathGlobFilter", "[!.]*.[xX][lL][sS][xX]")
             .load(folder).select("path", "content"))
    cells = files.mapInPandas(decode, CELLS)
    hidden = list_files(spark, folder, ".xlsx").where("startswith(name, '_')").select("path")
    return cells if hidden.isEmpty() else cells.union(hidden.mapInPandas(fetch, CELLS))


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=COLUMNS)
    frame["dt"] = pd.to_datetime(frame["dt"]).astype("datetime64[us]")
    frame["num"] = frame["num"].astype("float64")
    return frame


def workbook_cells(name: str, content: bytes) -> Iterator[tuple]:
    """Tuples in the order of the cells schema; a marker opens each sheet."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        present = set(archive.namelist())
        strings = _shared_strings(archive) if "xl/sharedStrings.xml" in present else []
        formats = _style_kinds(archive) if "xl/styles.xml" in present else []
        epoch, sheets = _sheets(archive)
        for position, (title, part) in enumerate(sheets, 1):
            address = (name, title, position)
            yield (*address, 0, 0, MARKER_KIND, None, None, None, None)
            if part in present:
                for row, col, kind, value in _sheet_values(archive, part, strings, formats, epoch):
                    yield (*address, row, col, *_typed(kind, value))


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _tree(archive: zipfile.ZipFile, part: str) -> ElementTree.Element:
    return ElementTree.fromstring(archive.read(part))


def _children(node, name: str):
    return [e for e in node.iter() if _local(e.tag) == name]


def _plain_text(node) -> str:
    """Text of a string item: its runs joined, phonetic hints left out."""
    parts = []
    for child in node:
        tag = _local(child.tag)
        if tag == "t":
            parts.append(child.text or "")
        elif tag == "r":
            parts.extend(t.text or "" for t in child if _local(t.tag) == "t")
    return "".join(parts)


def _shared_strings(archive: zipfile.ZipFile) -> list[str]:
    found = []
    with archive.open("xl/sharedStrings.xml") as stream:
        for _, node in ElementTree.iterparse(stream):
            if _local(node.tag) == "si":
                found.append(_plain_text(node))
                node.clear()
    return found


def _style_kinds(archive: zipfile.ZipFile) -> list[str]:
    """What each cell style shows a number as: n number, d date or time, u duration."""
    tree = _tree(archive, "xl/styles.xml")
    custom = {int(f.get("numFmtId")): f.get("formatCode", "") for f in _children(tree, "numFmt")}

    def kind(format_id: int) -> str:
        if format_id in custom:
            code = _LITERALS.sub("", custom[format_id].split(";")[0])
            if _DURATION.search(code):
                return "u"
            return "d" if _DATE_TOKEN.search(code) else "n"
        if format_id in DURATION_FORMAT_IDS:
            return "u"
        return "d" if format_id in DATE_FORMAT_IDS else "n"

    styles = next((e for e in tree if _local(e.tag) == "cellXfs"), [])
    return [kind(int(xf.get("numFmtId", 0))) for xf in styles]


def _sheets(archive: zipfile.ZipFile) -> tuple[datetime, list[tuple[str, str]]]:
    tree = _tree(archive, "xl/workbook.xml")
    targets = {r.get("Id"): r.get("Target") for r in _tree(archive, "xl/_rels/workbook.xml.rels")}
    late = any(p.get("date1904") in ("1", "true") for p in _children(tree, "workbookPr"))
    sheets = []
    for sheet in _children(tree, "sheet"):
        link = next(v for k, v in sheet.attrib.items() if _local(k) == "id")
        sheets.append((sheet.get("name"), posixpath.normpath(
            posixpath.join("/xl", targets[link])).lstrip("/")))
    return (EPOCH_1904 if late else EPOCH_1900), sheets


def _column_number(letters: str) -> int:
    number = 0
    for letter in letters:
        number = number * 26 + ord(letter) - 64
    return number


def _sheet_values(archive, part, strings, formats, epoch):
    """(row, column, type tag, Python value) of the non-empty cells of a sheet."""
    row = col = 0
    with archive.open(part) as stream:
        for event, node in ElementTree.iterparse(stream, events=("start", "end")):
            tag = _local(node.tag)
            if event == "start":
                if tag == "row":
                    row, col = int(node.get("r", row + 1)), 0
                continue
            if tag == "c":
                ref = _CELL_REF.fullmatch(node.get("r", ""))
                col = _column_number(ref.group(1)) if ref else col + 1
                kind, value = _cell_value(node, strings, formats, epoch)
                if value is not None:
                    yield row, col, kind, value
            if tag == "row":
                node.clear()


def _cell_value(node, strings, formats, epoch):
    kind = node.get("t", "n")
    if kind == "inlineStr":
        inline = next((e for e in node if _local(e.tag) == "is"), None)
        return "s", None if inline is None else _plain_text(inline)
    text = next((e.text for e in node if _local(e.tag) == "v"), None)
    if text is None:
        return kind, None
    if kind == "s":
        return "s", strings[int(text)]
    if kind == "b":
        return "b", text.strip() in ("1", "true")
    if kind == "d":
        return "d", datetime.fromisoformat(text)
    if kind == "n":
        number = float(text) if re.search(r"[.eE]", text) else int(text)
        style = int(node.get("s", 0))
        shown = formats[style] if style < len(formats) else "n"
        if shown == "u":
            return "u", timedelta(days=number)
        return ("n", number) if shown == "n" else ("d", _moment(number, epoch))
    return "s", text


def _moment(serial: float, epoch: datetime) -> datetime | time:
    """Date of a serial number, or a time of day for serials below one."""
    days, fraction = divmod(serial, 1)
    clock = timedelta(milliseconds=round(fraction * 86_400_000))
    if 0 <= serial < 1 and clock.days == 0:
        return (datetime.min + clock).time()
    if 0 < serial < 60 and epoch == EPOCH_1900:
        days += 1       # the format counts a 29 February 1900
    return epoch + timedelta(days=days) + clock


def _typed(kind: str, value) -> tuple:
    """(kind, num, dt, tm, raw) of a value."""
    if kind == "b":
        return ("b", float(value), None, None, str(value))
    if kind == "n":
        return ("n", float(value), None, None, str(value))
    if isinstance(value, time):
        return ("t", None, None, str(value), str(value))
    if isinstance(value, datetime):
        return ("dt", None, value, None, str(value))
    return ("s", None, None, None, str(value))

"""Cells of .xlsx workbooks with the standard library: a workbook is a zip of XML parts."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_DATE = re.compile(r"[ymdhs]", re.I)
#: Number formats that are dates or times without saying so in the workbook.
_DATE_FORMATS = {*range(14, 23), *range(45, 48)}


def _text(node: ElementTree.Element) -> str:
    return "".join(t.text or "" for t in node.iter(f"{{{_NS['m']}}}t"))


def _column(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", ref).group():
        n = n * 26 + ord(c) - 64
    return n - 1


def _moment(serial: float) -> str:
    at = datetime(1899, 12, 30) + timedelta(seconds=round(serial * 86400))
    return at.strftime("%Y-%m-%d %H:%M:%S")


def rows(content: bytes) -> Iterator[tuple[str, int, list[object]]]:
    """(sheet, row number, cells) of all sheets in the workbook's order. Dates come out as text, empty cells as None."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        part = lambda p: ElementTree.fromstring(z.read(p))
        shared = [_text(si) for si in part("xl/sharedStrings.xml").findall("m:si", _NS)] if "xl/sharedStrings.xml" in names else []
        dates: list[bool] = []
        if "xl/styles.xml" in names:
            styles = part("xl/styles.xml")
            custom = {int(f.get("numFmtId")): f.get("formatCode", "") for f in styles.iter(f"{{{_NS['m']}}}numFmt")}
            for xf in styles.findall("m:cellXfs/m:xf", _NS):
                k = int(xf.get("numFmtId", 0))
                plain = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", custom.get(k, ""))
                dates.append(k in _DATE_FORMATS or bool(_DATE.search(plain)))
        targets = {r.get("Id"): r.get("Target") for r in part("xl/_rels/workbook.xml.rels")}
        for sheet in part("xl/workbook.xml").findall("m:sheets/m:sheet", _NS):
            target = targets[sheet.get(_REL)].lstrip("/")
            data = part(target if target.startswith("xl/") else f"xl/{target}").find("m:sheetData", _NS)
            for k, row in enumerate(data if data is not None else (), 1):
                cells: list[object] = []
                for c in row.findall("m:c", _NS):
                    at = _column(c.get("r")) if c.get("r") else len(cells)
                    cells += [None] * (at + 1 - len(cells))
                    kind, v = c.get("t"), c.find("m:v", _NS)
                    if kind == "inlineStr":
                        cells[at] = _text(c)
                    elif v is None or v.text is None:
                        continue
                    elif kind == "s":
                        cells[at] = shared[int(v.text)]
                    elif kind == "b":
                        cells[at] = v.text == "1"
                    elif kind in ("str", "e", "d"):
                        cells[at] = v.text
                    else:
                        number = float(v.text)
                        style = int(c.get("s", 0))
                        cells[at] = _moment(number) if style < len(dates) and dates[style] else int(number) if number.is_integer() else number
                yield sheet.get("name"), int(row.get("r", k)), cells

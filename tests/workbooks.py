"""The books of an apiary, for tests.

A Book holds sheets as rows of Python values: str is text, int and float are numbers, date, datetime, time and timedelta are
what they say, Formula and Fault are cells with a formula and with an error value.  Tests change a sound book by functions.
"""

from __future__ import annotations

import json
import zipfile
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, time, timedelta
from pathlib import Path
from xml.etree import ElementTree as ET


@dataclass(frozen=True)
class Formula:
    text: str
    shown: str


@dataclass(frozen=True)
class Fault:
    shown: str


@dataclass
class Book:
    heads: dict[str, list[str]] = field(default_factory=dict)
    rows: dict[str, list[dict]] = field(default_factory=dict)
    merged: dict[str, str] = field(default_factory=dict)

    def sheet(self, name: str, head: str, *rows: tuple) -> None:
        self.heads[name] = head.split()
        self.rows[name] = [dict(zip(self.heads[name], r, strict=False)) for r in rows]

    def item(self, name: str, value) -> None:
        """Set an item of meta__readme (json, if it isn't text)."""
        text = value if value is None or isinstance(value, str) else json.dumps(value)
        own = [r for r in self.rows["meta__readme"] if r["item"] == name]
        if own:
            own[0]["value"] = text
        else:
            self.rows["meta__readme"].append({"item": name, "value": text})

    def column(self, sheet: str, name: str, values: list) -> None:
        self.heads[sheet].append(name)
        for r, v in zip(self.rows[sheet], values, strict=True):
            r[name] = v

    def grid(self, name: str) -> list[list]:
        head = self.heads[name]
        return [list(head), *([r.get(h) for h in head] for r in self.rows[name])]


SOURCE = "apiary_log"
COUNTRIES = ["FI", "EE", "NA"]


def apiary() -> Book:
    """A book without any fault."""
    b = Book()
    b.sheet("meta__readme", "item value")
    for name, value in {"workbook_id": SOURCE, "purpose": "weights of hives", "curator": "the keeper", "source_reference": "field notes", "contract_version": "2.0.0-draft.1", "locale": "fi", "timezone": "Europe/Helsinki", "default_identifier_profile": "hive", "coordinate_crs": "EPSG:4326"}.items():
        b.item(name, value)
    b.item("identifier_profiles", {"hive": {"type": "field_collection", "namespace": "hives", "year_range": [2010, 2039], "serial_width": 4}, "strain": {"type": "external", "namespace": "strains", "pattern": "^[a-z]{3}$"}})
    b.item("coordinate_fields", {"data__hives": {"latitude": "north", "longitude": "east", "display_digits": 2}})
    b.sheet("meta__tables", "sheet_name key_field key_scope record_unit notes", ("data__hives", "hive", "row", "a hive"), ("ref__strains", "strain", "row", "a strain of bees"))
    b.sheet(
        "meta__fields", "sheet_name field_name type minimum maximum identifier_profile ref_sheet ref_field", ("data__hives", "mass", "number", "0", "150"), ("data__hives", "bees", None, None, None, None, "ref__strains", "strain"),
        ("data__hives", "weighed", "date"), ("ref__strains", "strain", "text", None, None, "strain"))
    b.sheet(
        "data__hives", "hive north east weighed mass bees remark empty calc__gain",
        ("FI25_0001", 60.25, 24.5, date(2025, 5, 30), 31.5, "lig", 'keep "as is"\tand\nso on', None, Formula("E2-E3", "#VALUE!")),
        ("FI25_0002", "60° 15' 0\" N", "24:30:00 E", date(2025, 6, 1), 28, "car", "NA", None, None))
    b.sheet("ref__strains", "strain what", ("lig", "Italian"), ("car", "Carniolan"))
    b.sheet("calc__summary", "total", (Formula("1/0", "#DIV/0!"),))
    return b


def grown(b: Book) -> None:
    """A later state: one weight is corrected, one hive is new."""
    b.rows["data__hives"][0]["mass"] = 33.25
    b.rows["data__hives"].append({"hive": "FI25_0003", "north": 0, "east": 0, "weighed": date(2025, 6, 2), "bees": "lig"})


def clocks(b: Book) -> None:
    b.column("data__hives", "visit_time", [time(6, 45), time(19, 5, 30)])
    b.column("data__hives", "flight_duration", [timedelta(days=1, hours=3), timedelta(minutes=90)])
    b.column("data__hives", "visit_datetime", [datetime(2025, 5, 30, 6, 45), datetime(2025, 6, 1, 19, 5, 30)])


def visits(b: Book) -> None:
    """A key that stands for a thing seen several times."""
    b.rows["data__hives"][1]["hive"] = b.rows["data__hives"][0]["hive"]
    b.rows["meta__tables"][0] |= {"key_scope": "entity", "notes": "a hive is weighed again and again"}


def no_rows(b: Book) -> None:
    b.rows["data__hives"] = []


def token_inside(b: Book) -> None:
    b.rows["data__hives"][0]["remark"] = "\\N"


def too_light(b: Book) -> None:
    b.rows["data__hives"][0]["mass"], b.rows["data__hives"][1]["bees"] = -4, "bad"


#: What breaks which rules: a change of the rows of data__hives (new rows count from the third), or of the book.
FAULTS: dict[tuple[str, ...], Callable[[Book], None]] = {
    ("workbook.raw_formula",): lambda b: b.rows["data__hives"][0].update(mass=Formula("2+2", "4")),
    ("workbook.cell_error",): lambda b: b.rows["data__hives"][1].update(mass=Fault("#REF!")),
    ("workbook.whitespace_value",): lambda b: b.rows["data__hives"][1].update(remark=" \t"),
    ("workbook.spacer_row",): lambda b: b.rows["data__hives"].append({}),
    ("workbook.sheet_name",): lambda b: b.sheet("Scratch", "a"),
    ("workbook.merged_cells",): lambda b: b.merged.update(data__hives="F2:G2"),
    ("workbook.empty_sheet",): lambda b: b.heads.update(data__void=[]) or b.rows.update(data__void=[]),
    ("workbook.headers", "metadata.key_declaration"): lambda b: b.sheet("data__twice", "a a"),
    ("workbook.field_name",): lambda b: b.sheet("data__loud", "Loud"),
    ("metadata.source_identity",): lambda b: b.item("workbook_id", "someone_else"),
    ("metadata.required_item",): lambda b: b.item("curator", None),
    ("metadata.contract_version",): lambda b: b.item("contract_version", "9"),
    ("metadata.unknown_table",): lambda b: b.rows["meta__tables"].append({"sheet_name": "data__gone", "key_field": "x", "key_scope": "row", "record_unit": "x"}),
    ("metadata.unknown_field",): lambda b: b.rows["meta__fields"].append({"sheet_name": "data__hives", "field_name": "gone"}),
    ("identifier.duplicate_row_key", "value.code_whitespace", "value.controlled_code"): lambda b: b.rows["data__hives"].append({"hive": "FI25_0002", "bees": "lig "}),
    ("identifier.zero_serial", "coordinate.invalid"): lambda b: b.rows["data__hives"].append({"hive": "FI25_0000", "north": "-60 N", "east": 24}),
    ("identifier.storage", "identifier.syntax"): lambda b: b.rows["data__hives"].append({"hive": 31415926535, "mass": "9"}),
    ("identifier.whitespace", "identifier.lexical"): lambda b: b.rows["data__hives"].append({"hive": " FI25_0007"}),
    ("identifier.country", "identifier.year"): lambda b: b.rows["data__hives"].append({"hive": "XX55_0001"}),
    ("identifier.missing", "coordinate.incomplete_pair"): lambda b: b.rows["data__hives"].append({"north": 60}),
    ("temporal.invalid", "value.bound", "value.numeric_type"): lambda b: b.rows["data__hives"].append({"hive": "FI25_0009", "weighed": "2025-02-30", "mass": 151}),
}


def broken(b: Book) -> None:
    """Every fault at once."""
    for change in FAULTS.values():
        change(b)


def _letters(n: int) -> str:
    return (_letters((n - 1) // 26) if n > 26 else "") + "ABCDEFGHIJKLMNOPQRSTUVWXYZ"[(n - 1) % 26]


class Xlsx:
    """Writes a Book as XLSX; options: days counted from 1904, text in a shared table."""

    MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    #: Style of each kind of value: the number format at that place.
    FORMATS = (0, 15, 22, 20, 170)

    def __init__(self, from_1904: bool = False, shared: bool = False):
        self.origin = datetime(1904, 1, 1) if from_1904 else datetime(1899, 12, 30)
        self.from_1904, self.table = from_1904, [] if shared else None

    def days(self, v) -> tuple[int, float]:
        """Style and serial number."""
        if isinstance(v, datetime):
            return 2, (v - self.origin) / timedelta(days=1)
        if isinstance(v, date):
            return 1, float((datetime(v.year, v.month, v.day) - self.origin).days)
        if isinstance(v, time):
            return 3, (v.hour * 3600 + v.minute * 60 + v.second) / 86400
        return 4, v / timedelta(days=1)

    def cell(self, row: ET.Element, at: str, v) -> None:
        if v is None:
            return
        c = ET.SubElement(row, "c", r=at)
        if isinstance(v, str) and self.table is not None:
            c.set("t", "s")
            self.table.append(v)
            ET.SubElement(c, "v").text = str(len(self.table) - 1)
        elif isinstance(v, str):
            c.set("t", "inlineStr")
            inner = ET.SubElement(c, "is")
            for part in (v[:2], v[2:]):  # rich text: two runs and a reading aid
                ET.SubElement(ET.SubElement(inner, "r"), "t").text = part
            ET.SubElement(ET.SubElement(inner, "rPh"), "t").text = "aid"
        elif isinstance(v, Formula):
            c.set("t", "str")
            ET.SubElement(c, "f").text = v.text
            ET.SubElement(c, "v").text = v.shown
        elif isinstance(v, Fault):
            c.set("t", "e")
            ET.SubElement(c, "v").text = v.shown
        elif isinstance(v, int | float):
            ET.SubElement(c, "v").text = repr(v)
        else:
            style, serial = self.days(v)
            c.set("s", str(style))
            ET.SubElement(c, "v").text = repr(serial)

    def write(self, book: Book, path: Path, extra: dict[str, bytes] | None = None) -> Path:
        members: dict[str, ET.Element] = {}
        whole = members["xl/workbook.xml"] = ET.Element("workbook", {"xmlns": self.MAIN, "xmlns:r": self.LINKS})
        links = members["xl/_rels/workbook.xml.rels"] = ET.Element("Relationships")
        ET.SubElement(whole, "workbookPr", date1904="1" if self.from_1904 else "0")
        listed = ET.SubElement(whole, "sheets")
        for name in book.heads:
            k = str(len(listed) + 1)
            ET.SubElement(listed, "sheet", {"name": name, "sheetId": k, "r:id": "link" + k})
            ET.SubElement(links, "Relationship", Id="link" + k, Target=f"worksheets/{name}.xml", Type="worksheet")
            sheet = members[f"xl/worksheets/{name}.xml"] = ET.Element("worksheet", xmlns=self.MAIN)
            data = ET.SubElement(sheet, "sheetData")
            for i, values in enumerate(book.grid(name), 1):
                row = ET.SubElement(data, "row", r=str(i))
                for j, v in enumerate(values, 1):
                    self.cell(row, _letters(j) + str(i), v)
            # Far away, a cell that is only coloured.
            ET.SubElement(ET.SubElement(data, "row", r="3210"), "c", r="AD3210", s="1")
            if name in book.merged:
                ET.SubElement(ET.SubElement(sheet, "mergeCells"), "mergeCell", ref=book.merged[name])
        styles = members["xl/styles.xml"] = ET.Element("styleSheet", xmlns=self.MAIN)
        ET.SubElement(ET.SubElement(styles, "numFmts"), "numFmt", numFmtId="170", formatCode="[hh]:mm")
        kinds = ET.SubElement(styles, "cellXfs")
        for f in self.FORMATS:
            ET.SubElement(kinds, "xf", numFmtId=str(f))
        if self.table is not None:
            strings = members["xl/sharedStrings.xml"] = ET.Element("sst", xmlns=self.MAIN)
            for text in self.table:
                ET.SubElement(ET.SubElement(strings, "si"), "t").text = text
        return _pack(path, {n: ET.tostring(x, "utf-8") for n, x in members.items()} | (extra or {}))


class Ods:
    """Writes a Book as ODS, each sheet followed by a very large empty area."""

    SPACES = {p: f"urn:oasis:names:tc:opendocument:xmlns:{p}:1.0" for p in ("office", "table", "text")}

    def tag(self, name: str) -> str:
        space, _, local = name.partition(":")
        return f"{{{self.SPACES[space]}}}{local}"

    def add(self, parent: ET.Element, name: str, **attributes) -> ET.Element:
        """attributes: space__local_name for space:local-name."""
        return ET.SubElement(parent, self.tag(name), {self.tag(k.replace("__", ":").replace("_", "-")): str(v) for k, v in attributes.items()})

    def lines(self, cell: ET.Element, text: str) -> None:
        for line in text.split("\n"):
            p, last = self.add(cell, "text:p"), None
            for part in line.replace("\t", "\0\t\0").split("\0"):
                if part == "\t":
                    last = self.add(p, "text:tab")
                elif last is None:
                    p.text = (p.text or "") + part
                else:
                    last.tail = (last.tail or "") + part

    def value(self, row: ET.Element, v, span: int) -> None:
        wide = {"table__number_columns_spanned": span} if span > 1 else {}
        if v is None:
            self.add(row, "table:table-cell", **wide)
        elif isinstance(v, str):
            self.lines(self.add(row, "table:table-cell", office__value_type="string", **wide), v)
        elif isinstance(v, Formula):
            self.lines(self.add(row, "table:table-cell", office__value_type="string", table__formula="of:=" + v.text, **wide), v.shown)
        elif isinstance(v, Fault):
            self.lines(self.add(row, "table:table-cell", office__value_type="float", office__value=0, **wide), v.shown)
        elif isinstance(v, int | float):
            self.add(row, "table:table-cell", office__value_type="float", office__value=v, **wide)
        elif isinstance(v, date):  # a datetime is one as well
            self.add(row, "table:table-cell", office__value_type="date", office__date_value=v.isoformat(), **wide)
        else:
            s = int(v.total_seconds()) if isinstance(v, timedelta) else v.hour * 3600 + v.minute * 60 + v.second
            self.add(row, "table:table-cell", office__value_type="time", office__time_value=f"PT{s // 3600:02}H{s % 3600 // 60:02}M{s % 60:02}S", **wide)

    def write(self, book: Book, path: Path) -> Path:
        root = ET.Element(self.tag("office:document-content"))
        sheets = self.add(self.add(root, "office:body"), "office:spreadsheet")
        for name in book.heads:
            table = self.add(sheets, "table:table", table__name=name)
            for i, values in enumerate(book.grid(name), 1):
                row = self.add(table, "table:table-row")
                for j, v in enumerate(values, 1):
                    self.value(row, v, 2 if book.merged.get(name, "").startswith(_letters(j) + str(i) + ":") else 1)
                self.add(row, "table:table-cell", table__number_columns_repeated=9_000)
            self.add(self.add(table, "table:table-row", table__number_rows_repeated=700_000), "table:table-cell", table__number_columns_repeated=9_000)
        return _pack(path, {"content.xml": ET.tostring(root, "utf-8")})


def _pack(path: Path, members: dict[str, bytes]) -> Path:
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in members.items():
            z.writestr(zipfile.ZipInfo(name), data)
    return path

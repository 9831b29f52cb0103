"""Workbook files (OOXML) as DataFrames, by an own reader.

Spark lists and reads the files; each is opened in memory on an executor, after
checks that bound what an untrusted archive can do. Nothing is evaluated, run
or followed: formulas stay text beside their stored result. One pass over a
workbook gives records of all kinds (parts, relationships, sheets, cells,
ranges, names, dimensions, drawings, warnings); the readers below keep the one
that is asked for, and skip the cells where they are not.
"""

from __future__ import annotations

import hashlib
import io
import json
import posixpath
import re
import zipfile
from dataclasses import asdict, dataclass
from datetime import datetime, timedelta
from urllib.parse import unquote
from xml.etree import ElementTree as ET

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SUFFIXES = (".xlsx", ".xlsm", ".xltx", ".xltm", ".xlam")  # fixed values
MAX_ROW, MAX_COL = 1_048_576, 16_384


@dataclass(frozen=True)
class Limits:
    """Bounds on what is read; the defaults are fixed values."""

    max_file_bytes: int = 300 * 1024 * 1024
    max_uncompressed_bytes: int = 2 * 1024 * 1024 * 1024
    max_zip_entries: int = 30_000
    max_entry_compression_ratio: float = 1_000.0
    max_material_cells_per_sheet: int = 1_500_000

    @property
    def fingerprint(self) -> str:
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True, separators=(",", ":")).encode()).hexdigest()


class WorkbookError(ValueError):
    """The file is not a workbook that can be read."""


class PackageSecurityError(WorkbookError):
    """The archive is unsafe."""


# --- package


def check_name(path: str, size: int, limits: Limits) -> None:
    if not path.lower().endswith(SUFFIXES):
        raise WorkbookError(f"not a supported workbook type: {path}")
    if size > limits.max_file_bytes:
        raise PackageSecurityError(f"the file has {size} bytes")


def check_member(name: str) -> None:
    if not name or "\x00" in name or name.startswith(("/", "\\")) or re.match(r"^[A-Za-z]:", name):
        raise PackageSecurityError(f"unsafe member name: {name!r}")
    if any(p in (".", "..") for p in re.split(r"[/\\]", name)):
        raise PackageSecurityError(f"unsafe member name: {name!r}")


def ratio(info: zipfile.ZipInfo) -> float:
    if not info.file_size:
        return 1.0
    return info.file_size / info.compress_size if info.compress_size else float("inf")


def open_package(data: bytes, limits: Limits) -> zipfile.ZipFile:
    try:
        package = zipfile.ZipFile(io.BytesIO(data))
    except zipfile.BadZipFile as e:
        raise WorkbookError("not a ZIP archive") from e
    entries = package.infolist()
    if len(entries) > limits.max_zip_entries:
        raise PackageSecurityError(f"{len(entries)} entries")
    seen, total = set(), 0
    for info in entries:
        check_member(info.filename)
        if info.filename.lower() in seen:
            raise PackageSecurityError(f"a name occurs twice: {info.filename}")
        seen.add(info.filename.lower())
        if info.flag_bits & 1:
            raise PackageSecurityError(f"encrypted: {info.filename}")
        if (info.external_attr >> 16) & 0o170000 == 0o120000:
            raise PackageSecurityError(f"a symbolic link: {info.filename}")
        total += info.file_size
        if total > limits.max_uncompressed_bytes:
            raise PackageSecurityError("too large when expanded")
        if ratio(info) > limits.max_entry_compression_ratio:
            raise PackageSecurityError(f"compressed too much: {info.filename}")
    if "[content_types].xml" not in seen or not any(n.startswith("xl/") for n in seen):
        raise WorkbookError("a required part is missing")
    return package


def xml_bytes(package: zipfile.ZipFile, name: str) -> bytes:
    data = package.read(name)
    if re.search(rb"<!\s*(?:DOCTYPE|ENTITY)", data, re.I):
        raise PackageSecurityError(f"document type declarations aren't allowed: {name}")
    return data


def tag(element) -> str:
    return element.tag.rpartition("}")[2]


def attr(element, name: str) -> str | None:
    return next((v for k, v in element.attrib.items() if k.rpartition("}")[2] == name), None)


def tree(package: zipfile.ZipFile, name: str):
    return ET.fromstring(xml_bytes(package, name))


def nodes(root, name: str):
    return (e for e in root.iter() if tag(e) == name)


def child(element, name: str):
    return next((e for e in element if tag(e) == name), None)


# --- references and values

REF = re.compile(r"\$?([A-Za-z]{1,3})?\$?(\d+)?$")


def column_number(letters: str) -> int:
    out = 0
    for x in letters.upper():
        out = out * 26 + ord(x) - 64
    return out


def column_letters(n: int) -> str:
    out = ""
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def bounds(ref: str) -> tuple[int, int, int, int] | None:
    left, _, right = ref.rpartition("!")[2].partition(":")
    a, b = REF.match(left), REF.match(right or left)
    if not a or not b or not left or bool(a[1]) != bool(b[1]) or bool(a[2]) != bool(b[2]):
        return None
    r = sorted((int(a[2] or 1), int(b[2] or MAX_ROW)))
    c = sorted((column_number(a[1]) if a[1] else 1, column_number(b[1]) if b[1] else MAX_COL))
    if r[0] < 1 or r[1] > MAX_ROW or c[1] > MAX_COL:
        return None
    return r[0], c[0], r[1], c[1]


# Built-in number formats that stand for dates, and all texts used.
DATE_FORMATS = {14: "mm-dd-yy", 15: "d-mmm-yy", 16: "d-mmm", 17: "mmm-yy", 18: "h:mm AM/PM", 19: "h:mm:ss AM/PM", 20: "h:mm", 21: "h:mm:ss", 22: "m/d/yy h:mm", 45: "mm:ss", 46: "[h]:mm:ss", 47: "mmss.0"}
NUMBER_FORMATS = {0: "General", 1: "0", 2: "0.00", 3: "#,##0", 4: "#,##0.00", 9: "0%", 10: "0.00%", 11: "0.00E+00", 12: "# ?/?", 13: "# ??/??", 37: "#,##0 ;(#,##0)", 38: "#,##0 ;[Red](#,##0)", 39: "#,##0.00;(#,##0.00)", 40: "#,##0.00;[Red](#,##0.00)", 48: "##0.0E+0", 49: "@"}


def is_date_format(text: str) -> bool:
    plain = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.|_.|\*.', "", text)
    return text != "General" and bool(re.search(r"[dmyhs]", plain, re.I)) and not re.search(r"[#0?]", re.sub(r"[sS]\.0+", "", plain))


def serial_date(value: float, epoch_1904: bool) -> datetime:
    base = datetime(1904, 1, 1) if epoch_1904 else datetime(1899, 12, 30)
    if not epoch_1904 and value < 60:
        value += 1
    return base + timedelta(milliseconds=round(value * 86_400_000))


def shift(formula: str, rows: int, cols: int) -> str:
    """A shared formula moved to a dependent cell: relative parts move."""
    from ..functions.formulas import FormulaError, tokens

    def one(cell: str) -> str:
        m = re.match(r"(\$?)([A-Za-z]{1,3})(\$?)(\d+)$", cell)
        if not m:
            return cell
        c = m[2] if m[1] else column_letters(max(1, column_number(m[2]) + cols))
        return f"{m[1]}{c}{m[3]}{m[4] if m[3] else max(1, int(m[4]) + rows)}"

    try:
        parts = tokens(formula)
    except FormulaError:
        return formula
    moved = []
    for kind, text in parts:
        if kind == "range":
            sheet, mark, cells = text.rpartition("!")
            text = sheet + mark + ":".join(map(one, cells.split(":")))
        moved.append(text)
    return "".join(moved)


# --- one workbook


class Workbook:
    """Scans a package; every method yields (kind, record)."""

    def __init__(self, path: str, data: bytes, limits: Limits):
        check_name(path, len(data), limits)
        self.path, self.data, self.limits = path, data, limits
        self.package = open_package(data, limits)
        self.members = {n.lower(): n for n in self.package.namelist()}
        self.warnings: list[dict] = []
        self.rels: dict[str, dict[str, dict]] = {}

    def warn(self, code: str, message: str, sheet: str | None = None, **details) -> None:
        self.warnings.append({"code": code, "message": message, "sheet": sheet, "details": json.dumps(details, sort_keys=True)})

    def records(self, cells: bool, sheets: set[str] | None):
        yield from self.parts()
        yield from self.relationships()
        if "xl/vbaproject.bin" in self.members:
            self.warn("macros_present_not_executed", "the workbook holds macros")
        if "xl/connections.xml" in self.members:
            self.warn("data_connections_not_refreshed", "the workbook holds data connections")
        yield from self.book(cells, sheets)
        for w in self.warnings:
            yield "warning", w

    def parts(self):
        root = tree(self.package, self.members["[content_types].xml"])
        default = {attr(e, "Extension").lower(): attr(e, "ContentType") for e in nodes(root, "Default")}
        override = {attr(e, "PartName").lstrip("/").lower(): attr(e, "ContentType") for e in nodes(root, "Override")}
        for info in self.package.infolist():
            name, digest = info.filename, hashlib.sha256()
            with self.package.open(info) as f:
                while piece := f.read(1 << 20):
                    digest.update(piece)
            yield "part", {"name": name, "content_type": override.get(name.lower()) or default.get(name.rpartition(".")[2].lower()), "size": info.file_size, "compressed": info.compress_size, "ratio": ratio(info), "crc": info.CRC, "sha256": digest.hexdigest(), "part_kind": _feature(name)}

    def relationships(self):
        external = 0
        for name in self.package.namelist():
            if not name.lower().endswith(".rels"):
                continue
            folder, _, file = name.rpartition("/")
            source = posixpath.join(posixpath.dirname(folder), file[:-5]) if file != ".rels" else ""
            try:
                root = tree(self.package, name)
            except ET.ParseError:
                self.warn("relationship_parse_error", "relationships can't be parsed", part=name)
                continue
            for e in nodes(root, "Relationship"):
                target, rid = attr(e, "Target") or "", attr(e, "Id")
                outside = attr(e, "TargetMode") == "External" or target.startswith("\\\\") or bool(re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:", target))
                resolved = None
                if outside:
                    external += 1
                else:
                    path = unquote(target)
                    joined = posixpath.normpath(path.lstrip("/") if path.startswith("/") else posixpath.join(posixpath.dirname(source), path))
                    if joined.startswith(".."):
                        self.warn("invalid_relationship_target", "a target leaves the package", part=name, target=target)
                    else:
                        resolved = joined
                one = {"source": source, "rel_id": rid, "rel_type": (attr(e, "Type") or "").rpartition("/")[2], "target": target, "external": outside, "resolved": resolved}
                if rid in self.rels.setdefault(source, {}):
                    self.warn("duplicate_relationship_id", "an id occurs twice", part=name, id=rid)
                else:
                    self.rels[source][rid] = one
                yield "relationship", one
        if external:
            self.warn("external_relationships_present", "links to other files are not followed", count=external)

    def part_of(self, source: str, kind: str) -> str | None:
        return next((self.members.get((r["resolved"] or "").lower()) for r in self.rels.get(source, {}).values() if r["rel_type"] == kind), None)

    def book(self, cells: bool, wanted: set[str] | None):
        main = self.part_of("", "officeDocument")
        if not main:
            main = self.members.get("xl/workbook.xml")
            self.warn("workbook_relationship_missing", "the workbook part is taken from its usual place")
        if not main:
            raise WorkbookError("there is no workbook part")
        root = tree(self.package, main)
        properties = child(root, "workbookPr")
        epoch = properties is not None and attr(properties, "date1904") in ("1", "true")
        calc = child(root, "calcPr")
        yield "workbook", {"date_system": "1904" if epoch else "1900", "calculation": json.dumps(dict(calc.attrib) if calc is not None else {}, sort_keys=True), "properties": json.dumps(self.properties(), sort_keys=True, ensure_ascii=False), "security": json.dumps(self.security(root), sort_keys=True), "sha256": hashlib.sha256(self.data).hexdigest(), "size": len(self.data)}
        strings = self.strings(self.part_of(main, "sharedStrings"))
        styles = Styles(tree(self.package, p) if (p := self.part_of(main, "styles")) else None)
        names, titles = set(), []
        for position, e in enumerate(nodes(root, "sheet"), 1):
            title, rel = attr(e, "name"), self.rels.get(main, {}).get(e.attrib.get("{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id") or attr(e, "id"))
            titles.append(title)
            if title in names:
                self.warn("duplicate_sheet_name", "a sheet name occurs twice", title)
            names.add(title)
            part = None
            if rel is None:
                self.warn("sheet_relationship_missing", "the sheet has no part", title)
            elif rel["external"]:
                self.warn("external_sheet_relationship", "the sheet is in another file", title)
            else:
                part = self.members.get((rel["resolved"] or "").lower())
                if part is None:
                    self.warn("sheet_part_missing", "the sheet's part is missing", title)
            found = {"position": position, "sheet": title, "sheet_id": attr(e, "sheetId"), "state": attr(e, "state") or "visible", "part": part, "dimension": None, "n_cells": 0, "n_formulas": 0, "n_cached": 0, "freeze": None, "auto_filter": None, "protection": None, "tab_color": None, "default_height": None, "default_width": None}
            if part:
                yield from self.sheet(title, part, strings, styles, epoch, cells and (wanted is None or title in wanted), found)
            yield "sheet", found
        for e in nodes(root, "definedName"):
            scope = attr(e, "localSheetId")
            yield "name", {"name": attr(e, "name"), "scope": titles[int(scope)] if scope is not None and int(scope) < len(titles) else None, "definition": (e.text or "").strip(), "hidden": attr(e, "hidden") in ("1", "true")}

    def properties(self) -> dict:
        """Title, creator, dates and so on of the document's core properties."""
        part = self.members.get("docprops/core.xml")
        return {tag(e): e.text for e in tree(self.package, part) if e.text} if part else {}

    @staticmethod
    def security(root) -> dict:
        locks = child(root, "workbookProtection")
        return {k: locks.attrib.get(k) in ("1", "true") for k in ("lockStructure", "lockWindows", "lockRevision")} if locks is not None else {}

    def strings(self, part: str | None) -> list[str]:
        if not part:
            return []
        return ["".join(t.text or "" for t in si.iter() if tag(t) == "t" and not _phonetic(si, t)) for si in nodes(tree(self.package, part), "si")]

    def sheet(self, title: str, part: str, strings: list[str], styles: Styles, epoch: bool, want: bool, found: dict):
        shared: dict[str, tuple[str, int, int]] = {}
        numbers = {"dv": 0, "cf": 0}
        row = col = 0
        hyper, seen = [], set()
        for _, e in ET.iterparse(io.BytesIO(xml_bytes(self.package, part)), ("end",)):
            kind = tag(e)
            if kind == "dimension":
                found["dimension"] = attr(e, "ref")
            elif kind == "col":
                yield "dimension", {"sheet": title, "axis": "column", "first": int(attr(e, "min")), "last": int(attr(e, "max")), "size": _number(attr(e, "width")), "hidden": attr(e, "hidden") in ("1", "true"), "outline": int(attr(e, "outlineLevel") or 0), "collapsed": attr(e, "collapsed") in ("1", "true")}
            elif kind == "row":
                if attr(e, "hidden") in ("1", "true") or attr(e, "ht") or attr(e, "outlineLevel"):
                    n = int(attr(e, "r") or row)
                    yield "dimension", {"sheet": title, "axis": "row", "first": n, "last": n, "size": _number(attr(e, "ht")), "hidden": attr(e, "hidden") in ("1", "true"), "outline": int(attr(e, "outlineLevel") or 0), "collapsed": attr(e, "collapsed") in ("1", "true")}
                row = max(row, int(attr(e, "r") or row + 1))
                e.clear()
            elif kind == "c":
                ref = attr(e, "r")
                if ref:
                    b = bounds(ref)
                    row_, col = b[0], b[1]
                else:
                    self.warn("formula_coordinate_missing", "a cell has no reference", title)
                    row_, col = row + 1, col + 1
                found["n_cells"] += 1
                if found["n_cells"] > self.limits.max_material_cells_per_sheet:
                    raise PackageSecurityError(f"too many cells in {title}")
                f, v = child(e, "f"), child(e, "v")
                if f is not None:
                    found["n_formulas"] += 1
                    found["n_cached"] += v is not None and v.text is not None
                if (row_, col) in seen:
                    self.warn("duplicate_formula_coordinate", "a cell occurs twice", title, coordinate=ref)
                elif want:
                    seen.add((row_, col))
                    yield "cell", self.cell(title, row_, col, e, f, v, strings, styles, epoch, shared)
            elif kind == "mergeCell":
                yield from self.range(title, "merge", attr(e, "ref"), attr(e, "ref"), {}, "MERGE_RANGE_NOT_EXPANDED")
            elif kind == "dataValidation":
                numbers["dv"] += 1
                for one in (attr(e, "sqref") or "").split():
                    formulas = {tag(x): x.text for x in e}
                    yield from self.range(title, "validation", attr(e, "type") or "any", one, {**e.attrib, **formulas, "id": f"dv{numbers['dv']:04d}"}, "INVALID_DATA_VALIDATION_RANGE")
            elif kind == "conditionalFormatting":
                rules = [{**r.attrib, "formulas": [x.text for x in r if tag(x) == "formula"]} for r in e if tag(r) == "cfRule"]
                numbers["cf"] += 1
                for one in (attr(e, "sqref") or "").split():
                    yield from self.range(title, "conditional_format", rules[0].get("type", "") if rules else "", one, {"rules": rules, "id": f"cf{numbers['cf']:04d}"}, "INVALID_CONDITIONAL_FORMAT_RANGE")
            elif kind == "sheetProtection":
                found["protection"] = json.dumps({k: e.attrib.get(k) in ("1", "true") for k in ("sheet", "formatCells", "insertRows", "deleteRows")}, sort_keys=True)
            elif kind == "sheetFormatPr":
                found["default_height"], found["default_width"] = _number(attr(e, "defaultRowHeight")), _number(attr(e, "defaultColWidth"))
            elif kind == "tabColor":
                found["tab_color"] = attr(e, "rgb")
            elif kind == "autoFilter" and "worksheets" in part:
                found["auto_filter"] = attr(e, "ref")
                yield from self.range(title, "filter", "auto_filter", attr(e, "ref"), {}, "EXTRACTION_WARNING")
            elif kind == "hyperlink":
                hyper.append(e)
            elif kind == "pane":
                found["freeze"] = attr(e, "topLeftCell") if attr(e, "state") in ("frozen", "frozenSplit") else found["freeze"]
                yield "range", {"sheet": title, "kind": "pane", "name": attr(e, "state") or "", "ref": attr(e, "topLeftCell") or "", "details": json.dumps(dict(e.attrib), sort_keys=True), **dict.fromkeys(("min_row", "min_col", "max_row", "max_col"))}
        own = self.rels.get(part, {})
        for e in hyper:
            rel = own.get(e.attrib.get("{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"))
            yield from self.range(title, "hyperlink", rel["target"] if rel else attr(e, "location") or "", attr(e, "ref"), {"tooltip": attr(e, "tooltip")}, "EXTRACTION_WARNING")
        for rel in own.values():
            target = self.members.get((rel["resolved"] or "").lower())
            if target and rel["rel_type"] == "table":
                t = tree(self.package, target)
                columns = [attr(c, "name") for c in nodes(t, "tableColumn")]
                yield from self.range(title, "table", attr(t, "displayName") or attr(t, "name"), attr(t, "ref"), {"columns": columns, "totals": attr(t, "totalsRowCount"), "headers": attr(t, "headerRowCount")}, "INVALID_NATIVE_TABLE_RANGE")
            elif target and rel["rel_type"] == "comments":
                t = tree(self.package, target)
                authors = [a.text for a in nodes(t, "author")]
                for c in nodes(t, "comment"):
                    author = int(attr(c, "authorId") or 0)
                    yield from self.range(title, "comment", "".join(x.text or "" for x in nodes(c, "t")), attr(c, "ref"), {"author": authors[author] if author < len(authors) else None}, "EXTRACTION_WARNING")
            elif rel["rel_type"] in ("drawing", "vmlDrawing"):
                if not target:
                    self.warn("drawing_part_missing", "a drawing's part is missing", title, target=rel["target"])
                    continue
                try:
                    yield from self.drawing(title, tree(self.package, target), target)
                except ET.ParseError:
                    self.warn("drawing_parse_error", "a drawing can't be parsed", title, part=target)
        if found["n_formulas"] > found["n_cached"]:
            self.warn("FORMULA_CACHE_MISSING", "formulas without a stored result", title, count=found["n_formulas"] - found["n_cached"])

    def range(self, sheet: str, kind: str, name: str, ref: str | None, details: dict, code: str):
        b = bounds(ref or "")
        if b is None:
            self.warn(code, "a range can't be read", sheet, range=ref)
            return
        yield "range", {"sheet": sheet, "kind": kind, "name": name, "ref": ref, "details": json.dumps(details, sort_keys=True, ensure_ascii=False), **dict(zip(("min_row", "min_col", "max_row", "max_col"), b, strict=True))}

    def drawing(self, sheet: str, root, part: str):
        for anchor in root.iter():
            if tag(anchor) in ("twoCellAnchor", "oneCellAnchor", "absoluteAnchor", "shape"):
                inside = next(nodes(anchor, "cNvPr"), None)
                corner = [int(x.text) + 1 for n in ("from", "to") for p in nodes(anchor, n) for x in p if tag(x) in ("row", "col") and x.text]
                kinds = [tag(x) for x in anchor if tag(x) in ("sp", "pic", "graphicFrame", "grpSp", "cxnSp")]
                client = next((x.text for x in nodes(anchor, "Anchor")), None)
                yield "drawing", {"sheet": sheet, "part": part, "drawing_type": kinds[0] if kinds else tag(anchor), "name": attr(inside, "name") if inside is not None else attr(anchor, "id"), "alt_text": attr(inside, "descr") if inside is not None else None, "anchor": json.dumps(corner) if corner else client, "text": "".join(x.text or "" for x in nodes(anchor, "t")) or None}

    def cell(self, sheet, row, col, e, f, v, strings, styles: Styles, epoch, shared) -> dict:
        style = styles.cell(int(attr(e, "s") or 0))
        kind, text, number, truth, stamp = self.value(attr(e, "t") or "n", e, v, strings, style, epoch)
        out = {"sheet": sheet, "row": row, "col": col, "coord": f"{column_letters(col)}{row}", **style, "formula": None, "cache_status": "not_applicable", "cache_kind": None, "cache_str": None, "cache_num": None, "cache_bool": None, "cache_ts": None, "formula_type": None}
        if f is not None:
            formula = f.text or ""
            if attr(f, "t") == "shared":
                key = attr(f, "si")
                if formula:
                    shared[key] = (formula, row, col)
                elif key in shared:
                    base, r, c = shared[key]
                    formula = shift(base, row - r, col - c)
            out |= {"formula": f"={formula}", "formula_type": attr(f, "t") or "normal", "cache_status": "present" if v is not None and v.text is not None else "missing", "cache_kind": kind, "cache_str": text, "cache_num": number, "cache_bool": truth, "cache_ts": stamp, "kind": "formula", "v_str": None, "v_num": None, "v_bool": None, "v_ts": None}
            return out
        return out | {"kind": kind, "v_str": text, "v_num": number, "v_bool": truth, "v_ts": stamp}

    @staticmethod
    def value(code, e, v, strings, style, epoch):
        raw = v.text if v is not None else None
        if code == "inlineStr":
            return "text", "".join(t.text or "" for t in nodes(e, "t")), None, None, None
        if raw is None:
            return "blank", None, None, None, None
        if code == "s":
            k = int(raw) if raw.strip().isdigit() else -1
            return ("text", strings[k], None, None, None) if 0 <= k < len(strings) else ("error", raw, None, None, None)
        if code == "b":
            return "boolean", None, None, raw.strip() in ("1", "true"), None
        if code == "e":
            return "error", raw, None, None, None
        if code == "str":
            return "text", raw, None, None, None
        if code == "d":
            try:
                return "datetime", raw, None, None, datetime.fromisoformat(raw.replace("Z", ""))
            except ValueError:
                return "error", raw, None, None, None
        try:
            number = float(raw)
        except ValueError:
            return "error", raw, None, None, None
        if is_date_format(style["number_format"]) and -657435 < number < 2958466:
            return "datetime", None, None, None, serial_date(number, epoch)
        return ("integer" if re.fullmatch(r"-?\d+", raw.strip()) else "number"), None, number, None, None


def _feature(name: str) -> str:
    low = name.lower()
    for part, kind in (("vbaproject", "macro"), ("connections", "connection"), ("querytables", "query"), ("threadedcomments", "threaded_comment"), ("externallinks", "external_link"), ("worksheets/", "worksheet"), ("drawings/", "drawing"), ("media/", "media"), ("tables/", "table")):
        if part in low:
            return kind
    return "other"


def _phonetic(si, t) -> bool:
    return any(t in list(r.iter()) for r in si if tag(r) == "rPh")


def _number(text: str | None) -> float | None:
    return float(text) if text else None


class Styles:
    """Semantic styles of cell formats, without their local numbers."""

    def __init__(self, root):
        self.formats = [{}]
        if root is None:
            return
        own = {int(attr(e, "numFmtId")): attr(e, "formatCode") for e in nodes(root, "numFmt")}
        part = lambda name: list(child(root, name)) if child(root, name) is not None else []
        fonts, fills, borders = part("fonts"), part("fills"), part("borders")
        pick = lambda items, k: items[int(k or 0)] if int(k or 0) < len(items) else None
        self.formats = []
        for xf in part("cellXfs"):
            font, fill, border = pick(fonts, attr(xf, "fontId")), pick(fills, attr(xf, "fillId")), pick(borders, attr(xf, "borderId"))
            number = int(attr(xf, "numFmtId") or 0)
            pattern = child(fill, "patternFill") if fill is not None else None
            align = child(xf, "alignment")
            on = lambda n, font=font: font is not None and child(font, n) is not None and attr(child(font, n), "val") not in ("0", "false")
            self.formats.append({
                "bold": on("b"), "italic": on("i"), "font": _plain(font), "fill": _plain(fill), "border": _plain(border), "alignment": dict(align.attrib) if align is not None else {},
                "has_fill": pattern is not None and attr(pattern, "patternType") not in (None, "none"), "edges": sum(1 for x in border or [] if tag(x) in ("left", "right", "top", "bottom") and attr(x, "style") not in (None, "none")),
                "number_format": own.get(number) or DATE_FORMATS.get(number) or NUMBER_FORMATS.get(number, "General"),
            })

    def cell(self, k: int) -> dict:
        s = self.formats[k] if k < len(self.formats) and self.formats[k] else {"bold": False, "italic": False, "has_fill": False, "edges": 0, "number_format": "General"}
        canonical = json.dumps({n: s.get(n) for n in sorted(s)}, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        return {"bold": s["bold"], "italic": s["italic"], "has_fill": s["has_fill"], "border_edges": s["edges"], "number_format": s["number_format"], "style_hash": "style:" + hashlib.sha256(canonical.encode()).hexdigest()}


def _plain(element):
    """An element's content, without its place among others."""
    if element is None:
        return None
    return {"a": {k.rpartition("}")[2]: v for k, v in sorted(element.attrib.items())}, "c": [[tag(x), _plain(x)] for x in element]}


# --- readers

SCHEMAS = {
    "part": "name string, content_type string, size long, compressed long, ratio double, crc long, sha256 string, part_kind string",
    "relationship": "source string, rel_id string, rel_type string, target string, external boolean, resolved string",
    "workbook": "date_system string, calculation string, properties string, security string, sha256 string, size long",
    "sheet": "position int, sheet string, sheet_id string, state string, part string, dimension string, n_cells long, n_formulas long, n_cached long, freeze string, auto_filter string, protection string, tab_color string, default_height double, default_width double",
    "cell": "sheet string, row int, col int, coord string, kind string, v_str string, v_num double, v_bool boolean, v_ts timestamp_ntz, formula string, formula_type string, cache_status string, cache_kind string, cache_str string, cache_num double, cache_bool boolean, cache_ts timestamp_ntz, number_format string, bold boolean, italic boolean, has_fill boolean, border_edges int, style_hash string",
    "range": "sheet string, kind string, name string, ref string, min_row int, min_col int, max_row int, max_col int, details string",
    "name": "name string, scope string, definition string, hidden boolean",
    "dimension": "sheet string, axis string, first int, last int, size double, hidden boolean, outline int, collapsed boolean",
    "drawing": "sheet string, part string, drawing_type string, name string, alt_text string, anchor string, text string",
    "warning": "code string, message string, sheet string, details string",
}


def from_files(files: DataFrame, kind: str, limits: Limits, sheets: list[str] | None = None) -> DataFrame:
    """Records of one kind from a table of path and content (also a stream)."""
    import pyarrow as pa
    from pyspark.sql.types import _parse_datatype_string

    schema = f"workbook string, {SCHEMAS[kind]}"
    names = [f.name for f in _parse_datatype_string(schema)]
    wanted = set(sheets) if sheets is not None else None
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def flush(rows):
        return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], f.type) for n, f in zip(names, arrow, strict=True)], schema=arrow)

    def run(batches):
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                for what, record in Workbook(path, data.as_py(), limits).records(kind == "cell", wanted):
                    if what == kind:
                        rows.append({"workbook": path, **record})
                    if len(rows) >= 20_000:
                        yield flush(rows)
                        rows = []
                if rows:
                    yield flush(rows)

    return files.select("path", "content").mapInArrow(run, schema)


def _files(spark: SparkSession, path: str, limits: Limits) -> DataFrame:
    """path and content of the files. Sizes are checked before any is loaded."""
    files = spark.read.format("binaryFile").load(path)
    large = files.where(F.col("length") > limits.max_file_bytes).select("path").first()
    if large:
        raise PackageSecurityError(f"the file is too large: {large['path']}")
    return files


def read(spark: SparkSession, path: str, kind: str, limits: Limits | None = None, sheets: list[str] | None = None) -> DataFrame:
    """Records of one kind of all workbooks under ``path``."""
    limits = limits or Limits()
    return from_files(_files(spark, path, limits), kind, limits, sheets)


def scan(spark: SparkSession, path: str, limits: Limits | None = None, sheets: list[str] | None = None) -> dict[str, DataFrame]:
    """Records of all kinds: each workbook is parsed once, into a written table
    with one struct column for each kind."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    from ..storage import stored

    limits = limits or Limits()
    schema = _parse_datatype_string("workbook string, what string, " + ", ".join(f"of_{k} struct<{v.replace(' ', ':').replace(',:', ', ')}>" for k, v in SCHEMAS.items()))
    arrow = to_arrow_schema(schema)
    wanted = set(sheets) if sheets is not None else None

    def flush(book, rows):
        columns = [pa.array([book] * len(rows)), pa.array([what for what, _ in rows])]
        columns += [pa.array([r if f"of_{what}" == f.name else None for what, r in rows], f.type) for f in list(arrow)[2:]]
        return pa.RecordBatch.from_arrays(columns, schema=arrow)

    def run(batches):
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                for record in Workbook(path, data.as_py(), limits).records(True, wanted):
                    rows.append(record)
                    if len(rows) >= 10_000:
                        yield flush(path, rows)
                        rows = []
                if rows:
                    yield flush(path, rows)

    table = stored(_files(spark, path, limits).select("path", "content").mapInArrow(run, schema), "scan")
    return {k: table.where(F.col("what") == k).select("workbook", f"of_{k}.*") for k in SCHEMAS}


def read_cells(spark: SparkSession, path: str, sheets: list[str] | None = None, limits: Limits | None = None) -> DataFrame:
    return read(spark, path, "cell", limits, sheets)


def read_parts(spark: SparkSession, path: str, limits: Limits | None = None) -> DataFrame:
    return read(spark, path, "part", limits).withColumnRenamed("part_kind", "kind")


def read_sheets(spark: SparkSession, path: str, limits: Limits | None = None) -> DataFrame:
    return read(spark, path, "sheet", limits)


def read_names(spark: SparkSession, path: str, limits: Limits | None = None) -> DataFrame:
    return named(read(spark, path, "name", limits))


def named(n: DataFrame) -> DataFrame:
    """Defined names with their status; static ones have a destination."""
    from ..functions.formulas import name_status
    from ..functions.geometry import Rect

    r = Rect.parse(F.col("definition"))
    first = name_status(F.col("definition"))
    static = F.col("definition").contains("!") & r.r1.isNotNull()
    built_in = F.col("name").startswith("_xlnm.")
    return n.select("*", F.when((first == "raw") & F.coalesce(static, F.lit(False)), "static").otherwise(first).alias("status"), built_in.alias("built_in"), *r.columns())


def name_warnings(names: DataFrame) -> DataFrame:
    """Warnings for names that refer to nothing."""
    c = F.col
    details = F.to_json(F.struct("definition", "name", F.coalesce("scope", F.lit("workbook")).alias("scope"), "status"))
    message = F.concat(F.lit("Defined name '"), c("name"), F.lit("' contains a broken reference"))
    return names.where("status = 'broken'").select("workbook", F.lit("DEFINED_NAME_BROKEN_REFERENCE").alias("code"), message.alias("message"), c("scope").alias("sheet"), details.alias("details"))

"""A minimal workbook writer, for samples and tests: values and formulas."""

from __future__ import annotations

import io
import tempfile
import zipfile
from pathlib import Path
from xml.sax.saxutils import escape, quoteattr

from .ooxml import column_letters

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PKG = "http://schemas.openxmlformats.org/package/2006"


def cell_xml(row: int, col: int, value, style: int = 0) -> str:
    """A value, or (formula, cached result or None)."""
    at = f'r="{column_letters(col)}{row}" s="{style}"'
    if isinstance(value, tuple):
        formula, cached = value
        kept = "" if cached is None else f"<v>{escape(str(cached))}</v>"
        kind = ' t="str"' if isinstance(cached, str) else ""
        return f"<c {at}{kind}><f>{escape(formula.lstrip('='))}</f>{kept}</c>"
    if value is None:
        return f"<c {at}/>"
    if isinstance(value, bool):
        return f'<c {at} t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)):
        return f"<c {at}><v>{value!r}</v></c>"
    return f'<c {at} t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'


STYLES = (
    f'<styleSheet xmlns="{MAIN}"><fonts><font/><font><b/></font></fonts><fills><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill><fill><patternFill patternType="solid"><fgColor rgb="FFCCCCCC"/></patternFill></fill></fills>'
    '<borders><border/><border><left style="thin"/><right style="thin"/><top style="thin"/><bottom style="thin"/></border></borders>'
    '<cellXfs><xf/><xf borderId="1"/><xf fontId="1" fillId="2" borderId="1"/><xf numFmtId="14" borderId="1"/></cellXfs></styleSheet>'
)


def workbook_bytes(sheets: dict[str, dict], names: dict[str, str] | None = None, extra: dict[str, str] | None = None) -> bytes:
    """``sheets``: title to {cells: {(row, col): value or (value, style)...},
    styles: {(row, col): k}, merges: [ref], state, after: xml}. Style 0 is
    plain, 1 bordered, 2 a header, 3 a date."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        types = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k in range(1, len(sheets) + 1))
        z.writestr("[Content_Types].xml", f'<Types xmlns="{PKG}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>{types}</Types>')
        z.writestr("_rels/.rels", f'<Relationships xmlns="{PKG}/relationships"><Relationship Id="rId1" Type="{REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        listed = "".join(f'<sheet name={quoteattr(t)} sheetId="{k}" r:id="rId{k}" state="{s.get("state", "visible")}"/>' for k, (t, s) in enumerate(sheets.items(), 1))
        defined = "".join(f"<definedName name={quoteattr(n)}>{escape(d)}</definedName>" for n, d in (names or {}).items())
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{REL}"><sheets>{listed}</sheets><definedNames>{defined}</definedNames></workbook>')
        rels = "".join(f'<Relationship Id="rId{k}" Type="{REL}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{PKG}/relationships">{rels}<Relationship Id="rId99" Type="{REL}/styles" Target="styles.xml"/></Relationships>')
        z.writestr("xl/styles.xml", STYLES)
        for k, s in enumerate(sheets.values(), 1):
            rows: dict[int, list[str]] = {}
            for (r, c), v in sorted(s["cells"].items()):
                rows.setdefault(r, []).append(cell_xml(r, c, v, s.get("styles", {}).get((r, c), 0)))
            data = "".join(f'<row r="{r}">{"".join(x)}</row>' for r, x in rows.items())
            merges = "".join(f'<mergeCell ref="{m}"/>' for m in s.get("merges", []))
            z.writestr(f"xl/worksheets/sheet{k}.xml", f'<worksheet xmlns="{MAIN}" xmlns:r="{REL}">{s.get("before", "")}<sheetData>{data}</sheetData>{f"<mergeCells>{merges}</mergeCells>" if merges else ""}{s.get("after", "")}</worksheet>')
        for name, text in (extra or {}).items():
            z.writestr(name, text)
    return out.getvalue()


def write_sample(spark, sf: str) -> str:
    """The nation table as a workbook file; returns its path. It is written
    through Hadoop's file system into the shared folder, if one is set."""
    rows = spark.read.parquet(f"{sf}/nation.parquet").orderBy("n_nationkey").collect()  # a fixed table of 25 rows
    cells: dict = {(1, c): n for c, n in enumerate(("key", "name", "region", "next"), 1)}
    for r, x in enumerate(rows, 2):
        cells |= {(r, 1): x.n_nationkey, (r, 2): x.n_name, (r, 3): x.n_regionkey, (r, 4): (f"=A{r}+1", x.n_nationkey + 1 if r % 2 else None)}
    data = workbook_bytes({"Nations": {"cells": cells, "styles": {k: 2 if k[0] == 1 else 1 for k in cells}}})
    base = spark.conf.get("spark.checkpoint.dir", None) or "file://" + tempfile.mkdtemp(prefix="gridloom-")
    path = f"{base.rstrip('/')}/samples/{Path(sf.rstrip('/')).name}/nations.xlsx"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()
    return path

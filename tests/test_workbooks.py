"""The reader, the extraction and the command line on small workbooks."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from gridloom.api import Settings, extract, formula_signatures, write_bundle
from gridloom.sources import ooxml
from gridloom.sources.ooxml_writer import workbook_bytes


def matrix(top, left, head, body):
    cells = {(top, left + k): h for k, h in enumerate(head)}
    cells |= {(top + 1 + r, left + k): v for r, row in enumerate(body) for k, v in enumerate(row)}
    return cells, {k: 2 if k[0] == top else 1 for k in cells}


@pytest.fixture(scope="module")
def book(tmp_path_factory):
    head = ["KPI", "Actual 2025", "PLAN 2026", "B2027 vs PLAN 2026"]
    body = [["Service rate (%)", 0.628, 0.72, ("=C4-B4", 0.1)], ["FRANCE", None, None, None], ["Cost (M€)", -10.5, 0, ("=Calc!B2", None)], ["TOTAL OPEX", ("=B6", 5), 7, ("=#REF!:#REF!", None)]]
    cells, styles = matrix(3, 1, head, body)
    cells |= {(1, 1): "Copy table below to PowerPoint", (12, 1): "Source: ledger of the year", (5, 8): True}
    after = '<dataValidations><dataValidation type="decimal" sqref="B4:C6 D4"/></dataValidations><conditionalFormatting sqref="B4:D4"><cfRule type="cellIs" priority="1"><formula>0</formula></cfRule></conditionalFormatting>'
    sheets = {
        "Overview": {"cells": cells, "styles": styles, "merges": ["A5:D5"], "before": '<cols><col min="4" max="4" hidden="1" width="9"/></cols>', "after": after},
        "Calc": {"cells": {(1, 1): "x", (2, 2): 145, (3, 3): 45000}, "styles": {(3, 3): 3}, "state": "hidden"},
        "Internal": {"cells": {(1, 1): "Do not edit"}, "state": "veryHidden"},
    }
    path = tmp_path_factory.mktemp("books") / "mini.xlsx"
    path.write_bytes(workbook_bytes(sheets, {"Input": "Calc!$B$2:$C$3", "Broken": "Calc!#REF!", "Moving": "OFFSET(Calc!A1,1,1)", "Const": "0.19"}))
    return str(path)


def test_catalog_names_and_ranges(spark, book):
    got = [(r.position, r.sheet, r.state) for r in ooxml.read_sheets(spark, book).orderBy("position").collect()]
    assert got == [(1, "Overview", "visible"), (2, "Calc", "hidden"), (3, "Internal", "veryHidden")]
    assert {r.name: r.status for r in ooxml.read_names(spark, book).collect()} == {"Input": "static", "Broken": "broken", "Moving": "dynamic_unresolved", "Const": "raw"}
    ranges = ooxml.read(spark, book, "range").collect()
    assert sorted((r.kind, r.ref) for r in ranges) == [("conditional_format", "B4:D4"), ("merge", "A5:D5"), ("validation", "B4:C6"), ("validation", "D4")]
    assert {r.axis: (r["first"], r.hidden) for r in ooxml.read(spark, book, "dimension").collect()} == {"column": (4, True)}


def test_cells_keep_literal_formula_and_cache_apart(spark, book):
    cells = {(r.sheet, r.coord): r for r in ooxml.read_cells(spark, book).collect()}
    d4, d6, d7 = (cells["Overview", x] for x in ("D4", "D6", "D7"))
    assert (d4.formula, d4.cache_status, d4.cache_num, d4.v_num, d4.kind) == ("=C4-B4", "present", 0.1, None, "formula")
    assert (d6.formula, d6.cache_status, d6.cache_num) == ("=Calc!B2", "missing", None)
    assert d7.formula == "=#REF!:#REF!" and cells["Overview", "H5"].v_bool is True
    assert cells["Calc", "C3"].kind == "datetime" and str(cells["Calc", "C3"].v_ts)[:10] == "2023-03-15"
    head, body = cells["Overview", "A3"], cells["Overview", "A4"]
    assert head.bold and head.has_fill and head.border_edges == 4 and not body.bold
    assert body.style_hash == cells["Overview", "B4"].style_hash != head.style_hash
    codes = {r.code for r in ooxml.read(spark, book, "warning").collect()}
    assert "FORMULA_CACHE_MISSING" in codes
    signatures = {(r.row, r.col): r.signature for r in formula_signatures(ooxml.read_cells(spark, book)).collect()}
    assert signatures[4, 4] == "=R[0]C[-1]-R[0]C[-2]"


def test_shared_formulas_move():
    assert ooxml.shift('A1+$B$2+"A1"+Calc!C3:D$4', 2, 1) == 'B3+$B$2+"A1"+Calc!D5:E$4'


def test_extraction(spark, book, tmp_path):
    run = extract(spark, book, visible=True)
    accepted = {(r.sheet, r.range): r for r in run.tables.collect()}
    assert ("Overview", "A3:D7") in accepted
    long = [r for r in run.long.collect() if r.coord.endswith(("4", "6", "7"))]
    by = {r.coord: r for r in long}
    assert by["B4"].scenario == "actual" and by["B4"].year == 2025 and by["B4"].row_label == "Service rate (%)"
    assert by["B6"].section == "FRANCE" and by["C6"].value_state == "zero" and by["B7"].row_role == "total"
    assert {(r.row, r.reason) for r in run.dropped_rows.collect()} >= {(3, "header"), (5, "section")}
    assert any(r.kind == "source_note" and r.table_id for r in run.annotations.collect())
    assert "DEPENDENCY_SHEET_NOT_SELECTED" in {r.code for r in run.warnings.collect()}
    assert {r.sheet for r in run.digests.collect()} == {"Overview"}
    target = write_bundle(spark, run, str(tmp_path / "out"))
    manifest = json.loads((tmp_path / "out/manifest.json").read_text())
    assert manifest["tables"] and manifest["settings_fingerprint"] == Settings().fingerprint
    assert "Content-Security-Policy" in (tmp_path / "out/report.html").read_text()
    again = spark.read.json(f"{target}/records_long.jsonl")
    assert again.count() == run.long.count()
    with pytest.raises(FileExistsError):
        write_bundle(spark, run, target)
    assert not [p for p in tmp_path.iterdir() if p.name.startswith(".")]


def test_bundle_guards(tmp_path):
    from gridloom.plans.export import Bundle

    with pytest.raises(ValueError), Bundle(str(tmp_path / "b")) as out:
        out.json("../x.json", {})
    assert list(tmp_path.iterdir()) == []


def zipped(files, flags=None):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in files:
            z.writestr(name, data)
    return out.getvalue()


@pytest.mark.parametrize("name, data, error", [
    ("a.xls", b"x", ooxml.WorkbookError), ("a.xlsx", b"no zip", ooxml.WorkbookError),
    ("a.xlsx", zipped([("[Content_Types].xml", "<Types/>"), ("../outside.xml", "x")]), ooxml.PackageSecurityError),
    ("a.xlsx", zipped([("[Content_Types].xml", "<Types/>"), ("xl/a.xml", "x"), ("XL/A.xml", "y")]), ooxml.PackageSecurityError),
    ("a.xlsx", zipped([("[Content_Types].xml", "<Types/>"), ("xl/a.xml", "0" * 5_000_000)]), ooxml.PackageSecurityError),
    ("a.xlsx", zipped([("[Content_Types].xml", "<!DOCTYPE x><Types/>"), ("xl/a.xml", "x")]), ooxml.PackageSecurityError),
    ("a.xlsx", zipped([("[Content_Types].xml", "<Types/>")]), ooxml.WorkbookError),
])
def test_bad_packages(name, data, error):
    with pytest.raises(error):
        list(ooxml.Workbook(name, data, ooxml.Limits()).records(True, None))


def test_command_line(spark, book, tmp_path, capsys):
    from gridloom.cli import main

    assert main([book, "--list-sheets"], spark) == 0
    assert "veryHidden" in capsys.readouterr().out
    assert main([book, "--sheet", "Overview", "--output", str(tmp_path / "o")], spark) == 0
    assert (tmp_path / "o/manifest.json").exists()
    assert main([book], spark) == 2
    assert main([book, "--all-sheets", "--table-threshold", "0.2"], spark) == 2
    bad = tmp_path / "bad.xlsx"
    bad.write_bytes(b"nothing")
    assert main([str(bad), "--all-sheets"], spark) == 2


def test_stream_of_workbooks(spark, book, tmp_path):
    import shutil

    from gridloom.streaming import arriving_cells

    (tmp_path / "in").mkdir()
    shutil.copy(book, tmp_path / "in/a.xlsx")
    q = arriving_cells(spark, str(tmp_path / "in")).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).where(F.col("sheet") == "Calc").count() == 3


def banded_book():
    """Two-level headers with merges, section bands, formulas without results,
    a merged row group, and a remark beside a table."""
    heads = ["KPI", "Actual 2025", "F3 2026", "PLAN 2026", "B 2027", "B2027 vs F3 2026", "B2027 vs PLAN 2026"]
    cells = {(1, 2): "Copy table below to PowerPoint", (3, 2): "SERVICE KPIs EVOLUTION", (3, 7): "Δ", (5, 2): "QUALITY OF SERVICE", (9, 2): "COST OF SERVICE"}
    cells |= {(4, 2 + k): h for k, h in enumerate(heads)}
    body = [("Rate (%)", 0.6, 0.7, ("=D6-C6", None), 0.72, ("=F6-D6", 0.02), ("=F6-E6", None)), ("Index", 139, ("=Calc!B2", 145), 150, 155, ("=F7-D7", 10), None), ("Ratio", 0.3, "-", "ns", 0.4, None, None)]
    cells |= {(6 + r, 2 + k): v for r, row in enumerate(body) for k, v in enumerate(row)}
    cells |= {(10, 2 + k): v for k, v in enumerate(("Cost (M€)", -10.5, 0, -8.6, -9.2, ("=F10-D10", 1), ("=F10-E10", 2)))}
    cells |= {(11, 2 + k): v for k, v in enumerate(("TOTAL COST", *[(f"={x}10", None) for x in "CDEFGH"]))}
    cells |= {(14, 2): "Note: results of formulas are left out on purpose."}
    for r in range(3, 12):
        for k in range(2, 9):
            cells.setdefault((r, k), None)
    styles = {k: 2 if k[0] in (3, 4, 5, 9) else 1 for k in cells if 3 <= k[0] <= 11}
    first = {"cells": cells, "styles": styles, "merges": ["B3:F3", "G3:H3", "B5:H5", "B9:H9"], "after": '<dataValidations><dataValidation type="decimal" sqref="C6:F6"/></dataValidations><conditionalFormatting sqref="C6:F6"><cfRule type="cellIs" priority="1"><formula>0</formula></cfRule></conditionalFormatting>', "before": '<cols><col min="4" max="4" hidden="1" width="9"/></cols>'}
    grid = {(3, 2): "BUY & SHARE", (3, 4): "OPEX (M€)", (3, 6): "FTE Average", (5, 2): "BUSINESS OUTSOURCING", (4, 9): "Please ensure details correspond to totals"}
    grid |= {(4, 4 + k): h for k, h in enumerate(["2025", "PLAN 2026"] * 2)}
    for r, label in enumerate(["GRANTING", "SERVICE", "TOTAL"], 5):
        grid |= {(r, 3): label, **{(r, k): (r - 4) * k for k in range(4, 8)}}
    for r in range(3, 8):
        for k in range(2, 8):
            grid.setdefault((r, k), None)
    second = {"cells": grid, "styles": {k: 2 if k[0] < 5 else 1 for k in grid if k[1] < 9}, "merges": ["B3:C3", "D3:E3", "F3:G3", "B5:B7"]}
    return workbook_bytes({"Quality": first, "Matrix": second, "Calc": {"cells": {(2, 2): 145}, "state": "hidden"}}, {"Input": "Quality!$C$6:$F$10", "Broken": "Calc!#REF!"})


@pytest.fixture(scope="module")
def banded(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("banded") / "banded.xlsx"
    path.write_bytes(banded_book())
    return extract(spark, str(path), ["Quality", "Matrix"])


def test_bands_headers_and_titles(banded):
    tables = {r.range: r for r in banded.tables.where("decision = 'accepted'").collect()}
    quality, matrix = tables["B3:H11"], tables["B3:G7"]
    assert (quality.title, quality.header_rows, quality.layout_kind) == ("SERVICE KPIs EVOLUTION", [3, 4], "compound_matrix")
    assert (matrix.title, matrix.header_rows, matrix.layout_kind) == ("BUY & SHARE", [3, 4], "horizontal_compound_matrix")
    columns = {(r.table_id, r.letter): r for r in banded.columns.collect()}
    of = lambda t, letter: columns[t.table_id, letter]
    assert of(quality, "C").path == ["SERVICE KPIs EVOLUTION", "Actual 2025"] and of(quality, "C").role == "measure" and of(quality, "B").role == "row_label"
    assert (of(quality, "G").role, of(quality, "G").comparison_kind, of(quality, "G").path) == ("variance", "variance", ["Δ", "B2027 vs F3 2026"])
    assert (of(matrix, "B").role, of(matrix, "D").path, of(matrix, "D").unit, of(matrix, "F").unit) == ("row_group", ["OPEX (M€)", "2025"], "M€", "FTE")
    assert sorted((r.label, r.min_col, r.max_col) for r in banded.groups.where(F.col("table_id") == matrix.table_id).collect()) == [("FTE Average", 6, 7), ("OPEX (M€)", 4, 5)]
    sections = [(r.title, r.range) for r in banded.sections.where(F.col("table_id") == quality.table_id).orderBy("start_row").collect()]
    assert sections == [("QUALITY OF SERVICE", "B5:H8"), ("COST OF SERVICE", "B9:H11")]
    assert len({r.table_key for r in banded.tables.collect()}) == banded.tables.count()


def test_records_tell_missing_results_from_values(banded):
    got = {r.coord: r for r in banded.long.where("sheet = 'Quality'").collect()}
    assert (got["G6"].value, got["G6"].value_state, got["G6"].formula) == ("0.02", "number", "=F6-D6")
    assert (got["E6"].value, got["E6"].value_state) == (None, "formula_cache_missing")
    assert (got["D7"].value, got["D7"].value_state, got["D10"].value_state) == ("145", "number", "zero")
    assert (got["E8"].value_state, got["D8"].value_state, got["H7"].value_state) == ("ns", "dash", "blank")
    assert (got["C6"].section, got["C10"].section, got["C11"].is_total, got["C6"].scenario, got["C6"].year) == ("QUALITY OF SERVICE", "COST OF SERVICE", True, "actual", 2025)
    group = {r.row: r.row_labels for r in banded.long.where("sheet = 'Matrix'").collect()}
    assert group == {5: ["BUSINESS OUTSOURCING", "GRANTING"], 6: ["BUSINESS OUTSOURCING", "SERVICE"], 7: ["BUSINESS OUTSOURCING", "TOTAL"]}


def test_clean_view(banded):
    tables = {r.sheet: r for r in banded.clean_tables.where("source_range in ('B3:H11', 'B3:G7')").collect()}
    quality, matrix = tables["Quality"], tables["Matrix"]
    assert (quality.status, quality.title, quality.rows, quality.columns, quality.dropped_rows, quality.formula_cells) == ("ready", "SERVICE KPIs EVOLUTION", 5, 7, 4, 13)
    labels = [r.label for r in banded.clean_columns.where(F.col("table_id") == quality.table_id).orderBy("col").collect()]
    assert labels[:3] == ["KPI", "Actual 2025", "F3 2026"] and labels[5] == "Δ | B2027 vs F3 2026"
    assert matrix.inherited_cells == 2 and matrix.title == "BUY & SHARE"
    lent = {r.coord: (r.value, r.source_coord) for r in banded.clean.where("inherited").collect()}
    assert lent == {"B6": ("BUSINESS OUTSOURCING", "B5"), "B7": ("BUSINESS OUTSOURCING", "B5")}
    reasons = sorted((r.row, r.reason) for r in banded.dropped_rows.where(F.col("table_id") == quality.table_id).collect())
    assert reasons == [(3, "header"), (4, "header"), (5, "section"), (9, "section")]
    keys = [r.key for r in banded.clean_columns.where(F.col("table_id") == matrix.table_id).orderBy("col").collect()]
    assert keys == ["entity", "metric", "opex_m_2025", "opex_m_plan_2026", "fte_average_2025", "fte_average_plan_2026"]


def test_snapshots_and_blocks(banded):
    cells = {(r.sheet, r.coord): r for r in banded.cells.collect()}
    c6, d3 = cells["Quality", "C6"], cells["Quality", "D3"]
    assert (c6.validations, c6.conditional_formats, c6.column_hidden) == (["dv0001"], ["cf0001"], False) and cells["Quality", "D6"].column_hidden
    assert (d3.m_row, d3.m_col, d3.a_said) == (3, 2, "SERVICE KPIs EVOLUTION")
    blocks = {r.range: r for r in banded.annotations.collect()}
    assert blocks["I4"].kind == "instruction" and blocks["I4"].table_id and blocks["B14"].kind == "note" and "B1" in blocks
    codes = {r.code for r in banded.warnings.collect()}
    assert {"DEFINED_NAME_BROKEN_REFERENCE", "DEPENDENCY_SHEET_NOT_SELECTED", "FORMULA_CACHE_MISSING"} <= codes
    counts = {r.sheet: r for r in banded.counts.collect()}["Quality"]
    assert (counts.formulas, counts.merges, counts.validated, counts.cached_formulas) == (13, 4, 4, 5)


def test_formula_records(spark, book):
    from gridloom.api import formula_records

    got = {r.coord: r for r in formula_records(ooxml.read_cells(spark, book)).collect()}
    assert (got["D4"].status, got["D4"].signature, got["D4"].operands, got["D4"].cache_status) == ("ok", "=R[0]C[-1]-R[0]C[-2]", ["C4", "B4"], "present")
    assert (got["D7"].status, got["D7"].operands, got["D6"].operands) == ("failed", [], ["Calc!B2"])


def test_translation_to_the_first_cell():
    from gridloom.functions.formulas import translated

    assert translated("=D6-C$6+$B7", 6, 5) == "=#REF!-#REF!+$B2" and translated("=G8*2", 6, 5) == "=C3*2" and translated('="A1"&Calc!F6', 6, 5) == '="A1"&Calc!B1'


def test_selectors_must_match(spark, book):
    from gridloom.selection import SelectionError

    for bad in ({"sheets": ["Nowhere"]}, {"globs": ["Zz*"]}, {"indexes": "1-9"}):
        with pytest.raises(SelectionError):
            extract(spark, book, **bad)


def test_cached_booleans_and_dates(spark, tmp_path):
    from gridloom.api import effective_cells

    data = workbook_bytes({"S": {"cells": {(1, 1): ("=A2>1", 1), (1, 2): ("=TODAY()", 45000), (1, 3): 5}, "styles": {(1, 2): 3}}})
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        files = [(n, z.read(n).replace(b'<c r="A1" s="0">', b'<c r="A1" s="0" t="b">').replace(b"<v>5</v>", b"<v>five</v>")) for n in z.namelist()]
    (tmp_path / "c.xlsx").write_bytes(zipped(files))
    got = {r.coord: r for r in effective_cells(ooxml.read_cells(spark, str(tmp_path / "c.xlsx"))).collect()}
    assert (got["A1"].kind, got["A1"].v_bool, got["B1"].kind, str(got["B1"].v_ts)[:10], got["C1"].kind) == ("boolean", True, "datetime", "2023-03-15", "error")
    assert {r.kind for r in effective_cells(ooxml.read_cells(spark, str(tmp_path / "c.xlsx")), cached=False).where("formula is not null").collect()} == {"formula"}

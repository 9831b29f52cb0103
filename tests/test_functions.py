import pytest
from pyspark.sql import functions as F

from gridloom.functions import formulas, headers, text, values
from gridloom.functions.geometry import Rect, a1, column_letters, column_number
from gridloom.selection import SelectionError, glob_pattern, select_sheets


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_a1(spark):
    got = one(spark, column_letters(F.lit(1)), column_letters(F.lit(26)), column_letters(F.lit(27)), column_letters(F.lit(702)), column_letters(F.lit(703)), column_letters(F.lit(16384)), column_number(F.lit("XFD")), a1(F.lit(7), F.lit(28)))
    assert got == ("A", "Z", "AA", "ZZ", "AAA", "XFD", 16384, "AB7")


@pytest.mark.parametrize("ref, want", [("C5", (5, 3, 5, 3)), ("'a!b'!$D$9:B2", (2, 2, 9, 4)), ("A:C", (1, 1, 1048576, 3)), ("3:5", (3, 1, 5, 16384)), ("#REF!", (None,) * 4), ("A1:B", (None,) * 4)])
def test_parse(spark, ref, want):
    r = Rect.parse(F.lit(ref))
    assert one(spark, r.r1, r.c1, r.r2, r.c2) == want


def test_rectangles(spark):
    a, b = Rect.parse(F.lit("B3:F10")), Rect.parse(F.lit("E8:H12"))
    assert one(spark, a.intersection_area(b), a.union(b).ref, a.intersects(b), a.contains_rect(b), a.distance(b), a.distance(Rect.parse(F.lit("H12")))) == (6, "B3:H12", True, False, 0, 4)


def test_text(spark):
    c = F.lit(" a  b\u001cc\u0085\n")
    assert one(spark, text.normalize_ws(c), text.slug(F.lit("  Straße & Co. ")), text.slug(F.lit("***")), text.csv_guard(F.lit("=1")), text.csv_guard(F.lit("x"))) == ("a b c", "strasse-co", "item", "'=1", "x")
    kinds = [text.noise_kind(F.lit(x)) for x in ("Do not copy", "https://x", "please ensure", "* see below", "Revenue")]
    assert one(spark, *kinds) == ("banner", "source", "instruction", "note", None)


@pytest.mark.parametrize("path, want", [(["OPEX", "Actual 2025"], ("actual", 2025, None)), (["B 2027"], ("budget", 2027, None)), (["B2027 vs F3 2026"], ("comparison", 2027, "variance")), (["PLAN", "2026 %"], ("plan", 2026, None)), (["Δ %"], ("comparison", None, "percentage_variance")), (["F3 2026"], ("forecast", 2026, None)), ([], (None, None, None))])
def test_headers(spark, path, want):
    p = F.array(*[F.lit(x) for x in path]).cast("array<string>")
    assert one(spark, headers.scenario(p), headers.year(p), headers.comparison(p)) == want


def test_units_and_measures(spark):
    p = lambda *x: F.array(*[F.lit(v) for v in x])
    got = one(spark, headers.unit(p("OPEX (M€)"), F.lit(None).cast("string")), headers.unit(p("Rate"), F.lit("in %")), headers.measure(p("FTE Average", "2025"), F.lit("T")), headers.measure(p("2025"), F.lit("T")))
    assert got == ("M€", "%", "FTE Average", "T")


def test_states(spark):
    state = lambda kind, t=None, n=None, f=None, s=None: values.value_state(F.lit(kind), F.lit(t).cast("string"), F.lit(n).cast("double"), F.lit(f).cast("string"), F.lit(s).cast("string"))
    got = one(spark, state("formula", f="=A1", s="missing"), state("blank"), state("boolean"), state("integer", n=0), state("number", n=2), state("text", "–"), state("text", "N/S"), state("text", "XXX"), state("text", "#x"), state("text", "yyyy"))
    assert got == ("formula_cache_missing", "blank", "boolean", "zero", "number", "dash", "ns", "placeholder", "excel_error", "text")


def test_formulas():
    assert formulas.dependencies("=SUM(A1:B2)+'My ''x'!$C$3*LOG10(5)+\"A9\"+A1:B2") == ["A1:B2", "'My ''x'!$C$3"]
    assert formulas.signature('=A1&"A1"+$B$2+Calc!C3', 3, 2) == '=R[-2]C[-1]&"A1"+R2C2+Calc!R[0]C[1]'
    assert formulas.status("=#REF!:#REF!") == "failed" and formulas.dependencies("=#REF!:#REF!") == [] and formulas.status("=A1") == "ok"
    assert formulas.signature("= #REF!:#REF!  ", 1, 1) == "= #REF!:#REF!"


def test_selection(spark):
    import re

    assert re.match(glob_pattern("R?s*"), "Résumé, FR") and not re.match(glob_pattern("r*"), "R") and re.match(glob_pattern("[!a]x"), "bx")
    catalog = spark.createDataFrame([(1, "A", "visible"), (2, "B", "hidden"), (3, "Résumé, FR", "visible"), (4, "D", "veryHidden")], "position int, sheet string, state string")
    names = lambda **k: [r.sheet for r in select_sheets(catalog, **k).collect()]
    assert names(names=["D", "A"]) == ["A", "D"] and names(globs=["R*"]) == ["Résumé, FR"] and names(indexes="2-3, 1") == ["A", "B", "Résumé, FR"]
    assert names(visible=True) == ["A", "Résumé, FR"] and len(names(every=True)) == 4
    for bad in ({}, {"indexes": "3-2"}, {"indexes": "x"}, {"indexes": "0"}, {"every": True, "visible": True}, {"names": ["no"], "strict": True}, {"indexes": "9", "strict": True}, {"every": True, "globs": ["*"], "strict": True}):
        with pytest.raises(SelectionError):
            select_sheets(catalog, **bad)

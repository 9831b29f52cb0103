"""Detection against plain loops: links over gaps, metrics, suppression; and
the size of the plans."""

import random
import re

import pytest
from pyspark.sql import functions as F

from gridloom.plans import detect, structure

STYLE = "workbook string, sheet string, row int, col int, coord string, kind string, v_str string, v_num double, formula string, border_edges int, has_fill boolean, bold boolean, style_hash string, m_row int, m_col int, m_row2 int, m_col2 int, has_validation boolean"


def sheets(seed, n=4, size=14):
    """Cells of random sheets as plain records."""
    rng, out = random.Random(seed), []
    texts = ["Actual 2025", "KPI", "Total", "Please ensure all", "x" * 90, "FTE", "alpha", "  "]
    for k in range(n):
        merges = [(r, c, r, c + 2) for r, c in ((rng.randrange(1, size), rng.randrange(1, size - 2)) for _ in range(2))]
        for r in range(1, size):
            for c in range(1, size):
                if rng.random() < 0.45:
                    kind = rng.choice(["text", "text", "integer", "number", "formula", "blank"])
                    m = next((m for m in merges if m[0] <= r <= m[2] and m[1] <= c <= m[3]), (None,) * 4)
                    out.append(("w", f"s{k}", r, c, f"R{r}C{c}", kind, rng.choice(texts) if kind == "text" else None, 5.0 if kind in ("integer", "number") else None, "=A1" if kind == "formula" else None, rng.choice([0, 0, 0, 4, 2]), rng.random() < 0.1, rng.random() < 0.1, rng.choice([None, "a", "b", "c"]), *m, rng.random() < 0.05))
    return out


def plain(record):
    names = [x.split()[0] for x in STYLE.split(", ")]
    r = dict(zip(names, record, strict=True))
    r["text"] = re.sub(r"\s+", " ", r["v_str"] or "").strip()
    r["number"], r["calc"] = r["kind"] in ("integer", "number"), r["formula"] is not None
    r["content"] = r["kind"] != "blank" or r["calc"]
    r["active"] = r["content"] or r["border_edges"] > 0 or r["m_row"] is not None or r["has_validation"]
    r["prose"] = bool(r["text"]) and (len(r["text"]) >= 80 or re.search(r"please\s+ensure", r["text"], re.I) is not None)
    r["dressed"] = r["has_fill"] or r["bold"] or r["m_row"] is not None
    return r


def belongs(a, b, gap, horizontal):
    if gap <= 0:
        return True
    if a["m_row"] is not None and (a["m_row"], a["m_col"]) == (b["m_row"], b["m_col"]):
        return True
    if a["prose"] or b["prose"]:
        return False
    if (a["style_hash"] and a["style_hash"] == b["style_hash"]) or any(a[k] and b[k] for k in ("border_edges", "has_validation", "calc", "number")):
        return True
    value = lambda x: x["number"] or x["calc"]
    return horizontal and value(a) != value(b) and a["content"] and b["content"] and any(0 < len(x["text"]) <= 80 for x in (a, b))


def boxes(cells):
    """Bounding boxes of a sheet's components, by plain search."""
    cells = [c for c in cells if c["active"]]
    links = {(c["row"], c["col"]): set() for c in cells}
    for axis, line, limit in (("col", "row", 2), ("row", "col", 1)):
        for a in cells:
            after = [b for b in cells if b[line] == a[line] and b[axis] > a[axis]]
            if after:
                b = min(after, key=lambda x: x[axis])
                gap = b[axis] - a[axis] - 1
                if gap <= limit and belongs(a, b, gap, axis == "col"):
                    links[a["row"], a["col"]].add((b["row"], b["col"]))
                    links[b["row"], b["col"]].add((a["row"], a["col"]))
        for a in cells:
            for b in cells:
                if a["m_row"] is not None and (a["m_row"], a["m_col"]) == (b["m_row"], b["m_col"]):
                    links[a["row"], a["col"]].add((b["row"], b["col"]))
    seen, out = set(), set()
    for start in links:
        if start not in seen:
            todo, group = [start], {start}
            while todo:
                for x in links[todo.pop()] - group:
                    group.add(x)
                    todo.append(x)
            seen |= group
            rows, cols = [x for x, _ in group], [x for _, x in group]
            out.add((min(rows), min(cols), max(rows), max(cols)))
    return out


@pytest.fixture(scope="module")
def random_sheets(spark):
    records = sheets(7)
    by = {}
    for r in map(plain, records):
        by.setdefault(r["sheet"], []).append(r)
    return structure.features(spark.createDataFrame(records, STYLE)), by


def test_components_bridge_gaps_by_the_rules(random_sheets):
    f, by = random_sheets
    got = {}
    for r in detect.candidates_from_components(f).collect():
        got.setdefault(r.sheet, set()).add((r.min_row, r.min_col, r.max_row, r.max_col))
    assert got == {s: boxes(cells) for s, cells in by.items()}


def measured(cells, box, tokens):
    """The metrics of one box, cell by cell."""
    r1, c1, r2, c2 = box
    height, width = r2 - r1 + 1, c2 - c1 + 1
    inside = [c for c in cells if c["active"] and r1 <= c["row"] <= r2 and c1 <= c["col"] <= c2]
    content = [c for c in inside if c["content"]]
    rows = {r: [c for c in inside if c["row"] == r] for r in sorted({c["row"] for c in inside})}
    sets = [{c["col"] for c in v} for v in rows.values()]
    pairs = [len(a & b) / len(a | b) for a, b in zip(sets, sets[1:], strict=False)]
    value = lambda c: c["number"] or c["calc"]
    top = [c for c in content if c["row"] <= min(r2, r1 + 4)]
    top_text = [c["text"] for c in top if c["text"]]
    with_values = [v for v in rows.values() if any(map(value, v))]
    axes = [v for v in with_values if any(c["text"] and not c["number"] for c in v) and min(c["col"] for c in v if c["text"] and not c["number"]) < max(c["col"] for c in v if value(c))]
    bands = [v for v in rows.values() if 0 < sum(bool(c["text"]) for c in v) <= 2 and not any(map(value, v)) and any(c["text"] and c["dressed"] for c in v)]
    edge = [c for c in inside if c["row"] in (r1, r2) or c["col"] in (c1, c2)]
    said = [c for c in content if c["text"]]
    return {
        "grid": 0.55 * sum(c["border_edges"] > 0 for c in inside) / len(inside) + 0.45 * sum(min(4, c["border_edges"]) for c in inside) / (4 * len(inside)),
        "header": min(1, 0.6 * sum(bool(tokens.search(t)) for t in top_text) / max(1, len(top_text)) + 0.25 * sum(c["dressed"] for c in top) / max(1, len(top)) + 0.15 * (bool(top_text) and any(c["number"] and c["row"] > r1 + 4 for c in content))),
        "axes": len(axes) / max(1, len(with_values)), "series": sum(sum(map(value, v)) >= 2 for v in with_values) / max(1, len(with_values)),
        "regularity": sum(pairs) / len(pairs) if pairs else min(0.5, len(sets[0]) / max(2, width)),
        "rectangularity": (len(rows) / height * len({c["col"] for c in inside}) / width) ** 0.5 * sum(len(s) / (max(s) - min(s) + 1) for s in sets) / len(sets),
        "boundary": sum(c["border_edges"] > 0 for c in edge) / len(edge) if edge else 0, "section_structure": min(1, len(bands) / max(1, len(rows) * 0.15)), "structural_density": min(1, 2 * len(inside) / (height * width)),
        "prose_only": sum(c["prose"] for c in said) / max(1, len(said)) if sum(map(value, content)) <= 1 else 0, "background_only": float(not content and not any(c["has_validation"] for c in inside)),
        "tiny": float(height * width < 4 or height == 1 or width == 1), "material_cells": len(inside), "content_cells": len(content), "numeric_cells": sum(map(value, content)), "formula_cells": sum(c["calc"] for c in inside),
    }


def test_metrics(random_sheets):
    from gridloom.functions.headers import TOKEN

    f, by = random_sheets
    tokens = re.compile(TOKEN, re.I)
    found = detect.candidates_from_components(f)
    got = detect.score(detect.metrics(f, found)).collect()
    assert len(got) > 10
    for r in got:
        want = measured(by[r.sheet], (r.min_row, r.min_col, r.max_row, r.max_col), tokens)
        assert all(abs(r[k] - v) < 2e-6 for k, v in want.items()), (r, want)
        total = sum(detect.WEIGHTS[k] * r[k] for k in detect.WEIGHTS)
        assert abs(r.confidence - max(0, min(1, total))) < 1e-6
        assert ("label and value axes" in r.reasons) == (r.axes >= 0.55)


def test_suppression(spark):
    rng = random.Random(3)
    rows = []
    for k in range(300):
        r, c = rng.randrange(1, 60), rng.randrange(1, 60)
        rows.append(("w", f"s{k % 2}", f"c{k}", r, c, r + rng.randrange(1, 9), c + rng.randrange(1, 9), [rng.choice("ab")], rng.choice([None, f"n{k}"]), k % 40 == 0, round(rng.random(), 2)))
    schema = "workbook string, sheet string, candidate string, min_row int, min_col int, max_row int, max_col int, methods array<string>, source_name string, forced boolean, confidence double"
    area = lambda b: (b[2] - b[0] + 1) * (b[3] - b[1] + 1)
    want = {}
    for sheet in ("s0", "s1"):
        exact = {}
        for x in sorted((x for x in rows if x[1] == sheet), key=lambda x: (x[3:7], not x[9], -x[10], x[8] or x[2])):
            if x[3:7] in exact:
                e = exact[x[3:7]]
                exact[x[3:7]] = (*e[:7], sorted({*e[7], *x[7]}), e[8] or x[8], e[9] or x[9], max(e[10], x[10]))
            else:
                exact[x[3:7]] = x
        kept = []
        for x in sorted(exact.values(), key=lambda x: (not x[9], -x[10], -area(x[3:7]), x[3:7], x[8] or x[2])):
            for at, k in enumerate(kept):
                a, b = k[3:7], x[3:7]
                both = max(0, min(a[2], b[2]) - max(a[0], b[0]) + 1) * max(0, min(a[3], b[3]) - max(a[1], b[1]) + 1)
                if not both or (k[9] and x[9]):
                    continue
                small, large = sorted((area(a), area(b)))
                inside = both / small >= 0.97
                if both / (small + large - both) >= 0.55 or (inside and (large / small <= 1.35 or (both == area(b) if k[9] else not x[9]))):
                    kept[at] = (*k[:7], sorted({*k[7], *x[7]}), k[8] or x[8], k[9] or x[9], max(k[10], x[10]))
                    break
            else:
                kept.append(x)
        want |= {x[2]: (tuple(x[3:7]), x[7], x[8], x[9], x[10]) for x in kept}
    got = {r.candidate: ((r.min_row, r.min_col, r.max_row, r.max_col), r.methods, r.source_name, r.forced, r.confidence) for r in detect.suppress(spark.createDataFrame(rows, schema)).collect()}
    assert got == want


def test_plans_stay_small(spark, sf, monkeypatch):
    """Structure and clean view: few exchanges in each step, none repeated."""
    from gridloom import queries
    from gridloom.plans import clean

    seen = {}
    real = structure.stored

    def counted(df, name):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        seen[name] = (len(re.findall(r"(?<!Broadcast)Join", plan)), plan.count("Window ["))
        return real(df, name)

    monkeypatch.setattr(structure, "stored", counted)
    monkeypatch.setattr(clean, "stored", counted)
    made = structure.infer(queries.mixed_tables(spark, sf))
    clean.clean(made)
    assert len(seen) <= 20 and sum(j for j, _ in seen.values()) <= 48 and max(w for _, w in seen.values()) <= 6
    assert made.tables.where(F.col("layout").isNull()).count() == 0

"""Table candidates: components, metrics, score, thresholds and suppression.

Cells come as features (see ``structure.features``), one row per cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import Rect
from ..functions.headers import TOKEN
from ..functions.text import is_prose, matches
from ..operators.spatial import cells_in_rects, linked
from .structure import features

KEYS = ["workbook", "sheet"]
SIDES = ["min_row", "min_col", "max_row", "max_col"]
ID = [*KEYS, "candidate"]
ACCEPT, UNCERTAIN = 0.50, 0.35  # fixed values: default thresholds

# Weights of the score.
WEIGHTS = {
    "grid": 0.16, "header": 0.14, "axes": 0.12, "rectangularity": 0.10, "regularity": 0.09, "series": 0.08, "boundary": 0.07, "section_structure": 0.06,
    "structural_density": 0.08, "explicit": 0.18, "named": 0.06, "prose_only": -0.18, "background_only": -0.18, "huge_sparse": -0.12, "tiny": -0.12,
}


# Metrics that give a reason from 0.55 on.
REASONS = {
    "grid": "continuous border/grid scaffold", "header": "header or period/scenario evidence", "axes": "label and value axes", "rectangularity": "rectangular structural occupancy",
    "regularity": "repeated row/column structure", "series": "repeated numeric/formula series", "section_structure": "section-band structure",
}
METRICS = [k for k in WEIGHTS if k not in ("explicit", "named")]


def can_bridge(b: Column, gap: Column, horizontal: bool) -> Column:
    """Whether a cell belongs with ``b``, the one before it, over a gap: never
    across prose; with the same style, borders, rules, formulas or numbers on
    both sides; and in a row from a short label to a value."""
    c = F.col
    same = lambda name: b[name] & c(name)
    merge = (b["m_row"] == c("m_row")) & (b["m_col"] == c("m_col"))
    alike = F.coalesce(b["style_hash"] == c("style_hash"), F.lit(False)) | same("border") | same("validation") | same("calc") | same("number")
    if horizontal:
        short = lambda text: (text != "") & (F.char_length(text) <= 80)
        alike = alike | (((b["number"] | b["calc"]) != (c("number") | c("calc"))) & same("content") & (short(b["text"]) | short(c("text"))))
    return (gap <= 0) | F.coalesce(merge, F.lit(False)) | (~b["prose"] & ~c("prose") & alike)


def evidence(f: DataFrame) -> DataFrame:
    """Features with content (a value or a formula) and prose."""
    return f.withColumn("content", (F.col("kind") != "blank") | F.col("calc")).withColumn("prose", (F.col("text") != "") & is_prose(F.col("text")))


def candidates_from_components(f: DataFrame, horizontal_gap: int = 2, vertical_gap: int = 1) -> DataFrame:
    """Components of structural cells; a merge is one node."""
    c = F.col
    cells = evidence(f).where("structural").select(*KEYS, "row", "col", "text", "number", "calc", "content", "prose", "border", "validation", "style_hash", "m_row", "m_col")
    joins = lambda limit, horizontal: lambda b, gap: (gap <= limit) & can_bridge(b, gap, horizontal)
    found = linked(cells, joins(horizontal_gap, True), joins(vertical_gap, False), F.when(c("m_row").isNotNull(), F.struct("m_row", "m_col")))
    boxes = found.groupBy(*KEYS, "component").agg(F.min("row").alias("min_row"), F.min("col").alias("min_col"), F.max("row").alias("max_row"), F.max("col").alias("max_col"))
    return candidates(boxes, "sparse-component", F.lit(None).cast("string"), False)


def candidates(boxes: DataFrame, method: str, name: Column, forced: bool) -> DataFrame:
    """Candidates from rectangles, found by ``method``."""
    key = F.concat_ws("|", F.lit(method), name, Rect.of().ref)
    return boxes.select(*KEYS, key.alias("candidate"), *SIDES, F.array(F.lit(method)).alias("methods"), name.alias("source_name"), F.lit(forced).alias("forced")).dropDuplicates(ID)


def metrics(f: DataFrame, found: DataFrame, max_area: int = 1_000_000) -> DataFrame:
    """The metrics of each candidate, rounded to six places: one aggregation by
    its rows, one by itself."""
    c, n = F.col, F.count_if
    inside = cells_in_rects(evidence(f).where("structural"), found.select(*ID, *SIDES))
    value, text, merged = c("number") | c("calc"), c("text") != "", c("m_row").isNotNull()
    top = c("row") <= F.least(c("max_row"), c("min_row") + 4)
    edge = c("row").isin(c("min_row"), c("max_row")) | c("col").isin(c("min_col"), c("max_col"))
    dressed = c("styled") | merged
    rows = inside.groupBy(*ID, *SIDES, "row").agg(
        F.count("*").alias("n"), F.collect_set("col").alias("cols"), F.min("col").alias("lo"), F.max("col").alias("hi"), n(value).alias("values"), F.min(F.when(text & ~c("number"), c("col"))).alias("first_text"), F.max(F.when(value, c("col"))).alias("last_value"),
        n(text).alias("texts"), n(text & dressed).alias("dressed"), n("border").alias("bordered"), F.sum(F.least("edges", F.lit(4))).alias("edges"), n("content").alias("content"), n(c("content") & value).alias("numeric"), n("calc").alias("formulas"),
        n(c("content") & text).alias("said"), n(c("content") & text & c("prose")).alias("prose"), n(top & c("content")).alias("top"), n(top & c("content") & text).alias("top_text"), n(top & c("content") & text & matches(c("text"), TOKEN)).alias("top_tokens"),
        n(top & c("content") & dressed).alias("top_dressed"), n(~top & c("content") & c("number")).alias("below"), n(edge).alias("edge"), n(edge & c("border")).alias("bordered_edge"), n(c("validation") | c("noted")).alias("evidence"),
    )
    before = F.lag("cols").over(Window.partitionBy(*ID).orderBy("row"))
    rows = rows.withColumn("before", before)
    jaccard = F.size(F.array_intersect("cols", "before")) / F.size(F.array_union("cols", "before"))
    summed = ["n", "bordered", "edges", "content", "numeric", "formulas", "said", "prose", "top", "top_text", "top_tokens", "top_dressed", "below", "edge", "bordered_edge", "evidence"]
    m = rows.groupBy(*ID, *SIDES).agg(
        F.count("*").alias("rows"), F.avg(F.when(c("before").isNotNull(), jaccard)).alias("jaccard"), F.avg(F.size("cols") / (c("hi") - c("lo") + 1)).alias("filled"), F.size(F.array_distinct(F.flatten(F.collect_set("cols")))).alias("columns"),
        n(c("values") > 0).alias("value_rows"), n((c("values") > 0) & (c("first_text") < c("last_value"))).alias("axis_rows"), n(c("values") >= 2).alias("series_rows"),
        n(c("texts").between(1, 2) & (c("values") == 0) & (c("dressed") > 0)).alias("section_rows"), *[F.sum(x).alias(x) for x in summed],
    )
    m = found.join(m.drop(*SIDES), ID, "left").fillna(0, ["rows", "columns", "value_rows", "axis_rows", "series_rows", "section_rows", *summed]).fillna(0.0, ["jaccard", "filled"])
    r = Rect.of()
    least_one = lambda x: F.greatest(F.lit(1), x)
    flag = lambda x: x.cast("double")
    out = {
        "grid": F.when(c("n") > 0, 0.55 * c("bordered") / c("n") + 0.45 * c("edges") / (4 * c("n"))).otherwise(0.0),
        "header": F.least(F.lit(1.0), 0.60 * c("top_tokens") / least_one(c("top_text")) + 0.25 * c("top_dressed") / least_one(c("top")) + 0.15 * flag((c("top_text") > 0) & (c("below") > 0))),
        "axes": c("axis_rows") / least_one(c("value_rows")),
        "rectangularity": F.sqrt(c("rows") / r.height * c("columns") / r.width) * c("filled"),
        "regularity": F.when(c("rows") == 1, F.least(F.lit(0.5), c("columns") / F.greatest(F.lit(2), r.width))).otherwise(c("jaccard")),
        "series": c("series_rows") / least_one(c("value_rows")),
        "boundary": F.coalesce(F.try_divide(c("bordered_edge"), c("edge")), F.lit(0.0)),
        "section_structure": F.least(F.lit(1.0), c("section_rows") / F.greatest(F.lit(1.0), c("rows") * 0.15)),
        "structural_density": F.least(F.lit(1.0), c("n") / r.area * 2.0),
        "prose_only": F.when(c("numeric") <= 1, c("prose") / least_one(c("said"))).otherwise(0.0),
        "background_only": flag((c("content") == 0) & (c("evidence") == 0)),
        "huge_sparse": flag((r.area > max_area) | ((r.area > 10_000) & (c("n") / r.area < 0.02))),
        "tiny": flag((r.area < 4) | (r.width == 1) | (r.height == 1)),
    }
    counts = [c(x).cast("double").alias(y) for x, y in (("n", "material_cells"), ("content", "content_cells"), ("formulas", "formula_cells"), ("numeric", "numeric_cells"))]
    return m.select(*found.columns, *[F.round(x, 6).alias(k) for k, x in out.items()], *counts)


def score(measured: DataFrame) -> DataFrame:
    """confidence: the weighted sum within 0 to 1, 0.98 at least for forced
    ranges; and the reasons for it."""
    c = F.col
    marked = measured.withColumn("explicit", F.array_contains("methods", "explicit-range").cast("double")).withColumn("named", F.array_contains("methods", "named-range").cast("double"))
    total = sum((c(k) * w for k, w in WEIGHTS.items()), F.lit(0.0))
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), total))
    reasons = F.array_compact(F.array(
        *[F.when(c(k) >= 0.55, text) for k, text in REASONS.items()], F.when(c("prose_only") >= 0.5, "annotation-like prose dominates"), F.when(c("background_only") > 0, "style/background evidence without content"),
        F.when(c("huge_sparse") > 0, "oversized or very sparse range"), F.when(c("forced"), "forced native range"),
    ))
    return marked.withColumn("confidence", F.round(F.when(c("forced"), F.greatest(clamped, F.lit(0.98))).otherwise(clamped), 6)).withColumn("reasons", reasons)


def split(scored: DataFrame, accept: float = ACCEPT, uncertain: float = UNCERTAIN) -> DataFrame:
    """Adds decision: accepted, uncertain or rejected."""
    c = F.col("confidence")
    return scored.withColumn("decision", F.when(c >= accept, "accepted").when(c >= uncertain, "uncertain").otherwise("rejected"))


def suppress(scored: DataFrame) -> DataFrame:
    """Greedy suppression in rank order per sheet: forced, confidence, area,
    position. Equal ranges become one; a candidate falls to the first kept one
    that overlaps it enough, and lends it methods, reasons, the higher
    confidence and metrics, and a name; two forced ranges both stay. Only
    candidates, a few per sheet, are grouped."""
    largest = [k for k in (*METRICS, "explicit", "named", "material_cells", "content_cells", "formula_cells", "numeric_cells") if k in scored.columns]

    def fold(kept: dict, row: dict) -> None:
        for name in ("methods", "reasons"):
            if name in row:
                kept[name] = [*kept[name], *[x for x in row[name] if x not in kept[name]]]
        for name in ("confidence", "forced", *largest):
            kept[name] = max(kept[name], row[name])
        if "source_name" in row:
            kept["source_name"] = kept["source_name"] or row["source_name"]

    def run(table):
        import pyarrow as pa

        rows = table.to_pylist()
        place = lambda r: tuple(r[k] for k in SIDES)
        name = lambda r: r.get("source_name") or r["candidate"]
        exact: dict[tuple, dict] = {}
        for row in sorted(rows, key=lambda r: (place(r), not r["forced"], -r["confidence"], name(r))):
            row["area"] = (row["max_row"] - row["min_row"] + 1) * (row["max_col"] - row["min_col"] + 1)
            if place(row) in exact:
                fold(exact[place(row)], row)
            else:
                exact[place(row)] = row
        # kept ones by bands of rows and columns, so that only near ones are compared
        kept: list[dict] = []
        bands: dict[tuple, list[int]] = {}
        for row in sorted(exact.values(), key=lambda r: (not r["forced"], -r["confidence"], -r["area"], place(r), name(r))):
            touched = [(a, b) for a in range(row["min_row"] // 256, row["max_row"] // 256 + 1) for b in range(row["min_col"] // 64, row["max_col"] // 64 + 1)]
            over = next((kept[k] for k in sorted({k for t in touched for k in bands.get(t, ())}) if _absorbs(kept[k], row)), None)
            if over is None:
                for t in touched:
                    bands.setdefault(t, []).append(len(kept))
                kept.append(row)
            else:
                fold(over, row)
        for row in kept:
            del row["area"]
            if "methods" in row:
                row["methods"] = sorted(row["methods"])
        return pa.Table.from_pylist(kept, schema=table.schema)

    return scored.groupBy(*KEYS).applyInArrow(run, scored.schema)


def _absorbs(kept: dict, row: dict) -> bool:
    if kept["forced"] and row["forced"]:
        return False
    rows = min(kept["max_row"], row["max_row"]) - max(kept["min_row"], row["min_row"]) + 1
    cols = min(kept["max_col"], row["max_col"]) - max(kept["min_col"], row["min_col"]) + 1
    both = max(rows, 0) * max(cols, 0)
    if not both:
        return False
    iou = both / (kept["area"] + row["area"] - both)
    inside = both / min(kept["area"], row["area"])
    if iou >= 0.55:
        return True
    if inside >= 0.97:
        if max(kept["area"], row["area"]) / min(kept["area"], row["area"]) <= 1.35:
            return True
        if kept["forced"]:
            return both == row["area"]
        return not row["forced"]
    return False


def snap_to_merges(candidates: DataFrame, merges: DataFrame, max_area: int = 1_000_000) -> DataFrame:
    """Grows each candidate over the merges it cuts, until nothing changes.
    Merges are taken by position, and one that would exceed the area is left
    out alone. Candidates and merges of one sheet are grouped."""
    sides = ["min_row", "min_col", "max_row", "max_col"]
    own = [f"merge_{n}" for n in (*KEYS, *sides)]

    def run(found, merged):
        import numpy as np
        import pyarrow as pa

        table = lambda t, names: np.stack([t.column(n).to_numpy() for n in names], axis=1).astype(np.int64)
        m = table(merged, own[2:])
        m = m[np.lexsort(m.T[::-1])]
        grown = np.array([_snapped(box, m, max_area) for box in table(found, sides)], np.int64).reshape(-1, 4)
        for k, n in enumerate(sides):
            at = found.schema.get_field_index(n)
            found = found.set_column(at, n, pa.array(grown[:, k], found.schema.field(at).type))
        return found

    # names of their own: both sides may come from one table
    merges = merges.select(*[F.col(n).alias(m) for n, m in zip([*KEYS, *sides], own, strict=True)])
    return candidates.groupBy(*KEYS).cogroup(merges.groupBy(*own[:2])).applyInArrow(run, candidates.schema)


def _snapped(box, merges, max_area: int):
    """The box (four sides) after its sheet's merges (rows of four sides)."""
    import numpy as np

    def cut(b, m):
        meets = (m[:, 0] <= b[2]) & (m[:, 2] >= b[0]) & (m[:, 1] <= b[3]) & (m[:, 3] >= b[1])
        return meets & ~((m[:, 0] >= b[0]) & (m[:, 2] <= b[2]) & (m[:, 1] >= b[1]) & (m[:, 3] <= b[3]))

    def union(b, m):
        return np.concatenate((np.minimum(b[:2], m[..., :2].reshape(-1, 2).min(axis=0)), np.maximum(b[2:], m[..., 2:].reshape(-1, 2).max(axis=0))))

    area = lambda b: (b[..., 2] - b[..., 0] + 1) * (b[..., 3] - b[..., 1] + 1)
    # all cut merges at once: where the end fits, the order does not matter
    whole = box
    while (hit := cut(whole, merges)).any():
        whole = union(whole, merges[hit])
    if (whole == box).all() or area(whole) <= max_area:
        return whole
    changed = True
    while changed:
        changed, at = False, 0
        while at < len(merges):
            rest = merges[at:]
            joined = np.concatenate((np.minimum(box[:2], rest[:, :2]), np.maximum(box[2:], rest[:, 2:])), axis=1)
            fits = np.flatnonzero(cut(box, rest) & (area(joined) <= max_area))
            if not len(fits):
                break
            box, changed, at = joined[fits[0]], True, at + int(fits[0]) + 1
    return box


def detect_tables(cells: DataFrame, extra: DataFrame | None = None, merges: DataFrame | None = None, accept: float = ACCEPT, uncertain: float = UNCERTAIN, max_area: int = 1_000_000, gaps: tuple[int, int] = (2, 1)) -> DataFrame:
    """The candidates of all sheets with metrics, confidence, reasons and
    decision; forced ones are always accepted."""
    from ..storage import stored

    f = stored(features(cells), "sheet-features")
    found = candidates_from_components(f, *gaps)
    if extra is not None:
        found = found.unionByName(extra)
    if merges is not None:
        # a declared range may be larger than the limit of found ones
        declared = found.where("forced")
        found = snap_to_merges(found.where("not forced"), merges, max_area).unionByName(snap_to_merges(declared, merges, 1 << 40))
    scored = score(metrics(f, stored(found, "found"), max_area))
    out = split(suppress(scored), accept, uncertain)
    return out.withColumn("decision", F.when(F.col("forced"), "accepted").otherwise(F.col("decision")))

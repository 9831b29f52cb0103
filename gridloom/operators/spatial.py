"""Joins of cells with rectangles, as equality joins.

A condition with four inequalities would plan as a nested loop. Rectangles are
instead cut into bands of ``band`` rows, and cells carry the band they are in,
so that the join is an equality on (workbook, sheet, band) with the exact test
as a residual: a rectangle repeats once per band it touches, a cell never.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from ..functions.geometry import Rect

KEYS = ("workbook", "sheet")
BAND = 64


def banded(rects: DataFrame, band: int = BAND) -> DataFrame:
    bands = F.sequence(F.floor(F.col("min_row") / band), F.floor(F.col("max_row") / band))
    return rects.withColumn("band", F.explode(bands))


def cells_in_rects(cells: DataFrame, rects: DataFrame, how: str = "inner", band: int = BAND) -> DataFrame:
    """Cells joined with the rectangles that contain them. ``rects`` has the
    keys, min_row, min_col, max_row, max_col, and other columns of its own.
    ``how``: inner, left, left_semi or left_anti."""
    c = cells.withColumn("band", F.floor(F.col("row") / band)).alias("c")
    r = banded(rects, band).alias("r")
    on = [F.col(f"c.{k}") == F.col(f"r.{k}") for k in (*KEYS, "band")] + [Rect.of(alias="r").contains(F.col("c.row"), F.col("c.col"))]
    condition = on[0]
    for x in on[1:]:
        condition = condition & x
    out = c.join(r, condition, how)
    if how in ("left_semi", "left_anti"):
        return out.drop("band")
    return out.select(*[F.col(f"c.{n}") for n in cells.columns], *[F.col(f"r.{n}") for n in rects.columns if n not in KEYS])


def resolve_merges(cells: DataFrame, merges: DataFrame) -> DataFrame:
    """Each cell with its merge's range and anchor, is_anchor, and the value of
    the anchor (its own outside merges)."""
    joined = cells_in_rects(cells, merges.select(*KEYS, *Rect.of().columns()), "left")
    anchor = cells.select(*KEYS, F.col("row").alias("min_row"), F.col("col").alias("min_col"), F.col("v_str").alias("anchor_str"), F.col("v_num").alias("anchor_num"), F.col("kind").alias("anchor_kind"))
    inside = F.col("min_row").isNotNull()
    out = joined.join(anchor, [*KEYS, "min_row", "min_col"], "left")
    return out.select(
        *cells.columns, F.when(inside, Rect.of().ref).alias("merge_ref"), (inside & (F.col("row") == F.col("min_row")) & (F.col("col") == F.col("min_col"))).alias("is_anchor"),
        F.when(inside, F.col("anchor_str")).otherwise(F.col("v_str")).alias("resolved_str"), F.when(inside, F.col("anchor_num")).otherwise(F.col("v_num")).alias("resolved_num"),
    )


def memberships(cells: DataFrame, ranges: DataFrame, name: str) -> DataFrame:
    """Sorted names of all ranges that contain each cell; cells in none have
    an empty array."""
    found = cells_in_rects(cells.select(*KEYS, "row", "col"), ranges.select(*KEYS, name, *Rect.of().columns()))
    lists = found.groupBy(*KEYS, "row", "col").agg(F.array_sort(F.collect_set(name)).alias("members"))
    return cells.join(lists, [*KEYS, "row", "col"], "left").withColumn("members", F.coalesce("members", F.array().cast("array<string>")))


def smallest_containing(cells: DataFrame, rects: DataFrame, name: str) -> DataFrame:
    """For each cell the containing rectangle of least area (ties: position)."""
    found = cells_in_rects(cells.select(*KEYS, "row", "col"), rects)
    rank = F.struct(Rect.of().area, F.col("min_row"), F.col("min_col"), F.col(name))
    return found.groupBy(*KEYS, "row", "col").agg(F.min_by(name, rank).alias(name))


def hidden_cells(cells: DataFrame, rows: DataFrame, column_spans: DataFrame) -> DataFrame:
    """row_hidden by equality on the row; column_hidden by the spans, of which
    a sheet has a few."""
    out = cells.join(rows.where("hidden").select(*KEYS, "row").distinct().withColumn("row_hidden", F.lit(True)), [*KEYS, "row"], "left")
    one = column_spans.where("hidden").select(*KEYS, F.explode(F.sequence("min_col", "max_col")).alias("col")).distinct().withColumn("column_hidden", F.lit(True))
    out = out.join(one, [*KEYS, "col"], "left")
    return out.select(*cells.columns, F.coalesce("row_hidden", F.lit(False)).alias("row_hidden"), F.coalesce("column_hidden", F.lit(False)).alias("column_hidden"))


def nearest(left: DataFrame, right: DataFrame, left_id: str, right_id: str) -> DataFrame:
    """For each left rectangle (all of one id together) the nearest right one
    of its sheet; ties by the right one's corners, row first, then its id. Each
    sheet, whose size the file format bounds, searches a tree of boxes: pairs
    of rectangles are never made, and memory follows the sheet's rectangles."""
    corners = Rect.of().columns()
    known = F.col("workbook").isNotNull() & F.col("sheet").isNotNull()
    a, b = (x.where(known).select(*KEYS, F.col(n).alias("id"), *corners) for x, n in ((left, left_id), (right, right_id)))
    distance = a.alias("a").crossJoin(b.alias("b")).select(Rect.of(alias="a").distance(Rect.of(alias="b")).alias("d")).schema["d"].dataType
    kinds = {"workbook": left.schema["workbook"], "sheet": left.schema["sheet"], left_id: left.schema[left_id], right_id: right.schema[right_id]}
    schema = StructType([*(StructField(n, f.dataType) for n, f in kinds.items()), StructField("distance", distance)])

    def search(own, others):
        import pyarrow as pa

        from ..functions.boxes import Boxes, corners_of

        # an empty side has no rows
        if not own.num_rows or not others.num_rows:
            return pa.table({n: pa.array([]) for n in schema.names}).cast(arrow)
        others = others.sort_by([(n, "ascending") for n in ("min_row", "min_col", "max_row", "max_col", "id")])
        at, d = Boxes(corners_of(others)).nearest(corners_of(own))
        found = pa.table({"workbook": own.column("workbook"), "sheet": own.column("sheet"), "id": own.column("id"), "d": d, "at": at})
        # the best of all rectangles of an id
        found = found.sort_by([("d", "ascending"), ("at", "ascending")])
        first = np.unique(found.column("id").combine_chunks().dictionary_encode("encode").indices.to_numpy(), return_index=True)[1]
        found = found.take(pa.array(first))
        return pa.table([found.column("workbook"), found.column("sheet"), found.column("id"), others.column("id").take(found.column("at")), found.column("d")], names=schema.names).cast(arrow)

    arrow = to_arrow_schema(schema)
    return a.groupBy(*KEYS).cogroup(b.groupBy(*KEYS)).applyInArrow(search, schema)


def overlap_pairs(rects: DataFrame, name: str, band: int = BAND) -> DataFrame:
    """Pairs (left < right) of rectangles that intersect, with IoU. Both sides
    are cut into bands; the band of the later first row reports the pair."""
    a, b = banded(rects, band).alias("a"), banded(rects, band).alias("b")
    ra, rb = Rect.of(alias="a"), Rect.of(alias="b")
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in (*KEYS, "band")]
    once = F.col("a.band") == F.floor(F.greatest(ra.r1, rb.r1) / band)
    pairs = a.join(b, same[0] & same[1] & same[2] & (F.col(f"a.{name}") < F.col(f"b.{name}")) & ra.intersects(rb) & once)
    return pairs.select(*[F.col(f"a.{k}") for k in KEYS], F.col(f"a.{name}").alias("left_id"), F.col(f"b.{name}").alias("right_id"), F.round(ra.iou(rb), 6).alias("iou"))


def weak_style_cells(strong: DataFrame, weak: DataFrame) -> DataFrame:
    """Weak cells that are strong themselves or touch a strong one."""
    steps = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in ((0, 0), (1, 0), (-1, 0), (0, 1), (0, -1))])
    around = strong.select(*KEYS, "row", "col", F.explode(steps).alias("s")).select(*KEYS, (F.col("row") + F.col("s.r")).alias("row"), (F.col("col") + F.col("s.c")).alias("col")).distinct()
    return weak.join(around, [*KEYS, "row", "col"], "left_semi")


def materialise(rects: DataFrame, limit: int) -> DataFrame:
    """The cells of rectangles whose area is within ``limit``."""
    rows = rects.where((Rect.of().area <= limit) & ~Rect.of().is_full_axis).withColumn("row", F.explode(F.sequence("min_row", "max_row")))
    return rows.select(*KEYS, "row", F.explode(F.sequence("min_col", "max_col")).alias("col")).distinct()


def gap_edges(cells: DataFrame, axis: str, limit: int) -> DataFrame:
    """Neighbouring active cells of a row (or column) at most ``limit`` empty
    cells apart, with the gap."""
    line, step = ("row", "col") if axis == "horizontal" else ("col", "row")
    w = Window.partitionBy(*KEYS, line).orderBy(step)
    nxt = F.lead(step).over(w)
    return cells.withColumn("next", nxt).withColumn("gap", F.col("next") - F.col(step) - 1).where(F.col("gap") <= limit).select(*KEYS, "row", "col", F.lit(axis).alias("axis"), "next", "gap")


def row_runs(cells: DataFrame, gap: int = 0) -> DataFrame:
    """Maximal runs of cells of a row with at most ``gap`` empty ones between:
    far fewer than cells, so that components work on runs."""
    w = Window.partitionBy(*KEYS, "row").orderBy("col")
    new = F.coalesce((F.col("col") - F.lag("col").over(w) > gap + 1).cast("int"), F.lit(1))
    ids = cells.select(*KEYS, "row", "col").withColumn("run", F.sum(new).over(w))
    return ids.groupBy(*KEYS, "row", "run").agg(F.min("col").alias("min_col"), F.max("col").alias("max_col"), F.count("*").alias("cells"))


def components(cells: DataFrame, horizontal_gap: int = 0, vertical_gap: int = 0) -> DataFrame:
    """Bounding box and size of each connected component of cells. Runs are
    joined by a union-find per sheet, whose size the file format bounds; only
    runs enter the group, never cells."""
    runs = row_runs(cells, horizontal_gap)

    def solve(key, pdf):
        import pandas as pd

        pdf = pdf.sort_values(["row", "min_col"]).reset_index(drop=True)
        root = list(range(len(pdf)))

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        by_row = {r: g.index.tolist() for r, g in pdf.groupby("row")}
        lo, hi = pdf["min_col"].tolist(), pdf["max_col"].tolist()
        for r, mine in by_row.items():
            for step in range(1, vertical_gap + 2):
                other, j = by_row.get(r + step, []), 0
                for i in mine:
                    while j < len(other) and hi[other[j]] < lo[i]:
                        j += 1
                    k = j
                    while k < len(other) and lo[other[k]] <= hi[i]:
                        a, b = find(i), find(other[k])
                        root[max(a, b)] = min(a, b)
                        k += 1
        pdf["root"] = [find(x) for x in range(len(pdf))]
        out = pdf.groupby("root").agg(min_row=("row", "min"), min_col=("min_col", "min"), max_row=("row", "max"), max_col=("max_col", "max"), cells=("cells", "sum")).reset_index(drop=True)
        return pd.concat([pd.DataFrame({"workbook": key[0], "sheet": key[1]}, index=out.index), out], axis=1)

    return runs.groupBy(*KEYS).applyInPandas(solve, "workbook string, sheet string, min_row int, min_col int, max_row int, max_col int, cells long")


def linked(cells: DataFrame, horizontal, vertical, together: Column | None = None) -> DataFrame:
    """Adds component to cells: cells are linked to the one before them in
    their row or column where ``horizontal(before, gap)`` or ``vertical(before,
    gap)`` holds (``before`` is that cell, ``gap`` the empty cells between),
    and to all cells with the same value of ``together``.

    Rows are first cut into runs; a union-find per sheet sees the distinct
    links between runs, never cells."""
    c = F.col
    before = lambda order, *by: F.lag(F.struct(*cells.columns)).over(Window.partitionBy(*KEYS, *by).orderBy(order))
    marked = cells.withColumn("b", before("col", "row"))
    joins = F.coalesce(horizontal(c("b"), c("col") - c("b.col") - 1), F.lit(False))
    marked = marked.withColumn("run", F.sum((~joins).cast("int")).over(Window.partitionBy(*KEYS, "row").orderBy("col")).cast("int")).drop("b")
    above = F.lag(F.struct(*cells.columns, "run")).over(Window.partitionBy(*KEYS, "col").orderBy("row"))
    down = marked.withColumn("b", above).where(F.coalesce(vertical(c("b"), c("row") - c("b.row") - 1), F.lit(False)))
    edges = down.select(*KEYS, "row", "run", c("b.row").alias("row2"), c("b.run").alias("run2"))
    if together is not None:
        first = F.min(F.struct("row", "run")).over(Window.partitionBy(*KEYS, "group"))
        same = marked.withColumn("group", together).where(c("group").isNotNull()).withColumn("first", first)
        edges = edges.unionByName(same.select(*KEYS, "row", "run", c("first.row").alias("row2"), c("first.run").alias("run2")))
    edges = edges.where("row <> row2 or run <> run2").distinct()
    runs = marked.select(*KEYS, "row", "run").distinct()
    names = [f"e_{k}" for k in KEYS]
    ends = ("row", "run", "row2", "run2")
    edges = edges.select(*[c(k).alias(n) for k, n in zip((*KEYS, *ends), (*names, *[f"e_{n}" for n in ends]), strict=True)])

    def solve(key, own, links):
        import pyarrow as pa

        nodes = list(zip(own.column("row").to_pylist(), own.column("run").to_pylist(), strict=True))
        root = {n: n for n in nodes}

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for r, k, r2, k2 in zip(*(links.column(f"e_{n}").to_pylist() for n in ends), strict=True):
            a, b = find((r, k)), find((r2, k2))
            root[max(a, b)] = min(a, b)
        names = ["{}:{}".format(*find(n)) for n in nodes]
        return own.append_column("component", pa.array(names, pa.string()))

    schema = runs.schema.simpleString()[7:-1].replace(":", " ") + ", component string"
    runs = runs.select(*[c(n).alias(f"r_{n}") for n in runs.columns])
    found = runs.toDF(*[n[2:] for n in runs.columns]).groupBy(*KEYS).cogroup(edges.groupBy(*names)).applyInArrow(solve, schema)
    return marked.join(found, [*KEYS, "row", "run"]).drop("run")


def content_bounds(cells: DataFrame, condition: Column) -> DataFrame:
    return cells.where(condition).groupBy(*KEYS).agg(F.min("row").alias("min_row"), F.min("col").alias("min_col"), F.max("row").alias("max_row"), F.max("col").alias("max_col"))

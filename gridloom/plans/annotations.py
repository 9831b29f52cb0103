"""Texts outside of tables: their kind and the nearest table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import Rect
from ..functions.text import BLOCK_INSTRUCTION, BLOCK_SOURCE, NOTE_ROW, matches
from ..operators.spatial import cells_in_rects, linked, nearest

KEYS = ["workbook", "sheet"]
#: Empty cells that a block may skip, in a row and in a column (fixed values).
GAPS = (6, 1)


def annotation_kind(texts: Column, styled: Column) -> Column:
    """source_note, instruction, note, title or annotation; first match wins."""
    said = F.array_join(texts, " | ")
    long = F.exists(texts, lambda t: F.char_length(t) >= 80)
    one = (F.size(texts) == 1) & (F.char_length(F.get(texts, F.lit(0))) <= 80)
    return (
        F.when(matches(said, BLOCK_SOURCE), "source_note").when(matches(said, BLOCK_INSTRUCTION), "instruction").when(matches(said, NOTE_ROW) | long, "note")
        .when(one & styled, "title").otherwise("annotation")
    )


def annotate(f: DataFrame, tables: DataFrame, rejected: DataFrame) -> DataFrame:
    """Blocks of text, comments and links outside of tables, each with its
    texts, kind and nearest table: first the rejected regions, whole; what is
    left in groups of near cells. ``f`` are features of sheets."""
    c = F.col
    plain = F.when(c("text") != "", c("text")).when(c("comment"), F.concat(F.lit("[comment at "), c("coord"), F.lit("]"))).when(c("noted"), F.concat(F.lit("[hyperlink at "), c("coord"), F.lit("]")))
    cells = f.select(*KEYS, "row", "col", plain.alias("says"), "styled")
    outside = cells_in_rects(cells, tables.select(*KEYS, *Rect.of().columns()), "left_anti")
    regions = rejected.select(*KEYS, *Rect.of().columns()).distinct().withColumn("block", F.concat(F.lit("region "), Rect.of().ref))
    held = cells_in_rects(outside, regions)
    rest = cells_in_rects(outside.where("says is not null"), regions.select(*KEYS, *Rect.of().columns()), "left_anti")
    grouped = linked(rest, lambda b, gap: gap <= GAPS[0], lambda b, gap: gap <= GAPS[1])
    boxes = grouped.groupBy(*KEYS, "component").agg(F.min("row").alias("min_row"), F.min("col").alias("min_col"), F.max("row").alias("max_row"), F.max("col").alias("max_col"))
    grouped = grouped.join(boxes, [*KEYS, "component"]).withColumn("block", F.concat(F.lit("group "), "component"))
    every = held.unionByName(grouped.drop("component"))
    ordered = F.array_sort(F.collect_list(F.when(c("says").isNotNull(), F.struct("row", "col", "says"))))["says"]
    said = every.groupBy(*KEYS, "block", *[c(n) for n in ("min_row", "min_col", "max_row", "max_col")]).agg(F.array_distinct(ordered).alias("texts"), F.bool_or("styled").alias("styled")).where(F.size("texts") > 0)
    near = nearest(said.select(*KEYS, "block", *Rect.of().columns()), tables.select(*KEYS, "table_id", *Rect.of().columns()), "block", "table_id")
    out = said.join(near, [*KEYS, "block"], "left")
    return out.select(*KEYS, Rect.of().ref.alias("range"), *Rect.of().columns(), F.array_join("texts", " ").alias("text"), "texts", annotation_kind(c("texts"), c("styled")).alias("kind"), "table_id", "distance")

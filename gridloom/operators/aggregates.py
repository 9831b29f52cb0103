"""Counters, statistics, digests and warnings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import NUMERIC_KINDS

KEYS = ("workbook", "sheet")


def sheet_counts(cells: DataFrame) -> DataFrame:
    """Counters of each sheet; of evidence that cells lack there is none."""
    has = set(cells.columns)
    n = lambda c: F.count_if(c)
    flag = lambda name: n(F.col(name)) if name in has else F.lit(0).cast("long")
    kind = lambda *names: n(F.col("kind").isin(*names))
    formula = F.col("formula").isNotNull()
    cache = (lambda state: n(formula & (F.col("cache_status") == state))) if "cache_status" in has else lambda state: F.lit(0).cast("long")
    merged = F.col("m_row").isNotNull() if "m_row" in has else F.lit(False)
    anchor = merged & (F.col("m_row") == F.col("row")) & (F.col("m_col") == F.col("col")) if "m_row" in has else F.lit(False)
    return cells.groupBy(*KEYS).agg(
        F.count("*").alias("cells"), n(F.col("kind") != "blank").alias("values"), n(formula).alias("formulas"), n(F.col("border_edges") > 0).alias("bordered"), n(F.col("has_fill")).alias("filled"), kind(*NUMERIC_KINDS).alias("numeric"),
        F.max("row").alias("last_row"), F.max("col").alias("last_col"), kind("text").alias("texts"), kind("boolean").alias("booleans"), kind("datetime").alias("datetimes"), kind("error").alias("errors"), kind("blank").alias("blanks"), n(F.col("bold")).alias("bold"),
        cache("present").alias("cached_formulas"), cache("missing").alias("uncached_formulas"), n(merged).alias("merged_cells"), n(anchor).alias("merges"), flag("has_validation").alias("validated"), flag("has_conditional_format").alias("conditional"),
        flag("has_comment").alias("comments"), flag("has_hyperlink").alias("hyperlinks"), flag("row_hidden").alias("in_hidden_rows"), flag("column_hidden").alias("in_hidden_columns"), F.countDistinct("style_hash").alias("styles"),
    )


def row_stats(cells: DataFrame) -> DataFrame:
    value = F.col("kind").isin(*NUMERIC_KINDS) | F.col("formula").isNotNull()
    return cells.groupBy(*KEYS, "row").agg(
        F.count_if(value).alias("values"), F.size(F.collect_set(F.when(F.col("kind") == "text", F.col("v_str")))).alias("texts"), F.count_if(F.col("border_edges") > 0).alias("bordered"), F.count_if(F.col("bold")).alias("styled"),
        F.min_by("v_str", F.when(F.col("kind") == "text", F.col("col"))).alias("first_text"), F.count("*").alias("cells"),
    )


#: Rows of a block of a digest.
BLOCK = 4096


def digest(cells: DataFrame, payload: Column, keys: list[str], order: list[str], row: str = "row") -> DataFrame:
    """SHA-256 over cells in order, in three levels (rows, blocks of BLOCK row
    numbers, all), so that no aggregation state holds more than one row's text,
    one block's hashes or the blocks' hashes."""
    return digests(cells, {"digest": payload}, keys, order, row)


def digests(cells: DataFrame, payloads: dict[str, Column], keys: list[str], order: list[str], row: str = "row") -> DataFrame:
    """Several digests in one pass; cells without a payload don't count."""
    c = F.col
    listed = lambda p: F.array_sort(F.collect_list(F.when(p.isNotNull(), F.struct(*[c(o) for o in order], p.alias("p")))))["p"]
    hashed = lambda x: F.sha2(F.array_join(x, "\n"), 256)
    rows = cells.groupBy(*keys, row).agg(*[hashed(listed(p)).alias(n) for n, p in payloads.items()])
    up = lambda df, by, at: df.groupBy(*by).agg(*[hashed(F.array_sort(F.collect_list(F.struct(at, n)))[n]).alias(n) for n in payloads])
    blocks = up(rows.withColumn("__block", F.floor(c(row) / BLOCK)), [*keys, "__block"], row)
    return up(blocks, keys, "__block")


def workbook_digest(sheets: DataFrame) -> DataFrame:
    """structure and content of each workbook from its sheets' digests."""
    lists = lambda *names: F.sha2(F.to_json(F.array_sort(F.collect_list(F.struct("sheet", *names)))), 256)
    return sheets.groupBy("workbook").agg(lists("formula", "layout", "style").alias("structure"), lists("content").alias("content"))


def reconcile(raw: DataFrame, sheet: DataFrame, keys: list[str], formula: str = "formula") -> DataFrame:
    """Where two catalogues of formulas agree: both, different, raw_only or
    sheet_only, by key."""
    a, b = raw.select(*keys, F.col(formula).alias("a")), sheet.select(*keys, F.col(formula).alias("b"))
    side = F.when(F.col("b").isNull(), "raw_only").when(F.col("a").isNull(), "sheet_only").when(F.col("a") == F.col("b"), "both").otherwise("different")
    return a.join(b, keys, "full").select(*keys, side.alias("side"))


def warning_dedup(warnings: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first warning of each locus."""
    return warnings.withColumn("turn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("turn = 1").drop("turn")


def warning_summary(warnings: DataFrame, code: str, order: str, message: str, examples: int = 5) -> DataFrame:
    """Per code: count, first message, and the first examples. The examples
    come from a ranked top-n, so no group is gathered whole. All warnings have
    one severity."""
    counts = warnings.groupBy(code).agg(F.count("*").alias("n"), F.min_by(message, order).alias("first_message"))
    ranked = warnings.withColumn("turn", F.row_number().over(Window.partitionBy(code).orderBy(order))).where(F.col("turn") <= examples)
    few = ranked.groupBy(code).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", F.col(order).cast("string").alias("x")))), lambda s: s["x"]), ",").alias("examples"))
    return counts.join(few, code)

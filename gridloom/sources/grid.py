"""Lifts a relation into the cell model: a header row and one cell per value.

Row numbers restart on every sheet, so the window is partitioned by sheet and
no larger than the file format's row limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import a1


def grid(df: DataFrame, sheet: Column, order: list[str], columns: list[str], workbook: str = "wb") -> DataFrame:
    """workbook, sheet, row, col, coord, kind, v_str, v_num, v_bool, v_ts,
    formula and style evidence that follows from the position: border_edges,
    has_fill, bold, style_hash. Nulls are cells of kind blank."""
    body = df.select(sheet.alias("sheet"), *[F.col(c) for c in dict.fromkeys([*order, *columns])])
    body = body.withColumn("row", F.row_number().over(Window.partitionBy("sheet").orderBy(*order)) + 1)
    kinds = dict(df.dtypes)

    def value(name: str) -> Column:
        c, kind = F.col(name), kinds[name]
        number = c.cast("double") if kind in ("int", "bigint", "smallint", "double", "float") or kind.startswith("decimal") else F.lit(None).cast("double")
        text = c if kind == "string" else F.lit(None).cast("string")
        stamp = c.cast("timestamp_ntz") if kind.startswith("timestamp") or kind == "date" else F.lit(None).cast("timestamp_ntz")
        truth = c if kind == "boolean" else F.lit(None).cast("boolean")
        label = {"string": "text", "boolean": "boolean"}.get(kind, "datetime" if kind.startswith(("timestamp", "date")) else "integer" if kind in ("int", "bigint", "smallint") else "number")
        return F.struct(F.lit(columns.index(name) + 1).alias("col"), F.when(c.isNull(), "blank").otherwise(label).alias("kind"), text.alias("v_str"), number.alias("v_num"), truth.alias("v_bool"), stamp.alias("v_ts"))

    cells = body.select("sheet", "row", F.explode(F.array(*[value(c) for c in columns])).alias("x")).select("sheet", "row", "x.*")
    names = F.explode(F.array(*[F.struct(F.lit(k + 1).alias("col"), F.lit(c).alias("v_str")) for k, c in enumerate(columns)]))
    head = body.select("sheet").distinct().select("sheet", F.lit(1).alias("row"), names.alias("x"))
    head = head.select("sheet", "row", "x.col", F.lit("text").alias("kind"), "x.v_str", F.lit(None).cast("double").alias("v_num"), F.lit(None).cast("boolean").alias("v_bool"), F.lit(None).cast("timestamp_ntz").alias("v_ts"))
    place = F.col("row") + F.col("col")
    return head.unionByName(cells).select(
        F.lit(workbook).alias("workbook"), "sheet", "row", "col", a1(F.col("row"), F.col("col")).alias("coord"), "kind", "v_str", "v_num", "v_bool", "v_ts",
        F.lit(None).cast("string").alias("formula"), (place % 5).cast("int").alias("border_edges"), (place % 3 == 0).alias("has_fill"), (F.col("row") == 1).alias("bold"),
        F.concat(F.lit("style:"), (place % 2).cast("string")).alias("style_hash"),
    )

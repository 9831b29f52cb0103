"""Ordered operators as windows within a sheet or table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def carry_forward(df: DataFrame, keys: list[str], order: str, value: Column, name: str) -> DataFrame:
    """The last non-null value so far."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def section_ranges(df: DataFrame, keys: list[str], row: str, is_start: Column, title: Column) -> DataFrame:
    """One row per section: it ends before the next one, the last at the bottom."""
    bottom = df.groupBy(*keys).agg(F.max(row).alias("bottom"))
    starts = df.where(is_start).select(*keys, F.col(row).alias("start_row"), title.alias("title"))
    starts = starts.withColumn("next", F.lead("start_row").over(Window.partitionBy(*keys).orderBy("start_row")))
    return starts.join(bottom, keys).select(*keys, "title", "start_row", F.coalesce(F.col("next") - 1, F.col("bottom")).alias("end_row"))


def occurrence(df: DataFrame, keys: list[str], order: list[str], name: str = "occurrence") -> DataFrame:
    """0-based count of earlier rows with the same keys."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)


def unique_labels(df: DataFrame, keys: list[str], label: str, order: str, name: str = "unique_label") -> DataFrame:
    """Repeated labels (whatever their case) get `` (2)``, `` (3)`` and so on."""
    w = Window.partitionBy(*keys, F.lower(label)).orderBy(order)
    turn = F.row_number().over(w)
    return df.withColumn(name, F.when(turn > 1, F.concat(F.col(label), F.lit(" ("), turn.cast("string"), F.lit(")"))).otherwise(F.col(label)))


def runs(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Runs of consecutive ``order`` numbers with one value: start, end, size."""
    w = Window.partitionBy(*keys, value).orderBy(order)
    marked = df.where(F.col(value).isNotNull()).withColumn("island", F.col(order) - F.row_number().over(w))
    return marked.groupBy(*keys, value, "island").agg(F.min(order).alias("start"), F.max(order).alias("end"), F.count("*").alias("size")).drop("island")


def adjacent_jaccard(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Mean Jaccard of the column sets of consecutive occupied rows."""
    rows = cells.groupBy(*keys, "row").agg(F.collect_set("col").alias("cols"))
    before = F.lag("cols").over(Window.partitionBy(*keys).orderBy("row"))
    pairs = rows.withColumn("before", before).where("before is not null")
    share = F.size(F.array_intersect("cols", "before")) / F.size(F.array_union("cols", "before"))
    return pairs.groupBy(*keys).agg(F.round(F.avg(share), 6).alias("regularity"))


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key, numbered; the limit is pushed below
    the shuffle by the optimizer."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= n)

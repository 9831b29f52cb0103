"""Clean tables: labelled columns, kept rows with provenance, and a log of what
was dropped.

``clean`` starts from a table's structure. Rows and columns are judged on two
aggregations of the cells (by row, by column); kept rows and kept columns then
meet by equality on the table, and cells join them by (row, col). A body cell
without a value of its own takes that of its merge's anchor only downwards.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import headers
from ..functions.geometry import Rect, a1
from ..functions.text import distinct_in_order, folded, matches, noise_kind, normalize_ws, row_drop_reason
from ..operators.windows import unique_labels
from ..storage import stored
from .structure import BOUNDS, LABEL_ROLES, TABLE, VALUE_ROLES, Structure

#: Rows that are looked at for header rows (a fixed value).
HEADER_SCAN = 11


@dataclass
class Clean:
    """cells (one for each kept row and column), columns, dropped_rows,
    dropped_columns, and tables: status, title, header rows and counts."""

    cells: DataFrame
    columns: DataFrame
    dropped_rows: DataFrame
    dropped_columns: DataFrame
    tables: DataFrame


def resolved(cells: DataFrame) -> DataFrame:
    """Adds the value as inherited in the body (down a merge) under r_ and, for
    headers, in all of a merge under h_."""
    c = F.col
    lent = ~c("full") & F.coalesce(c("a_full"), F.lit(False))
    down = lent & (c("col") == c("m_col"))
    measure = F.coalesce(c("calc") | c("number"), F.lit(False))
    pick = lambda when, own, anchor: F.when(when, c(anchor)).otherwise(own)
    return cells.select(
        "*", (c("full") | down).alias("r_full"), down.alias("r_lent"), pick(down, c("text"), "a_text").alias("r_text"), pick(down, c("shown"), "a_shown").alias("r_shown"), pick(down, c("formula"), "a_formula").alias("r_formula"),
        pick(down, measure, "a_measure").alias("r_measure"), pick(down, c("head"), "a_head").alias("r_head"), pick(lent, c("text"), "a_text").alias("h_text"), pick(lent, c("head"), "a_head").alias("h_head"),
    )


def _row_view(cells: DataFrame) -> DataFrame:
    """By row: texts as read across merges, header texts, measures."""
    c = F.col
    said = lambda name: distinct_in_order(F.array_sort(F.collect_list(F.when((c(name) != "") & ~c(name).startswith("="), F.struct("col", c(name).alias("t")))))["t"])
    return cells.groupBy(*TABLE, "row").agg(said("h_text").alias("seen"), said("r_head").alias("heads"), F.count_if("r_measure").alias("measures"))


def header_rows(s: Structure, view: DataFrame) -> DataFrame:
    """TABLE and header_rows: the proposed rows that hold, and more of the
    leading twelve until a business row comes."""
    c = F.col
    lead = s.tables.select(*TABLE, *BOUNDS, "header_rows").withColumn("scan", F.least(c("t_row2"), c("t_row") + HEADER_SCAN))
    sources = s.columns.select(*TABLE, F.explode("header_sources").alias("s")).groupBy(*TABLE).agg(F.collect_set(F.regexp_extract("s", r"(\d+)$", 1).cast("int")).alias("sources"))
    near = view.join(lead.select(*TABLE, "t_row", "scan"), TABLE).where(c("row").between(c("t_row"), c("scan")))
    near = near.join(s.rows.select(*TABLE, "row", "role"), [*TABLE, "row"], "left").withColumn("role", F.lower(F.coalesce("role", F.lit("unknown"))))
    semantic = F.size(F.filter("heads", lambda t: matches(t, headers.CLEAN_TOKEN)))
    business = c("role").isin("data", "total")
    fact = F.struct(
        row_drop_reason(c("role"), c("heads"), c("measures")).alias("reason"), (F.size("heads") > 0).alias("says"), ((c("measures") >= 2) & (semantic < 2)).alias("values"),
        ((semantic < 2) & ((c("measures") >= 2) | business)).alias("body"), ((semantic >= 2) | ((F.size("heads") >= 2) & (c("measures") == 0) & ~business)).alias("head"),
    )
    known = near.groupBy(*TABLE).agg(F.map_from_entries(F.collect_list(F.struct("row", fact))).alias("at"))
    t = lead.join(known, TABLE, "left").join(sources, TABLE, "left")
    all_ = F.array_union("header_rows", F.coalesce("sources", F.array().cast("array<int>")))
    holds = lambda r: F.coalesce((r <= c("scan")) & c("at")[r]["reason"].isNull() & c("at")[r]["says"] & ~c("at")[r]["values"], F.lit(False))
    state = F.struct(F.filter(all_, holds).alias("rows"), F.lit(False).alias("stopped"))

    def step(x, r):
        now = c("at")[r]
        band = F.coalesce(now["reason"].isin("section", "group"), F.lit(False))
        plain = now.isNotNull() & now["reason"].isNull() & now["says"]
        stops = x["stopped"] | (band & (F.size(x["rows"]) > 0)) | F.coalesce(plain & now["body"], F.lit(False))
        taken = ~stops & F.coalesce(plain & now["head"], F.lit(False))
        return F.struct(F.when(taken, F.array_union(x["rows"], F.array(r))).otherwise(x["rows"]).alias("rows"), stops.alias("stopped"))

    return t.select(*TABLE, F.array_sort(F.aggregate(F.sequence("t_row", "scan"), state, step)["rows"]).alias("header_rows"))


def header_title(cells: DataFrame, bands: DataFrame) -> DataFrame:
    """A title from header rows: two words or more, merged or mostly upper case;
    the first by row, then by column."""
    c = F.col
    heads = cells.join(bands, TABLE).where(F.array_contains("header_rows", c("row")) & (c("h_head") != ""))
    # one text for each source; the patterns then run on these few only
    first = heads.groupBy(*TABLE, F.when(c("full"), c("row")).otherwise(c("src_row")).alias("sr"), F.when(c("full"), c("col")).otherwise(c("src_col")).alias("sc")).agg(F.min(F.struct("row", "col", (F.coalesce(c("m_col"), c("col")) - F.coalesce(c("m_col2"), c("col"))).alias("w"), c("h_head").alias("t"))).alias("x"))
    first = first.where(headers.usable_title(c("x.t")).isNotNull() & ~folded(c("x.t")).isin(*headers.GENERIC_TITLES))
    letters, upper = F.regexp_replace("x.t", r"\P{L}", ""), F.regexp_replace("x.t", r"\P{Lu}", "")
    loud = F.try_divide(F.char_length(upper), F.char_length(letters)) >= 0.65
    words = F.size(F.regexp_extract_all("x.t", F.lit("([A-Za-z]+)"), 1))
    return first.where((words >= 2) & (F.coalesce(loud, F.lit(False)) | (c("x.w") < 0))).groupBy(*TABLE).agg(F.min("x")["t"].alias("header_title"))


def natural_label(position: Column, total: Column, role: Column) -> Column:
    """Label of a label column without a header."""
    last = position == total - 1
    return (
        F.when(total == 1, "Metric").when(role == "row_group", F.when(position == 0, "Entity").otherwise("Group")).when((role == "row_label") & last, "Metric")
        .when(role == "dimension", F.when(last, "Group").otherwise("Activity")).otherwise(F.when(last, "Metric").otherwise("Activity"))
    )


def annotation_column(role: Column, measures: Column, texts: Column, noisy: Column, shortest: Column) -> Column:
    """A column of remarks: by role, all noise, or up to three long texts."""
    return (role == "annotation") | ((measures == 0) & (texts > 0) & ((noisy == texts) | (~role.isin(*LABEL_ROLES) & (texts <= 3) & (shortest >= 100))))


def clean(s: Structure, names: DataFrame | None = None) -> Clean:
    """The clean form of all tables. ``names`` (TABLE, source_name) may give a
    title where the structure has none."""
    c = F.col
    cells = resolved(s.cells)
    view = stored(_row_view(cells), "row-view")
    bands = stored(header_rows(s, view), "clean-bands")
    t = s.tables.drop("header_rows").join(bands, TABLE)
    t = t.join(names, TABLE, "left") if names is not None else t.withColumn("source_name", F.lit(None).cast("string"))
    titles = t.join(header_title(cells, bands), TABLE, "left").select(*TABLE, *BOUNDS, "header_rows", F.coalesce(headers.usable_title(c("title")), headers.usable_title(c("source_name")), c("header_title")).alias("title"))
    titles = stored(titles, "clean-titles")

    # rows
    none = F.array().cast("array<string>")
    every = titles.select(*TABLE, "header_rows", F.explode(F.sequence("t_row", "t_row2")).alias("row"))
    known = s.rows.select(*TABLE, "row", "role", "labels", "label", "section")
    rows = every.join(view, [*TABLE, "row"], "left").join(known, [*TABLE, "row"], "left")
    rows = rows.select(*TABLE, "row", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("labels", none).alias("labels"), "label", c("section").alias("own_section"), F.coalesce("seen", none).alias("seen"), F.coalesce("measures", F.lit(0)).alias("measures"), F.array_contains("header_rows", c("row")).alias("is_header"))
    rows = rows.withColumn("reason", F.when(c("is_header"), "header").otherwise(row_drop_reason(c("role"), c("seen"), c("measures"))))
    begins = F.when(c("reason").isin("section", "group"), F.nullif(normalize_ws(F.coalesce("label", F.get("seen", F.lit(0)))), F.lit("")))
    carried = F.last(begins, ignorenulls=True).over(Window.partitionBy(*TABLE).orderBy("row").rowsBetween(Window.unboundedPreceding, 0))
    rows = stored(rows.withColumn("section", F.coalesce("own_section", carried)).drop("own_section", "seen", "is_header"), "clean-rows")
    kept = rows.where("reason is null")

    # columns
    labelled = c("role").isin(*LABEL_ROLES)
    by = Window.partitionBy(*TABLE)
    columns = s.columns.select(*TABLE, "col", "letter", "role", "path").withColumn("position", F.when(labelled, F.count_if(labelled).over(by.orderBy("col")) - 1)).withColumn("total", F.count_if(labelled).over(by))
    body = cells.join(kept.select(*TABLE, "row"), [*TABLE, "row"])
    word = ~c("r_measure") & (c("r_text") != "")
    fill = body.groupBy(*TABLE, "col").agg(F.count_if("r_full").alias("filled"), F.count_if("r_measure").alias("measures"), F.count_if(word).alias("texts"), F.count_if(word & noise_kind(c("r_text")).isNotNull()).alias("noisy"), F.min(F.when(word, F.char_length("r_text"))).alias("shortest"))
    deepest = kept.groupBy(*TABLE).agg(F.max(F.size("labels")).alias("deepest"))
    judged = columns.join(fill, [*TABLE, "col"], "left").join(deepest, TABLE, "left").fillna(0, ["filled", "measures", "texts", "noisy", "shortest", "deepest"])
    remark = annotation_column(c("role"), c("measures"), c("texts"), c("noisy"), c("shortest"))
    populated = (c("filled") > 0) | F.coalesce(c("position") < c("deepest"), F.lit(False))
    judged = stored(judged.withColumn("reason", F.when(remark, "annotation").when(~populated, "body_empty")), "clean-columns")
    order = F.array_sort(F.collect_list(F.struct("row", "h_head")))["h_head"]
    heads = cells.join(bands, TABLE).where(F.array_contains("header_rows", c("row")) & (c("h_head") != "")).groupBy(*TABLE, "col").agg(order.alias("heads"))
    good = judged.where("reason is null").join(heads, [*TABLE, "col"], "left").join(titles.select(*TABLE, "t_col", "title"), TABLE)
    good = good.withColumn("actual", headers.clean_path(F.coalesce("heads", none), c("title"))).withColumn("inferred", headers.clean_path(c("path"), c("title")))
    longer = (F.size("inferred") > F.size("actual")) & (folded(headers.leaf(c("inferred"))) == folded(headers.leaf(c("actual"))))
    path = F.when((F.size("actual") == 0) | longer, c("inferred")).otherwise(c("actual"))
    bare = F.when(labelled, natural_label(c("position"), c("total"), c("role"))).when(c("role").isin(*VALUE_ROLES), "Value").when(c("col") == c("t_col"), "Group").otherwise("Value")
    good = good.withColumn("header_path", path).withColumn("synthetic_label", F.size("header_path") == 0).withColumn("raw", F.when(F.size(path) > 0, normalize_ws(headers.joined(path))).otherwise(bare))
    good = unique_labels(good, TABLE, "raw", "col", "label")
    base = F.coalesce(F.nullif(F.regexp_replace(F.regexp_replace(folded(c("label")), "[^a-z0-9]+", "_"), "^_+|_+$", ""), F.lit("")), F.lit("value"))
    good = good.withColumn("base", base).withColumn("turn", F.row_number().over(Window.partitionBy(*TABLE, "base").orderBy("col")))
    good = good.select(*TABLE, "col", "letter", "role", "header_path", "label", F.when(c("turn") > 1, F.concat("base", F.lit("_"), c("turn").cast("string"))).otherwise(c("base")).alias("key"), "synthetic_label", "position")
    good = stored(good, "kept-columns")

    # cells: kept rows and columns meet on their table
    frame = kept.select(*TABLE, "row", c("role").alias("row_role"), "section", "labels").join(good, TABLE)
    put = frame.join(cells.select(*TABLE, "row", "col", "r_shown", "r_formula", "r_lent", "cache_status", "number_format", "style_hash", "m_row", "m_col"), [*TABLE, "row", "col"], "left")
    given = F.when(c("r_shown").isNull() & c("position").isNotNull(), F.get("labels", c("position").cast("int")))
    value = F.coalesce(c("r_shown"), given)
    lent = F.coalesce(c("r_lent"), F.lit(False))
    put = put.select(
        *TABLE, "row", "col", a1(c("row"), c("col")).alias("coord"), c("row_role").alias("role"), "section", "label", "key", value.alias("value"), c("r_formula").alias("formula"), "cache_status", "number_format", "style_hash",
        F.when(lent, a1(c("m_row"), c("m_col"))).alias("source_coord"), lent.alias("inherited"), given.isNotNull().alias("synthetic"),
    )
    put = stored(put, "clean-cells")
    says = put.groupBy(*TABLE, "row").agg(F.bool_or(F.coalesce(normalize_ws(c("value")) != "", F.lit(False))).alias("says"))
    empty = kept.select(*TABLE, "row").join(says.where("says"), [*TABLE, "row"], "left_anti")
    out = put.join(says.where("says").select(*TABLE, "row"), [*TABLE, "row"])
    dropped = rows.where("reason is not null").select(*TABLE, "row", "reason").unionByName(empty.withColumn("reason", F.lit("body_empty")))
    gone = judged.where("reason is not null").select(*TABLE, "col", "letter", "reason")
    return Clean(out, good, dropped, gone, _counts(titles, out, good, dropped, gone))


def _counts(titles: DataFrame, cells: DataFrame, columns: DataFrame, rows: DataFrame, gone: DataFrame) -> DataFrame:
    c = F.col
    one = [
        cells.groupBy(*TABLE).agg(F.countDistinct("row").alias("rows"), F.count("*").alias("cells"), F.count_if(c("formula").isNotNull()).alias("formula_cells"), F.count_if("inherited").alias("inherited_cells"), F.count_if("synthetic").alias("synthetic_cells")),
        columns.groupBy(*TABLE).agg(F.count("*").alias("columns")), rows.groupBy(*TABLE).agg(F.count("*").alias("dropped_rows")), gone.groupBy(*TABLE).agg(F.count("*").alias("dropped_columns")),
    ]
    t = titles
    for x in one:
        t = t.join(x, TABLE, "left")
    names = ["rows", "columns", "cells", "dropped_rows", "dropped_columns", "formula_cells", "inherited_cells", "synthetic_cells"]
    t = t.fillna(0, names)
    r = Rect(c("t_row"), c("t_col"), c("t_row2"), c("t_col2"))
    return t.select(*TABLE, F.when((c("rows") > 0) & (c("columns") > 0), "ready").otherwise("empty").alias("status"), "title", r.ref.alias("source_range"), "header_rows", r.height.alias("source_rows"), r.width.alias("source_columns"), *names)


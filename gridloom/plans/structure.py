"""Structure of tables: header rows, title, columns, rows, sections, groups.

``infer`` makes one pass over the cells: their features are written once, and
then one aggregation by row and one by column (header and body cells apart)
give small tables of rows and columns on which windows and folds decide. A
table's header rows are at most ten and are folded as an array; everything else
is keyed by (workbook, sheet, row) or (workbook, sheet, col), where the sheet
is a table's id or a sheet that holds one table.

Labels go down and across only within merges, and over blank neighbours of the
same style under a parent header; blanks are never filled otherwise.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import hashing, headers
from ..functions.geometry import Rect, a1, column_letters
from ..functions.text import NOTE_ROW, TOTAL, TITLE_BANNER, distinct_in_order, folded, matches, normalize_ws, slug, without_repeats
from ..functions.values import NUMERIC_KINDS, display_text, has_formula, header_text, number_text
from ..operators.windows import runs
from ..storage import stored

TABLE = ["workbook", "sheet"]
BOUNDS = ["t_row", "t_col", "t_row2", "t_col2"]
LABEL_ROLES = ("row_group", "row_label", "dimension")  # fixed values
VALUE_ROLES = ("measure", "formula_measure", "variance")  # fixed values
#: What cells may lack: a relation lifted into cells has none of it.
OPTIONAL = {
    "v_bool": "boolean", "v_ts": "timestamp_ntz", "cache_status": "string", "number_format": "string", "m_row": "int", "m_col": "int", "m_row2": "int", "m_col2": "int", "a_said": "string", "a_text": "string", "a_head": "string", "a_shown": "string", "a_full": "boolean",
    "a_measure": "boolean", "a_formula": "string", "has_validation": "boolean", "has_comment": "boolean", "has_hyperlink": "boolean",
}
# Weights and thresholds of header rows, titles and row roles.
HEADER_ACCEPT, HEADER_SCAN, TITLE_SCAN = 0.36, 9, 4
ROW_CONFIDENCE = {"note": 0.90, "total": 0.92, "section_header": 0.88, "group_header": 0.72, "spacer": 0.95, "unknown": 0.35}


def completed(cells: DataFrame) -> DataFrame:
    """Cells with all optional columns, null where they are missing."""
    return cells.select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in OPTIONAL.items() if name not in cells.columns])


def cell_text(kind: Column, text: Column) -> Column:
    """Normalised text of a text or error, else empty."""
    return F.coalesce(F.when(kind.isin("text", "error"), normalize_ws(text)), F.lit(""))


def own_texts(cells: DataFrame) -> DataFrame:
    """Adds what a cell says by itself: said (numbers, truth values and times
    as text; formulas only by a textual result), head (as a header), shown, and
    full (it has a formula or a value that is not blank)."""
    c = F.col
    formula = has_formula(c("formula"))
    text = cell_text(c("kind"), c("v_str"))
    plain = F.when(c("kind").isin(*NUMERIC_KINDS), number_text(c("v_num"))).when(c("kind") == "boolean", F.when(c("v_bool"), "True").otherwise("False")).when(c("kind") == "datetime", F.date_format("v_ts", "yyyy-MM-dd HH:mm:ss"))
    shown = F.coalesce(display_text(c("kind"), c("v_str"), c("v_num"), c("v_bool"), c("v_ts")), F.when(formula, c("formula")))
    blank = (c("kind") == "blank") | ((c("kind") == "text") & (text == ""))
    return cells.select(
        "*", F.when(text != "", text).when(formula, "").otherwise(F.coalesce(plain, F.lit(""))).alias("said"),
        header_text(c("kind"), c("v_str"), c("v_num"), c("formula")).alias("head"), shown.alias("shown"), (formula | ~blank).alias("full"),
    )


def features(cells: DataFrame) -> DataFrame:
    """One row per cell with what the steps below ask for."""
    c, f = F.col, lambda name: F.coalesce(F.col(name), F.lit(False))
    formula = has_formula(c("formula"))
    merged = c("m_row").isNotNull()
    number = c("kind").isin(*NUMERIC_KINDS)
    structural = (c("kind") != "blank") | formula | (F.coalesce("border_edges", F.lit(0)) > 0) | merged | f("has_validation") | f("has_comment") | f("has_hyperlink")
    e = own_texts(completed(cells))
    return e.select(
        *TABLE, *[n for n in BOUNDS if n in cells.columns], "row", "col", "coord", "kind", "v_str", "v_num", "formula", "cache_status", "number_format", "style_hash", "shown", "head", "full", "m_row", "m_col", "m_row2", "m_col2", "a_full", "a_text", "a_head", "a_shown", "a_measure", "a_formula",
        cell_text(c("kind"), c("v_str")).alias("text"), F.when(merged, F.coalesce("a_said", F.lit(""))).otherwise(c("said")).alias("said"),
        F.coalesce("m_row", "row").alias("src_row"), F.coalesce("m_col", "col").alias("src_col"), number.alias("number"), formula.alias("calc"), structural.alias("structural"),
        F.coalesce("border_edges", F.lit(0)).alias("edges"), (F.coalesce("border_edges", F.lit(0)) > 0).alias("border"), (f("has_comment") | f("has_hyperlink")).alias("noted"), f("has_comment").alias("comment"), (f("bold") | f("has_fill")).alias("styled"), f("has_validation").alias("validation"),
        (structural | f("has_fill") | F.coalesce(c("number_format") != "General", F.lit(False))).alias("material"),
    )


@dataclass
class Structure:
    """Tables of one run: cells (features), tables, columns, rows, sections and
    groups, all written."""

    cells: DataFrame
    tables: DataFrame
    columns: DataFrame
    rows: DataFrame
    sections: DataFrame
    groups: DataFrame


def _row_facts(f: DataFrame) -> DataFrame:
    c, n = F.col, F.count_if
    merged = c("m_row").isNotNull()
    item = F.struct("col", "said", "src_row", "src_col", "styled", (c("m_col2") - c("m_col") + 1).alias("wide"))
    list_ = lambda when, what: F.array_sort(F.collect_list(F.when(when, what)))
    return f.groupBy(*TABLE, "row").agg(
        F.count("*").alias("cells"), n("number").alias("numbers"), n("calc").alias("formulas"), n("structural").alias("structural"), n("border").alias("bordered"), n("styled").alias("styled"),
        n(c("styled") | merged).alias("dressed"), n("material").alias("material"), F.coalesce(F.max(F.when(merged, c("m_col2") - c("m_col") + 1)), F.lit(1)).alias("widest"),
        F.coalesce(F.bool_or(merged & (c("m_col") <= c("t_col")) & (c("m_col2") >= c("t_col2"))), F.lit(False)).alias("full_width"),
        list_(c("said") != "", item).alias("items"), list_(c("text") != "", F.struct("col", "text")).alias("texts"),
    )


def header_score(top: Column) -> Column:
    """Score of a row of facts as a header row, 0 to 1."""
    c = F.col
    said = F.size("said")
    values = c("numbers") + c("formulas")
    semantic = F.size(F.filter("said", lambda t: matches(t, headers.SEMANTIC)))
    score = (
        0.18 * (said > 0).cast("int") + 0.42 * semantic / F.greatest(F.lit(1), said) + 0.20 * c("dressed") / F.greatest(F.lit(1), c("material")) + 0.14 * (c("widest") > 1).cast("int") + 0.08 * (c("row") == top).cast("int")
        - 0.38 * ((values >= 2) & (said > 0)).cast("int") - 0.30 * ((said == 0) & (values > 0)).cast("int")
    )
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def header_band(tables: DataFrame, facts: DataFrame) -> DataFrame:
    """tables with header_rows: a run of rows from the first two on that score
    enough. A blank row is bridged if the next one is a header; one label over
    the full width right below leaf headers begins a section instead."""
    c = F.col
    height = c("t_row2") - c("t_row") + 1
    lead = tables.withColumn("scan", F.least(c("t_row2"), c("t_row") + F.least(F.lit(HEADER_SCAN), F.greatest(F.lit(2), F.floor(height / 3))).cast("int")))
    near = facts.join(lead.select(*TABLE, "t_row", "scan"), TABLE).where(c("row").between(c("t_row"), c("scan")))
    said = distinct_in_order(F.transform("items", lambda x: x["said"]))
    near = near.withColumn("said", said).withColumn("score", header_score(c("t_row")))
    leaf = (F.size("said") >= 2) | (F.size(F.filter("said", lambda t: matches(t, headers.SEMANTIC))) >= 2)
    fact = F.struct("score", leaf.alias("leaf"), (c("full_width") & (F.size("said") == 1) & (c("numbers") + c("formulas") == 0)).alias("band"), (F.size("said") > 0).alias("says"))
    known = near.groupBy(*TABLE).agg(F.map_from_entries(F.collect_list(F.struct("row", fact))).alias("at"))
    state = F.struct(F.lit(False).alias("started"), F.lit(False).alias("stopped"), F.array().cast("array<int>").alias("rows"))

    def step(s, row):
        x, before, after = c("at")[row], c("at")[row - 1], c("at")[row + 1]
        score = F.coalesce(x["score"], F.when(row == c("t_row"), 0.08).otherwise(0.0))
        good = score >= HEADER_ACCEPT
        section = s["started"] & F.coalesce(x["band"] & before["leaf"], F.lit(False))
        bridged = s["started"] & x.isNull() & F.coalesce(after["score"] >= HEADER_ACCEPT, F.lit(False))
        late = F.when(good, ~s["started"] & (row > c("t_row") + 1)).otherwise(~s["started"] & (row >= c("t_row") + 1))
        stops = s["stopped"] | section | late | (~good & s["started"] & ~bridged)
        taken = ~stops & good
        return F.struct((s["started"] | taken).alias("started"), stops.alias("stopped"), F.when(taken, F.array_append(s["rows"], row)).otherwise(s["rows"]).alias("rows"))

    found = lead.join(known, TABLE, "left").withColumn("band", F.aggregate(F.sequence("t_row", "scan"), state, step)["rows"])
    weak = (F.size("band") == 0) & (height > 1) & F.coalesce(c("at")[c("t_row")]["says"], F.lit(False))
    warning = F.when(weak, "Header row inferred weakly from the first table row.").when(F.size("band") == 0, "No reliable header row was detected.")
    return found.select(*TABLE, *BOUNDS, F.when(weak, F.array("t_row")).otherwise(c("band")).alias("header_rows"), warning.alias("header_warning"))


def titles(tables: DataFrame, facts: DataFrame) -> DataFrame:
    """title of each table: of the plausible labels of the header rows (or the
    first five) the first by row, then by column."""
    c = F.col
    where = F.when(F.size("header_rows") > 0, F.array_contains("header_rows", c("row"))).otherwise(c("row") <= F.least(c("t_row2"), c("t_row") + TITLE_SCAN))
    x = facts.join(tables, TABLE).where(where).select(*TABLE, *BOUNDS, "row", F.explode("items").alias("x"))
    t, wide = c("x.said"), c("x.wide")
    score = F.when(matches(t, TITLE_BANNER), -1.0).otherwise(
        0.15 + 0.20 * (~t.rlike(f"(?iu)^(?:{headers.PERIOD})$")).cast("int") + 0.22 * c("x.styled").cast("int") + F.coalesce(0.28 * F.least(F.lit(1.0), wide / (c("t_col2") - c("t_col") + 1)), F.lit(0.0))
        + 0.10 * F.char_length(t).between(3, 90).cast("int") + 0.08 / (1 + c("row") - c("t_row")) - 0.25 * t.rlike(f"(?iu)^(?:{headers.SEMANTIC})$").cast("int")
    )
    first = x.groupBy(*TABLE, "x.src_row", "x.src_col").agg(F.min(F.struct("row", "x.col", (-score).alias("rank"), t.alias("title"))).alias("one"))
    plausible = (c("one.rank") < 0) & ~headers.is_period_only(c("one.title"))
    return first.where(plausible).groupBy(*TABLE).agg(F.min("one")["title"].alias("title"))


def header_cells(f: DataFrame, tables: DataFrame) -> DataFrame:
    """Cells of header rows with their text (said) and its source, blanks under
    a parent header filled: between two labels at most seven columns apart, if
    all blanks have the left one's style."""
    c = F.col
    heads = f.join(tables.select(*TABLE, "header_rows"), TABLE).where(F.array_contains("header_rows", c("row")))
    w = Window.partitionBy(*TABLE, "row").orderBy("col")
    label = F.when(c("said") != "", F.struct("col", "said", "src_row", "src_col", "styled", "style_hash"))
    heads = heads.withColumn("left", F.last(label, ignorenulls=True).over(w)).withColumn("right", F.first(F.when(c("said") != "", c("col")), ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)))
    same = (c("said") == "") & (c("style_hash") == c("left.style_hash"))
    heads = heads.withColumn("alike", F.count_if(same).over(Window.partitionBy(*TABLE, "row", "left.col")))
    gap = c("right") - c("left.col")
    fill = (c("said") == "") & gap.between(2, 7) & c("left.styled") & c("left.style_hash").isNotNull() & headers.is_parent(c("left.said")) & (c("alike") == gap - 1)
    pick = lambda name: F.when(F.coalesce(fill, F.lit(False)), c(f"left.{name}")).otherwise(c(name)).alias(name)
    return heads.select(*TABLE, "row", "col", pick("said"), pick("src_row"), pick("src_col"))


def column_roles(columns: DataFrame) -> DataFrame:
    """Adds first_value (the table's first value column) and role to columns
    with body counts and header semantics."""
    c = F.col
    value = (c("numeric") > 0) | (c("formula") > 0) | c("year").isNotNull() | c("scenario").isNotNull() | c("comparison_kind").isNotNull()
    out = columns.withColumn("is_value", value).withColumn("first_value", F.min(F.when(value, c("col"))).over(Window.partitionBy(*TABLE)))
    before = F.coalesce(c("col") < c("first_value"), F.lit(False))
    scaffold = (c("border") > 0) | (c("validation") > 0)
    role = (
        F.when(c("comparison_kind").isNotNull(), "variance").when(before & (c("vertical_merge") > 0), "row_group").when(before & (c("text") >= c("numeric")), "row_label")
        .when(c("long_text") > c("numeric") + c("formula"), "annotation").when(c("formula") > c("numeric"), "formula_measure").when(c("is_value"), "measure").when(c("text") > 0, "dimension")
        .when(scaffold & F.coalesce(c("col") >= c("first_value"), F.lit(False)), "measure").otherwise("unknown")
    )
    return out.withColumn("role", role)


def body_counts(f: DataFrame, tables: DataFrame) -> DataFrame:
    """What the body rows of each column hold."""
    c, n = F.col, F.count_if
    text = (c("text") != "") & ~c("number")
    body = f.join(tables.select(*TABLE, "header_rows"), TABLE).where(~F.array_contains("header_rows", c("row")))
    return body.groupBy(*TABLE, "col").agg(
        n(text).alias("text"), n(text & (F.char_length("text") >= 80)).alias("long_text"), n("number").alias("numeric"), n("calc").alias("formula"), n("border").alias("border"), n("validation").alias("validation"),
        n(c("m_row2") > c("m_row")).alias("vertical_merge"),
    )


def describe_columns(f: DataFrame, tables: DataFrame) -> DataFrame:
    """One row for each column of each table: role, path, key, what the header
    says, and confidence."""
    c = F.col
    order = F.array_sort(F.collect_list(F.struct("row", "said", F.concat(column_letters(c("src_col")), c("src_row").cast("string")).alias("src"))))
    paths = header_cells(f, tables).where(c("said") != "").groupBy(*TABLE, "col").agg(order.alias("x"))
    paths = paths.select(*TABLE, "col", without_repeats(c("x")["said"]).alias("path"), F.array_distinct(c("x")["src"]).alias("header_sources"))
    stats = body_counts(f, tables)
    every = tables.select(*TABLE, "title", "t_col", F.explode(F.sequence("t_col", "t_col2")).alias("col"))
    zero = [F.coalesce(x, F.lit(0)).alias(x) for x in ("text", "long_text", "numeric", "formula", "border", "validation", "vertical_merge")]
    none = F.array().cast("array<string>")
    joined = every.join(stats, [*TABLE, "col"], "left").join(paths, [*TABLE, "col"], "left").select(*TABLE, "title", "t_col", "col", *zero, F.coalesce("path", none).alias("path"), F.coalesce("header_sources", none).alias("header_sources"))
    roled = column_roles(joined.select("*", *headers.semantics(c("path"), c("title"))))
    parts = F.transform("path", lambda t: folded(normalize_ws(t)))
    sign = F.struct(c("comparison_kind"), parts.alias("path"), c("role"), c("scenario"), c("unit"), c("year"))
    roled = roled.withColumn("signature", F.to_json(sign, {"ignoreNullFields": "false"}))
    roled = roled.withColumn("occurrence", F.row_number().over(Window.partitionBy(*TABLE, "signature").orderBy("col")) - 1)
    readable = F.when(F.size("path") > 0, F.array_join("path", "-")).otherwise(F.concat(F.lit("column-"), (c("col") - c("t_col") + 1).cast("string")))
    key = F.concat(slug(readable, "column"), F.lit("-"), F.substring(F.sha2(F.concat(F.lit('{"occurrence":'), c("occurrence").cast("string"), F.lit(',"signature":'), c("signature"), F.lit("}")), 256), 1, 8))
    values, says = (c("numeric") + c("formula")) > 0, c("year").isNotNull() | c("scenario").isNotNull() | c("comparison_kind").isNotNull()
    evidence = (F.size("path") > 0) | values
    confidence = F.round(F.least(F.lit(1.0), 0.25 + 0.25 * (F.size("path") > 0).cast("int") + 0.20 * values.cast("int") + 0.20 * says.cast("int") + 0.10 * (evidence & (c("role") != "unknown")).cast("int")), 6)
    return roled.select(*TABLE, "col", column_letters(c("col")).alias("letter"), "role", "path", "header_sources", key.alias("key"), "scenario", "year", "comparison_kind", "unit", "measure", F.when(F.size("path") > 1, c("path")[0]).alias("group"), confidence.alias("confidence"))


def row_role() -> Column:
    """Role by a row's facts, direct texts and labels; the first match wins."""
    c = F.col
    values = c("numbers") + c("formulas")
    everything = F.array_join(distinct_in_order(F.concat("labels", "direct")), " | ")
    primary = F.coalesce(F.try_element_at("labels", F.lit(-1)), F.get("direct", F.lit(0)), F.lit(""))
    long = F.coalesce(F.array_max(F.transform("direct", F.char_length)) >= 90, F.lit(False)) | (F.aggregate("direct", F.lit(0), lambda a, t: a + F.char_length(t)) >= 150)
    upper = (F.upper(primary) == primary) & (F.lower(primary) != primary) & (F.char_length(primary) <= 70)
    width = c("t_col2") - c("t_col") + 1
    wide = c("widest") >= F.greatest(F.lit(2), F.floor(width * 0.55))
    half = F.greatest(F.lit(1), F.floor(c("cells") / 2))
    return (
        F.when(matches(everything, NOTE_ROW) | (long & (values == 0)), "note").when(matches(everything, TOTAL), "total")
        .when((values == 0) & F.size("direct").between(1, 2) & (wide | upper | (c("styled") >= half)), "section_header")
        .when((values == 0) & F.size("direct").between(1, 3) & (c("styled") > 0), "group_header")
        .when((values > 0) | (F.size("labels") > 0), "data").when((c("structural") > 0) & (c("bordered") >= half), "data").when((c("structural") == 0) & (F.size("direct") == 0), "spacer").otherwise("unknown")
    )


def describe_rows(f: DataFrame, facts: DataFrame, tables: DataFrame, columns: DataFrame) -> DataFrame:
    """One row for each body row of each table: role, labels, section, key."""
    c = F.col
    labelled = columns.where(c("role").isin(*LABEL_ROLES)).select(*TABLE, "col")
    without = tables.select(*TABLE).join(labelled.select(*TABLE).distinct(), TABLE, "left_anti")
    first = f.join(without, TABLE).where((c("text") != "") & ~c("number")).groupBy(*TABLE).agg(F.min("col").alias("col"))
    lists = F.array_sort(F.collect_list(F.struct("col", "said", a1(c("src_row"), c("src_col")).alias("src"))))
    labels = f.where(c("said") != "").join(labelled.unionByName(first), [*TABLE, "col"]).groupBy(*TABLE, "row").agg(lists.alias("x"))
    labels = labels.select(*TABLE, "row", without_repeats(c("x")["said"]).alias("labels"), F.array_distinct(c("x")["src"]).alias("label_sources"))
    every = tables.select(*TABLE, *BOUNDS, "header_rows", F.explode(F.sequence("t_row", "t_row2")).alias("row")).where(~F.array_contains("header_rows", c("row"))).drop("header_rows")
    none = F.array().cast("array<string>")
    counts = [F.coalesce(x, F.lit(0)).alias(x) for x in ("cells", "numbers", "formulas", "structural", "bordered", "styled", "widest")]
    rows = every.join(facts, [*TABLE, "row"], "left").join(labels, [*TABLE, "row"], "left").select(
        *TABLE, "row", *BOUNDS, *counts, F.coalesce("labels", none).alias("labels"), F.coalesce("label_sources", none).alias("label_sources"), F.coalesce(distinct_in_order(F.transform("texts", lambda x: x["text"])), none).alias("direct"),
    )
    rows = rows.withColumn("role", row_role())
    values = c("numbers") + c("formulas")
    waits = (c("role") == "data") & (values == 0) & (c("structural") > 0)
    sure = F.coalesce(*[F.when(c("role") == k, F.lit(v)) for k, v in ROW_CONFIDENCE.items()], F.when(values > 0, 0.82).when(F.size("labels") > 0, 0.65).otherwise(0.58))
    label = F.coalesce(F.try_element_at("labels", F.lit(-1)), F.get("direct", F.lit(0)))
    rows = rows.select("*", label.alias("label"), (c("role") == "total").alias("is_total"), waits.alias("is_placeholder"), sure.alias("confidence"))
    begins = F.when(c("role") == "section_header", c("label"))
    rows = rows.withColumn("section", F.last(begins, ignorenulls=True).over(Window.partitionBy(*TABLE).orderBy("row").rowsBetween(Window.unboundedPreceding, 0)))
    fold = lambda t: folded(normalize_ws(t))
    sign = F.struct(F.transform("labels", fold).alias("labels"), c("role"), F.when(c("section").isNull(), none).otherwise(F.array(fold(c("section")))).alias("section"))
    rows = rows.withColumn("signature", F.to_json(sign))
    rows = rows.withColumn("occurrence", F.row_number().over(Window.partitionBy(*TABLE, "signature").orderBy("row")) - 1)
    key = F.concat(slug(F.coalesce("label", "role"), "row"), F.lit("-"), F.substring(F.sha2(F.concat(F.lit('{"occurrence":'), c("occurrence").cast("string"), F.lit(',"signature":'), c("signature"), F.lit("}")), 256), 1, 8))
    return rows.select(*TABLE, "row", "role", "labels", "label_sources", "label", "section", "is_total", "is_placeholder", "confidence", key.alias("key"), "direct", values.alias("values"))


def section_table(rows: DataFrame, tables: DataFrame) -> DataFrame:
    """One row per section, from its band to the row before the next."""
    c = F.col
    starts = rows.where("role = 'section_header' and label is not null").select(*TABLE, c("row").alias("start_row"), c("label").alias("title"))
    by = Window.partitionBy(*TABLE).orderBy("start_row")
    starts = starts.withColumn("next", F.lead("start_row").over(by)).withColumn("occurrence", F.row_number().over(Window.partitionBy(*TABLE, folded(c("title"))).orderBy("start_row")) - 1)
    key = F.concat(slug(c("title"), "section"), F.lit("-"), F.substring(hashing.stable_hash(title=folded(c("title")), occurrence=c("occurrence")), 1, 8))
    ends = starts.join(tables.select(*TABLE, *BOUNDS), TABLE).withColumn("end_row", F.coalesce(c("next") - 1, c("t_row2")))
    return ends.select(*TABLE, key.alias("key"), "title", "start_row", "end_row", Rect(c("start_row"), c("t_col"), c("end_row"), c("t_col2")).ref.alias("range"))


def column_groups(f: DataFrame, tables: DataFrame, columns: DataFrame) -> DataFrame:
    """Groups of columns: merged labels over two columns or more in the header
    rows, and runs of value columns with one first path part; none by the
    table's title."""
    c = F.col
    own = tables.select(*TABLE, *BOUNDS, "header_rows", "title")
    heads = f.where((c("m_col2") > c("m_col")) & (c("said") != "")).join(own, TABLE)
    heads = heads.where(F.arrays_overlap("header_rows", F.sequence("m_row", "m_row2")))
    merged = heads.select(*TABLE, "title", F.greatest("m_col", "t_col").alias("min_col"), F.least("m_col2", "t_col2").alias("max_col"), c("said").alias("label"), a1(c("m_row"), c("m_col")).alias("source")).where("max_col > min_col")
    values = columns.where(c("role").isin(*VALUE_ROLES))
    same = runs(values, TABLE, "col", "group").where("size >= 2")
    first = values.select(*TABLE, c("col").alias("start"), F.get("header_sources", F.lit(0)).alias("source"))
    lined = same.join(first, [*TABLE, "start"]).join(own.select(*TABLE, "title"), TABLE).select(*TABLE, "title", c("start").alias("min_col"), c("end").alias("max_col"), c("group").alias("label"), "source")
    both = merged.withColumn("by", F.lit(0)).unionByName(lined.withColumn("by", F.lit(1))).where(F.coalesce(folded(c("title")) != folded(c("label")), F.lit(True)))
    one = both.groupBy(*TABLE, "min_col", "max_col", folded(c("label")).alias("fold")).agg(F.min(F.struct("by", "label", "source")).alias("x"))
    key = F.concat(slug(c("label"), "column-group"), F.lit("-"), F.substring(hashing.stable_hash(label=c("fold"), width=c("max_col") - c("min_col") + 1), 1, 8))
    return one.select(*TABLE, "min_col", "max_col", "fold", "x.label", "x.source").select(*TABLE, key.alias("key"), "label", "min_col", "max_col", "source")


def layout_kind(groups: Column, sections: Column, value_columns: Column, label_columns: Column, placeholder_rows: Column, data_rows: Column) -> Column:
    """Layout of a table from its counts; the first match wins. ``data_rows``
    counts placeholders, too."""
    return (
        F.when((groups > 0) & (sections > 0), "compound_matrix").when(groups > 0, "horizontal_compound_matrix").when((sections > 0) & (value_columns >= 2), "sectioned_matrix")
        .when((value_columns >= 2) & (label_columns > 0), "matrix").when((data_rows > 0) & (placeholder_rows == data_rows), "input_grid").when((value_columns == 1) & (label_columns > 0), "list").otherwise("region")
    )


def infer(cells: DataFrame) -> Structure:
    """The structure of all tables. ``cells`` are keyed by table; BOUNDS, if
    they carry them, are the table's own, else what the cells span."""
    c = F.col
    f = stored(features(cells), "features")
    if BOUNDS[0] in cells.columns:
        bounds, f = f.select(*TABLE, *BOUNDS).distinct(), f.drop(*BOUNDS)
    else:
        bounds = f.groupBy(*TABLE).agg(F.min("row").alias("t_row"), F.min("col").alias("t_col"), F.max("row").alias("t_row2"), F.max("col").alias("t_col2"))
    bounds = stored(bounds, "bounds")
    facts = stored(_row_facts(f.join(bounds, TABLE)), "row-facts")
    banded = stored(header_band(bounds, facts), "bands")
    tables = stored(banded.join(titles(banded, facts), TABLE, "left"), "titled")
    columns = stored(describe_columns(f, tables), "columns")
    rows = stored(describe_rows(f, facts, tables, columns), "rows")
    sections, groups = stored(section_table(rows, tables), "sections"), stored(column_groups(f, tables, columns), "groups")
    per = lambda df, **kinds: df.groupBy(*TABLE).agg(*[F.count_if(k).alias(n) for n, k in kinds.items()])
    counts = [
        per(columns, value_columns=c("role").isin(*VALUE_ROLES), label_columns=c("role").isin(*LABEL_ROLES)), per(rows, placeholders=c("is_placeholder"), data_rows=c("role") == "data"),
        per(sections, sections=F.lit(True)), per(groups, groups=F.lit(True)),
    ]
    out = tables
    for one in counts:
        out = out.join(one, TABLE, "left")
    out = out.fillna(0, ["value_columns", "label_columns", "placeholders", "data_rows", "sections", "groups"])
    warnings = F.array_compact(F.array(
        "header_warning", F.when(c("title").isNull(), "No reliable table title was detected."), F.when(c("label_columns") == 0, "No reliable row-label column was detected."), F.when(c("value_columns") == 0, "No reliable value column was detected."),
    ))
    kind = layout_kind(*[c(n) for n in ("groups", "sections", "value_columns", "label_columns", "placeholders", "data_rows")])
    out = out.select(*TABLE, *BOUNDS, "header_rows", "title", kind.alias("layout"), warnings.alias("warnings"))
    return Structure(f, stored(out, "tables"), columns, rows, sections, groups)


def fingerprints(s: Structure) -> DataFrame:
    """schema, layout, formula, style and semantics hashes and the key of each
    table; positions are relative to the table, texts folded."""
    from ..functions.formulas import translated_udf

    c = F.col
    fold = lambda t: folded(normalize_ws(F.coalesce(t, F.lit(""))))
    json = lambda x: F.to_json(x, {"ignoreNullFields": "false"})
    parts = F.transform("path", fold)
    cols = s.columns.groupBy(*TABLE).agg(
        F.array_sort(F.collect_list(F.struct("col", json(F.struct("comparison_kind", parts.alias("header"), fold(c("measure")).alias("measure"), "role", "scenario", "unit", "year")).alias("j")))).alias("x"),
        F.array_sort(F.collect_list(F.struct("col", json(F.struct("role", "scenario", "year", "comparison_kind", "unit", fold(c("measure")).alias("measure"))).alias("j")))).alias("m"),
    )
    said = json(F.struct("is_total", F.transform("labels", fold).alias("labels"), "role", F.array_compact(F.array(fold(c("section")))).alias("section")))
    lines = s.rows.where("role <> 'spacer'").groupBy(*TABLE).agg(F.array_sort(F.collect_list(F.struct("row", said.alias("j")))).alias("r"))
    rel = lambda row, col: F.concat_ws(",", (row - c("t_row")).cast("string"), (col - c("t_col")).cast("string"))
    at = s.cells.join(s.tables.select(*TABLE, *BOUNDS), TABLE)
    shape = F.when((c("m_row") == c("row")) & (c("m_col") == c("col")) & (c("m_row2") <= c("t_row2")) & (c("m_col2") <= c("t_col2")), F.concat_ws(":", rel(c("m_row"), c("m_col")), rel(c("m_row2"), c("m_col2"))))
    order = lambda p: F.transform(F.array_sort(F.collect_list(F.when(p.isNotNull(), F.struct("row", "col", p.alias("p"))))), lambda x: F.concat_ws("|", x["p"]))
    here = rel(c("row"), c("col"))
    per_row = at.groupBy(*TABLE, "row").agg(*[F.sha2(F.array_join(order(p), "\n"), 256).alias(n) for n, p in (("merge", shape), ("style", F.when(c("style_hash").isNotNull(), F.concat_ws(":", here, c("style_hash")))), ("formula", F.when(c("calc"), F.concat_ws(":", here, translated_udf("formula", "row", "col")))))])
    whole = per_row.groupBy(*TABLE).agg(*[F.sha2(F.array_join(F.array_sort(F.collect_list(F.struct("row", n)))[n], "\n"), 256).alias(n) for n in ("merge", "style", "formula")])
    spans = s.sections.groupBy(*TABLE).agg(F.array_sort(F.collect_list(F.struct("start_row", "end_row", fold(c("title")).alias("t")))).alias("sp"))
    grouped = s.groups.groupBy(*TABLE).agg(F.array_sort(F.collect_list(F.struct("min_col", "max_col", fold(c("label")).alias("t")))).alias("gp"))
    t = s.tables
    for one in (cols, lines, whole, spans, grouped):
        t = t.join(one, TABLE, "left")
    schema = F.sha2(F.concat_ws("\n", fold(c("title")), F.array_join(c("x")["j"], "\n"), F.array_join(c("r")["j"], "\n")), 256)
    def placed(name: str, base: str, low: str, high: str) -> Column:
        return F.transform(name, lambda x: F.concat_ws(",", (x[low] - c(base)).cast("string"), (x[high] - c(base)).cast("string"), x["t"]))

    spans_, groups_ = placed("sp", "t_row", "start_row", "end_row"), placed("gp", "t_col", "min_col", "max_col")
    layout = F.sha2(F.concat_ws("\n", (c("t_col2") - c("t_col")).cast("string"), (c("t_row2") - c("t_row")).cast("string"), F.transform("header_rows", lambda r: (r - c("t_row")).cast("string")), c("merge"), spans_, groups_), 256)
    out = t.select(*TABLE, fold(c("title")).alias("fold"), schema.alias("schema"), layout.alias("layout"), "formula", "style", F.sha2(F.array_join(c("m")["j"], "\n"), 256).alias("semantics"))
    return out.select(*TABLE, F.concat(F.lit("table-"), F.substring(hashing.stable_hash(title=c("fold"), schema=c("schema")), 1, 16)).alias("table_key"), "schema", "layout", "formula", "style", "semantics")

"""Extraction of workbooks: from files to tables, records and a bundle."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Settings
from .functions import hashing
from .functions.formulas import dependencies_udf, referenced_sheets, signature_udf, simple_dependencies, status_udf
from .functions.geometry import Rect, a1
from .operators import aggregates, spatial
from .plans import clean, detect, export, structure
from .plans.annotations import annotate
from .plans.report import html_report
from .selection import select_sheets
from .sources import ooxml
from .storage import stored

TABLE = ["workbook", "sheet"]
#: Merges up to this many cells are written out (a fixed value).
MERGE_CELLS = 100_000


@dataclass
class Extraction:
    """DataFrames of one run. Intermediate tables are written; what stands
    here is computed from them when it is used."""

    workbooks: DataFrame
    sheets: DataFrame
    cells: DataFrame
    ranges: DataFrame
    names: DataFrame
    candidates: DataFrame
    tables: DataFrame
    columns: DataFrame
    rows: DataFrame
    sections: DataFrame
    groups: DataFrame
    long: DataFrame
    clean: DataFrame
    clean_columns: DataFrame
    clean_tables: DataFrame
    dropped_rows: DataFrame
    dropped_columns: DataFrame
    unassigned: DataFrame
    annotations: DataFrame
    warnings: DataFrame
    digests: DataFrame
    counts: DataFrame


def effective_cells(cells: DataFrame, cached: bool = True) -> DataFrame:
    """Kind and value of formulas are the stored result's; without one, the
    kind is formula and there is no value. The literal columns of other cells
    stay as they are."""
    c = F.col
    present = c("formula").isNotNull() & (c("cache_status") == "present") & F.lit(cached)
    pairs = {"kind": "cache_kind", "v_str": "cache_str", "v_num": "cache_num", "v_bool": "cache_bool", "v_ts": "cache_ts"}
    status = F.when(c("formula").isNotNull() & ~F.lit(cached), "not_read").otherwise(c("cache_status"))
    return cells.select(*[n for n in cells.columns if n not in (*pairs, "cache_status")], status.alias("cache_status"), *[F.when(present, c(k)).otherwise(c(v)).alias(v) for v, k in pairs.items()])


def with_merges(cells: DataFrame, merges: DataFrame, limit: int = MERGE_CELLS) -> DataFrame:
    """Cells with their merge (m_row, m_col, m_row2, m_col2) and what its anchor
    says (a_...). Merged cells that the file leaves out are added, blank, for
    merges of ``limit`` cells at most."""
    c = F.col
    boxes = merges.select(*TABLE, *Rect.of().columns()).distinct()
    places = spatial.materialise(boxes, limit)
    missing = places.join(cells.select(*TABLE, "row", "col"), [*TABLE, "row", "col"], "left_anti")
    filled = {"coord": a1(c("row"), c("col")), "kind": F.lit("blank"), "cache_status": F.lit("not_applicable"), "bold": F.lit(False), "italic": F.lit(False), "has_fill": F.lit(False), "border_edges": F.lit(0)}
    types = dict(cells.dtypes)
    blank = missing.select(*[c(n) if n in (*TABLE, "row", "col") else filled.get(n, F.lit(None)).cast(types[n]).alias(n) for n in cells.columns])
    every = spatial.cells_in_rects(cells.unionByName(blank), boxes, "left")
    names = dict(zip(("min_row", "min_col", "max_row", "max_col"), ("m_row", "m_col", "m_row2", "m_col2"), strict=True))
    # merges don't overlap in a sound file; where they do, the smallest counts
    rank = F.row_number().over(spatial.Window.partitionBy(*TABLE, "row", "col").orderBy(Rect.of().area, "min_row", "min_col"))
    every = every.withColumn("turn", F.when(c("min_row").isNotNull(), rank)).where("turn is null or turn = 1").drop("turn").withColumnsRenamed(names)
    anchors = structure.own_texts(every.where((c("row") == c("m_row")) & (c("col") == c("m_col"))))
    measure = structure.has_formula(c("formula")) | c("kind").isin(*structure.NUMERIC_KINDS)
    lent = anchors.select(*TABLE, "m_row", "m_col", c("said").alias("a_said"), structure.cell_text(c("kind"), c("v_str")).alias("a_text"), c("head").alias("a_head"), c("shown").alias("a_shown"), c("full").alias("a_full"), measure.alias("a_measure"), c("formula").alias("a_formula"))
    return every.join(lent, [*TABLE, "m_row", "m_col"], "left")


def with_marks(cells: DataFrame, ranges: DataFrame, dimensions: DataFrame, settings: Settings) -> DataFrame:
    """Adds what ranges say of each cell: its validations and conditional
    formats by id, comment, link, and whether its row or column is hidden."""
    c = F.col
    kinds = [k for k, on in (("validation", settings.include_validation_membership), ("conditional_format", settings.include_conditional_format_membership), ("comment", True), ("hyperlink", True)) if on]
    marks = ranges.where(c("kind").isin(*kinds)).select(*TABLE, *Rect.of().columns(), c("kind").alias("mark"), F.coalesce(F.get_json_object("details", "$.id"), "name").alias("what"))
    found = spatial.cells_in_rects(cells.select(*TABLE, "row", "col"), marks)
    of = lambda kind: F.array_sort(F.collect_set(F.when(c("mark") == kind, c("what"))))
    lists = found.groupBy(*TABLE, "row", "col").agg(of("validation").alias("validations"), of("conditional_format").alias("conditional_formats"), F.min(F.when(c("mark") == "comment", c("what"))).alias("comment"), F.min(F.when(c("mark") == "hyperlink", c("what"))).alias("hyperlink"))
    out = cells.join(lists, [*TABLE, "row", "col"], "left")
    some = lambda name: F.coalesce(F.size(name) > 0, F.lit(False))
    out = out.withColumns({"has_validation": some("validations"), "has_conditional_format": some("conditional_formats"), "has_comment": c("comment").isNotNull(), "has_hyperlink": c("hyperlink").isNotNull()})
    rows = dimensions.where("axis = 'row'").select(*TABLE, c("first").alias("row"), "hidden")
    spans = dimensions.where("axis = 'column'").select(*TABLE, c("first").alias("min_col"), c("last").alias("max_col"), "hidden")
    return spatial.hidden_cells(out, rows, spans)


def table_cells(cells: DataFrame, tables: DataFrame) -> DataFrame:
    """Cells of each table, keyed as a sheet of its own: the plans then work on
    tables as on sheets. A table without any stored cell has none."""
    inside = spatial.cells_in_rects(cells, tables.select(*TABLE, F.col("key").alias("table_key"), *Rect.of().columns()))
    names = dict(zip(("min_row", "min_col", "max_row", "max_col"), structure.BOUNDS, strict=True))
    return inside.drop("sheet").withColumnRenamed("table_key", "sheet").withColumnsRenamed(names)


def extract(spark: SparkSession, path: str, sheets: list[str] | None = None, settings: Settings | None = None, **selectors) -> Extraction:
    """Reads the workbooks under ``path`` and finds the tables of the selected
    sheets (all, unless ``sheets`` or selectors name some). Each workbook is
    parsed once; sheets are selected workbook by workbook."""
    c = F.col
    settings = settings or Settings()
    found = ooxml.scan(spark, path, settings)
    catalog = found["sheet"]
    chosen = select_sheets(catalog, names=sheets, strict=True, **selectors) if sheets or any(selectors.values()) else catalog
    keys = chosen.select(*TABLE)
    own = lambda df: df.join(keys, TABLE, "left_semi")
    raw, ranges = own(found["cell"]), own(found["range"])
    of = lambda kind: ranges.where(c("kind") == kind)
    merges = of("merge").select(*TABLE, *Rect.of().columns())
    cells = stored(with_marks(with_merges(effective_cells(raw, settings.include_cached_values), merges), ranges, found["dimension"], settings), "cells")

    # candidates and tables
    names = ooxml.named(found["name"])
    place = F.regexp_extract(F.regexp_replace("definition", "'", ""), r"^=?([^!]+)!", 1)
    static = names.where("status = 'static' and not built_in").where(Rect.of().area <= settings.max_table_area).select("workbook", place.alias("sheet"), "name", *Rect.of().columns())
    extra = detect.candidates(own(static), "named-range", c("name"), False).unionByName(detect.candidates(of("table"), "explicit-range", c("name"), True))
    scored = stored(detect.detect_tables(cells, extra, merges, settings.table_score_threshold, settings.uncertain_table_threshold, settings.max_table_area, (settings.horizontal_gap, settings.vertical_gap)), "scored")
    accepted = scored.where("decision <> 'rejected'").withColumn("key", F.concat_ws("|", "sheet", "candidate"))
    inside = table_cells(cells, accepted)
    made = structure.infer(inside)
    of_key = accepted.select("workbook", c("key").alias("sheet"), "source_name")
    cleaned = clean.clean(made, of_key)

    # every table's id, by what identifies it
    t = accepted.select("workbook", c("sheet").alias("of_sheet"), c("key").alias("sheet"), *Rect.of().columns(), "methods", "source_name", "confidence", "decision", "reasons")
    t = t.join(made.tables.select(*TABLE, c("title").alias("own_title"), c("layout").alias("own_layout"), "header_rows", "warnings"), TABLE)
    native = F.array_contains("methods", "explicit-range")
    title, layout = F.when(native, F.coalesce("source_name", "own_title")).otherwise(c("own_title")), c("own_layout")
    t = t.withColumns({"title": title, "layout_kind": layout, "range": Rect.of().ref})
    t = t.withColumn("table_id", hashing.table_id(c("of_sheet"), c("range"), c("title"), c("layout_kind"), c("source_name")))
    t = t.join(structure.fingerprints(made), TABLE, "left")
    t = stored(t, "tables")
    ids = t.select(*TABLE, "of_sheet", "table_id")
    given = lambda df: df.join(ids, TABLE).drop("sheet").withColumnRenamed("of_sheet", "sheet")
    tables = t.drop("sheet", "own_title", "own_layout").withColumnRenamed("of_sheet", "sheet")

    features = structure.features(cells)
    rejected = scored.where("decision = 'rejected'")
    outside = spatial.cells_in_rects(cells.join(features.where("structural").select(*TABLE, "row", "col"), [*TABLE, "row", "col"], "left_semi"), tables.select(*TABLE, *Rect.of().columns()), "left_anti")
    needs = raw.where("formula is not null").select(*TABLE, F.explode(referenced_sheets(simple_dependencies(c("formula")))).alias("needed"))
    missing = needs.join(keys.select("workbook", c("sheet").alias("needed")), ["workbook", "needed"], "left_anti").join(catalog.select("workbook", c("sheet").alias("needed")), ["workbook", "needed"], "left_semi")
    missing = missing.groupBy(*TABLE, "needed").agg(F.count("*").alias("n"))
    missing = missing.select("workbook", F.lit("DEPENDENCY_SHEET_NOT_SELECTED").alias("code"), F.concat(F.lit("formulas refer to "), c("needed")).alias("message"), "sheet", F.to_json(F.struct("n", "needed")).alias("details"))
    remarks = given(made.tables.select(*TABLE, F.explode("warnings").alias("message"))).select("workbook", F.lit("TABLE_STRUCTURE").alias("code"), "message", "sheet", F.to_json(F.struct("table_id")).alias("details"))
    warnings = found["warning"].unionByName(ooxml.name_warnings(names)).unionByName(missing).unionByName(remarks)
    text = lambda *n: hashing.canonical_json(**{x: c(x).cast("string") for x in n})
    filled = (c("kind") != "blank") | c("formula").isNotNull()
    digests = aggregates.digests(cells, {
        "layout": F.when(c("m_row").isNotNull() | (c("border_edges") > 0), text("coord", "m_row", "m_col", "m_row2", "m_col2", "border_edges")), "formula": F.when(c("formula").isNotNull(), text("coord", "formula")),
        "style": F.when(c("style_hash").isNotNull(), text("coord", "style_hash")), "content": F.when(filled, text("coord", "kind", "v_str", "v_num", "v_bool", "v_ts", "formula", "cache_status")),
    }, TABLE, ["col"])
    return Extraction(
        workbooks=found["workbook"], sheets=chosen, cells=cells, ranges=ranges, names=names, candidates=scored, tables=tables, columns=given(made.columns), rows=given(made.rows.drop("direct")), sections=given(made.sections), groups=given(made.groups),
        long=given(export.long_records(made)), clean=given(cleaned.cells), clean_columns=given(cleaned.columns), clean_tables=given(cleaned.tables), dropped_rows=given(cleaned.dropped_rows), dropped_columns=given(cleaned.dropped_columns),
        unassigned=outside, annotations=annotate(features, tables, rejected), warnings=aggregates.warning_dedup(warnings, ["workbook", "code", "sheet", "message"], ["details"]), digests=digests, counts=aggregates.sheet_counts(cells),
    )


def formula_signatures(cells: DataFrame) -> DataFrame:
    return cells.where("formula is not null").select(*TABLE, "row", "col", signature_udf("formula", "row", "col").alias("signature"))


def formula_records(cells: DataFrame) -> DataFrame:
    """Each formula with its type, whether it can be split into tokens, its
    relative signature, its operands in order, and the state of its result."""
    f = cells.where("formula is not null")
    return f.select(*TABLE, "row", "col", "coord", "formula", "formula_type", "cache_status", status_udf("formula").alias("status"), signature_udf("formula", "row", "col").alias("signature"), dependencies_udf("formula").alias("operands"))


def write_bundle(spark: SparkSession, run: Extraction, target: str, settings: Settings | None = None) -> str:
    """Writes a run as a folder that appears whole or not at all. Records are
    written by the executors, so on a cluster the target must be a folder that
    they share; the manifest and previews, which are bounded, by the driver."""
    settings = settings or Settings()
    listed = lambda df, *order: [r.asDict(recursive=True) for r in df.orderBy(*order).collect()]
    records = {
        "cells": run.cells, "formulas": formula_records(run.cells), "unassigned_cells": run.unassigned, "annotations": run.annotations, "ranges": run.ranges, "defined_names": run.names, "warnings": run.warnings, "candidates": run.candidates, "columns": run.columns, "rows": run.rows, "sections": run.sections,
        "column_groups": run.groups, "dropped_rows": run.dropped_rows, "dropped_columns": run.dropped_columns, "clean_columns": run.clean_columns, "clean_tables": run.clean_tables,
    }
    digests = run.digests.persist()
    try:
        with export.Bundle(target) as out:
            index = listed(run.tables.select(*TABLE, "table_id", "title", "range", "layout_kind", "confidence", "decision", "table_key"), "workbook", "sheet", "range")
            out.json("manifest.json", {
                "settings": asdict(settings), "settings_fingerprint": settings.fingerprint, "workbooks": listed(run.workbooks, "workbook"), "sheets": listed(run.sheets, "workbook", "position"), "tables": index,
                "digests": listed(digests, *TABLE), "fingerprints": listed(aggregates.workbook_digest(digests), "workbook"), "counts": listed(run.counts, *TABLE),
                "warnings": listed(aggregates.warning_summary(run.warnings, "code", "details", "message"), "code"),
            })
            out.json("schema.json", {name: df.schema.jsonValue() for name, df in {**records, "records_long": run.long, "clean_records": run.clean}.items()})
            for name, df in records.items():
                out.jsonl(f"{name}.jsonl", df)
            for name, df, order in (("records_long", run.long, ["workbook", "sheet", "table_id", "row", "col"]), ("clean_records", run.clean, ["workbook", "sheet", "table_id", "row", "col"])):
                df = stored(df.orderBy(*order), name)  # files in order of their names
                out.jsonl(f"{name}.jsonl", df)
                out.csv(f"{name}.csv", df, settings.csv_formula_injection_safe)
            out.csv("tables_index.csv", run.tables.drop("methods", "reasons", "warnings", "header_rows"), settings.csv_formula_injection_safe)
            out.csv("clean_tables_index.csv", run.clean_tables.drop("header_rows"), settings.csv_formula_injection_safe)
            out.jsonl("styles.jsonl", run.cells.where("style_hash is not null").select("style_hash", "number_format", "bold", "italic", "has_fill", "border_edges").dropDuplicates(["style_hash"]))
            out.path("report.html").write_text(html_report(run, settings), "utf-8")
    finally:
        digests.unpersist()
    return str(target)


__all__ = ["Extraction", "Settings", "effective_cells", "extract", "formula_records", "formula_signatures", "structure", "with_merges", "write_bundle"]

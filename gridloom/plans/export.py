"""Tidy and wide records of tables, and files for other programs."""

from __future__ import annotations

import json
import os
import shutil
import uuid
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import headers
from ..functions.text import csv_guard
from ..functions.values import value_state
from .structure import TABLE, Structure

EXCLUDED_ROWS = ("title", "header", "section_header", "spacer", "note", "footnote")  # fixed values
MEASURES = ("measure", "formula_measure", "variance", "unknown_measure")  # fixed values


def long_records(s: Structure) -> DataFrame:
    """One observation per data row and measure column, with the row's labels,
    section and what the header says. Rows, columns and cells meet by equality
    joins on the sheet and the row or column. A formula's value is its stored
    result, and its state tells when there is none."""
    c = F.col
    columns = s.columns.where(c("role").isin(*MEASURES)).select(*TABLE, "col", c("role").alias("column_role"), c("key").alias("column_key"), headers.joined(c("path")).alias("column_header"), c("group").alias("measure_group"), "scenario", "year", "comparison_kind", "unit", "measure", c("confidence").alias("column_confidence"))
    rows = s.rows.where(~c("role").isin(*EXCLUDED_ROWS)).select(*TABLE, "row", c("role").alias("row_role"), "section", c("label").alias("row_label"), c("labels").alias("row_labels"), "is_total", "is_placeholder", "confidence")
    out = s.cells.join(rows, [*TABLE, "row"]).join(columns, [*TABLE, "col"])
    state = value_state(c("kind"), c("v_str"), c("v_num"), c("formula"), c("cache_status"))
    value = F.when(~c("calc") | (c("cache_status") == "present"), c("shown"))
    return out.select(
        *TABLE, "row", "col", "coord", "row_role", "section", "row_label", "row_labels", "is_total", "is_placeholder", "column_role", "column_key", "column_header", "measure_group", "scenario", "year", "comparison_kind", "unit", "measure",
        value.alias("value"), state.alias("value_state"), "formula", "cache_status", "number_format", "style_hash", F.round(F.least("confidence", "column_confidence"), 6).alias("confidence"),
    )


def values_wide(records: DataFrame, columns: list[str]) -> DataFrame:
    """One row per source row and one column per given header."""
    return records.groupBy(*TABLE, "row", "row_label").pivot("column_header", columns).agg(F.first("value"))


def csv_safe(df: DataFrame, guard: bool = True) -> DataFrame:
    """All columns as text: nested ones as JSON, and with ``guard`` nothing
    reads as a formula."""
    kinds = dict(df.dtypes)
    text = lambda n: F.to_json(n) if kinds[n].startswith(("array", "map", "struct")) else F.col(n).cast("string")
    return df.select(*[(csv_guard(text(n)) if guard else text(n)).alias(n) for n in df.columns])


class Bundle:
    """An output folder that appears whole or not at all: files go to a sibling
    folder, which is renamed at the end. An existing target is an error."""

    def __init__(self, target: str):
        self.target = Path(target).absolute()
        if self.target.exists():
            raise FileExistsError(self.target)
        self.target.parent.mkdir(parents=True, exist_ok=True)
        self.work = self.target.parent / f".{self.target.name}.{uuid.uuid4().hex[:8]}"

    def __enter__(self):
        self.work.mkdir()
        return self

    def __exit__(self, kind, value, trace):
        if kind is None:
            os.rename(self.work, self.target)
        else:
            shutil.rmtree(self.work, ignore_errors=True)
        return False

    def path(self, relative: str) -> Path:
        out = (self.work / relative).resolve()
        if self.work.resolve() not in out.parents:
            raise ValueError(f"outside the bundle: {relative}")
        out.parent.mkdir(parents=True, exist_ok=True)
        return out

    def json(self, relative: str, value, compact: bool = False) -> None:
        style = {"separators": (",", ":")} if compact else {"indent": 2}
        self.path(relative).write_text(json.dumps(value, sort_keys=True, ensure_ascii=False, default=str, **style) + "\n", "utf-8")

    def jsonl(self, relative: str, df: DataFrame) -> None:
        """Written by the executors, one file per task."""
        df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(self.path(relative).as_uri())

    def csv(self, relative: str, df: DataFrame, guard: bool = True) -> None:
        csv_safe(df, guard).write.mode("overwrite").option("header", True).option("escape", '"').csv(self.path(relative).as_uri())


def default_output(source: str, root: str = ".") -> str:
    return f"{root}/output/{Path(source).stem}_{datetime.now(timezone.utc):%Y%m%dT%H%M%SZ}"

"""Which sheets of a catalog to read."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class SelectionError(ValueError):
    """A selector names nothing, or makes no sense."""


def glob_pattern(glob: str) -> str:
    """Case-sensitive glob as a regular expression: * ? [..]."""
    out, k = "", 0
    while k < len(glob):
        x = glob[k]
        if x == "*":
            out += ".*"
        elif x == "?":
            out += "."
        elif x == "[" and "]" in glob[k + 1 :]:
            end = glob.index("]", k + 1)
            inside = glob[k + 1 : end].replace("\\", "\\\\")
            out += f"[{'^' + inside[1:] if inside.startswith('!') else inside}]"
            k = end
        else:
            out += re.escape(x)
        k += 1
    return f"^(?s:{out})$"


def index_spans(indexes: str) -> list[tuple[int, int]]:
    spans = []
    for part in filter(None, (p.strip() for p in indexes.split(","))):
        m = re.fullmatch(r"(\d+)(?:\s*-\s*(\d+))?", part)
        if not m:
            raise SelectionError(f"not an index or a range: {part}")
        low, high = int(m[1]), int(m[2] or m[1])
        if low < 1 or high < low:
            raise SelectionError(f"a range must rise from 1: {part}")
        spans.append((low, high))
    return spans


def select_sheets(catalog: DataFrame, names: list[str] | None = None, globs: list[str] | None = None, indexes: str = "", every: bool = False, visible: bool = False, strict: bool = False) -> DataFrame:
    """Rows of ``catalog`` (position, sheet, state) that a selector names, in
    workbook order. ``every`` and ``visible`` win over the others; with
    ``strict``, mixing them is an error, and so is a selector without a match."""
    if every and visible:
        raise SelectionError("all and visible exclude each other")
    if every or visible:
        if strict and (names or globs or indexes):
            raise SelectionError("all or visible with other selectors")
        return (catalog if every else catalog.where("state = 'visible'")).orderBy("position")
    tests = [F.col("sheet") == n for n in names or []] + [F.col("sheet").rlike(glob_pattern(g)) for g in globs or []] + [F.col("position").between(a, b) for a, b in index_spans(indexes)]
    if not tests:
        raise SelectionError("nothing is selected")
    if strict:
        found = catalog.agg(*[F.count_if(t).alias(f"t{k}") for k, t in enumerate(tests)], F.max("position").alias("last")).first()
        if not all(found[f"t{k}"] for k in range(len(tests))) or any(b > found["last"] for _, b in index_spans(indexes)):
            raise SelectionError("a selector matches no sheet")
    condition = tests[0]
    for t in tests[1:]:
        condition = condition | t
    return catalog.where(condition).orderBy("position")

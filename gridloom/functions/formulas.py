"""Formula text: operands, dependencies and relative signatures.

A small tokenizer knows strings, quoted sheet names, brackets, operators and
numbers; what is left between them and looks like a reference is a range
operand. Formulas are never evaluated.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CELL = r"\$?[A-Za-z]{1,3}\$?[0-9]{1,7}"
TOKEN = re.compile(
    rf"""(?P<string>"(?:[^"]|"")*")"""
    rf"""|(?P<range>(?:(?:'(?:[^']|'')+'|[A-Za-z0-9_.\[\]]+)!)?(?:{CELL}(?::{CELL})?|\$?[A-Za-z]{{1,3}}:\$?[A-Za-z]{{1,3}}|\$?[0-9]{{1,7}}:\$?[0-9]{{1,7}})(?![A-Za-z0-9_.(!]))"""
    r"""|(?P<error>\#[A-Z/0]+[!?]?)|(?P<number>[0-9]+(?:\.[0-9]*)?(?:[eE][+-]?[0-9]+)?)|(?P<word>[^\W\d][\w.\\]*\(?)|(?P<other>.)""",
    re.X | re.S,
)
ONE = re.compile(r"(\$?)([A-Za-z]{1,3})(\$?)([0-9]{1,7})$")


class FormulaError(ValueError):
    """The text can't be split into tokens."""


def tokens(formula: str) -> list[tuple[str, str]]:
    if re.search(r"#REF!\s*:\s*#REF!", formula):
        raise FormulaError("a range between errors")
    body = formula[1:] if formula.startswith("=") else formula
    if body.count('"') % 2:
        raise FormulaError("a string without its end")
    return [(m.lastgroup, m[0]) for m in TOKEN.finditer(body)]


def dependencies(formula: str | None) -> list[str]:
    if not formula:
        return []
    try:
        return list(dict.fromkeys(text for kind, text in tokens(formula) if kind == "range"))
    except FormulaError:
        return []


def _number(letters: str) -> int:
    out = 0
    for x in letters.upper():
        out = out * 26 + ord(x) - 64
    return out


def _relative(cell: str, row: int, col: int) -> str:
    m = ONE.match(cell)
    if not m:
        return cell
    r = f"R{m[4]}" if m[3] else f"R[{int(m[4]) - row}]"
    c = f"C{_number(m[2])}" if m[1] else f"C[{_number(m[2]) - col}]"
    return r + c


def signature(formula: str | None, row: int, col: int) -> str | None:
    """The formula with references relative to its cell; strings and names stay."""
    if not formula:
        return None
    try:
        parts = tokens(formula)
    except FormulaError:
        return re.sub(r"\s+", " ", formula).strip()
    out = []
    for kind, text in parts:
        if kind == "range":
            sheet, mark, cells = text.rpartition("!")
            text = sheet + mark + ":".join(_relative(x, row, col) for x in cells.split(":"))
        out.append(text)
    return "=" + "".join(out)


def translated(formula: str | None, row: int, col: int) -> str | None:
    """The formula as if moved to A1: relative parts move along, and what would
    leave the sheet is an error. What can't be split is folded text."""
    if not formula:
        return None

    def one(cell: str) -> str | None:
        m = ONE.match(cell)
        if not m:
            return cell
        c = _number(m[2]) if m[1] else _number(m[2]) - col + 1
        r = int(m[4]) if m[3] else int(m[4]) - row + 1
        return f"{m[1]}{_letters(c)}{m[3]}{r}" if c > 0 and r > 0 else None

    try:
        parts = tokens(formula)
    except FormulaError:
        return re.sub(r"\s+", " ", formula).strip().casefold()
    out = []
    for kind, text in parts:
        if kind == "range":
            sheet, mark, cells = text.rpartition("!")
            moved = [one(x) for x in cells.split(":")]
            text = sheet + mark + ("#REF!" if None in moved else ":".join(moved))
        out.append(text)
    return "=" + "".join(out)


def _letters(number: int) -> str:
    out = ""
    while number:
        number, k = divmod(number - 1, 26)
        out = chr(65 + k) + out
    return out


def status(formula: str | None) -> str | None:
    if not formula:
        return None
    try:
        tokens(formula)
        return "ok"
    except FormulaError:
        return "failed"


@F.pandas_udf(T.ArrayType(T.StringType()))
def dependencies_udf(formula: pd.Series) -> pd.Series:
    return formula.map(dependencies)


@F.pandas_udf(T.StringType())
def signature_udf(formula: pd.Series, row: pd.Series, col: pd.Series) -> pd.Series:
    return pd.Series([signature(f, int(r), int(c)) for f, r, c in zip(formula, row, col, strict=True)])


@F.pandas_udf(T.StringType())
def translated_udf(formula: pd.Series, row: pd.Series, col: pd.Series) -> pd.Series:
    return pd.Series([translated(f, int(r), int(c)) for f, r, c in zip(formula, row, col, strict=True)])


@F.pandas_udf(T.StringType())
def status_udf(formula: pd.Series) -> pd.Series:
    return formula.map(status)


def simple_dependencies(formula: Column) -> Column:
    """Range operands without the tokenizer, in the JVM: enough for formulas
    that hold no text constants or functions named like cells."""
    return F.array_distinct(F.regexp_extract_all(formula, F.lit(rf"((?:(?:'(?:[^']|'')+'|[A-Za-z0-9_.]+)!)?{CELL}(?::{CELL})?)(?![A-Za-z0-9_.(!])"), 1))


def referenced_sheets(operands: Column) -> Column:
    """Sheet names of range operands, unquoted, distinct."""
    prefixed = F.filter(operands, lambda o: o.contains("!"))
    name = lambda o: F.replace(F.regexp_replace(F.regexp_replace(o, r"![^!]*$", ""), r"^'|'$", ""), F.lit("''"), F.lit("'"))
    return F.array_distinct(F.transform(prefixed, name))


def name_status(definition: Column) -> Column:
    """Status of a defined name before its destinations are checked."""
    upper = F.upper(definition)
    return F.when(upper.contains("#REF!"), "broken").when(upper.rlike(r"\b(?:OFFSET|INDIRECT)\("), "dynamic_unresolved").when(definition.rlike(r"^=?'?[^!']*\[[^!]*!"), "external_unresolved").otherwise("raw")

"""Values of cells: kind-tagged columns, cache status, states and views.

A cell has kind, v_str, v_num, v_bool, v_ts, formula, and for formulas a cached
value in cache_kind, cache_str, cache_num, cache_bool with cache_status. Literal
value, formula text and cached result are three things; a missing cache is
never a zero or a blank.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import folded, normalize_ws

# Texts that stand for states.
DASHES = ("-", "–", "—")
NOT_SIGNIFICANT = ("ns", "n/s", "n.a.", "n/a", "na")
PLACEHOLDERS = ("xxx", "xxxx", "tbd", "to be completed")
NUMERIC_KINDS = ("integer", "number", "decimal", "duration_seconds")


def number_text(number: Column) -> Column:
    """Whole numbers without a fraction, others as they are."""
    whole = (number == F.floor(number)) & (F.abs(number) < 1e15)
    return F.when(whole, number.cast("long").cast("string")).otherwise(number.cast("string"))


def has_formula(formula: Column) -> Column:
    return F.coalesce(formula != "", F.lit(False))


def effective(formula: Column, cache_status: Column, cached: Column, literal: Column) -> Column:
    return F.when(has_formula(formula), F.when(cache_status == "present", cached)).otherwise(literal)


def value_state(kind: Column, text: Column, number: Column, formula: Column, cache_status: Column) -> Column:
    """State of the effective value; ``kind``, ``text`` and ``number`` are the
    effective value's own."""
    plain = normalize_ws(text)
    low = folded(plain)
    return (
        F.when(has_formula(formula) & (F.coalesce(cache_status, F.lit("missing")) != "present"), "formula_cache_missing")
        .when(kind.isNull() | (kind == "blank"), "blank")
        .when(kind == "boolean", "boolean")
        .when(kind.isin(*NUMERIC_KINDS), F.when(number == 0, "zero").otherwise("number"))
        .when(plain.isin(*DASHES), "dash")
        .when(low.isin(*NOT_SIGNIFICANT), "ns")
        .when(low.isin(*PLACEHOLDERS), "placeholder")
        .when((kind == "error") | plain.startswith("#"), "excel_error")
        .otherwise("text")
    )


def display_text(kind: Column, text: Column, number: Column, boolean: Column, ts: Column) -> Column:
    return (
        F.when(kind == "boolean", F.when(boolean, "true").otherwise("false"))
        .when(kind.isin(*NUMERIC_KINDS), number_text(number))
        .when(kind == "datetime", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(text)
    )


def display_value(formula: Column, cache_status: Column, cached: Column, literal: Column) -> Column:
    """The cached result, else the formula's text, else the literal value."""
    return F.when(has_formula(formula), F.when((cache_status == "present") & cached.isNotNull(), cached).otherwise(formula)).otherwise(literal)


def clean_export(value: Column, formula: Column, literal: Column, formula_view: bool) -> Column:
    shown = F.coalesce(value, F.nullif(formula, F.lit("")), literal, F.lit(""))
    return F.when(has_formula(formula), formula).otherwise(shown) if formula_view else shown


def preview(formula: Column, cache_status: Column, cached: Column, literal: Column) -> Column:
    return F.when(has_formula(formula), F.when(cache_status == "present", cached).otherwise(F.lit("∅ cache"))).otherwise(literal)


def header_text(kind: Column, text: Column, number: Column, formula: Column) -> Column:
    """Text of a header cell; of numbers only whole years count."""
    year = kind.isin(*NUMERIC_KINDS) & (number == F.floor(number)) & number.between(1900, 2200)
    return F.when(has_formula(formula), "").when(year, number.cast("long").cast("string")).when(kind.isin("text", "error"), normalize_ws(text)).otherwise("")

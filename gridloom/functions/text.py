"""Text expressions, all evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python splits it: also NBSP, file separators and NEL.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]+"

# Patterns whose matches define the results.
BANNER = r"copy\s+(?:the\s+)?table|copy\s+.*(?:powerpoint|\bppt\b)|do\s+not\s+copy|not\s+(?:to\s+be\s+)?cop(?:y|ied)"
SOURCE = r"^\s*(?:source|sourcing)\b|https?://|equal\s+to\s+figures"
INSTRUCTION = r"^\s*(?:please|ensure|must|manually|enter|fill\s+in)\b|^\s*complete\s+(?:all|the|these|yellow|required|missing|cells?)\b|please\s+ensure"
NOTE = r"^\s*(?:note|definition|where)\b|^\s*(?:\*|\(\*)"
PROSE_BANNER = r"copy\s+table|please\s+ensure|instructions?|definitions?|notes?:"
NOTE_ROW = r"^\s*(?:note|source|sourcing|definition|where|please|\*|\(\*)|copy\s+table|do\s+not\s+copy|manual(?:ly)?\s+enter"
TITLE_BANNER = r"copy\s+table|copy\s+.*powerpoint|please\s+ensure"
BLOCK_SOURCE = r"source|sourcing|ilon|perseus|https?://|equal\s+to\s+figures"
BLOCK_INSTRUCTION = r"please|ensure|must|enter|complete|copy|do\s+not|manually"
TOTAL = r"(?:^|\b)(?:grand\s+total|sub\s*total|subtotal|total)(?:\b|$)"


def matches(text: Column, pattern: str) -> Column:
    """Case-insensitive search; false for null."""
    return F.coalesce(text.rlike(f"(?iu){pattern}"), F.lit(False))


def normalize_ws(text: Column) -> Column:
    """Runs of white space become one space; the ends are trimmed."""
    return F.trim(F.regexp_replace(text, SPACE, " "))


def folded(text: Column) -> Column:
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


def distinct_in_order(texts: Column) -> Column:
    return F.array_distinct(texts)


def without_repeats(texts: Column) -> Column:
    """Without texts that equal the one before, whatever their case."""
    return F.filter(texts, lambda t, k: F.coalesce(folded(normalize_ws(t)) != folded(normalize_ws(F.get(texts, k - 1))), F.lit(True)))


def slug(text: Column, fallback: str = "item", limit: int = 60) -> Column:
    made = F.regexp_replace(F.regexp_replace(folded(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    made = F.regexp_replace(F.substring(made, 1, limit), "-+$", "")
    return F.coalesce(F.nullif(made, F.lit("")), F.lit(fallback))


def csv_guard(text: Column) -> Column:
    """Keeps spreadsheets from reading text as a formula."""
    return F.when(text.rlike(r"^[=+\-@\t\r]"), F.concat(F.lit("'"), text)).otherwise(text)


def noise_kind(text: Column) -> Column:
    """banner, source, instruction, note or null; the first match wins."""
    return (
        F.when(matches(text, BANNER), "banner")
        .when(matches(text, SOURCE), "source")
        .when(matches(text, INSTRUCTION), "instruction")
        .when(matches(text, NOTE), "note")
    )


def is_prose(text: Column) -> Column:
    return F.coalesce(F.char_length(text) >= 80, F.lit(False)) | matches(text, PROSE_BANNER)


def row_drop_reason(role: Column, texts: Column, measures: Column) -> Column:
    """Why a body row goes: its role first, then noise; a noisy row with values
    (or of role data or total) stays if one of its texts is not noise."""
    role = F.lower(role)
    noise = noise_kind(F.array_join(texts, " | "))
    rescued = ((measures > 0) | role.isin("data", "total")) & F.exists(texts, lambda t: noise_kind(t).isNull())
    return (
        F.when(role == "section_header", "section")
        .when(role == "group_header", "group")
        .when(role.isin("note", "footnote", "source", "instruction", "banner", "spacer", "title"), role)
        .when(~rescued, noise)
    )

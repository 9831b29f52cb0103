"""Content-addressed identities: SHA-256 over canonical JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_json(**fields: Column) -> Column:
    """Compact JSON with sorted keys; nulls are kept."""
    return F.to_json(F.struct(*[v.alias(k) for k, v in sorted(fields.items())]), {"ignoreNullFields": "false"})


def stable_hash(**fields: Column) -> Column:
    return F.sha2(canonical_json(**fields), 256)


def cell_id(sheet: Column, coordinate: Column) -> Column:
    return F.concat(F.lit("cell_"), F.substring(stable_hash(coordinate=coordinate, sheet=sheet), 1, 18))


def table_id(sheet: Column, ref: Column, title: Column, layout_kind: Column, source_name: Column) -> Column:
    return F.concat(F.lit("tbl_"), F.substring(stable_hash(sheet=sheet, range=ref, title=title, layout_kind=layout_kind, source_name=source_name), 1, 16))

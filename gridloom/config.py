"""Settings of an extraction."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass

from .sources.ooxml import Limits


@dataclass(frozen=True)
class Settings(Limits):
    """Immutable settings that change results; the defaults are fixed values."""

    table_score_threshold: float = 0.50
    uncertain_table_threshold: float = 0.35
    horizontal_gap: int = 2
    vertical_gap: int = 1
    max_table_area: int = 1_000_000
    preview_rows: int = 120
    preview_columns: int = 80
    include_cached_values: bool = True
    include_conditional_format_membership: bool = True
    include_validation_membership: bool = True
    csv_formula_injection_safe: bool = True

    def __post_init__(self):
        if not 0 <= self.uncertain_table_threshold <= self.table_score_threshold <= 1:
            raise ValueError("thresholds must satisfy 0 <= uncertain <= table <= 1")
        if min(self.max_file_bytes, self.max_zip_entries, self.max_material_cells_per_sheet) <= 0:
            raise ValueError("limits must be positive")

    @property
    def fingerprint(self) -> str:
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True, separators=(",", ":")).encode()).hexdigest()

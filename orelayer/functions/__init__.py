from .values import (
    ISO_PATTERN,
    blank,
    canonical,
    iso_timestamp,
    period_label,
    strip,
    year_range,
)

__all__ = ["ISO_PATTERN", "blank", "canonical", "iso_timestamp", "period_label", "strip", "year_range"]

"""Trace columns of the bronze and silver layers."""

from __future__ import annotations

from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def add_trace(
    df: DataFrame,
    source_system: str = "unknown",
    source_entity: str | None = "unknown",
    extractor: str = "unknown",
    schema_version: str = "1.0",
    **custom: Any,
) -> DataFrame:
    """Bronze trace columns. ``source_entity=None`` takes each row's file name.

    Keywords that start with ``custom_`` become columns with a leading underscore.
    """
    entity = F.col("_metadata.file_name") if source_entity is None else F.lit(source_entity)
    extra = {f"_{k}": F.lit(v) for k, v in custom.items() if k.startswith("custom_")}
    return df.withColumns(
        {
            "_extraction_timestamp": F.current_timestamp(),
            "_source_system": F.lit(source_system),
            "_source_entity": entity,
            "_extractor_name": F.lit(extractor),
            "_schema_version": F.lit(schema_version),
            **extra,
        }
    )


def add_silver_metadata(
    df: DataFrame, source_path: str, transformer: str, version: str = "1.0", loaded_at: datetime | None = None
) -> DataFrame:
    """Silver columns; ``loaded_at`` marks all rows of one run with one time."""
    return df.withColumns(
        {
            "_silver_load_timestamp": F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp"),
            "_bronze_source_path": F.lit(source_path),
            "_transformer_name": F.lit(transformer),
            "_transformation_version": F.lit(version),
        }
    )

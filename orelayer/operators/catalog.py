"""Queries over the dataset catalog and registration of datasets.

The catalog is a set of metadata tables: ``datasets``, ``dataset_schemas``,
``dataset_lineage`` and ``governance_tags``. Queries take them as DataFrames.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.slots import SLOT, SlotLog

# The metadata tables.
DATASETS = (
    "dataset_id int, dataset_name string, layer string, format string, location string, description string, "
    "owner string, created_at timestamp, updated_at timestamp, row_count bigint, size_mb decimal(10,2), "
    "tags array<string>, metadata map<string,string>"
)
SCHEMAS = "dataset_id int, schema_version string, schema_definition string, is_current boolean, created_at timestamp"
LINEAGE = (
    "dataset_id int, source_dataset_id int, transformation_name string, transformation_type string, created_at timestamp"
)
TAGS = "dataset_id int, tag_type string, tag_value string, column_name string, confidence decimal(3,2), created_at timestamp"
TABLES = {"datasets": DATASETS, "dataset_schemas": SCHEMAS, "dataset_lineage": LINEAGE, "governance_tags": TAGS}

# Allowed layers and formats, relevance by matched field.
LAYERS = ("bronze", "silver", "gold")
FORMATS = ("parquet", "table", "view")
RELEVANCE_NAME, RELEVANCE_DESCRIPTION, RELEVANCE_OTHER = 1.0, 0.8, 0.5


# --- queries -------------------------------------------------------------------

def has_any_tag(tags: Sequence[str]) -> Column:
    return F.arrays_overlap("tags", F.array(*[F.lit(t) for t in tags]))


def filter_datasets(
    datasets: DataFrame, layer: str | None = None, owner: str | None = None, tags: Sequence[str] | None = None
) -> DataFrame:
    if layer is not None:
        datasets = datasets.filter(F.col("layer") == layer)
    if owner is not None:
        datasets = datasets.filter(F.col("owner") == owner)
    if tags:
        datasets = datasets.filter(has_any_tag(tags))
    return datasets


def page_of(df: DataFrame, order: Sequence[Column], page: int = 1, page_size: int = 20) -> DataFrame:
    """One page in a total order, with the number of all rows on each row."""
    total = df.agg(F.count("*")).scalar()
    rows = df.orderBy(*order).offset((page - 1) * page_size).limit(page_size)
    return rows.withColumn("total", total)


def list_datasets(
    datasets: DataFrame,
    layer: str | None = None,
    owner: str | None = None,
    tags: Sequence[str] | None = None,
    page: int = 1,
    page_size: int = 20,
) -> DataFrame:
    """Latest first; the id decides between equal times."""
    found = filter_datasets(datasets, layer, owner, tags)
    return page_of(found, [F.desc("updated_at"), F.asc("dataset_id")], page, page_size)


def get_dataset(datasets: DataFrame, dataset_id: int) -> DataFrame:
    return datasets.filter(F.col("dataset_id") == dataset_id)


def search_matches(
    datasets: DataFrame, text: str, layer: str | None = None, tags: Sequence[str] | None = None
) -> DataFrame:
    """All datasets that match in name, description or tags, with a relevance."""
    pattern = f"%{text}%"
    in_name, in_description = F.col("dataset_name").ilike(pattern), F.col("description").ilike(pattern)
    in_tags = F.to_json("tags").ilike(pattern)
    relevance = (
        F.when(in_name, F.lit(RELEVANCE_NAME))
        .when(in_description, F.lit(RELEVANCE_DESCRIPTION))
        .otherwise(F.lit(RELEVANCE_OTHER))
    )
    return (
        filter_datasets(datasets, layer, tags=tags)
        .filter(in_name | in_description | in_tags)
        .withColumn("relevance_score", relevance)
    )


def search(
    datasets: DataFrame, text: str, layer: str | None = None, tags: Sequence[str] | None = None, limit: int = 20
) -> DataFrame:
    """The most relevant matches."""
    order = [F.desc("relevance_score"), F.desc("updated_at"), F.asc("dataset_id")]
    return search_matches(datasets, text, layer, tags).orderBy(*order).limit(limit)


def neighbours(datasets: DataFrame, lineage: DataFrame, dataset_id: int | None = None) -> DataFrame:
    """Direct sources and consumers of one dataset, or of all of them."""

    def side(own: str, other: str, direction: str) -> DataFrame:
        edges = lineage.filter(F.col(own).isNotNull() & F.col(other).isNotNull())
        if dataset_id is not None:
            edges = edges.filter(F.col(own) == dataset_id)
        edges = edges.select(
            F.col(own).alias("of_dataset_id"),
            F.col(other).alias("dataset_id"),
            F.lit(direction).alias("direction"),
            "transformation_name",
            "transformation_type",
        )
        return edges.join(datasets, "dataset_id")

    return side("dataset_id", "source_dataset_id", "upstream").unionByName(
        side("source_dataset_id", "dataset_id", "downstream")
    )


def with_current_schema(datasets: DataFrame, schemas: DataFrame) -> DataFrame:
    current = schemas.filter("is_current").select("dataset_id", "schema_version", "schema_definition")
    return datasets.join(current, "dataset_id", "left")


def with_lineage_counts(datasets: DataFrame, lineage: DataFrame) -> DataFrame:
    """Distinct sources and consumers per dataset. Each side is counted before
    the join, so the two never multiply each other."""
    up = lineage.groupBy("dataset_id").agg(F.count_distinct("source_dataset_id").alias("upstream_count"))
    down = (
        lineage.filter(F.col("source_dataset_id").isNotNull())
        .groupBy(F.col("source_dataset_id"))
        .agg(F.count_distinct("dataset_id").alias("downstream_count"))
        .withColumnRenamed("source_dataset_id", "dataset_id")
    )
    joined = datasets.join(up, "dataset_id", "left").join(down, "dataset_id", "left")
    return joined.fillna(0, subset=["upstream_count", "downstream_count"])


def governance_of(tags: DataFrame, dataset_id: int) -> DataFrame:
    return tags.filter(F.col("dataset_id") == dataset_id)


def tagged_datasets(datasets: DataFrame, tags: DataFrame, tag_type: str = "pii") -> DataFrame:
    """Datasets that carry a tag of the type, each once."""
    marked = tags.filter(F.col("tag_type") == tag_type).select("dataset_id").distinct()
    return datasets.join(marked, "dataset_id", "left_semi")


def quality_summary(profiles: DataFrame, validations: DataFrame) -> DataFrame:
    """Scores of profiles and validation runs in one list."""
    profiled = profiles.select(
        F.lit("profiling").alias("metric_type"),
        F.col("source_name").alias("entity_name"),
        F.col("profile_timestamp").alias("metric_timestamp"),
        F.col("quality_score").cast("double").alias("score"),
        F.col("null_percentage").cast("double").alias("null_percentage"),
        F.col("duplicate_percentage").cast("double").alias("duplicate_percentage"),
    )
    share = F.col("rules_passed") / F.nullif(F.col("rules_executed"), F.lit(0)) * 100
    validated = validations.select(
        F.lit("validation").alias("metric_type"),
        F.col("pipeline_name").alias("entity_name"),
        F.col("validation_timestamp").alias("metric_timestamp"),
        F.round(share, 2).alias("score"),
    )
    return profiled.unionByName(validated, allowMissingColumns=True)


# --- the metadata store ------------------------------------------------------------

class Catalog:
    """The metadata tables as a log of registrations and changes below one base path.

    A dataset's id is the number that its registration won in the log, so two writers never get the
    same one; of two registrations of one name the lower number counts, and the other writer is told.
    Dataset, schema and lineage of a registration lie in one file. Nothing is ever updated: the
    current schema of a dataset is the one that was added last.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.registered = SlotLog(spark, f"{base.rstrip('/')}/registered")
        self.changed = SlotLog(spark, f"{base.rstrip('/')}/changed")

    def _rows(self, name: str) -> DataFrame:
        """All rows of a table with their place in the log, without those of void registrations."""
        schema = T.DataType.fromDDL(TABLES[name])
        first = self.registered.read(name, schema)
        if name in ("datasets", "dataset_schemas", "dataset_lineage"):
            names = self.registered.read("datasets", T.DataType.fromDDL(DATASETS))
            counts = names.groupBy("dataset_name").agg(F.min(SLOT).alias(SLOT)).select(SLOT)
            first = first.join(counts, SLOT, "left_semi").select(*first.columns)
        place = lambda later: F.struct(F.lit(later).alias("later"), SLOT).alias("_place")
        rows = first.select(*schema.names, place(0))
        return rows.unionByName(self.changed.read(name, schema).select(*schema.names, place(1)))

    def table(self, name: str) -> DataFrame:
        schema = T.DataType.fromDDL(TABLES[name])
        rows = self._rows(name)
        if name == "dataset_schemas":  # of one version that was added twice, the first counts
            kept = rows.groupBy("dataset_id", "schema_version").agg(F.min("_place").alias("_place"), F.min_by("schema_definition", "_place").alias("schema_definition"), F.min_by("created_at", "_place").alias("created_at"))
            latest = kept.groupBy("dataset_id").agg(F.max_by("schema_version", "_place").alias("_current"))
            rows = kept.join(latest, "dataset_id").withColumn("is_current", F.col("schema_version") == F.col("_current"))
        return rows.select(*schema.names)

    def _id_of(self, name: str) -> int | None:
        found = self.table("datasets").filter(F.col("dataset_name") == name).select("dataset_id").first()
        return None if found is None else found[0]

    def register(
        self,
        name: str,
        layer: str,
        location: str,
        df: DataFrame | None = None,
        sources: Sequence[str] = (),
        transformation: tuple[str, str] | None = None,
        format: str = "parquet",
        description: str | None = None,
        owner: str | None = None,
        row_count: int | None = None,
        size_mb: float | None = None,
        tags: Sequence[str] = (),
        metadata: Mapping[str, str] | None = None,
        schema_version: str = "1.0",
        now: datetime | None = None,
    ) -> int:
        """Add a dataset with its schema and lineage; names are unique."""
        if layer not in LAYERS:
            raise ValueError(f"unknown layer: {layer}")
        if format not in FORMATS:
            raise ValueError(f"unknown format: {format}")
        taken = ValueError(f"dataset '{name}' is already registered")
        ids = {r[0]: r[1] for r in self.table("datasets").where(F.col("dataset_name").isin(name, *sources)).select("dataset_name", "dataset_id").collect()}
        if name in ids:
            raise taken
        for source in sources:
            if source not in ids:
                raise ValueError(f"unknown source dataset: {source}")
        moment = now or datetime.now()
        kind, label = transformation or (None, None)

        def records(dataset_id: int) -> list[tuple[str, dict[str, Any]]]:
            found: list[tuple[str, dict[str, Any]]] = [("datasets", {
                "dataset_id": dataset_id, "dataset_name": name, "layer": layer, "format": format,
                "location": location, "description": description, "owner": owner, "created_at": moment,
                "updated_at": moment, "row_count": row_count, "size_mb": None if size_mb is None else round(size_mb, 2),
                "tags": list(tags), "metadata": dict(metadata or {})})]
            if df is not None:
                found.append(("dataset_schemas", {
                    "dataset_id": dataset_id, "schema_version": schema_version, "schema_definition": df.schema.json(), "created_at": moment}))
            for source in sources:
                found.append(("dataset_lineage", {
                    "dataset_id": dataset_id, "source_dataset_id": ids[source],
                    "transformation_name": label, "transformation_type": kind, "created_at": moment}))
            return found

        slot = self.registered.append(records)
        if self._id_of(name) != slot:  # another writer registered the name a moment before
            raise taken
        return slot

    def add_schema(self, dataset_id: int, df: DataFrame, version: str, now: datetime | None = None) -> None:
        """A further schema of a dataset, from now on the current one; versions are unique."""
        of = F.col("dataset_id") == dataset_id
        if not self.table("dataset_schemas").where(of & (F.col("schema_version") == version)).isEmpty():
            raise ValueError(f"dataset {dataset_id} has a schema {version} already")
        if self.table("datasets").where(of).isEmpty():
            raise ValueError(f"unknown dataset: {dataset_id}")
        self.changed.append(lambda _: [("dataset_schemas", {
            "dataset_id": dataset_id, "schema_version": version, "schema_definition": df.schema.json(), "created_at": now or datetime.now()})])

    def add_tag(
        self, dataset_id: int, tag_type: str, value: str | None = None, column: str | None = None,
        confidence: float | None = None,
    ) -> None:
        self.changed.append(lambda _: [("governance_tags", {
            "dataset_id": dataset_id, "tag_type": tag_type, "tag_value": value, "column_name": column,
            "confidence": None if confidence is None else round(confidence, 2), "created_at": datetime.now()})])

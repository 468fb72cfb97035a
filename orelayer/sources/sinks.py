"""Sinks: bronze, silver batches, marts, rejection log, backups, run records."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.contract import Contract
from ..session import create_new, delete, exists, list_names, move
from .files import BRONZE_PARTITION, SourceError, bronze_path, partition_values, read_latest_partition
from .ledger import list_files
from .slots import SlotLog

BATCH = "batch_id"
BUCKET = "key_bucket"
VERSION = "version"
MERGED = "_merged"
BACKUP_PARTITION = "backup_date"

# The layout of the rejection log.
REJECTION_COLUMNS = ("table_name", "raw_row", "reason", "rejected_at")


# --- bronze ----------------------------------------------------------------------

def append_bronze(df: DataFrame, base: str, table: str, day: date | str) -> str:
    """Append new files to the day's partition; existing files are never touched."""
    path = f"{bronze_path(base, table)}/{BRONZE_PARTITION}={day}"
    df.write.mode("append").parquet(path)
    return path


def land_bronze(df: DataFrame, base: str, table: str, day: date | str) -> bool:
    """Write the day's partition unless it holds files; False when it was skipped.

    The files are written aside and the finished folder is renamed into place, so a partition that
    is there is whole, whoever wrote it and whatever marks it carries.
    """
    spark = df.sparkSession
    path = f"{bronze_path(base, table)}/{BRONZE_PARTITION}={day}"
    if _has_files(spark, path):
        return False
    aside = f"{base.rstrip('/')}/_landing/{table}-{day}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(aside)
    if not _has_files(spark, path):
        delete(spark, path)  # at most the traces of a writer that broke off
        if move(spark, aside, path):
            return True
    delete(spark, aside)
    return False


def _has_files(spark: SparkSession, path: str) -> bool:
    return any(n[0] not in "._" for n in list_names(spark, path))


def append_files(df: DataFrame, base: str, table: str, day: date | str, name: str) -> None:
    """Add files of a given name to the day's partition; the same name again replaces its files."""
    spark = df.sparkSession
    path = f"{bronze_path(base, table)}/{BRONZE_PARTITION}={day}"
    aside = f"{base.rstrip('/')}/_landing/{table}-{day}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(aside)
    before = [n for n in list_names(spark, path) if n.startswith(f"{name}-")]
    mark = uuid.uuid4().hex[:8]
    for i, part in enumerate(n for n in list_names(spark, aside) if n[0] not in "._"):
        move(spark, f"{aside}/{part}", f"{path}/{name}-{i:05d}-{mark}.parquet")
    for old in before:  # readers see a row twice for a moment, never not at all
        delete(spark, f"{path}/{old}")
    delete(spark, aside)


def write_extract(df: DataFrame, base: str, prefix: str, moment: datetime, partition_by: Sequence[str] = ()) -> str:
    """Snappy Parquet in a folder named after the source and the time."""
    path = f"{base.rstrip('/')}/{prefix}_{moment:%Y%m%d_%H%M%S}.parquet"
    writer = df.write.mode("errorifexists").option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


# --- silver and rejections ---------------------------------------------------------

def key_bucket(key: Sequence[str], buckets: int) -> Column:
    """The bucket of a row's key out of ``buckets``, the same for equal typed keys in every batch."""
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def write_batch(df: DataFrame, path: str, batch_id: int | str, bucket: Column | None = None, by: str = BUCKET) -> None:
    """Replace one batch of a table. Writing a batch again changes nothing else.

    With a bucket (``key_bucket``, or another column named ``by``) the rows lie in
    a folder for each, so a later batch reads only the buckets that it touches.
    """
    target = f"{path}/{BATCH}={batch_id}"
    if bucket is not None:
        dealt = df.withColumn(by, bucket).hint("rebalance", by)
        dealt.write.mode("overwrite").partitionBy(by).parquet(target)
    else:
        df.write.mode("overwrite").parquet(target)


def read_batches(
    spark: SparkSession, path: str, schema: T.StructType, without: int | str | None = None,
    buckets: Sequence[int | None] | None = None, bucketed: bool = False, only: int | str | None = None,
    by: str = BUCKET, kind: T.DataType = T.IntegerType(),
) -> DataFrame:
    """The table over all batches, or an empty frame when nothing was written.

    ``buckets`` names the buckets that are needed; the others are not read.
    """
    if not partition_values(spark, path, BATCH):
        return spark.createDataFrame([], schema)
    layout = [T.StructField(BATCH, T.StringType())]
    if bucketed or by != BUCKET or buckets is not None:
        layout.append(T.StructField(by, kind))
    df = spark.read.schema(T.StructType([*schema.fields, *layout])).option("basePath", path).parquet(path)
    merged = merged_batches(spark, path)
    if merged:
        df = df.filter(~F.col(BATCH).isin(*merged))
    if without is not None:
        df = df.filter(F.col(BATCH) != str(without))
    if only is not None:
        df = df.filter(F.col(BATCH) == str(only))
    if buckets is not None:
        named = [b for b in buckets if b is not None]
        asked = F.col(by).isin(*named) if named else F.lit(False)
        df = df.filter(asked | F.col(by).isNull() if None in buckets else asked)
    return df.select(*schema.names)


# --- compaction ------------------------------------------------------------------------

def merged_batches(spark: SparkSession, path: str) -> list[str]:
    """Batches whose rows stand in a merged one already and whose folders are still there."""
    found = []
    for name in list_names(spark, f"{path}/{MERGED}"):
        if name.endswith(".json") and exists(spark, f"{path}/{BATCH}={name[: -len('.json')]}"):
            found += spark.read.schema("batches array<string>").json(f"{path}/{MERGED}/{name}").first()[0]
    return sorted(set(found) & set(partition_values(spark, path, BATCH))) if found else []


def bins_of(sizes: Mapping[str, int], most: int) -> list[list[str]]:
    """Batches smaller than ``most`` bytes, packed into bins of about that size; each into the first bin
    that has room, the largest first. Bins of one batch are left out."""
    bins: list[tuple[int, list[str]]] = []
    for batch in sorted((b for b, n in sizes.items() if n < most), key=lambda b: (-sizes[b], b)):
        for i, (size, names) in enumerate(bins):
            if size + sizes[batch] <= most:
                bins[i] = (size + sizes[batch], [*names, batch])
                break
        else:
            bins.append((sizes[batch], [batch]))
    return [names for _, names in bins if len(names) > 1]


def compact(spark: SparkSession, path: str, schema: T.StructType, most_bytes: int = 128 << 20, by: str | None = BUCKET) -> int:
    """Rewrite the small batches of a table as larger ones; returns how many folders went.

    A merged batch is written aside, a note names the batches that it stands for, and one rename puts
    it in place: from then on readers pass those batches over, and their folders go. Before it the
    note says nothing. Rows don't change. A batch that is run again later finds its rows stored and
    skips them. Nothing else writes to the table meanwhile.
    """
    for old in merged_batches(spark, path):  # what a compaction that broke off has left
        delete(spark, f"{path}/{BATCH}={old}")
    place = F.regexp_extract("path", f"/{BATCH}=([^/]+)/", 1)
    sizes = {r[0]: r[1] for r in list_files(spark, path).groupBy(place).agg(F.sum("length")).collect() if r[0]}
    layout = T.StructType([*schema.fields, *([T.StructField(by, T.IntegerType())] if by else [])])
    gone = 0
    for names in bins_of(sizes, most_bytes):
        merged, aside = f"merged-{uuid.uuid4().hex}", f"{path.rstrip('/').rsplit('/', 1)[0]}/_aside/{uuid.uuid4().hex}"
        stored = T.StructType([*layout.fields, T.StructField(BATCH, T.StringType())])
        rows = spark.read.schema(stored).option("basePath", path).parquet(*[f"{path}/{BATCH}={n}" for n in names]).select(*layout.names)
        (rows.hint("rebalance", by).write.partitionBy(by) if by else rows.hint("rebalance").write).parquet(aside)
        create_new(spark, f"{path}/{MERGED}/{merged}.json", json.dumps({"batches": names}))
        move(spark, aside, f"{path}/{BATCH}={merged}")
        for n in names:
            delete(spark, f"{path}/{BATCH}={n}")
        delete(spark, f"{path}/{MERGED}/{merged}.json")
        gone += len(names) - 1
    return gone


# --- versions of a table -------------------------------------------------------------

def current_version(spark: SparkSession, path: str) -> str:
    """The folder of the version that counts: the last one that was put in place."""
    found = partition_values(spark, path, VERSION)
    return f"{path}/{VERSION}={found[-1] if found else f'{0:09d}'}"


def publish_version(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """A new version of a table: written aside, put in place by one rename, the older ones then
    removed. Whoever reads, and whatever breaks off, finds the old version or the new one whole."""
    aside = f"{path.rstrip('/')}_aside/{uuid.uuid4().hex}"
    write(aside)
    while True:
        found = partition_values(spark, path, VERSION)
        number = int(found[-1]) + 1 if found else 1
        target = f"{path}/{VERSION}={number:09d}"
        if move(spark, aside, target):
            break
    for old in found:
        delete(spark, f"{path}/{VERSION}={old}")
    return target


def with_rejected_at(df: DataFrame) -> DataFrame:
    return df.withColumn("rejected_at", F.current_timestamp()).select(*REJECTION_COLUMNS)


def append_rejections(df: DataFrame, path: str) -> None:
    with_rejected_at(df).write.mode("append").parquet(path)


# --- marts ---------------------------------------------------------------------------

def overwrite_mart(df: DataFrame, path: str) -> int:
    """Replace a mart and return its row count, read back from the files."""
    df.withColumn("_refreshed_at", F.current_timestamp()).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path).count()


# --- backup and restore ----------------------------------------------------------------

def _as_text(df: DataFrame) -> DataFrame:
    """Dates and times as ISO-8601 text; fractions only where there are any."""
    found = {}
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            found[f.name] = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
            fine = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
            found[f.name] = F.when(fine.endswith(".000000"), whole).otherwise(fine)
    return df.withColumns(found) if found else df


def backup_columns(contract: Contract, df: DataFrame) -> list[str]:
    return [*contract.columns, *(["_loaded_at"] if "_loaded_at" in df.columns else [])]


def backup(df: DataFrame, root: str, contract: Contract, day: date | str, fmt: str = "parquet") -> str:
    """Write the contract columns of a table to the day's backup partition.

    ``fmt`` may be ``avro`` where that data source is installed.
    """
    path = f"{root.rstrip('/')}/{contract.table}/{BACKUP_PARTITION}={day}"
    _as_text(df.select(*backup_columns(contract, df))).write.mode("overwrite").format(fmt).save(path)
    return path


def read_backup(spark: SparkSession, root: str, contract: Contract, fmt: str = "parquet") -> DataFrame:
    """The latest backup with the contract's types."""
    path = f"{root.rstrip('/')}/{contract.table}"
    if fmt == "parquet":
        df = read_latest_partition(spark, path, BACKUP_PARTITION)
    else:
        days = partition_values(spark, path, BACKUP_PARTITION)
        if not days:
            raise SourceError(f"no backup of '{contract.table}' below {root}")
        df = spark.read.format(fmt).load(f"{path}/{BACKUP_PARTITION}={days[-1]}")
    typed = [F.col(f.name).cast(f.type).alias(f.name) for f in contract.fields]
    loaded = [F.col("_loaded_at").cast("timestamp")] if "_loaded_at" in df.columns else []
    return df.select(*typed, *loaded)


def restore(spark: SparkSession, root: str, contract: Contract, target: str, fmt: str = "parquet") -> int:
    """Replace only the named table by its latest backup; an empty backup is refused."""
    df = read_backup(spark, root, contract, fmt)
    if df.isEmpty():
        raise SourceError(f"the latest backup of '{contract.table}' is empty")
    df.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target).count()


# --- run records ---------------------------------------------------------------------------

# The run record tables, with the id of each as the first column.
RUN_RECORDS = {
    "transformation_runs": (
        "run_id bigint, transformer_name string, bronze_source_path string, silver_target_table string, run_timestamp timestamp, "
        "records_processed bigint, execution_time_seconds int, status string, error_message string, transformation_version string, created_at timestamp"
    ),
    "pipeline_runs": (
        "run_id bigint, pipeline_name string, run_date timestamp, status string, records_processed bigint, execution_time_seconds int, "
        "error_message string, created_at timestamp"
    ),
    "data_quality_metrics": (
        "metric_id bigint, dataset_name string, check_name string, check_timestamp timestamp, status string, metric_value double, "
        "threshold_value double, message string, created_at timestamp"
    ),
    "source_profiles": (
        "profile_id bigint, source_name string, source_type string, profile_timestamp timestamp, total_rows bigint, total_columns int, "
        "null_percentage decimal(5,2), duplicate_percentage decimal(5,2), quality_score decimal(5,2), profile_json string, created_at timestamp"
    ),
    "validation_runs": (
        "validation_id bigint, pipeline_name string, layer string, data_path string, validation_timestamp timestamp, rules_executed int, "
        "rules_passed int, rules_failed int, passed boolean, validation_json string, created_at timestamp"
    ),
    "dataset_statistics": (
        "stat_id bigint, dataset_id int, stat_timestamp timestamp, row_count bigint, column_count int, null_percentage decimal(5,2), "
        "duplicate_percentage decimal(5,2), quality_score decimal(5,2), statistics_json string"
    ),
}


def append_record(spark: SparkSession, base: str, kind: str, record: Mapping[str, Any]) -> int:
    """Add one run record and return its id, the number it won in the log. Unknown keys are an
    error, missing ones null; ``created_at`` is now."""
    names = T.DataType.fromDDL(RUN_RECORDS[kind]).names
    unknown = set(record) - set(names[1:])
    if unknown:
        raise ValueError(f"unknown columns for {kind}: {sorted(unknown)}")
    made = {"created_at": datetime.now()} if "created_at" in names else {}
    return SlotLog(spark, f"{base.rstrip('/')}/{kind}").append(lambda slot: [(kind, {**made, **record, names[0]: slot})])


def read_records(spark: SparkSession, base: str, kind: str) -> DataFrame:
    schema = T.DataType.fromDDL(RUN_RECORDS[kind])
    return SlotLog(spark, f"{base.rstrip('/')}/{kind}").read(kind, schema).select(*schema.names)

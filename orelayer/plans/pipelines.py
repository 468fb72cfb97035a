"""Pipelines: landing, validation, delta load, marts, gates.

A load writes its annotated rows once to shared staging space and works from
there: the source is read a single time, every later step sees the same rows,
and a lost executor costs no recompute of the source. The reject columns are
null in accepted rows, so reading the rejected ones back costs next to nothing.
Counts are taken as the rows are written.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace
from datetime import date, datetime, timezone
from time import monotonic
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import contract as c
from ..operators import delta
from ..operators.contract import Contract, STAFFING
from ..operators.keys import annotate_fk, orphan_values
from ..operators.metadata import add_silver_metadata, add_trace
from ..operators.quality import Rule, ValidationResult, require_passed, validate
from ..operators.transforms import latest_by_key
from ..session import Workspace, delete, exists, move, observed
from ..sources import files, sinks
from ..sources.ledger import Ledger, stage_fresh
from ..sources.records import PROBLEM
from . import marts
from .registry import Registry, registry as default_registry


@dataclass(frozen=True)
class Lake:
    """Where the layers live, and the list of the bronze files that were loaded.

    ``buckets`` is how many folders a silver batch is dealt to by key. It is
    the same for as long as a table is kept; large tables want hundreds.
    """

    bronze: str
    silver: str
    gold: str
    log: str
    ledger: str = ""
    buckets: int = 8

    @classmethod
    def under(cls, root: str, buckets: int = 8) -> "Lake":
        root = root.rstrip("/")
        return cls(f"{root}/bronze", f"{root}/silver", f"{root}/gold", f"{root}/rejected_log", f"{root}/ledger", buckets)

    def table(self, name: str) -> str:
        return f"{self.silver}/{name}"

    def bucket(self, key: Sequence[str]) -> Column:
        return sinks.key_bucket(key, self.buckets)

    def ledger_of(self, table: str) -> str:
        return f"{self.ledger or self.silver + '_ledger'}/{table}"


@dataclass
class LoadResult:
    table: str
    batch_id: str
    rows: int = 0
    inserted: int = 0
    skipped: int = 0
    conflicts: int = 0
    rejected: int = 0
    superseded: int = 0

    def to_dict(self) -> dict:
        return asdict(self)


@dataclass
class RunResult:
    success: bool
    target: str
    records: int
    metadata: dict = field(default_factory=dict)
    timestamp: datetime = field(default_factory=datetime.now)

    def to_dict(self) -> dict:
        return {**asdict(self), "timestamp": self.timestamp.isoformat()}


# --- loading a table -------------------------------------------------------------

def silver_schema(contract: Contract) -> T.StructType:
    return contract.typed_schema()


def read_silver(
    spark: SparkSession, lake: Lake, contract: Contract, without: str | None = None, loaded_at: bool = False,
    buckets: Sequence[int] | None = None, only: str | None = None,
) -> DataFrame:
    """A silver table over its batches; ``loaded_at`` adds the load time. ``buckets`` are those of the
    keys that are looked for (see ``sinks.key_bucket``); the others are not read."""
    schema = silver_schema(contract)
    if loaded_at:
        schema = T.StructType([*schema.fields, T.StructField("_loaded_at", T.TimestampType())])
    path = sinks.current_version(spark, lake.table(contract.table))
    return sinks.read_batches(spark, path, schema, without, buckets, bucketed=True, only=only)


def buckets_of(lake: Lake, rows: DataFrame, key: Sequence[str]) -> list[int]:
    """The buckets that some rows fall in, ``lake.buckets`` at most."""
    return sorted(r[0] for r in rows.select(lake.bucket(key)).distinct().collect())


def compact_silver(spark: SparkSession, lake: Lake, contract: Contract, most_bytes: int = 128 << 20) -> int:
    """Merge the small batches of a silver table, see ``sinks.compact``; returns how many folders went."""
    schema = T.StructType([*silver_schema(contract).fields, T.StructField("_loaded_at", T.TimestampType())])
    return sinks.compact(spark, sinks.current_version(spark, lake.table(contract.table)), schema, most_bytes)


def read_rejections(spark: SparkSession, lake: Lake) -> DataFrame:
    schema = T.StructType(
        [T.StructField(n, T.TimestampType() if n == "rejected_at" else T.StringType()) for n in sinks.REJECTION_COLUMNS]
    )
    if not exists(spark, lake.log):
        return spark.createDataFrame([], schema)
    extra = [T.StructField("log_of", T.StringType()), T.StructField(sinks.BATCH, T.StringType())]
    return spark.read.schema(T.StructType([*schema.fields, *extra])).parquet(lake.log).select(*schema.names)


def _log_path(lake: Lake, table: str) -> str:
    return f"{lake.log}/log_of={table}"


def load(
    spark: SparkSession,
    source: DataFrame,
    contract: Contract,
    lake: Lake,
    batch_id: int | str,
    parents: Mapping[str, DataFrame] | None = None,
    arrival: Sequence[str] = (),
    problem: str | None = None,
) -> LoadResult:
    """Check, compare and store one batch of rows.

    Accepted rows with unknown keys are added to the table; conflicts and
    rejected rows go to the log. All three are keyed by the batch, so a batch
    that is run again replaces its own earlier output and nothing else.

    With ``arrival`` columns the accepted row of a key that arrived last
    counts; those before it are superseded. A rejected row never stands in
    for an accepted one. A ``problem`` column holds what the reader found
    wrong with a row, which is one more reason to reject it.
    """
    batch_id = str(batch_id)
    with Workspace(spark, f"load-{contract.table}") as work:
        extra = [*arrival, *([problem] if problem else [])]
        checked = contract.annotate(source.select(*[n for n in contract.columns if n in source.columns], *extra))
        checked = checked.withColumn(c.SOURCE, F.col(c.SOURCE).dropFields(*extra)) if extra else checked
        if problem:
            found = F.array_compact(F.array(F.col(problem)))
            checked = checked.withColumn(c.REASONS, F.concat(c.REASONS, found)).drop(problem)
        if contract.foreign_keys:
            if parents is None:
                parents = {fk.parent: read_silver(spark, lake, STAFFING[fk.parent]) for fk in contract.foreign_keys}
            checked = annotate_fk(checked, contract.foreign_keys, parents, work)
        seen = Observation()
        sealed = c.sealed(checked).observe(seen, F.count("*").alias("rows"), F.count_if(F.col(c.OK)).alias("good"))
        rows = work.stage(sealed, "checked")
        n_rows, n_good = observed(seen, "rows", "good")
        good, bad = c.sealed_accepted(rows), c.sealed_rejected(rows, contract.table)
        if arrival:
            good = work.stage(latest_by_key(good, contract.key, arrival).drop(*arrival), "latest")

        def stored(keys: DataFrame) -> DataFrame:
            return read_silver(spark, lake, contract, without=batch_id, buckets=buckets_of(lake, keys, contract.key))

        outcome = work.stage(delta.classify(good, stored(good), contract.key, work, values_of=stored), "outcome")
        fresh = delta.new_rows(outcome).withColumn("_loaded_at", F.current_timestamp())
        target = sinks.current_version(spark, lake.table(contract.table))
        sinks.write_batch(fresh, target, batch_id, lake.bucket(contract.key))
        log = bad.unionByName(delta.conflict_log(outcome, contract.table, contract.key))
        sinks.write_batch(sinks.with_rejected_at(log), _log_path(lake, contract.table), batch_id)

        # Three rows at most, read back from the staged outcome.
        counts = {r[delta.STATUS]: r["rows"] for r in delta.status_counts(outcome).collect()}
        return LoadResult(
            contract.table,
            batch_id,
            rows=n_rows,
            inserted=counts.get(delta.NEW, 0),
            skipped=counts.get(delta.SKIPPED, 0),
            conflicts=counts.get(delta.CONFLICT, 0),
            rejected=n_rows - n_good,
            superseded=n_good - sum(counts.values()),
        )


def load_csv(
    spark: SparkSession, path: str, contract: Contract, lake: Lake, batch_id: int | str, header: bool = True,
    parents: Mapping[str, DataFrame] | None = None,
) -> LoadResult:
    """A CSV file, or a folder of them, straight into its table.

    Columns are found by the names in each file's header. Rows with more
    fields than the header, and rows of files that lack a column, are rejected
    and say so.
    """
    with Workspace(spark, "csv") as work:
        source = files.read_csv_by_name(spark, path, contract.columns, files.CsvOptions(header=header), work)
        return load(spark, source, contract, lake, batch_id, parents, problem=PROBLEM)


def load_batch(
    spark: SparkSession, source: DataFrame, contract: Contract, lake: Lake, batch_id: int | str,
    parents: Mapping[str, DataFrame] | None = None, day: date | str | None = None,
) -> LoadResult:
    """A batch of records: loaded, and the new rows also landed in bronze."""
    result = load(spark, source, contract, lake, batch_id, parents)
    new = read_silver(spark, lake, contract, only=result.batch_id)
    texts = [F.col(n).cast("string").alias(n) for n in contract.columns]
    # Append-only: landing a repeated batch again is harmless, since silver
    # takes the last arrival of a key and skips what it already holds.
    sinks.append_bronze(new.select(*texts), lake.bronze, contract.table, day or date.today())
    return result


def batch_report(
    spark: SparkSession, source: DataFrame, contract: Contract, lake: Lake,
    parents: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """What a load would do with each row, without writing to the tables."""
    checked = contract.annotate(source.select(*contract.columns))
    if contract.foreign_keys:
        parents = parents or {fk.parent: read_silver(spark, lake, STAFFING[fk.parent]) for fk in contract.foreign_keys}
        checked = annotate_fk(checked, contract.foreign_keys, parents, Workspace(spark, "report"))
    refused = c.rejected(checked, contract.table).select(
        F.lit("rejected").alias("outcome"), F.lit(1).cast("bigint").alias("copies"), "raw_row", "reason"
    )
    outcome = delta.classify(c.accepted(checked), read_silver(spark, lake, contract), contract.key)
    raw = F.to_json(F.struct(*contract.columns), {"ignoreNullFields": "false"})
    is_conflict = F.col(delta.STATUS) == delta.CONFLICT
    compared = outcome.select(
        F.col(delta.STATUS).alias("outcome"),
        F.col(delta.COPIES).alias("copies"),
        raw.alias("raw_row"),
        F.when(is_conflict, delta.conflict_reason(outcome, contract.key)).alias("reason"),
    )
    return refused.unionByName(compared)


def bronze_to_silver(
    spark: SparkSession, contract: Contract, lake: Lake, batch_id: int | str, since: date | str | None = None,
    parents: Mapping[str, DataFrame] | None = None,
) -> LoadResult | None:
    """All bronze partitions of a table (or those from a day on) into silver,
    whether they were loaded before or not.

    The last accepted arrival of a key wins; all other rows go to the
    rejection log. Returns None when nothing has landed.
    """
    path = files.bronze_path(lake.bronze, contract.table)
    if not files.partition_values(spark, path, files.BRONZE_PARTITION):
        return None
    landed = files.read_bronze(spark, lake.bronze, contract.table)
    if since is not None:
        landed = landed.filter(F.col(files.BRONZE_PARTITION) >= F.lit(str(since)).cast("date"))
    return load(spark, landed, contract, lake, batch_id, parents, arrival=[files.BRONZE_PARTITION])


def load_new_files(
    spark: SparkSession, contract: Contract, lake: Lake, batch_id: int | str, parents: Mapping[str, DataFrame] | None = None
) -> LoadResult | None:
    """The bronze files of a table that no other batch has loaded, into silver.

    Files are found wherever they lie, so rows that were appended to an older
    day, or days that came late, are loaded by the next batch, and each row is
    stored or logged by one batch. A batch that is run again takes its own
    files once more, and those that came since. What a batch that broke off
    has left is removed first. Returns None when nothing has ever landed.
    """
    batch_id, path = str(batch_id), files.bronze_path(lake.bronze, contract.table)
    if not files.partition_values(spark, path, files.BRONZE_PARTITION):
        return None
    ledger = Ledger(spark, lake.ledger_of(contract.table))

    def undo(batch: str) -> None:
        delete(spark, f"{sinks.current_version(spark, lake.table(contract.table))}/{sinks.BATCH}={batch}")
        delete(spark, f"{_log_path(lake, contract.table)}/{sinks.BATCH}={batch}")

    ledger.recover(batch_id, undo)
    with Workspace(spark, "new-files") as work:
        found, paths = stage_fresh(ledger, path, batch_id, work)
        schema = T.StructType([*contract.string_schema().fields, T.StructField(files.BRONZE_PARTITION, T.DateType())])
        landed = spark.read.option("basePath", path).parquet(*paths) if paths else spark.createDataFrame([], schema)
        with ledger.batch(batch_id, found):
            return load(spark, landed, contract, lake, batch_id, parents, arrival=[files.BRONZE_PARTITION])


def land_sources(spark: SparkSession, csv_dir: str, lake: Lake, day: date | str, header: bool = False) -> list[str]:
    """Land the staffing files; nothing at all when one is missing, and no
    partition twice. Returns the tables that were written."""
    paths = {t: f"{csv_dir.rstrip('/')}/{t}.csv" for t in STAFFING}
    if not files.require_sources(spark, paths, on_missing="skip"):
        return []
    written = []
    for table, contract in STAFFING.items():
        source = files.read_csv(spark, paths[table], contract.columns, files.CsvOptions(header=header))
        if sinks.land_bronze(source, lake.bronze, table, day):
            written.append(table)
    return written


# --- marts --------------------------------------------------------------------------

def refresh_marts(spark: SparkSession, lake: Lake, year: int = 2021) -> dict[str, Any]:
    """Rebuild both marts from silver; an empty fact table is an error."""
    hires, departments, jobs = (
        read_silver(spark, lake, STAFFING[t]) for t in ("hired_employees", "departments", "jobs")
    )
    if hires.isEmpty():
        raise files.SourceError("hired_employees is empty: load data first")
    by_quarter = marts.hires_by_quarter(hires, departments, jobs)
    quarter_rows = sinks.overwrite_mart(by_quarter, f"{lake.gold}/mart_hires_by_quarter")
    with Workspace(spark, "marts") as work:
        # One row per department, used for the mean and for the comparison.
        counted = work.stage(marts.department_hires(departments, hires, year), "department_hires")
        above_rows = sinks.overwrite_mart(marts.above_mean(counted), f"{lake.gold}/mart_departments_above_mean")
        mean = marts.mean_hires(counted).first()[0]
    return {
        "status": "ok",
        "source_rows_total": hires.count(),
        "mart_hires_by_quarter_rows": quarter_rows,
        "mart_departments_above_mean_rows": above_rows,
        f"mean_hires_per_department_{year}": float(mean or 0),
    }


def run_all(spark: SparkSession, csv_dir: str, lake: Lake, day: date | str, header: bool = False) -> dict[str, Any]:
    """Land, load dimensions, load facts, rebuild the marts.

    A day loads the bronze files that no other day has loaded, see
    ``load_new_files``; each bad row is rejected once and nothing is read again.
    """
    landed = land_sources(spark, csv_dir, lake, day, header)
    loads = {}
    for table in ("departments", "jobs", "hired_employees"):
        result = load_new_files(spark, STAFFING[table], lake, batch_id=str(day))
        loads[table] = result.to_dict() if result else None
    return {"landed": landed, "loads": loads, "marts": refresh_marts(spark, lake)}


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table in one result."""
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, df in tables.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def lake_status(spark: SparkSession, lake: Lake) -> DataFrame:
    """Rows per silver table and in the rejection log."""
    tables = {name: read_silver(spark, lake, contract) for name, contract in STAFFING.items()}
    return table_counts({**tables, "rejected_log": read_rejections(spark, lake)})


def backup_table(
    spark: SparkSession, root: str, contract: Contract, lake: Lake, day: date | str, fmt: str = "parquet"
) -> dict[str, Any]:
    """Back up a silver table with its load times."""
    path = sinks.backup(read_silver(spark, lake, contract, loaded_at=True), root, contract, day, fmt)
    return {"table": contract.table, "backup_file": path, "rows_backed_up": spark.read.format(fmt).load(path).count()}


def restore_table(
    spark: SparkSession, root: str, contract: Contract, lake: Lake, fmt: str = "parquet"
) -> dict[str, Any]:
    """Replace a silver table by its latest backup and list orphans that result.

    Only the named table is touched; the foreign keys are checked afterwards.
    The restored rows are a new version of the table, put in place by one
    rename: a restore that breaks off leaves the old table as it was.
    """
    df = sinks.read_backup(spark, root, contract, fmt)
    if df.isEmpty():
        raise files.SourceError(f"the latest backup of '{contract.table}' is empty")
    path = lake.table(contract.table)
    sinks.publish_version(spark, path, lambda aside: sinks.write_batch(df, aside, "restore", lake.bucket(contract.key)))
    found = {}
    for child in STAFFING.values():
        for fk in child.foreign_keys:
            if contract.table in (child.table, fk.parent):
                missing = orphan_values(
                    read_silver(spark, lake, child), fk.column, read_silver(spark, lake, STAFFING[fk.parent])
                )
                found[f"{child.table}.{fk.column}"] = missing.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    return {"table": contract.table, "rows_restored": read_silver(spark, lake, contract).count(), "orphans": found}


# --- generic pipelines -----------------------------------------------------------------

def run_transform(
    source: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    target: str,
    name: str = "transform",
    source_path: str = "",
    mode: str = "append",
    version: str = "1.0",
    records: str | None = None,
) -> RunResult:
    """Read, transform, add silver metadata, write: one job over the source,
    which counts the rows as it writes them. With a folder for ``records`` the
    run leaves a record there, also one that fails."""
    spark, moment = source.sparkSession, datetime.now(timezone.utc)

    def work() -> RunResult:
        seen = Observation()
        out = add_silver_metadata(transform(source), source_path, name, version, moment)
        out.observe(seen, F.count("*").alias("rows")).write.mode(mode).parquet(target)
        return RunResult(True, target, observed(seen, "rows")[0], {"bronze_path": source_path, "transformer": name})

    return _recorded(spark, records, "transformation_runs", work, lambda run: run.records, {
        "transformer_name": name, "bronze_source_path": source_path, "silver_target_table": target,
        "run_timestamp": moment.replace(tzinfo=None), "transformation_version": version,
    })


# The status of a run record.
SUCCESS, FAILED = "success", "failed"


def _recorded(
    spark: SparkSession, base: str | None, kind: str, work: Callable[[], Any], rows: Callable[[Any], int], record: Mapping[str, Any]
) -> Any:
    """Do some work and leave a run record of it, with the error if it raised one."""
    if base is None:
        return work()
    began, result, error = monotonic(), None, None
    try:
        result = work()
        return result
    except BaseException as broken:
        error = f"{type(broken).__name__}: {str(broken)[:1000]}"
        raise
    finally:
        sinks.append_record(spark, base, kind, {
            **record, "records_processed": None if result is None else rows(result), "execution_time_seconds": int(monotonic() - began),
            "status": FAILED if error else SUCCESS, "error_message": error,
        })


def record_validation(spark: SparkSession, base: str, pipeline: str, layer: str, path: str, result: ValidationResult) -> int:
    """The outcome of a set of rules as a record."""
    return sinks.append_record(spark, base, "validation_runs", {
        "pipeline_name": pipeline, "layer": layer, "data_path": path, "validation_timestamp": datetime.now(),
        "rules_executed": result.rules_executed, "rules_passed": result.rules_passed, "rules_failed": result.rules_failed,
        "passed": result.passed, "validation_json": json.dumps(result.to_dict(), default=str),
    })


def extract(
    spark: SparkSession,
    path: str,
    bronze: str,
    declared: Mapping[str, Any] | None = None,
    config: Mapping[str, Any] | None = None,
    watermark: tuple[str, Any] | None = None,
    now: datetime | None = None,
    reject_path: str | None = None,
) -> RunResult:
    """Check a file, read it, apply its declared schema, add trace columns and
    write Parquet, all in one job that also counts. With a watermark only newer
    rows are written and only newer ones are rejected; a row whose watermark
    can't be read is rejected by every extract that meets it. The file is read
    again only where there are rejected rows to be logged.
    """
    kind = files.check_file(spark, path)
    source = files.read_file(spark, path, config)
    version, contract = "inferred", None
    if declared:
        contract = Contract.from_declared(declared)
        version = contract.version
        source = contract.annotate(source)
    name = path.rstrip("/").rsplit("/", 1)[-1]
    moment = now or datetime.now()
    if watermark is not None:
        newer = files.newer_than(source, *watermark)
        if contract is not None:
            unread = (F.size(c.REASONS) > 0) & F.col(watermark[0]).isNull()
            newer = source.filter(unread | (F.col(watermark[0]) > F.lit(watermark[1])))
        source = newer
    seen = Observation()
    bad = F.count_if(F.size(c.REASONS) > 0) if contract is not None else F.count_if(F.lit(False))
    counted = source.observe(seen, F.count("*").alias("rows"), bad.alias("bad"))
    good = c.accepted(counted) if contract is not None else counted
    traced = add_trace(good, "file", name, "FileExtractor", version)
    target = sinks.write_extract(traced, bronze, name.rsplit(".", 1)[0], moment)
    rows, rejected_rows = observed(seen, "rows", "bad")
    if reject_path and rejected_rows:
        sinks.append_rejections(c.rejected(source, name), reject_path)
    meta = {
        "source_file": path, "source_format": kind, "columns": traced.columns,
        "schema_applied": contract is not None, "rejected": rejected_rows,
    }
    if watermark is not None:
        meta |= {"incremental": True, "watermark_column": watermark[0], "last_watermark": str(watermark[1])}
    return RunResult(True, target, rows - rejected_rows, meta)


@dataclass
class GatedResult:
    bronze: ValidationResult
    silver: ValidationResult
    run: RunResult


def gated_pipeline(
    spark: SparkSession,
    source_path: str,
    bronze: str,
    target: str,
    transform: Callable[[DataFrame], DataFrame],
    bronze_rules: Sequence[Rule | Mapping[str, Any]],
    silver_rules: Sequence[Rule | Mapping[str, Any]],
    declared: Mapping[str, Any] | None = None,
    config: Mapping[str, Any] | None = None,
    now: datetime | None = None,
    name: str = "pipeline",
    records: str | None = None,
) -> GatedResult:
    """Ingest, validate, transform, validate, publish. A failed gate raises and stops.

    What the transform makes is validated aside and then put into the target
    by one rename, as a folder of its own: the target never holds rows that a
    gate has not passed, or part of a run. With a folder for ``records`` the
    pipeline, its transformation and each gate leave a record there.
    """
    def checked(df: DataFrame, rules: Sequence[Rule | Mapping[str, Any]], layer: str, path: str) -> ValidationResult:
        result = validate(df, rules, now)
        if records is not None:
            record_validation(spark, records, name, layer, path, result)
        return require_passed(result)

    def work() -> GatedResult:
        landed = extract(spark, source_path, bronze, declared, config, now=now)
        df = spark.read.parquet(landed.target)
        first = checked(df, bronze_rules, "bronze", landed.target)
        run_id = uuid.uuid4().hex
        aside = f"{target.rstrip('/')}_aside/{run_id}"
        try:
            run = run_transform(df, transform, aside, name, landed.target, records=records)
            second = checked(spark.read.parquet(aside), silver_rules, "silver", target)
            published = f"{target.rstrip('/')}/{sinks.BATCH}={run_id}"
            move(spark, aside, published)
        finally:
            delete(spark, aside)
        return GatedResult(first, second, replace(run, target=published))

    started = {"pipeline_name": name, "run_date": datetime.now()}
    return _recorded(spark, records, "pipeline_runs", work, lambda done: done.run.records, started)


def from_config(config: Mapping[str, Any], registry: Registry = default_registry) -> Callable[[SparkSession], RunResult]:
    """A transformation run described by ``bronze_path``, ``silver_table`` and
    the names of registered ``steps``."""
    path, target = config["bronze_path"], config["silver_table"]
    options = config.get("config") or {}
    step = registry.compose(*options.get("steps", []))

    def run(spark: SparkSession) -> RunResult:
        source = spark.read.parquet(path)
        return run_transform(source, step, target, options.get("name", "transform"), path, options.get("mode", "append"))

    return run

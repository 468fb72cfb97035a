"""Whole pipelines: events as staff rows, suppliers as departments, parts as jobs."""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.contract import DEPARTMENTS, HIRED_EMPLOYEES, JOBS
from ..operators import transforms as tr
from ..operators.quality import BRONZE_RULES, ValidationFailed
from ..plans import marts, pipelines as p
from ..plans.registry import Registry
from ..session import Workspace
from ..sources import files, sinks
from .base import query, table
from .contracts import STAFF_REASON_SQL, raw_staff
from .quality import NOW, SALES_SQL, sales

_FK_SQL = f"""
select *, case when reason <> '' then reason else
    case when dep_t || job_t <> '' then 'FK Violation: ' || concat_ws('; ', nullif(dep_t, ''), nullif(job_t, '')) else '' end end as why
from (select *,
    case when dep_v in (select s_suppkey from supplier) then '' else 'department_id ' || dep_v || ' not in raw.departments' end as dep_t,
    case when job_v in (select p_partkey from part where p_size > 5) then '' else 'job_id ' || job_v || ' not in raw.jobs' end as job_t
  from ({STAFF_REASON_SQL}))"""
SILVER_SQL = f"""
select id_v as id, name_v as name, datetime_v as datetime, dep_v as department_id, job_v as job_id from ({_FK_SQL}) where why = ''"""


def _dimensions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    departments = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"), F.concat(F.lit(" "), "s_name").alias("department")
    )
    jobs = table(spark, sf, "part").filter("p_size > 5").select(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("job")
    )
    return departments, jobs


def _loaded(spark: SparkSession, sf: str) -> tuple[p.Lake, p.LoadResult]:
    lake = p.Lake.under(Workspace(spark, "lake").root)
    departments, jobs = _dimensions(spark, sf)
    p.load(spark, departments, DEPARTMENTS, lake, 1)
    p.load(spark, jobs, JOBS, lake, 1)
    return lake, p.load(spark, raw_staff(spark, sf), HIRED_EMPLOYEES, lake, 1)


@query("load_silver", SILVER_SQL)
def load_silver(spark: SparkSession, sf: str) -> DataFrame:
    lake, _ = _loaded(spark, sf)
    return p.read_silver(spark, lake, HIRED_EMPLOYEES)


@query("load_rejections", f"select 'hired_employees' as table_name, why as reason from ({_FK_SQL}) where why <> ''")
def load_rejections(spark: SparkSession, sf: str) -> DataFrame:
    lake, _ = _loaded(spark, sf)
    return p.read_rejections(spark, lake).select("table_name", "reason")


@query("load_counts", f"""
with a as (select count(*) as rows, count(*) filter (where why = '') as good, count(*) filter (where why <> '') as bad from ({_FK_SQL}))
select 'first' as run, rows, good as inserted, cast(0 as bigint) as skipped, bad as rejected from a
union all select 'again', rows, 0, good, bad from a
union all select 'replayed', rows, good, 0, bad from a""")
def load_counts(spark: SparkSession, sf: str) -> DataFrame:
    """A second batch of the same rows adds nothing; the first batch run again
    gives what it gave before."""
    lake, first = _loaded(spark, sf)
    again = p.load(spark, raw_staff(spark, sf), HIRED_EMPLOYEES, lake, 2)
    replayed = p.load(spark, raw_staff(spark, sf), HIRED_EMPLOYEES, lake, 1)
    rows = [
        (name, r.rows, r.inserted, r.skipped, r.rejected)
        for name, r in (("first", first), ("again", again), ("replayed", replayed))
    ]
    return spark.createDataFrame(rows, "run string, rows bigint, inserted bigint, skipped bigint, rejected bigint")


@query("batch_report", f"select case when why = '' then 'new' else 'rejected' end as outcome, nullif(why, '') as reason from ({_FK_SQL})")
def batch_report(spark: SparkSession, sf: str) -> DataFrame:
    lake = p.Lake.under(Workspace(spark, "lake").root)
    departments, jobs = _dimensions(spark, sf)
    parents = {"departments": departments.withColumn("id", F.col("id").try_cast("int")),
               "jobs": jobs.withColumn("id", F.col("id").try_cast("int"))}
    report = p.batch_report(spark, raw_staff(spark, sf), HIRED_EMPLOYEES, lake, parents)
    return report.select("outcome", "reason")


# --- bronze to gold ------------------------------------------------------------------

def _write_csv(df: DataFrame, path: str) -> None:
    df.write.option("quoteAll", True).option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)


def _full_run(spark: SparkSession, sf: str) -> p.Lake:
    work = Workspace(spark, "run")
    lake = p.Lake.under(work.path("lake"))
    departments = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("id"), "c_name")
    _, jobs = _dimensions(spark, sf)
    lines = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.concat(F.lit("clerk "), F.col("o_orderkey").cast("string")).alias("name"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("datetime"),
        F.col("o_custkey").cast("string").alias("department_id"),
        F.col("o_custkey").cast("string").alias("job_id"),
    )
    folder = work.path("csv")
    _write_csv(departments, f"{folder}/departments.csv")
    _write_csv(jobs, f"{folder}/jobs.csv")
    _write_csv(lines, f"{folder}/hired_employees.csv")
    p.land_sources(spark, folder, lake, "2024-01-01")
    p.land_sources(spark, folder, lake, "2024-01-01")  # lands nothing
    for contract in (DEPARTMENTS, JOBS, HIRED_EMPLOYEES):
        p.bronze_to_silver(spark, contract, lake, "2024-01-01")
    p.refresh_marts(spark, lake, 1997)
    return lake


_RUN_SQL = """
select c_name as department, p_name as job, o_orderdate as moment, c_custkey
from orders join customer on o_custkey = c_custkey join part on o_custkey = p_partkey and p_size > 5"""


@query("run_marts", f"""
select department, job, cast(year(moment) as integer) as hire_year,
       count(*) filter (where quarter(moment) = 1) as q1, count(*) filter (where quarter(moment) = 2) as q2,
       count(*) filter (where quarter(moment) = 3) as q3, count(*) filter (where quarter(moment) = 4) as q4
from ({_RUN_SQL}) group by department, job, year(moment)""")
def run_marts(spark: SparkSession, sf: str) -> DataFrame:
    lake = _full_run(spark, sf)
    return spark.read.parquet(f"{lake.gold}/mart_hires_by_quarter").drop("_refreshed_at")


@query("run_above_mean", f"""
with d as (select c_custkey, count(moment) as hired from customer left join
             (select * from ({_RUN_SQL}) where year(moment) = 1997) using (c_custkey) group by c_custkey)
select cast(c_custkey as integer) as id, c_name as department, hired
from d join customer using (c_custkey) where hired > (select avg(hired) from d)""")
def run_above_mean(spark: SparkSession, sf: str) -> DataFrame:
    lake = _full_run(spark, sf)
    return spark.read.parquet(f"{lake.gold}/mart_departments_above_mean").drop("_refreshed_at")


@query("restore_check", f"""
select department_id, count(*) as rows from ({SILVER_SQL})
where department_id not in (select s_suppkey from supplier where s_acctbal > 0) group by department_id""")
def restore_check(spark: SparkSession, sf: str) -> DataFrame:
    """Restoring fewer departments leaves the employees and shows the orphans."""
    from ..operators.keys import orphan_values

    lake, _ = _loaded(spark, sf)
    backups = Workspace(spark, "backups").root
    fewer = table(spark, sf, "supplier").filter("s_acctbal > 0").select(
        F.col("s_suppkey").try_cast("int").alias("id"), F.col("s_name").alias("department")
    )
    sinks.backup(fewer, backups, DEPARTMENTS, "2024-01-01")
    p.restore_table(spark, backups, DEPARTMENTS, lake)
    return orphan_values(
        p.read_silver(spark, lake, HIRED_EMPLOYEES), "department_id", p.read_silver(spark, lake, DEPARTMENTS)
    )


_DAYS_SQL = """
with k as (select o_orderkey as k, o_orderkey % 5 as part, o_orderkey % 7 = 0 as bad from orders),
landed as (
  select k, case when bad then ' ' else 'name ' || k end as name from k where part < 4
  union all select k, ' ' from k where part = 1 and k % 13 = 0
  union all select k, ' ' from k where part = 4
)
select 'stored' as kind, cast(k as integer) as id, name as department, cast(null as varchar) as raw_row, cast(null as varchar) as reason from landed where name <> ' '
union all select 'stored', cast(k as integer), 'other ' || k, null, null from k where part = 0 and k % 11 = 0 and bad
union all select 'logged', null, null, '{"id":"' || k || '","department":" "}', 'department is empty' from landed where name = ' '
union all select 'logged', null, null, '{"id":' || k || ',"department":"other ' || k || '"}',
  'CONFLICT: id=' || k || ' exists with different data — department: ''name ' || k || ''' → ''other ' || k || '''' from k where part = 0 and k % 11 = 0 and not bad
"""


@query("run_days", _DAYS_SQL)
def run_days(spark: SparkSession, sf: str) -> DataFrame:
    """Days that land late, rows that are appended to an old day, good rows followed by bad ones of
    the same key, a day of bad rows only, and repeated runs: every row is stored or logged once."""
    lake = p.Lake.under(Workspace(spark, "days").root)
    k = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    rows = k.select(F.col("k").cast("string").alias("id"), F.when(F.col("k") % 7 == 0, " ").otherwise(F.concat(F.lit("name "), "k")).alias("department"), "k")
    part, blank = F.col("k") % 5, F.lit(" ").alias("department")

    def land(df: DataFrame, day: str) -> None:
        sinks.append_bronze(df.select("id", "department"), lake.bronze, "departments", day)

    def run(day: str) -> None:
        p.load_new_files(spark, DEPARTMENTS, lake, day)

    land(rows.where(part == 0), "2024-01-01")
    run("2024-01-01")
    again = rows.where((part == 0) & (F.col("k") % 11 == 0)).withColumn("department", F.concat(F.lit("other "), "id"))
    land(rows.where(part == 1).unionByName(again), "2024-01-03")
    land(rows.where((part == 1) & (F.col("k") % 13 == 0)).withColumn("department", blank), "2024-01-04")
    run("2024-01-04")
    land(rows.where(part == 2), "2024-01-01")
    land(rows.where(part == 3), "2024-01-02")
    run("2024-01-05")
    run("2024-01-04")
    run("2024-01-05")
    land(rows.where(part == 4).withColumn("department", blank), "2024-01-06")
    run("2024-01-06")
    run("2024-01-07")  # nothing new
    stored = p.read_silver(spark, lake, DEPARTMENTS).select(F.lit("stored").alias("kind"), "id", "department")
    return stored.unionByName(p.read_rejections(spark, lake).select(F.lit("logged").alias("kind"), "raw_row", "reason"), allowMissingColumns=True)


@query("load_csv_header", """
select 'stored' as kind, cast(o_orderkey as integer) as id, o_orderpriority as department, cast(null as varchar) as raw_row, cast(null as varchar) as reason from orders where o_orderkey % 7 <> 0
union all select 'logged', null, null, '{"id":"' || o_orderkey || '","department":"' || o_orderpriority || '"}', 'row has 3 fields, header has 2' from orders where o_orderkey % 7 = 0""")
def load_csv_header(spark: SparkSession, sf: str) -> DataFrame:
    """Two files whose headers have different orders, loaded at once; rows with a field too many are rejected."""
    work = Workspace(spark, "load-csv")
    lake, folder = p.Lake.under(work.path("lake")), work.path("departments.csv")
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("department"), F.col("o_orderkey").alias("k"))
    for i, names in enumerate((["id", "department"], ["department", "id"])):
        row = F.concat_ws(",", *names, F.when(F.col("k") % 7 == 0, F.lit("surplus")))
        part = orders.where(F.col("k") % 2 == i).coalesce(1).select(row.alias("value"))
        spark.createDataFrame([(",".join(names),)], "value string").unionByName(part).coalesce(1).write.mode("append").text(folder)
    p.load_csv(spark, folder, DEPARTMENTS, lake, 1)
    stored = p.read_silver(spark, lake, DEPARTMENTS).select(F.lit("stored").alias("kind"), "id", "department")
    return stored.unionByName(p.read_rejections(spark, lake).select(F.lit("logged").alias("kind"), "raw_row", "reason"), allowMissingColumns=True)


@query("run_records", """
with good as (select count(*) as n from orders where o_totalprice > 250000)
select 'transformation_runs' as record, 'large_orders' as name, 'success' as status, n as records, cast(null as integer) as failed from good
union all select 'transformation_runs', 'pipeline', 'success', (select count(*) from customer), null
union all select 'transformation_runs', 'pipeline', 'success', (select count(*) from customer), null
union all select 'transformation_runs', 'broken', 'failed', null, null
union all select 'pipeline_runs', 'pipeline', 'success', (select count(*) from customer), null
union all select 'pipeline_runs', 'pipeline', 'failed', null, null
union all select 'validation_runs', 'bronze', 'true', null, 0
union all select 'validation_runs', 'silver', 'true', null, 0
union all select 'validation_runs', 'bronze', 'true', null, 0
union all select 'validation_runs', 'silver', 'false', null, 1""")
def run_records(spark: SparkSession, sf: str) -> DataFrame:
    """What runs leave behind: a transformation, one that fails, and a gated pipeline whose second run fails its gate."""
    work = Workspace(spark, "records")
    records, source = work.path("records"), work.path("customer.parquet")
    large = lambda df: df.filter("o_totalprice > 250000").select("o_orderkey", "o_totalprice")
    p.run_transform(table(spark, sf, "orders"), large, work.path("silver"), "large_orders", "orders", records=records)
    with contextlib.suppress(ValueError):
        p.run_transform(table(spark, sf, "orders"), lambda df: tr.clean_nulls(df, strategy="?"), work.path("none"), "broken", records=records)
    table(spark, sf, "customer").write.parquet(source)
    for n, limit in ((1, 1), (2, 1 << 40)):
        rule = [{"name": "size", "type": "volume", "config": {"min_rows": limit}}]
        with contextlib.suppress(ValidationFailed):
            p.gated_pipeline(spark, source, work.path(f"bronze{n}"), work.path("gated"), lambda df: df.select("c_custkey"), BRONZE_VOLUME, rule, records=records)
    runs = sinks.read_records(spark, records, "transformation_runs").select(F.lit("transformation_runs").alias("record"), F.col("transformer_name").alias("name"), "status", F.col("records_processed").alias("records"))
    piped = sinks.read_records(spark, records, "pipeline_runs").select(F.lit("pipeline_runs").alias("record"), F.col("pipeline_name").alias("name"), "status", F.col("records_processed").alias("records"))
    gates = sinks.read_records(spark, records, "validation_runs").select(F.lit("validation_runs").alias("record"), F.col("layer").alias("name"), F.col("passed").cast("string").alias("status"), F.col("rules_failed").alias("failed"))
    return runs.unionByName(piped).unionByName(gates, allowMissingColumns=True)


BRONZE_VOLUME = [{"name": "any", "type": "volume", "config": {"min_rows": 1}}]


_BAD_SQL = """case when k % 7 = 0 then 'x' || k else cast(k as varchar) end as id, case when k % 5 = 0 then ' ' else given end as name,
  concat_ws('; ', case when k % 7 = 0 then 'id is null/invalid' end, case when k % 5 = 0 then '{0} is empty' end) as why"""


@query("load_batch", f"""
with d as (select {_BAD_SQL.format('department')} from (select s_suppkey as k, s_name as given from supplier))
select 'bronze' as place, id, name, cast(null as varchar) as raw_row, cast(null as varchar) as reason from d where why = ''
union all select 'silver', id, name, null, null from d where why = ''
union all select 'log', null, null, '{{"id":"' || id || '","department":"' || name || '"}}', why from d, (values (1), (2)) as twice(n) where why <> ''""")
def load_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of records with bad rows: the new ones also land in bronze, a repeated batch adds nothing but its rejections."""
    lake = p.Lake.under(Workspace(spark, "batch").root)
    k = F.col("s_suppkey")
    rows = table(spark, sf, "supplier").select(
        F.when(k % 7 == 0, F.concat(F.lit("x"), k.cast("string"))).otherwise(k.cast("string")).alias("id"),
        F.when(k % 5 == 0, F.lit(" ")).otherwise(F.col("s_name")).alias("department"))
    for batch in (1, 2):
        p.load_batch(spark, rows, DEPARTMENTS, lake, batch, day="2024-01-01")
    landed = files.read_bronze(spark, lake.bronze, "departments").select(F.lit("bronze").alias("place"), "id", F.col("department").alias("name"))
    stored = p.read_silver(spark, lake, DEPARTMENTS).select(F.lit("silver").alias("place"), F.col("id").cast("string"), F.col("department").alias("name"))
    logged = p.read_rejections(spark, lake).select(F.lit("log").alias("place"), "raw_row", "reason")
    return landed.unionByName(stored).unionByName(logged, allowMissingColumns=True)


@query("load_bad_jobs", f"""
with d as (select {_BAD_SQL.format('job')} from (select p_partkey as k, p_name as given from part))
select table_name, raw_row, reason from (
  select 'jobs' as table_name, '{{"id":"' || id || '","job":"' || name || '"}}' as raw_row, why as reason from d where why <> '')""")
def load_bad_jobs(spark: SparkSession, sf: str) -> DataFrame:
    """Jobs with unreadable ids and blank names, as they stand in the log."""
    lake = p.Lake.under(Workspace(spark, "jobs").root)
    k = F.col("p_partkey")
    rows = table(spark, sf, "part").select(
        F.when(k % 7 == 0, F.concat(F.lit("x"), k.cast("string"))).otherwise(k.cast("string")).alias("id"),
        F.when(k % 5 == 0, F.lit(" ")).otherwise(F.col("p_name")).alias("job"))
    p.load(spark, rows, JOBS, lake, 1)
    return p.read_rejections(spark, lake).select("table_name", "raw_row", "reason")


@query("from_config", """
select o_orderkey, o_totalprice * 2 as doubled, 'shaped' as _transformer_name from orders where o_totalprice > 100000""")
def from_config(spark: SparkSession, sf: str) -> DataFrame:
    """A transformation run that a configuration describes, of two registered steps."""
    target, steps = Workspace(spark, "config").path("orders"), Registry()
    steps.register("large", lambda df: df.filter("o_totalprice > 100000"))
    steps.register("doubled", lambda df: df.select("o_orderkey", (F.col("o_totalprice") * 2).alias("doubled")))
    p.from_config({"bronze_path": f"{sf.rstrip('/')}/orders.parquet", "silver_table": target, "config": {"steps": ["large", "doubled"], "name": "shaped"}}, steps)(spark)
    return spark.read.parquet(target).select("o_orderkey", "doubled", "_transformer_name")


@query("compact", """
select cast(o_orderkey as integer) as id, 'name ' || o_orderkey as department, true as fewer from orders""")
def compact(spark: SparkSession, sf: str) -> DataFrame:
    """A table of six batches before and after its small batches were merged: the same rows in fewer folders."""
    lake = p.Lake.under(Workspace(spark, "compact").root)
    k = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    for i in range(6):
        p.load(spark, k.where(F.col("k") % 6 == i).select(F.col("k").cast("string").alias("id"), F.concat(F.lit("name "), "k").alias("department")), DEPARTMENTS, lake, i)
    path = sinks.current_version(spark, lake.table("departments"))
    before = len(files.partition_values(spark, path, sinks.BATCH))
    p.compact_silver(spark, lake, DEPARTMENTS)
    fewer = len(files.partition_values(spark, path, sinks.BATCH)) < before
    return p.read_silver(spark, lake, DEPARTMENTS).withColumn("fewer", F.lit(fewer))


# --- extracts and gates ------------------------------------------------------------------

_EXTRACTED = ["transaction_id", "customer_id", "quantity", "transaction_date", "_source_system", "_source_entity",
              "_extractor_name", "_schema_version"]


def _sales_csv(spark: SparkSession, sf: str) -> str:
    path = Workspace(spark, "source").path("sales.csv")
    df = sales(spark, sf).withColumn("transaction_date", F.date_format("transaction_date", "yyyy-MM-dd'T'HH:mm:ss"))
    df.write.option("header", True).csv(path)
    return path


def _extract_sql(where: str) -> str:
    return f"""select transaction_id, customer_id, quantity, transaction_date, 'file' as _source_system,
      'sales.csv' as _source_entity, 'FileExtractor' as _extractor_name, '1.0' as _schema_version from ({SALES_SQL}) {where}"""


@query("extract", _extract_sql(""))
def extract(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.contract import SALES_DECLARED

    path = _sales_csv(spark, sf)
    run = p.extract(spark, path, Workspace(spark, "bronze").root, SALES_DECLARED)
    return spark.read.parquet(run.target).select(*_EXTRACTED)


@query("extract_incremental", _extract_sql("where transaction_date > timestamp '2000-06-30'"))
def extract_incremental(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.contract import SALES_DECLARED

    last = F.lit("2000-06-30 00:00:00").cast("timestamp_ntz")
    run = p.extract(
        spark, _sales_csv(spark, sf), Workspace(spark, "bronze").root, SALES_DECLARED, watermark=("transaction_date", last)
    )
    return spark.read.parquet(run.target).select(*_EXTRACTED)


@query("gated_run", f"""
select product_id, count(transaction_id) as transaction_id_count, cast(sum(quantity) as bigint) as quantity_sum
from ({SALES_SQL}) group by product_id""")
def gated_run(spark: SparkSession, sf: str) -> DataFrame:
    work = Workspace(spark, "gated")
    path = _sales_csv(spark, sf)
    declared = {"version": "1.0", "columns": [
        {"name": n, "type": t, "required": True} for n, t in (
            ("transaction_id", "string"), ("customer_id", "string"), ("product_id", "string"), ("quantity", "integer"),
            ("unit_price", "float"), ("total_amount", "float"), ("transaction_date", "datetime"))]}
    after = [
        {"name": "one_row_per_product", "type": "uniqueness", "config": {"columns": ["product_id"]}},
        {"name": "counts", "type": "business_rule", "config": {"condition": "transaction_id_count > 0"}},
    ]
    p.gated_pipeline(
        spark, path, work.path("bronze"), work.path("silver"),
        lambda df: tr.aggregate_metrics(df, ["product_id"], {"transaction_id": "count", "quantity": "sum"}),
        BRONZE_RULES, after, declared)
    return spark.read.parquet(work.path("silver")).select("product_id", "transaction_id_count", "quantity_sum")


@query("run_transform", """
select o_orderkey, o_totalprice, 'orders' as _bronze_source_path, 'large_orders' as _transformer_name,
       '1.0' as _transformation_version from orders where o_totalprice > 250000""")
def run_transform(spark: SparkSession, sf: str) -> DataFrame:
    target = Workspace(spark, "silver").path("orders")
    p.run_transform(
        table(spark, sf, "orders"),
        lambda df: df.filter("o_totalprice > 250000").select("o_orderkey", "o_totalprice"),
        target, "large_orders", "orders")
    return spark.read.parquet(target).drop("_silver_load_timestamp")


_COUNTED = ("customer", "supplier", "part", "orders", "lineitem", "events", "documents")


@query("status_counts", " union all ".join(f"select '{t}' as table_name, count(*) as rows from {t}" for t in _COUNTED))
def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return p.table_counts({t: table(spark, sf, t) for t in _COUNTED})


@query("lake_status", f"""
select 'departments' as table_name, count(*) as rows from supplier
union all select 'jobs', count(*) from part where p_size > 5
union all select 'hired_employees', count(*) from ({SILVER_SQL})
union all select 'rejected_log', count(*) from ({_FK_SQL}) where why <> ''""")
def lake_status(spark: SparkSession, sf: str) -> DataFrame:
    lake, _ = _loaded(spark, sf)
    return p.lake_status(spark, lake)


@query("lake_backup", SILVER_SQL)
def lake_backup(spark: SparkSession, sf: str) -> DataFrame:
    """A silver table backed up, and the backup read with the table's types."""
    lake, _ = _loaded(spark, sf)
    root = Workspace(spark, "backups").root
    p.backup_table(spark, root, HIRED_EMPLOYEES, lake, "2024-01-01")
    return sinks.read_backup(spark, root, HIRED_EMPLOYEES).drop("_loaded_at")

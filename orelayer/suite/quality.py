"""Quality rules, standalone checks and source profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import profiling, sketches, uniqueness
from ..operators.quality import (
    BRONZE_RULES,
    SILVER_RULES,
    duplicate_rows,
    not_null_test,
    rules_report,
    run_column_tests,
    unique_test,
    utc,
)
from ..session import Workspace
from ..sources.sinks import append_bronze, write_json
from .base import query, table

_SHOWN = ["rule_name", "rule_type", "severity", "column_name", "measured", "passed"]
NOW = utc(2001, 12, 31)
NOW_SQL = "timestamp '2001-12-31 00:00:00'"


def _age_sql(column: str, source: str) -> str:
    return f"(select (epoch_us({NOW_SQL}) - epoch_us(max({column}))) / 3.6e9 from {source})"


# --- a rule set over the customers -----------------------------------------------------

CUSTOMER_RULES = [
    {"name": "columns_present", "type": "schema", "config": {"columns": ["c_custkey", "c_name"]}},
    {"name": "columns_missing", "type": "schema", "severity": "warning", "config": {"columns": ["c_custkey", "c_phone"]}},
    {"name": "nulls", "type": "null_check", "config": {"columns": ["c_custkey", "c_name", "c_phone"]}},
    {"name": "segment_nulls", "type": "null_check", "severity": "warning",
     "config": {"columns": ["segment"], "max_null_percentage": 10}},
    {"name": "balance", "type": "business_rule", "config": {"condition": "c_acctbal >= 0"}},
    {"name": "segment_known", "type": "business_rule", "severity": "info", "config": {"condition": "segment <> 'BUILDING'"}},
    {"name": "no_condition", "type": "business_rule"},
    {"name": "volume", "type": "volume", "severity": "warning", "config": {"min_rows": 10}},
    {"name": "too_many", "type": "volume", "severity": "warning", "config": {"max_rows": 100}},
    {"name": "unique_key", "type": "uniqueness", "config": {"columns": ["c_custkey"]}},
    {"name": "unique_place", "type": "uniqueness", "config": {"columns": ["c_nationkey", "segment"]}},
    {"name": "unknown", "type": "no_such_type"},
]


def _customers(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "customer")
    return df.withColumn("segment", F.nullif("c_mktsegment", F.lit("MACHINERY"))).drop("c_mktsegment")


@query("rules_report", """
with c as (select *, nullif(c_mktsegment, 'MACHINERY') as segment from customer),
n as (select cast(count(*) as double) as n from c)
select 'columns_present' as rule_name, 'schema' as rule_type, 'error' as severity, cast(null as varchar) as column_name,
       cast(null as double) as measured, true as passed
union all select 'columns_missing', 'schema', 'warning', null, null, false
union all select 'nulls', 'null_check', 'error', 'c_custkey',
       (select count(*) from c where c_custkey is null) / n * 100, (select count(*) from c where c_custkey is null) = 0 from n
union all select 'nulls', 'null_check', 'error', 'c_name',
       (select count(*) from c where c_name is null) / n * 100, (select count(*) from c where c_name is null) = 0 from n
union all select 'nulls', 'null_check', 'error', 'c_phone', null, false
union all select 'segment_nulls', 'null_check', 'warning', 'segment',
       (select count(*) from c where segment is null) / n * 100,
       (select count(*) from c where segment is null) / n * 100 <= 10 from n
union all select 'balance', 'business_rule', 'error', null, count(*), count(*) = 0 from c where not (c_acctbal >= 0)
union all select 'segment_known', 'business_rule', 'info', null, count(*), count(*) = 0 from c where not (segment <> 'BUILDING')
union all select 'no_condition', 'business_rule', 'error', null, null, true
union all select 'volume', 'volume', 'warning', null, n, n >= 10 from n
union all select 'too_many', 'volume', 'warning', null, n, n <= 100 from n
union all select 'unique_key', 'uniqueness', 'error', null, count(*) - count(distinct c_custkey),
       count(*) = count(distinct c_custkey) from c
union all select 'unique_place', 'uniqueness', 'error', null, n - (select count(*) from (select distinct c_nationkey, segment from c)),
       n = (select count(*) from (select distinct c_nationkey, segment from c)) from n
union all select 'unknown', 'no_such_type', 'error', null, null, true""")
def customer_rules(spark: SparkSession, sf: str) -> DataFrame:
    return rules_report(_customers(spark, sf), CUSTOMER_RULES).select(*_SHOWN)


# --- the shipped rule sets over sales rows -----------------------------------------------

SALES_SQL = """
select l_orderkey || '-' || l_linenumber as transaction_id, cast(l_suppkey as varchar) as customer_id,
       cast(l_partkey as varchar) as product_id, cast(l_quantity as bigint) as quantity,
       l_extendedprice / l_quantity as unit_price, l_extendedprice as total_amount, l_shipdate as transaction_date,
       case when l_returnflag <> 'R' then 'a@example.com' end as customer_email,
       case when l_linestatus = 'O' and l_returnflag = 'A' then 'note' end as notes
from lineitem"""


def sales(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
        F.col("l_suppkey").cast("string").alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("l_extendedprice").alias("total_amount"),
        F.col("l_shipdate").alias("transaction_date"),
        F.when(F.col("l_returnflag") != "R", "a@example.com").alias("customer_email"),
        F.when((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "A"), "note").alias("notes"),
    )


def _null_sql(rule: str, severity: str, column: str, limit: float) -> str:
    share = f"(select 100.0::double * 0 + count(*) filter (where {column} is null)::double / count(*) * 100 from s)"
    return f"select '{rule}', 'null_check', '{severity}', '{column}', {share}, {share} <= {limit}"


def _broken_sql(rule: str, severity: str, condition: str) -> str:
    return f"select '{rule}', 'business_rule', '{severity}', null, count(*), count(*) = 0 from s where not ({condition})"


def _report_sql(*parts: str) -> str:
    head = (
        "select cast(null as varchar) as rule_name, cast(null as varchar) as rule_type, cast(null as varchar) as severity, "
        "cast(null as varchar) as column_name, cast(null as double) as measured, cast(null as boolean) as passed where false"
    )
    return f"with s as ({SALES_SQL}) " + " union all ".join([head, *parts])


@query("rules_bronze_sales", _report_sql(
    "select 'required_columns_bronze', 'schema', 'error', null, null, true",
    *[_null_sql("no_nulls_in_keys", "error", c, 0) for c in ("transaction_id", "customer_id", "product_id")],
    *[_null_sql("limited_nulls_in_optional", "warning", c, 50) for c in ("customer_email", "notes")],
    "select 'minimum_volume', 'volume', 'warning', null, count(*), count(*) between 1 and 10000000 from s",
    f"select 'data_freshness', 'freshness', 'warning', '_extraction_timestamp', {_age_sql('transaction_date', 's')}, "
    f"{_age_sql('transaction_date', 's')} <= 48",
    _broken_sql("positive_quantity", "error", "quantity > 0"),
    _broken_sql("positive_prices", "error", "unit_price > 0 and total_amount > 0"),
    _broken_sql("amount_calculation", "warning", "abs(total_amount - (quantity * unit_price)) < 0.01"),
))
def rules_bronze_sales(spark: SparkSession, sf: str) -> DataFrame:
    df = sales(spark, sf).withColumns({
        "_extraction_timestamp": F.col("transaction_date").cast("timestamp"),
        "_source_system": F.lit("file"), "_source_entity": F.lit("sales")})
    return rules_report(df, BRONZE_RULES, NOW).select(*_SHOWN)


@query("rules_silver_sales", _report_sql(
    "select 'required_columns_silver', 'schema', 'error', null, null, true",
    "select 'unique_transaction_id', 'uniqueness', 'error', null, count(*) - count(distinct transaction_id), "
    "count(*) = count(distinct transaction_id) from s",
    *[_null_sql("no_nulls_in_required_fields", "error", c, 0) for c in (
        "transaction_id", "customer_id", "product_id", "quantity", "unit_price", "total_amount", "transaction_date")],
    _broken_sql("valid_quantity", "error", "quantity > 0 and quantity < 10000"),
    _broken_sql("valid_amount", "error", "total_amount > 0 and total_amount < 1000000"),
    _broken_sql("valid_date_range", "error", "transaction_date >= '2020-01-01' and transaction_date <= current_date"),
    "select 'expected_volume', 'volume', 'warning', null, count(*), count(*) between 100 and 5000000 from s",
    f"select 'silver_freshness', 'freshness', 'warning', '_silver_load_timestamp', {_age_sql('transaction_date', 's')}, "
    f"{_age_sql('transaction_date', 's')} <= 24",
))
def rules_silver_sales(spark: SparkSession, sf: str) -> DataFrame:
    df = sales(spark, sf).withColumns({
        "_silver_load_timestamp": F.col("transaction_date").cast("timestamp"),
        "_bronze_source_path": F.lit("bronze"), "_transformer_name": F.lit("sales")})
    return rules_report(df, SILVER_RULES, NOW).select(*_SHOWN)


# --- single tests -----------------------------------------------------------------------------

@query("not_null_test", "select * from lineitem where nullif(l_returnflag, 'A') is null")
def not_null(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    return not_null_test(lines.withColumn("flag", F.nullif("l_returnflag", F.lit("A"))), "flag").drop("flag")


@query("unique_test", "select l_orderkey, count(*) as rows from lineitem group by 1 having count(*) > 1")
def unique(spark: SparkSession, sf: str) -> DataFrame:
    return unique_test(table(spark, sf, "lineitem"), "l_orderkey")


@query("duplicate_rows", """
select count(*) - (select count(*) from (select distinct l_orderkey, l_linenumber from lineitem)) as duplicates
from lineitem""")
def duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_rows(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


_TESTED = {
    "supplier": {"s_suppkey": ["unique", "not_null"], "s_name": ["not_null"]},
    "part": {"p_partkey": ["unique", "not_null"], "p_name": ["unique"]},
    "lineitem": {
        "l_orderkey": ["unique", "not_null"],
        "l_suppkey": ["not_null", ("supplier", "s_suppkey")],
        "l_partkey": [("part", "p_partkey")],
    },
}


def _unique_sql(name: str, column: str) -> str:
    return (f"select '{name}' as table_name, '{column}' as column, 'unique' as test, count(*) as failures "
            f"from (select {column} from {name} group by 1 having count(*) > 1)")


def _not_null_sql(name: str, column: str) -> str:
    return f"select '{name}', '{column}', 'not_null', count(*) from {name} where {column} is null"


@query("column_tests", " union all ".join([
    _unique_sql("supplier", "s_suppkey"), _unique_sql("part", "p_partkey"), _unique_sql("part", "p_name"),
    _unique_sql("lineitem", "l_orderkey"), _not_null_sql("supplier", "s_suppkey"), _not_null_sql("supplier", "s_name"),
    _not_null_sql("part", "p_partkey"), _not_null_sql("lineitem", "l_orderkey"), _not_null_sql("lineitem", "l_suppkey"),
    "select 'lineitem', 'l_suppkey', 'relationships', count(*) from lineitem where l_suppkey not in (select s_suppkey from supplier where s_acctbal > 0)",
    "select 'lineitem', 'l_partkey', 'relationships', count(*) from lineitem where l_partkey not in (select p_partkey from part)",
]))
def column_tests(spark: SparkSession, sf: str) -> DataFrame:
    """All tests of three tables; the relationship only counts solvent suppliers."""
    tables = {n: table(spark, sf, n) for n in ("supplier", "part", "lineitem")}
    parents = {**tables, "solvent": tables["supplier"].filter("s_acctbal > 0")}
    lines = {**_TESTED["lineitem"], "l_suppkey": ["not_null", ("solvent", "s_suppkey")]}
    return run_column_tests(parents, {**_TESTED, "lineitem": lines})


# --- profiles ------------------------------------------------------------------------------------

def _profile_sql(source: str, columns: list[tuple[str, str, str]]) -> str:
    parts = []
    for name, dtype, kind in columns:
        number, text, date = kind == "number", kind == "text", kind == "date"
        null = "null"
        parts.append(f"""
select '{name}' as name, '{dtype}' as dtype, count(*) filter (where {name} is null) as null_count,
  round_even(count(*) filter (where {name} is null) / count(*) * 100, 2) as null_percentage,
  count(distinct {name}) as distinct_count,
  round_even(count(distinct {name}) / count(*) * 100, 2) as distinct_percentage,
  cast({f'min({name})' if number else null} as double) as min, cast({f'max({name})' if number else null} as double) as max,
  cast({f'round_even(avg({name}), 2)' if number else null} as double) as mean,
  cast({f'median({name})' if number else null} as double) as median,
  cast({f'round_even(stddev_samp({name}), 2)' if number else null} as double) as std,
  cast({f'count(*) filter (where {name} = 0)' if number else null} as bigint) as zeros_count,
  cast({f'count(*) filter (where {name} < 0)' if number else null} as bigint) as negative_count,
  cast({f'min(length({name}))' if text else null} as integer) as min_length,
  cast({f'max(length({name}))' if text else null} as integer) as max_length,
  cast({f'round_even(avg(length({name})), 2)' if text else null} as double) as avg_length,
  cast({f"count(*) filter (where trim({name}) = '')" if text else null} as bigint) as empty_count,
  cast({f"strftime(min({name}), '%Y-%m-%d %H:%M:%S')" if date else null} as varchar) as min_date,
  cast({f"strftime(max({name}), '%Y-%m-%d %H:%M:%S')" if date else null} as varchar) as max_date,
  cast({f'floor((epoch(max({name})) - epoch(min({name}))) / 86400)' if date else null} as bigint) as date_range_days
from {source}""")
    return " union all ".join(parts)


_ORDER_COLUMNS = [
    ("o_orderkey", "bigint", "number"), ("o_custkey", "bigint", "number"), ("o_orderstatus", "string", "text"),
    ("o_totalprice", "double", "number"), ("o_orderdate", "timestamp_ntz", "date"), ("o_orderpriority", "string", "text"),
]
_CUSTOMER_COLUMNS = [
    ("c_custkey", "bigint", "number"), ("c_name", "string", "text"), ("c_nationkey", "int", "number"),
    ("c_acctbal", "double", "number"), ("segment", "string", "text"),
]
_CUSTOMER_SQL = "(select * exclude (c_mktsegment), nullif(c_mktsegment, 'MACHINERY') as segment from customer)"


@query("profile_orders", _profile_sql("orders", _ORDER_COLUMNS))
def profile_orders(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.profile_columns(table(spark, sf, "orders")).drop("sample_values", "rows")


@query("profile_customer", _profile_sql(_CUSTOMER_SQL, _CUSTOMER_COLUMNS))
def profile_customer(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.profile_columns(_customers(spark, sf)).drop("sample_values", "rows")


def _samples_sql(source: str, columns: list[str]) -> str:
    return " union all ".join(
        f"select '{c}' as name, (select string_agg(v, '|' order by k) from (select distinct {c} as k, "
        f"cast({c} as varchar) as v from {source} where {c} is not null order by k limit 10)) as samples"
        for c in columns
    )


@query("profile_samples", _samples_sql("orders", [c for c, _, _ in _ORDER_COLUMNS]))
def profile_samples(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders")
    return profiling.profile_columns(df).select("name", F.array_join("sample_values", "|").alias("samples"))


@query("profile_overview", """
with d as (select count(*) as u from (select distinct * from lineitem)), t as (select count(*) as n from lineitem)
select n as total_rows, cast(11 as bigint) as total_columns, n - u as duplicate_rows,
       round_even((n - u) / n * 100, 2) as duplicate_percentage from t, d""")
def profile_overview(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.profile_overview(table(spark, sf, "lineitem"))


_SKETCHED = [("o_orderkey", "number"), ("o_custkey", "number"), ("o_orderstatus", "text"), ("o_totalprice", "number"), ("o_orderdate", "date"), ("o_orderpriority", "text")]
_INCREMENTAL_SQL = " union all ".join(f"""
select '{c}' as name, count(*) as rows, count(*) filter (where {c} is null) as null_count, true as distinct_within, {'true' if kind == 'number' else 'cast(null as boolean)'} as median_within,
  cast({f'min({c})' if kind == 'number' else 'null'} as double) as min, cast({f'max({c})' if kind == 'number' else 'null'} as double) as max,
  cast({f'round_even(avg({c}), 2)' if kind == 'number' else 'null'} as double) as mean, cast({f'round_even(stddev_samp({c}), 2)' if kind == 'number' else 'null'} as double) as std,
  cast({f'min(length({c}))' if kind == 'text' else 'null'} as integer) as min_length, cast({f'max(length({c}))' if kind == 'text' else 'null'} as integer) as max_length,
  cast({f'round_even(avg(length({c})), 2)' if kind == 'text' else 'null'} as double) as avg_length,
  cast({f"strftime(max({c}), '%Y-%m-%d %H:%M:%S')" if kind == 'date' else 'null'} as varchar) as max_date from orders""" for c, kind in _SKETCHED)


@query("profile_incremental", _INCREMENTAL_SQL)
def profile_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Three days that land out of order, each sketched once; the estimates are held against the
    whole table: distinct counts within 4 %, the median within 2 % of the ranks."""
    base, store = Workspace(spark, "bronze").root, Workspace(spark, "profiles").root
    orders = table(spark, sf, "orders")
    for batch, day in (("b1", 1), ("b2", 3), ("b3", 2)):
        append_bronze(orders.where(F.col("o_orderkey") % 3 == day - 1), base, "orders", f"2024-01-0{day}")
        sketches.profile_incremental(spark, base, "orders", store, batch)
    found = sketches.profile_incremental(spark, base, "orders", store, "b3")  # once more: the same
    exact = orders.agg(*[F.count_distinct(c).alias(c) for c, _ in _SKETCHED]).select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("exact")) for c, _ in _SKETCHED])))
    numbers = [c for c, kind in _SKETCHED if kind == "number"]
    values = orders.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("v")) for c in numbers])))
    ranks = values.join(F.broadcast(found.select("name", "median")), "name").groupBy("name").agg(F.avg((F.col("v") < F.col("median")).cast("int")).alias("below"), F.avg((F.col("v") <= F.col("median")).cast("int")).alias("upto"))
    joined = found.join(exact, "name").join(ranks, "name", "left")
    return joined.select(
        "name", "rows", "null_count", (F.abs(F.col("distinct_count") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.04 * F.col("exact"))).alias("distinct_within"),
        ((F.col("below") <= 0.52) & (F.col("upto") >= 0.48)).alias("median_within"), "min", "max", "mean", "std", "min_length", "max_length", "avg_length", "max_date")


@query("unique_incremental", """
select count(*) as total_rows, count(distinct (user_id, event_type, value > 50)) as distinct_keys,
       count(*) - count(distinct (user_id, event_type, value > 50)) as duplicate_rows from events""")
def unique_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and distinct keys of four batches, one of them added twice, from their index alone."""
    path = Workspace(spark, "unique").root
    events = table(spark, sf, "events").withColumn("high", F.col("value") > 50)
    for i in (0, 1, 2, 3, 1):
        uniqueness.add_batch(events.where(F.col("event_id") % 4 == i), ["user_id", "event_type", "high"], path, i)
    return uniqueness.uniqueness(spark, path)


@query("quality_score", """
with c as (select *, nullif(c_mktsegment, 'MACHINERY') as segment from customer),
m as (select round_even((1 - count(*) filter (where segment is null) / (count(*) * 5)) * 100, 2) as completeness,
             round_even((count(distinct c_custkey) + count(distinct c_name) + count(distinct c_nationkey)
                   + count(distinct c_acctbal) + count(distinct segment)) / 5 / count(*) * 100, 2) as uniqueness from c)
select round_even(completeness * 0.7::double + uniqueness * 0.3::double, 2) as overall_score, completeness, uniqueness from m""")
def quality_score(spark: SparkSession, sf: str) -> DataFrame:
    return profiling.quality_score(profiling.profile_columns(_customers(spark, sf)))


@query("profile_json", """
select 'customer.parquet' as source_name, count(*) as total_rows, cast(5 as bigint) as total_columns,
       count(*) - count(distinct c_custkey) as duplicate_rows, cast(5 as bigint) as profiled from customer""")
def profile_json(spark: SparkSession, sf: str) -> DataFrame:
    """The whole profile of a file, written as JSON and read back."""
    path = Workspace(spark, "profile").path("customer.json")
    write_json(profiling.profile_file(spark, f"{sf.rstrip('/')}/customer.parquet"), path)
    found = spark.read.json(path)
    return found.select(
        "source_name", "overview.total_rows", "overview.total_columns", "overview.duplicate_rows",
        F.size("columns").cast("bigint").alias("profiled"))

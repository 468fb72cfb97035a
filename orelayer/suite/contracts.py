"""Row contracts, foreign keys, delta load and quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import contract as c
from ..operators import delta
from ..operators.contract import Contract, ForeignKey, HIRED_EMPLOYEES
from ..operators.keys import annotate_fk, orphan_values, orphans
from ..session import Workspace
from .base import query, table

# --- staffing rows derived from events: text columns, some of them broken ----------

RAW_STAFF_SQL = """
select case when value < 1 then 'abc' when value > 250 then null else cast(event_id as varchar) end as id,
       case event_type when 'error' then chr(9) || ' ' else '  ' || event_type || chr(10) end as name,
       case when value < 5 then strftime(ts, '%Y/%m/%d %H:%M')
            when value < 10 then strftime(ts, '%Y-%m-%d')
            when value < 20 then strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+05:00'
            when value < 21 then '2021-13-01T00:00:00Z'
            else strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' end as datetime,
       cast(user_id as varchar) as department_id,
       case when value > 200 then 'x' || user_id else cast(user_id as varchar) end as job_id
from events
"""


def raw_staff(spark: SparkSession, sf: str) -> DataFrame:
    v, ts = F.col("value"), F.col("ts")
    user = F.col("user_id").cast("string")
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, sf, "events").select(
        F.when(v < 1, "abc").when(v > 250, F.lit(None)).otherwise(F.col("event_id").cast("string")).alias("id"),
        F.when(F.col("event_type") == "error", "\t ").otherwise(
            F.concat(F.lit("  "), "event_type", F.lit("\n"))
        ).alias("name"),
        F.when(v < 5, F.date_format(ts, "yyyy/MM/dd HH:mm"))
        .when(v < 10, F.date_format(ts, "yyyy-MM-dd"))
        .when(v < 20, F.concat(iso, F.lit("+05:00")))
        .when(v < 21, "2021-13-01T00:00:00Z")
        .otherwise(F.concat(iso, F.lit("Z")))
        .alias("datetime"),
        user.alias("department_id"),
        F.when(v > 200, F.concat(F.lit("x"), user)).otherwise(user).alias("job_id"),
    )


_STRIPPED = "regexp_replace(name, '^\\s+|\\s+$', '', 'g')"
STAFF_CHECK_SQL = f"""
select id, name, datetime, department_id, job_id,
       try_cast(id as integer) as id_v, {_STRIPPED} as name_v,
       case when regexp_full_match(datetime, '\\d{{4}}-\\d{{2}}-\\d{{2}}([T ]\\d{{2}}:\\d{{2}}(:\\d{{2}}(\\.\\d{{1,6}})?)?(Z|[+-]\\d{{2}}:\\d{{2}})?)?')
            then try_cast(regexp_replace(datetime, '(Z|[+-]\\d{{2}}:\\d{{2}})$', '') as timestamp) end as datetime_v,
       try_cast(department_id as integer) as dep_v, try_cast(job_id as integer) as job_v
from ({RAW_STAFF_SQL})
"""
STAFF_REASON_SQL = f"""
select *, concat_ws('; ',
    case when id_v is null then 'id is null/invalid' end,
    case when name is null or name_v = '' then 'name is empty' end,
    case when datetime_v is null then 'datetime is empty/invalid format' end,
    case when dep_v is null then 'department_id is null/invalid' end,
    case when job_v is null then 'job_id is null/invalid' end) as reason
from ({STAFF_CHECK_SQL})
"""


@query("validate_split_ok", f"""
select id_v as id, name_v as name, datetime_v as datetime, dep_v as department_id, job_v as job_id
from ({STAFF_REASON_SQL}) where reason = ''""")
def validate_split_ok(spark: SparkSession, sf: str) -> DataFrame:
    return c.accepted(HIRED_EMPLOYEES.annotate(raw_staff(spark, sf)))


@query("validate_split_bad", f"""
select 'hired_employees' as table_name,
       to_json({{'id': id, 'name': name, 'datetime': datetime, 'department_id': department_id, 'job_id': job_id}})::varchar as raw_row,
       reason
from ({STAFF_REASON_SQL}) where reason <> ''""")
def validate_split_bad(spark: SparkSession, sf: str) -> DataFrame:
    return c.rejected(HIRED_EMPLOYEES.annotate(raw_staff(spark, sf)), "hired_employees")


# --- declared schema -------------------------------------------------------------------

DECLARED = {
    "version": "1.0",
    "columns": [
        {"name": "transaction_id", "type": "string", "required": True},
        {"name": "quantity", "type": "integer", "required": True, "validation": {"min": 2, "max": 48}},
        {"name": "unit_price", "type": "float", "required": True, "validation": {"min": 0}},
        {"name": "returned", "type": "boolean"},
        {"name": "transaction_date", "type": "datetime", "required": True},
    ],
}


def _declared_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
        F.when(F.col("l_tax") == 0.08, "many").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("quantity"),
        F.col("l_extendedprice").cast("string").alias("unit_price"),
        F.when(F.col("l_returnflag") == "N", "no idea").otherwise(
            (F.col("l_returnflag") == "R").cast("string")
        ).alias("returned"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("transaction_date"),
    )


_DECLARED_SQL = """
select l_orderkey || '-' || l_linenumber as transaction_id,
       case when l_tax = 0.08 then null else cast(l_quantity as bigint) end as quantity,
       l_extendedprice as unit_price, l_shipdate as transaction_date,
       concat_ws('; ', case when l_tax = 0.08 then 'quantity is null/invalid' end,
                       case when l_tax <> 0.08 and l_quantity < 2 then 'quantity is below 2' end,
                       case when l_tax <> 0.08 and l_quantity > 48 then 'quantity is above 48' end,
                       case when l_returnflag = 'N' then 'returned is null/invalid' end) as reason,
       l_returnflag = 'R' as returned
from lineitem
"""


@query("declared_schema_ok", f"select * exclude (reason) from ({_DECLARED_SQL}) where reason = ''")
def declared_schema_ok(spark: SparkSession, sf: str) -> DataFrame:
    return c.apply_contract(_declared_rows(spark, sf), Contract.from_declared(DECLARED))


@query("declared_schema_bad", f"select transaction_id, reason from ({_DECLARED_SQL}) where reason <> ''")
def declared_schema_bad(spark: SparkSession, sf: str) -> DataFrame:
    marked = Contract.from_declared(DECLARED).annotate(_declared_rows(spark, sf))
    return marked.filter(F.size(c.REASONS) > 0).select("transaction_id", c.reason_text().alias("reason"))


# --- foreign keys -------------------------------------------------------------------------

LINE_CONTRACT = Contract(
    "lineitem",
    tuple(
        c.Field(n, "bigint") for n in ("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    ),
    key=("l_orderkey", "l_linenumber"),
    foreign_keys=(
        ForeignKey("l_suppkey", "supplier", "s_suppkey", label="supplier"),
        ForeignKey("l_partkey", "part", "p_partkey", label="part"),
    ),
)
_PARENT_SUPPLIERS = "s_acctbal > 0"
_PARENT_PARTS = "p_size >= 8"


def _parents(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "supplier": table(spark, sf, "supplier").filter(_PARENT_SUPPLIERS),
        "part": table(spark, sf, "part").filter(_PARENT_PARTS),
    }


@query("fk_check", f"""
with marked as (
  select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_suppkey, l_partkey, concat_ws('; ',
    case when l_suppkey not in (select s_suppkey from supplier where {_PARENT_SUPPLIERS})
         then 'l_suppkey ' || l_suppkey || ' not in supplier' end,
    case when l_partkey not in (select p_partkey from part where {_PARENT_PARTS})
         then 'l_partkey ' || l_partkey || ' not in part' end) as t from lineitem)
select l_orderkey, l_linenumber, l_suppkey, l_partkey,
       case when t = '' then '' else 'FK Violation: ' || t end as reason from marked""")
def fk_check(spark: SparkSession, sf: str) -> DataFrame:
    keys = LINE_CONTRACT.columns
    marked = LINE_CONTRACT.annotate(table(spark, sf, "lineitem").select(*keys))
    checked = annotate_fk(marked, LINE_CONTRACT.foreign_keys, _parents(spark, sf))
    return checked.select(*keys, c.reason_text().alias("reason"))


@query("orphan_values", f"""
select l_partkey, count(*) as rows from lineitem
where l_partkey not in (select p_partkey from part where {_PARENT_PARTS}) group by l_partkey""")
def fk_orphan_values(spark: SparkSession, sf: str) -> DataFrame:
    return orphan_values(table(spark, sf, "lineitem"), "l_partkey", _parents(spark, sf)["part"], "p_partkey")


@query("orphans", f"""
select * from lineitem where l_partkey not in (select p_partkey from part where {_PARENT_PARTS})""")
def fk_orphans(spark: SparkSession, sf: str) -> DataFrame:
    return orphans(table(spark, sf, "lineitem"), "l_partkey", _parents(spark, sf)["part"], "p_partkey")


# --- delta load ---------------------------------------------------------------------------
# Stored: the finished and open orders. Incoming: all orders, the urgent ones with
# another priority text and all times moved by less than a second.

_STORED = "o_orderstatus <> 'P'"


def _order_outcome(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    incoming = orders.withColumns(
        {
            "o_orderpriority": F.when(urgent, "1-RUSH").otherwise(F.col("o_orderpriority")),
            "o_orderdate": F.col("o_orderdate") + F.expr("interval 0.5 second"),
        }
    )
    return delta.classify(incoming, orders.filter(_STORED), ["o_orderkey"], Workspace(spark, "delta"))


_INCOMING_SQL = """
select * replace (case when o_orderpriority = '1-URGENT' then '1-RUSH' else o_orderpriority end as o_orderpriority,
                  o_orderdate + interval 500 milliseconds as o_orderdate) from orders"""


@query("delta_new", f"select * from ({_INCOMING_SQL}) where not ({_STORED})")
def delta_new(spark: SparkSession, sf: str) -> DataFrame:
    return delta.new_rows(_order_outcome(spark, sf))


@query("delta_skipped", f"""
select o_orderkey, cast(1 as bigint) as copies from ({_INCOMING_SQL})
where {_STORED} and o_orderpriority <> '1-RUSH'""")
def delta_skipped(spark: SparkSession, sf: str) -> DataFrame:
    outcome = _order_outcome(spark, sf).filter(F.col(delta.STATUS) == delta.SKIPPED)
    return outcome.select("o_orderkey", F.col(delta.COPIES).alias("copies"))


@query("delta_conflict", f"""
select o_orderkey, 'o_orderpriority' as field, '1-URGENT' as current, '1-RUSH' as incoming
from ({_INCOMING_SQL}) where {_STORED} and o_orderpriority = '1-RUSH'""")
def delta_conflict(spark: SparkSession, sf: str) -> DataFrame:
    outcome = _order_outcome(spark, sf).filter(F.col(delta.STATUS) == delta.CONFLICT)
    return outcome.select("o_orderkey", F.inline(delta.CHANGES))


@query("delta_conflict_log", f"""
select 'orders' as table_name, 'CONFLICT: o_orderkey=' || o_orderkey || ' exists with different data — '
       || 'o_orderpriority: ''1-URGENT'' → ''1-RUSH''' as reason
from ({_INCOMING_SQL}) where {_STORED} and o_orderpriority = '1-RUSH'""")
def delta_conflict_log(spark: SparkSession, sf: str) -> DataFrame:
    return delta.conflict_log(_order_outcome(spark, sf), "orders", ["o_orderkey"]).select("table_name", "reason")


@query("delta_in_batch", """
with lines as (select l_orderkey, l_linenumber, l_returnflag, l_linestatus from lineitem),
keys as (select l_orderkey, l_linenumber, count(*) as n, count(distinct l_returnflag || l_linestatus) as forms
         from lines group by all),
outcome as (
  select 'new' as status, 1 as rows from keys where forms = 1
  union all select 'skipped', n - 1 from keys where forms = 1
  union all select 'conflict', n from keys where forms > 1)
select status, cast(sum(rows) as bigint) as rows from outcome group by status""")
def delta_in_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Keys that repeat inside one batch, against an empty table."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    outcome = delta.classify(lines, lines.filter("false"), ["l_orderkey", "l_linenumber"], Workspace(spark, "delta"))
    return delta.status_counts(outcome).withColumnRenamed(delta.STATUS, "status")


@query("delta_in_batch_rows", """
with lines as (select l_orderkey, l_linenumber, l_returnflag, l_linestatus from lineitem),
keys as (select l_orderkey, l_linenumber from lines group by all
         having count(distinct l_returnflag || l_linestatus) > 1)
select l.* from lines l join keys using (l_orderkey, l_linenumber)""")
def delta_in_batch_rows(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    outcome = delta.classify(lines, lines.filter("false"), ["l_orderkey", "l_linenumber"])
    return outcome.filter(F.col(delta.STATUS) == delta.CONFLICT).select(*lines.columns)


# --- quarantine -------------------------------------------------------------------------------

ROW_RULES = {
    "non_negative_balance": "c_acctbal >= 0",
    "known_segment": "c_mktsegment <> 'MACHINERY'",
}
_ROW_SQL = """
select *, concat_ws('; ', case when not (c_acctbal >= 0) then 'non_negative_balance' end,
                          case when not (c_mktsegment <> 'MACHINERY') then 'known_segment' end) as reason
from customer"""


@query("quarantine_ok", f"select * exclude (reason) from ({_ROW_SQL}) where reason = ''")
def quarantine_ok(spark: SparkSession, sf: str) -> DataFrame:
    return c.quarantine(table(spark, sf, "customer"), ROW_RULES, "customer")[0]


@query("quarantine_bad", f"""
select 'customer' as table_name, c_custkey, reason from ({_ROW_SQL}) where reason <> ''""")
def quarantine_bad(spark: SparkSession, sf: str) -> DataFrame:
    bad = c.quarantine(table(spark, sf, "customer"), ROW_RULES, "customer")[1]
    key = F.get_json_object("raw_row", "$.c_custkey").cast("bigint").alias("c_custkey")
    return bad.select("table_name", key, "reason")

"""Transformations, joins, dedup and incremental reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import transforms as tr
from ..operators.keys import spread_key
from ..plans.registry import Registry
from ..sources import files
from .base import query, table


@query("select_rename_cast", """
select cast(o_orderkey as varchar) as order_id, cast(o_totalprice as decimal(18,2)) as price,
       o_orderstatus as status, cast(o_orderdate as date) as ordered,
       try_cast(o_orderpriority as integer) as priority
from orders""")
def select_rename_cast(spark: SparkSession, sf: str) -> DataFrame:
    names = ["o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate", "o_orderpriority"]
    df = tr.select_columns(table(spark, sf, "orders"), names)
    df = tr.rename_columns(
        df,
        {
            "o_orderkey": "order_id", "o_totalprice": "price", "o_orderstatus": "status",
            "o_orderdate": "ordered", "o_orderpriority": "priority", "no_such_column": "x",
        },
    )
    return tr.cast_columns(
        df, {"order_id": "string", "price": "decimal(18,2)", "ordered": "date", "priority": "int"}
    )


@query("calc_filter", """
select l_orderkey, l_linenumber, l_quantity,
       cast(cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2))) as decimal(20,4)) as net_price
from lineitem where l_quantity >= 10 and l_returnflag = 'R'""")
def calc_filter(spark: SparkSession, sf: str) -> DataFrame:
    df = tr.filter_by_condition(table(spark, sf, "lineitem"), "l_quantity >= 10 AND l_returnflag = 'R'")
    net = "cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))"
    df = tr.add_calculated_column(df, "net_price", f"cast({net} as decimal(20,4))")
    return df.select("l_orderkey", "l_linenumber", "l_quantity", "net_price")


_GAPS_SQL = """(select o_orderkey, nullif(o_orderstatus, 'O') as status,
  case when o_orderpriority <> '1-URGENT' then o_custkey end as custkey from orders)"""


def _with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("O")).alias("status"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey")).alias("custkey"),
    )


@query("clean_nulls_drop", f"select * from {_GAPS_SQL} where status is not null and custkey is not null")
def clean_nulls_drop(spark: SparkSession, sf: str) -> DataFrame:
    return tr.clean_nulls(_with_gaps(spark, sf))


@query("clean_nulls_drop_subset", f"select * from {_GAPS_SQL} where custkey is not null")
def clean_nulls_drop_subset(spark: SparkSession, sf: str) -> DataFrame:
    return tr.clean_nulls(_with_gaps(spark, sf), ["custkey"])


@query("clean_nulls_zero", f"select o_orderkey, status, coalesce(custkey, 0) as custkey from {_GAPS_SQL}")
def clean_nulls_zero(spark: SparkSession, sf: str) -> DataFrame:
    return tr.clean_nulls(_with_gaps(spark, sf), strategy="fill_zero")


@query("clean_nulls_empty", f"select o_orderkey, coalesce(status, '') as status, custkey from {_GAPS_SQL}")
def clean_nulls_empty(spark: SparkSession, sf: str) -> DataFrame:
    return tr.clean_nulls(_with_gaps(spark, sf), strategy="fill_empty")


@query("dates", "select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts from events")
def dates(spark: SparkSession, sf: str) -> DataFrame:
    return tr.standardize_dates(table(spark, sf, "events").select("event_id", "ts"), "ts")


@query("dates_format", "select o_orderkey, strftime(o_orderdate, '%d/%m/%Y') as o_orderdate from orders")
def dates_format(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return tr.standardize_dates(df, "o_orderdate", "dd/MM/yyyy")


@query("surrogate_key", """
select *, row_number() over (order by c_acctbal, c_custkey) + 99 as row_id from customer""")
def surrogate_key(spark: SparkSession, sf: str) -> DataFrame:
    return tr.add_surrogate_key(table(spark, sf, "customer"), "row_id", 100, ["c_acctbal", "c_custkey"])


@query("surrogate_key_fast", "select count(*) as rows, count(*) as ids, true as from_start from lineitem")
def surrogate_key_fast(spark: SparkSession, sf: str) -> DataFrame:
    """The gapped keys differ from run to run; what must hold is that they are unique."""
    keyed = spread_key(table(spark, sf, "lineitem").select("l_orderkey"), "row_id", 5)
    per_id = keyed.groupBy("row_id").agg(F.count("*").alias("n"))
    return per_id.agg(
        F.sum("n").alias("rows"), F.count("*").alias("ids"), (F.min("row_id") >= 5).alias("from_start")
    )


# --- lookups: the lookup keys are shifted, so both sides have unmatched keys -----

_LOOKUP_SQL = "(select c_custkey + 200 as custkey, c_name, c_mktsegment from customer)"
_FACTS_SQL = "(select o_custkey as custkey, o_orderkey, o_totalprice from orders)"


def _lookup(spark: SparkSession, sf: str, how: str) -> DataFrame:
    facts = table(spark, sf, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderkey", "o_totalprice")
    names = table(spark, sf, "customer").select(
        (F.col("c_custkey") + 200).alias("custkey"), "c_name", "c_mktsegment"
    )
    return tr.enrich_with_lookup(facts, names, "custkey", how)


def _register_lookups() -> None:
    for how, join in (("inner", "join"), ("left", "left join"), ("right", "right join"), ("full", "full join")):
        sql = (
            f"select custkey, o_orderkey, o_totalprice, c_name, c_mktsegment "
            f"from {_FACTS_SQL} f {join} {_LOOKUP_SQL} l using (custkey)"
        )
        query(f"lookup_{how}", sql)(lambda spark, sf, how=how: _lookup(spark, sf, how))
    for how, word in (("left_semi", "in"), ("left_anti", "not in")):
        sql = f"select * from {_FACTS_SQL} where custkey {word} (select custkey from {_LOOKUP_SQL})"
        query(f"lookup_{how.split('_')[1]}", sql)(lambda spark, sf, how=how: _lookup(spark, sf, how))


_register_lookups()


@query("aggregate_metrics", """
select o_orderstatus, o_orderpriority, cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(28,2)) as price_sum,
       count(o_custkey) as o_custkey_count, min(o_orderkey) as o_orderkey_min, max(o_orderdate) as o_orderdate_max
from orders group by o_orderstatus, o_orderpriority""")
def aggregate_metrics(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").withColumn("price", F.col("o_totalprice").cast("decimal(18,2)"))
    return tr.aggregate_metrics(
        df,
        ["o_orderstatus", "o_orderpriority"],
        {"price": "sum", "o_custkey": "count", "o_orderkey": "min", "o_orderdate": "max"},
    )


# --- dedup ------------------------------------------------------------------------

_LINE_REST = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
_LINE_DESC = ", ".join(f"{c.strip()} desc" for c in _LINE_REST.split(","))


def _dedup_sql(order: str) -> str:
    return (
        "select * exclude (rn) from (select *, row_number() over "
        f"(partition by l_orderkey, l_linenumber order by {order}) as rn from lineitem) where rn = 1"
    )


@query("dedup_first", _dedup_sql(_LINE_REST))
def dedup_first(spark: SparkSession, sf: str) -> DataFrame:
    return tr.deduplicate(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "first")


@query("dedup_last", _dedup_sql(_LINE_DESC))
def dedup_last(spark: SparkSession, sf: str) -> DataFrame:
    return tr.deduplicate(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "last")


@query("dedup_latest", f"""
with keyed as (select * replace (case when l_returnflag <> 'N' or l_quantity > 5 then l_orderkey end as l_orderkey)
               from lineitem),
ranked as (select *, row_number() over (partition by l_orderkey, l_linenumber
             order by l_shipdate desc, {_LINE_DESC}) as rn from keyed where l_orderkey is not null)
select * exclude (rn) from ranked where rn = 1
union all select * from keyed where l_orderkey is null""")
def dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Last arrival by ship date; rows without a key are all kept."""
    lines = table(spark, sf, "lineitem")
    keep = (F.col("l_returnflag") != "N") | (F.col("l_quantity") > 5)
    keyed = lines.withColumn("l_orderkey", F.when(keep, F.col("l_orderkey"))).select(*lines.columns)
    return tr.latest_by_key(keyed, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


# --- incremental --------------------------------------------------------------------

@query("incremental", "select * from events where ts > timestamp '2024-01-15 00:00:00'")
def incremental(spark: SparkSession, sf: str) -> DataFrame:
    last = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return files.newer_than(table(spark, sf, "events"), "ts", last)


@query("latest_value", "select * from orders where o_orderdate = (select max(o_orderdate) from orders)")
def latest_value(spark: SparkSession, sf: str) -> DataFrame:
    return files.latest_by_column(table(spark, sf, "orders"), "o_orderdate")


@query("registry_compose", """
select o_orderkey, o_orderstatus as status, cast(o_totalprice as decimal(18,2)) as price
from orders where o_totalprice > 100000""")
def registry_compose(spark: SparkSession, sf: str) -> DataFrame:
    steps = Registry()
    steps.register("large", lambda df: tr.filter_by_condition(df, "o_totalprice > 100000"))
    steps.register("names", lambda df: tr.rename_columns(df, {"o_orderstatus": "status", "o_totalprice": "price"}))
    steps.register("types", lambda df: tr.cast_columns(df, {"price": "decimal(18,2)"}), version="1.1")
    steps.register("shape", lambda df: tr.select_columns(df, ["o_orderkey", "status", "price"]))
    return table(spark, sf, "orders").transform(steps.compose("large", "names", "types", "shape"))


@query("distinct_pairs", "select distinct o_custkey, o_orderstatus from orders")
def distinct_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_custkey", "o_orderstatus").distinct()

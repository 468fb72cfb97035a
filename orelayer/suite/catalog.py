"""Catalog queries: parts as datasets, lineitems as lineage edges and tags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import catalog as cat
from ..session import Workspace
from .base import query, table

DATASETS_SQL = """
select p_partkey as dataset_id, p_name as dataset_name,
       case when p_size <= 15 then 'bronze' when p_size <= 35 then 'silver' else 'gold' end as layer,
       p_type as description, p_brand as owner,
       timestamp '2024-01-01' + to_hours(p_size) as updated_at, p_brand || ',' || p_type as tags
from part"""
SCHEMAS_SQL = """
select p_partkey as dataset_id, '1.' || p_size as schema_version, p_size > 25 as is_current,
       p_brand as schema_definition from part"""
LINEAGE_SQL = """
select l_partkey as dataset_id, case when l_tax > 0.01 then l_suppkey end as source_dataset_id,
       l_returnflag as transformation_name, l_linestatus as transformation_type from lineitem"""
TAGS_SQL = """
select l_partkey as dataset_id,
       case when l_quantity > 45 then 'pii' when l_quantity > 30 then 'sensitive' else 'compliance' end as tag_type from lineitem"""


def datasets(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("dataset_id"),
        F.col("p_name").alias("dataset_name"),
        F.when(size <= 15, "bronze").when(size <= 35, "silver").otherwise("gold").alias("layer"),
        F.col("p_type").alias("description"),
        F.col("p_brand").alias("owner"),
        (start + F.make_dt_interval(hours=size)).alias("updated_at"),
        F.array("p_brand", "p_type").alias("tags"),
    )


def schemas(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("dataset_id"),
        F.concat(F.lit("1."), F.col("p_size").cast("string")).alias("schema_version"),
        F.col("p_brand").alias("schema_definition"),
        (F.col("p_size") > 25).alias("is_current"),
    )


def lineage(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("dataset_id"),
        F.when(F.col("l_tax") > 0.01, F.col("l_suppkey")).alias("source_dataset_id"),
        F.col("l_returnflag").alias("transformation_name"),
        F.col("l_linestatus").alias("transformation_type"),
    )


def tags(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("l_quantity")
    kind = F.when(n > 45, "pii").when(n > 30, "sensitive").otherwise("compliance")
    return table(spark, sf, "lineitem").select(F.col("l_partkey").alias("dataset_id"), kind.alias("tag_type"))


def _flat(df: DataFrame) -> DataFrame:
    return df.withColumn("tags", F.array_join("tags", ","))


@query("catalog_list", f"""
with f as (select * from ({DATASETS_SQL}) where layer = 'silver' and (owner = 'Brand#7' or description = 'ECONOMY'))
select *, (select count(*) from f) as total from f order by updated_at desc, dataset_id limit 20 offset 40""")
def catalog_list(spark: SparkSession, sf: str) -> DataFrame:
    page = cat.list_datasets(datasets(spark, sf), layer="silver", tags=["Brand#7", "ECONOMY"], page=3, page_size=20)
    return _flat(page)


@query("catalog_owner", f"select * from ({DATASETS_SQL}) where owner = 'Brand#7'")
def catalog_owner(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(cat.filter_datasets(datasets(spark, sf), owner="Brand#7"))


_MATCHES_SQL = f"""
select *, case when dataset_name ilike '%ec%' then 1.0::double when description ilike '%ec%' then 0.8::double
          else 0.5::double end as relevance_score
from ({DATASETS_SQL}) where dataset_name ilike '%ec%' or description ilike '%ec%' or tags ilike '%ec%'"""


@query("catalog_search_all", _MATCHES_SQL)
def catalog_search_all(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(cat.search_matches(datasets(spark, sf), "EC"))


@query("catalog_search", f"{_MATCHES_SQL} order by relevance_score desc, updated_at desc, dataset_id limit 20")
def catalog_search(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(cat.search(datasets(spark, sf), "EC"))


@query("lineage_neighbours", f"""
with d as ({DATASETS_SQL}), l as ({LINEAGE_SQL})
select l.dataset_id as of_dataset_id, d.dataset_id, 'upstream' as direction, l.transformation_name, l.transformation_type,
       d.dataset_name, d.layer from l join d on l.source_dataset_id = d.dataset_id
union all
select l.source_dataset_id, d.dataset_id, 'downstream', l.transformation_name, l.transformation_type, d.dataset_name, d.layer
from l join d on l.dataset_id = d.dataset_id where l.source_dataset_id is not null""")
def lineage_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    names = datasets(spark, sf).select("dataset_id", "dataset_name", "layer")
    return cat.neighbours(names, lineage(spark, sf))


@query("lineage_counts", f"""
with d as ({DATASETS_SQL}), l as ({LINEAGE_SQL})
select d.*, (select count(distinct source_dataset_id) from l where l.dataset_id = d.dataset_id) as upstream_count,
       (select count(distinct l.dataset_id) from l where l.source_dataset_id = d.dataset_id) as downstream_count from d""")
def lineage_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(cat.with_lineage_counts(datasets(spark, sf), lineage(spark, sf)))


@query("current_schema", f"""
select d.*, s.schema_version, s.schema_definition from ({DATASETS_SQL}) d
left join ({SCHEMAS_SQL}) s on d.dataset_id = s.dataset_id and s.is_current""")
def current_schema(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(cat.with_current_schema(datasets(spark, sf), schemas(spark, sf)))


@query("pii", f"""
select distinct d.* from ({DATASETS_SQL}) d join ({TAGS_SQL}) t on d.dataset_id = t.dataset_id where t.tag_type = 'pii'""")
def pii(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(cat.tagged_datasets(datasets(spark, sf), tags(spark, sf)))


@query("quality_summary", """
select 'profiling' as metric_type, s_name as entity_name, timestamp '2024-01-01' as metric_timestamp,
       s_acctbal as score, cast(s_nationkey as double) as null_percentage, cast(1 as double) as duplicate_percentage from supplier
union all
select 'validation', o_orderpriority, o_orderdate,
       round(case when o_orderstatus = 'P' then null else length(o_orderpriority) / 15 * 100 end, 2), null, null from orders""")
def quality_summary(spark: SparkSession, sf: str) -> DataFrame:
    profiles = table(spark, sf, "supplier").select(
        F.col("s_name").alias("source_name"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("profile_timestamp"),
        F.col("s_acctbal").alias("quality_score"),
        F.col("s_nationkey").alias("null_percentage"),
        F.lit(1).alias("duplicate_percentage"),
    )
    runs = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("pipeline_name"),
        F.col("o_orderdate").alias("validation_timestamp"),
        F.when(F.col("o_orderstatus") == "P", 0).otherwise(15).alias("rules_executed"),
        F.length("o_orderpriority").alias("rules_passed"),
    )
    return cat.quality_summary(profiles, runs)


# --- the metadata store -----------------------------------------------------------------------

_REGISTERED = {"customer": "bronze", "orders": "silver", "lineitem": "silver", "events": "bronze", "documents": "gold"}


def _registered(spark: SparkSession, sf: str) -> cat.Catalog:
    """The tables as datasets: lineitem comes from orders, orders from customer and events; orders
    gets a second schema, and every table with a text column is tagged."""
    store = cat.Catalog(spark, Workspace(spark, "catalog").root)
    sources = {"orders": ["customer", "events"], "lineitem": ["orders"]}
    for name in ("customer", "events", "orders", "lineitem", "documents"):
        df = table(spark, sf, name)
        number = store.register(name, _REGISTERED[name], f"/{name}", df=df, sources=sources.get(name, ()), row_count=df.count(), owner="o" + name[0], tags=[name[:2]])
        if name == "orders":
            store.add_schema(number, df.select("o_orderkey"), "2.0")
        if "string" in dict(df.dtypes).values():
            store.add_tag(number, "pii", column="text", confidence=0.75)
    return store


_REGISTERED_SQL = " union all ".join(
    f"""select {i} as dataset_id, '{n}' as dataset_name, '{_REGISTERED[n]}' as layer, count(*) as row_count, '{v}' as schema_version,
        cast({k} as integer) as fields, cast({up} as bigint) as upstream_count, cast({down} as bigint) as downstream_count from {n}"""
    for i, n, v, k, up, down in ((1, "customer", "1.0", 5, 0, 1), (2, "events", "1.0", 6, 0, 1), (3, "orders", "2.0", 1, 2, 1), (4, "lineitem", "1.0", 11, 1, 0), (5, "documents", "1.0", 5, 0, 0)))


@query("catalog_register", _REGISTERED_SQL)
def catalog_register(spark: SparkSession, sf: str) -> DataFrame:
    """Registered datasets with their current schema and lineage; one has had two schemas."""
    store = _registered(spark, sf)
    found = cat.with_current_schema(store.table("datasets"), store.table("dataset_schemas"))
    found = cat.with_lineage_counts(found, store.table("dataset_lineage"))
    fields = F.size(F.from_json("schema_definition", "fields array<struct<name:string>>")["fields"])
    return found.select("dataset_id", "dataset_name", "layer", "row_count", "schema_version", fields.alias("fields"), "upstream_count", "downstream_count")


@query("catalog_governance", """
select 1 as dataset_id, 'customer' as dataset_name, 'pii' as tag_type, cast(0.75 as double) as confidence, count(*) as row_count from customer
union all select 3, 'orders', 'pii', 0.75, count(*) from orders""")
def catalog_governance(spark: SparkSession, sf: str) -> DataFrame:
    """Single datasets by id, each with its governance tags."""
    store = _registered(spark, sf)
    tags = lambda i: cat.governance_of(store.table("governance_tags"), i).select("dataset_id", "tag_type", F.col("confidence").cast("double").alias("confidence"))
    one = [cat.get_dataset(store.table("datasets"), i).select("dataset_id", "dataset_name", "row_count").join(tags(i), "dataset_id") for i in (1, 3)]
    return one[0].unionByName(one[1])

"""Index inputs derived from the given tables, in Spark and in SQL.

The given tables hold no registry, no notifications and no feature files. Every
SQL text here is a list of common table expressions that mirrors the function of
the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entidex.sources.registry import Registry


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day_of(time: str):
    return F.col(time).cast("date").cast("timestamp_ntz")


def user_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index of `user_id`: each event type is a feature table with one file per day."""
    day = F.col("ts").cast("date").cast("string")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"),
        F.col("event_type").alias("feature_table"),
        F.col("ts").alias("event_timestamp"),
        day_of("ts").alias("created_timestamp"),
        F.concat(F.lit("lake/"), "event_type", F.lit("/"), day, F.lit(".parquet")).alias("path"),
    )


USER_INDEX = """user_index as (
    select user_id as id, event_type as feature_table, ts as event_timestamp,
           cast(cast(ts as date) as timestamp) as created_timestamp,
           concat('lake/', event_type, '/', cast(cast(ts as date) as varchar), '.parquet') as path
    from events)"""


def order_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index of `o_custkey`, with one feature table and one file."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"),
        F.lit("orders").alias("feature_table"),
        F.col("o_orderdate").alias("event_timestamp"),
        F.col("o_orderdate").alias("created_timestamp"),
        F.lit("lake/orders/0.parquet").alias("path"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their order's date."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate")
    return lines.join(orders, "l_orderkey")


def registry(spark: SparkSession, sf_dir: str) -> Registry:
    """Parts are sources and feature tables, suppliers are entities and projects.

    Holds every irregular case: deleted tables, archived projects, NULL flags,
    broken JSON, blank and equal time columns, a name that is too long, types that
    cannot be indexed, several entities of one name.
    """
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    lineitem = table(spark, sf_dir, "lineitem")
    home = lineitem.groupBy("l_partkey").agg(F.min("l_suppkey").alias("s_suppkey"))
    return Registry(
        data_sources=part.select(
            F.col("p_partkey").alias("id"),
            F.when(F.col("p_size") == 50, "{broken")
            .otherwise(F.concat(F.lit('{"file_url": "s3a://'), part_directory(), F.lit('/"}')))
            .alias("config"),
            F.lit("event_ts").alias("timestamp_column"),
            F.when(F.col("p_brand") == "Brand#7", F.lit(" "))
            .when(F.col("p_brand") == "Brand#8", F.lit(None))
            .when(F.col("p_brand") == "Brand#9", F.lit("event_ts"))
            .otherwise(F.lit("created_ts"))
            .alias("created_timestamp_column"),
        ),
        feature_tables=part.join(home, F.col("p_partkey") == F.col("l_partkey"))
        .join(supplier, "s_suppkey")
        .select(
            F.col("p_partkey").alias("id"),
            F.when(F.col("p_size") == 49, F.rpad(F.lower("p_type"), 256, "x"))
            .otherwise(F.concat(F.lower("p_type"), F.lit("_"), F.col("p_size").cast("string")))
            .alias("name"),
            F.col("p_partkey").alias("batch_source_id"),
            F.col("s_name").alias("project_name"),
            F.when(F.col("p_size") != 1, F.col("p_size") > 45).alias("is_deleted"),
        ),
        feature_tables_entities_v2=lineitem.select(
            F.col("l_partkey").alias("feature_table_id"), F.col("l_suppkey").alias("entity_v2_id")
        ).distinct(),
        entities_v2=supplier.select(
            F.col("s_suppkey").alias("id"),
            F.when(F.col("s_nationkey") == 5, F.lit("nation_5"))
            .otherwise(F.concat(F.lit("supplier_"), F.col("s_suppkey").cast("string")))
            .alias("name"),
            F.when(F.col("s_acctbal").between(0, 150), "STRING")
            .when(F.col("s_acctbal") < 3000, "BOOL")
            .when(F.col("s_acctbal") < 5000, "int64")
            .otherwise("INT64")
            .alias("type"),
        ),
        projects=supplier.select(
            F.col("s_name").alias("name"),
            F.when(F.col("s_nationkey") != 3, F.col("s_acctbal") < 0).alias("archived"),
        ),
    )


def part_directory():
    """Directory of a part's feature files, such as `lake/economy/red_widget/Brand#17`."""
    return F.concat(
        F.lit("lake/"), F.lower("p_type"), F.lit("/"), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("/"), "p_brand"
    )


_PART_DIRECTORY = "concat('lake/', lower(p_type), '/', replace(p_name, ' ', '_'), '/', p_brand)"

REGISTRY = f"""home as (select l_partkey, min(l_suppkey) as s_suppkey from lineitem group by l_partkey),
data_sources as (
    select p_partkey as id,
           case when p_size = 50 then '{{broken'
                else concat('{{"file_url": "s3a://', {_PART_DIRECTORY}, '/"}}') end as config,
           'event_ts' as timestamp_column,
           case p_brand when 'Brand#7' then ' ' when 'Brand#8' then null when 'Brand#9' then 'event_ts'
                else 'created_ts' end as created_timestamp_column
    from part),
feature_tables as (
    select p_partkey as id,
           case when p_size = 49 then rpad(lower(p_type), 256, 'x')
                else concat(lower(p_type), '_', p_size) end as name,
           p_partkey as batch_source_id, s_name as project_name,
           case when p_size <> 1 then p_size > 45 end as is_deleted
    from part join home on p_partkey = l_partkey join supplier using (s_suppkey)),
feature_tables_entities_v2 as (
    select distinct l_partkey as feature_table_id, l_suppkey as entity_v2_id from lineitem),
entities_v2 as (
    select s_suppkey as id, case when s_nationkey = 5 then 'nation_5' else concat('supplier_', s_suppkey) end as name,
           case when s_acctbal between 0 and 150 then 'STRING' when s_acctbal < 3000 then 'BOOL'
                when s_acctbal < 5000 then 'int64' else 'INT64' end as type
    from supplier),
projects as (
    select s_name as name, case when s_nationkey <> 3 then s_acctbal < 0 end as archived from supplier),
sources as (
    select distinct case when json_valid(ds.config) then json_extract_string(ds.config, '$.file_url') end as file_url,
           en.name as entity_name, en.type as entity_type, ft.name as feature_table,
           ds.timestamp_column, ds.created_timestamp_column
    from data_sources ds
    join feature_tables ft on ds.id = ft.batch_source_id
    join feature_tables_entities_v2 fte on ft.id = fte.feature_table_id
    join entities_v2 en on fte.entity_v2_id = en.id
    join projects pr on ft.project_name = pr.name
    where ft.is_deleted = false and pr.archived = false)"""


def lookalike_directory(number):
    """Directories that differ in a few digits amid long names, such as a team's number."""
    team = F.lpad(number.cast("string"), 7, "0")
    return F.concat(F.lit("lake/warehouse/features/online-serving-team-"), team, F.lit("/daily-aggregated-feature-tables/v1"))


LOOKALIKE = "'lake/warehouse/features/online-serving-team-' || lpad({}::varchar, 7, '0') || '/daily-aggregated-feature-tables/v1'"


def part_notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One notification per event, for a file in the directory of the part numbered like the user.

    Columns: event_name, key, received_at, seq. Users without such a part point to
    a directory that no source knows.
    """
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("user_id"), part_directory().alias("directory"))
    file = F.concat(F.lit("/"), F.col("event_id").cast("string"), F.lit(".parquet"))
    return (
        table(spark, sf_dir, "events")
        .join(parts, "user_id", "left")
        .select(
            F.when(F.col("event_type") == "error", "s3:ObjectRemoved:Delete")
            .otherwise("s3:ObjectCreated:Put")
            .alias("event_name"),
            F.concat(
                F.when(F.col("event_type") == "signup", F.lit("lake/new"))
                .when(F.col("event_type") == "view", F.regexp_replace("directory", "/[^/]*$", ""))
                .otherwise(F.coalesce("directory", F.lit("lake/none"))),
                file,
            ).alias("key"),
            F.col("ts").alias("received_at"),
            F.col("event_id").alias("seq"),
        )
    )


PART_NOTIFICATIONS = f"""notifications as (
    select case when event_type = 'error' then 's3:ObjectRemoved:Delete' else 's3:ObjectCreated:Put' end as event_name,
           case when event_type = 'signup' then 'lake/new'
                when event_type = 'view' then regexp_replace({_PART_DIRECTORY}, '/[^/]*$', '')
                when p_partkey is null then 'lake/none'
                else {_PART_DIRECTORY} end || '/' || event_id || '.parquet' as key,
           ts as received_at, event_id as seq
    from events left join part on p_partkey = user_id),
parents as (
    select distinct regexp_replace(key, '/[^/]*$', '') as parent from notifications where key is not null)"""

ROUTES = """candidates as (
    select parent, feature_table, timestamp_column, created_timestamp_column,
           string_agg(entity_name || ':' || entity_type, ',' order by entity_name, entity_type) as entities,
           string_agg(entity_name, ',' order by entity_name, entity_type) as entity_names,
           count(*) as n_entities, count(distinct entity_name) as n_names,
           min(case when upper(entity_type) not in ('INT64', 'BOOL') then entity_name || ':' || entity_type end)
               as unsupported
    from (select distinct parent, s.entity_name, s.entity_type, s.feature_table, s.timestamp_column,
                 s.created_timestamp_column
          from parents join sources s on s.file_url like concat('%', parent, '%') escape '\\')
    group by all),
routes as (
    select * exclude (rk) from (
        select *, count(*) over (partition by parent) as n_candidates,
               row_number() over (partition by parent order by feature_table nulls first,
                   timestamp_column nulls first, created_timestamp_column nulls first) as rk
        from candidates)
    where rk = 1)"""

ROUTE_PROBLEM = """case when entities is null then 'no route'
         when unsupported is not null then 'unsupported entity type: ' || split_part(unsupported, ':', 2)
         when length(feature_table) > 255 then 'feature table name too long'
         when trim(coalesce(timestamp_column, '')) = '' or trim(coalesce(created_timestamp_column, '')) = ''
             then 'time column not named'
         when n_names < n_entities or timestamp_column = created_timestamp_column then 'column named twice' end"""

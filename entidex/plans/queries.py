"""Every operator as a query over the given tables, with the same query in SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta
from itertools import count
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entidex.functions import keys, values
from entidex.id_files import IdFiles
from entidex.id_sets import IdSets
from entidex.operators import checks, jobs, lookups
from entidex.operators.extract import entity_rows, union_all
from entidex.operators.latest import latest, latest_by_window, newest_event_per_load
from entidex.operators.routes import LocationPostings, matching_locations, routes_for_parents, routes_of
from entidex.plans import inputs
from entidex.plans.streamed import clocked_index, irregular_index, late_index, malformed_index, removals_index, shared_files, state_index, streamed_index
from entidex.schemas import ROW_KEY
from entidex.sources import notifications
from entidex.sources.feature_files import read_features
from entidex.sources.registry import TABLES, located_sources, read_registry, registered_sources
from entidex.storage import scratch_root
from entidex.store import EntityIndex
from entidex.streaming.ingest import profile_of, stored_keys_near

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

SPAN = ("2024-01-08 00:00:00", "2024-01-14 23:59:59.999999")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


# The latest view

_LATEST = f"""with {inputs.USER_INDEX},
loads as (
    select id, feature_table, max(event_timestamp) as event_timestamp, created_timestamp, path
    from user_index group by id, feature_table, created_timestamp, path),
ranked as (
    select *, row_number() over (partition by id order by created_timestamp desc nulls first,
        path desc nulls first, feature_table desc nulls first) as rk
    from loads)
select id, feature_table, event_timestamp, created_timestamp, path, rk from ranked where rk = 1"""


@query(_LATEST)
def latest_entity(spark, sf_dir):
    return latest_by_window(inputs.user_index(spark, sf_dir))


@query(_LATEST)
def latest_by_max_struct(spark, sf_dir):
    return latest(inputs.user_index(spark, sf_dir))


@query(
    f"""with {inputs.USER_INDEX}
select id, feature_table, created_timestamp, path, max(event_timestamp) as event_timestamp
from user_index group by id, feature_table, created_timestamp, path"""
)
def newest_event_per_load_rows(spark, sf_dir):
    return newest_event_per_load(inputs.user_index(spark, sf_dir))


# Lookups


@query(f"with {inputs.USER_INDEX} select distinct id from user_index")
def entity_ids(spark, sf_dir):
    return lookups.entity_ids(inputs.user_index(spark, sf_dir))


def _id_sets(spark, sf_dir):
    """Sets of the ids of two batches, which share most of them, and of their negatives far apart."""
    rows = inputs.user_index(spark, sf_dir)
    apart = rows.withColumn("id", F.col("id") * -100_003)
    index, half = EntityIndex(spark, scratch_root(spark)), F.lit("2024-01-16").cast("timestamp_ntz")
    index.define({"user": "bigint"}, 0)
    for batch, part in enumerate((rows.filter(F.col("event_timestamp") < half), rows.filter(F.col("event_timestamp") >= half).unionByName(apart))):
        index.append_entity("user", part, batch)
        IdSets(index, "user").keep(batch)
    return IdSets(index, "user")


@query(f"with {inputs.USER_INDEX} select id from user_index union select id * -100003 as id from user_index")
def entity_ids_from_sets(spark, sf_dir):
    """All ids from the sets that each batch keeps of them."""
    return _id_sets(spark, sf_dir).ids()


@query(
    f"""with {inputs.USER_INDEX}
select feature_table, count(distinct id) as n_ids
from (select feature_table, id from user_index union all select feature_table, id * -100003 from user_index) group by feature_table"""
)
def n_ids_from_sets(spark, sf_dir):
    """Number of ids per feature table from the same sets."""
    return _id_sets(spark, sf_dir).counts()


@query(
    f"""with {inputs.USER_INDEX} select * from user_index
where event_timestamp between timestamp '{SPAN[0]}' and timestamp '{SPAN[1]}'"""
)
def ids_in_span(spark, sf_dir):
    return lookups.in_span(inputs.user_index(spark, sf_dir), *SPAN)


@query(f"{_LATEST} and event_timestamp between timestamp '2024-01-30 12:00:00' and timestamp '2024-01-30 18:00:00'")
def latest_in_span(spark, sf_dir):
    span = ("2024-01-30 12:00:00", "2024-01-30 18:00:00")
    return lookups.latest_in_span(inputs.user_index(spark, sf_dir), *span)


_BUYERS = """buyers as (select distinct user_id as id from events where event_type = 'purchase' and value > 150)"""


def _buyers(spark, sf_dir):
    events = inputs.table(spark, sf_dir, "events")
    bought = events.filter((F.col("event_type") == "purchase") & (F.col("value") > 150))
    return bought.select(F.col("user_id").alias("id")).distinct()


@query(f"with {inputs.USER_INDEX}, {_BUYERS} select distinct path from user_index where id in (select id from buyers)")
def paths_for_ids(spark, sf_dir):
    return lookups.paths_for_ids(inputs.user_index(spark, sf_dir), _buyers(spark, sf_dir))


@query(SQL["paths_for_ids"])
def paths_for_few_ids(spark, sf_dir):
    """The same from a stored index that knows the id bounds of its files, of two batches."""
    rows, half = inputs.user_index(spark, sf_dir), F.lit("2024-01-16").cast("timestamp_ntz")
    index = EntityIndex(spark, scratch_root(spark), file_rows=1_000)
    index.define({"user": "bigint"}, 0)
    for batch, part in enumerate((F.col("event_timestamp") < half, F.col("event_timestamp") >= half)):
        index.append_entity("user", rows.filter(part), batch)
        IdFiles(index, "user").describe(batch)
    return index.paths_for_ids("user", _buyers(spark, sf_dir))


@query(
    """with wanted as (
    select distinct o_custkey as id, o_orderdate as event_timestamp
    from orders join customer on o_custkey = c_custkey
    where c_mktsegment = 'BUILDING' and o_orderdate between timestamp '1996-01-01' and timestamp '1996-12-31')
select o_orderkey, o_custkey, o_orderdate, o_orderstatus, o_totalprice, 'lake/orders/0.parquet' as path,
       'orders' as feature_table
from orders join wanted on o_custkey = id and o_orderdate = event_timestamp"""
)
def features_for_ids(spark, sf_dir):
    customers = inputs.table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    index = inputs.order_index(spark, sf_dir)
    rows = lookups.rows_for_ids(
        lookups.in_span(index, "1996-01-01", "1996-12-31"), customers.select(F.col("c_custkey").alias("id"))
    )
    features = inputs.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice", F.lit("lake/orders/0.parquet").alias("path")
    )
    return lookups.features_for_rows(rows, features, "o_custkey", "o_orderdate", "o_orderdate")


@query(
    """with shared as (
    select user_id as id, date_trunc('second', ts) as event_timestamp, date_trunc('day', ts) as created_timestamp,
           value * factor as value, feature_table
    from events, (values ('int96', 1), ('micros', 2), ('millis', 3)) as t(feature_table, factor)),
loads as (
    select id, feature_table, created_timestamp, max(event_timestamp) as event_timestamp from shared group by all),
newest as (
    select * from loads qualify row_number() over (partition by id order by created_timestamp desc, feature_table desc) = 1)
select 'latest' as kind, id as user, value, event_timestamp as event_ts, created_timestamp as created_ts, feature_table
from shared join newest using (id, feature_table, event_timestamp, created_timestamp)
union all
select 'span', id, value, event_timestamp, created_timestamp, feature_table from shared
where feature_table <> 'int96' and event_timestamp between timestamp '2024-01-08' and timestamp '2024-01-09'"""
)
def features_by_path(spark, sf_dir):
    """Feature rows read from files of several feature tables that share ids and times.

    The files hold their times in three ways. Once for the latest rows, once for a span of
    two of the tables.
    """
    root, index = shared_files(spark, sf_dir)
    span = lookups.in_span(index.filter("feature_table != 'int96'"), "2024-01-08", "2024-01-09")
    parts = []
    for kind, rows in {"latest": latest(index), "span": span}.items():
        features = read_features(rows.select("path"), root, ["user", "value"], "event_ts", "created_ts")
        found = lookups.features_for_rows(rows, features, "user", "event_ts", "created_ts")
        parts.append(found.drop("path").withColumn("kind", F.lit(kind)))
    return union_all(parts)


_REMOVED = """removed as (
    select concat('lake/', event_type, '/', cast(cast(ts as date) as varchar), '.parquet') as key
    from events where value > 400)"""


@query(
    f"""with {inputs.USER_INDEX}, {_REMOVED}
select * from user_index where path not in (select key from removed)"""
)
def index_without_removed(spark, sf_dir):
    values_over = inputs.table(spark, sf_dir, "events").filter(F.col("value") > 400)
    day = F.col("ts").cast("date").cast("string")
    removed = values_over.select(
        F.concat(F.lit("lake/"), "event_type", F.lit("/"), day, F.lit(".parquet")).alias("key")
    ).distinct()
    return lookups.without_removed(inputs.user_index(spark, sf_dir), removed)


@query(
    f"""with {inputs.USER_INDEX} select * from user_index
where event_timestamp between timestamp '{SPAN[0]}' and timestamp '{SPAN[1]}'"""
)
def stored_ids_in_span(spark, sf_dir):
    """Writes the index and reads a span of it back."""
    index = EntityIndex(spark, scratch_root(spark))
    index.define({"user": "bigint"}, 0)
    index.append_entity("user", inputs.user_index(spark, sf_dir), 0)
    return lookups.in_span(index.entity("user"), *SPAN).drop("event_month", "batch_id")


# Index rows


@query(
    """with lines as (
    select l_partkey, l_suppkey, l_returnflag, l_shipdate, o_orderdate
    from lineitem join orders on l_orderkey = o_orderkey),
entities as (
    select 'part' as entity, l_partkey as id, * from lines union all
    select 'supplier', l_suppkey, * from lines)
select distinct entity, id, l_returnflag as feature_table, l_shipdate as event_timestamp,
       o_orderdate as created_timestamp, concat('lake/line_', l_returnflag, '/0.parquet') as path
from entities"""
)
def index_rows_multi_entity(spark, sf_dir):
    rows = entity_rows(
        inputs.order_lines(spark, sf_dir),
        {"part": F.col("l_partkey"), "supplier": F.col("l_suppkey")},
        F.col("l_shipdate"),
        F.col("o_orderdate"),
        F.col("l_returnflag").alias("feature_table"),
        F.concat(F.lit("lake/line_"), "l_returnflag", F.lit("/0.parquet")).alias("path"),
    )
    return rows.distinct()


@query(
    """select 'toxic' as entity, toxic = 1 as id,
       cast(to_timestamp(1704067200 + doc_id) at time zone 'UTC' as timestamp) as event_timestamp,
       timestamp '2024-01-01' as created_timestamp, 'labels' as feature_table, 'lake/labels/0.parquet' as path
from labels"""
)
def index_rows_bool_entity(spark, sf_dir):
    labels = inputs.table(spark, sf_dir, "labels")
    first = 1_704_067_200  # 2024-01-01 in epoch seconds
    return entity_rows(
        labels,
        {"toxic": F.col("toxic") == 1},
        values.from_epoch_micros((F.col("doc_id") + first) * 1_000_000),
        values.from_epoch_micros(F.lit(first * 1_000_000)),
        F.lit("labels").alias("feature_table"),
        F.lit("lake/labels/0.parquet").alias("path"),
    )


@query(
    """select event_id, epoch_us(ts) as micros, make_timestamp(epoch_us(ts)) as event_timestamp,
       make_timestamp(-epoch_us(ts)) as before_epoch
from events"""
)
def epoch_micros(spark, sf_dir):
    micros = values.to_epoch_micros(F.col("ts"))
    return inputs.table(spark, sf_dir, "events").select(
        "event_id",
        micros.alias("micros"),
        values.from_epoch_micros(micros).alias("event_timestamp"),
        values.from_epoch_micros(-micros).alias("before_epoch"),
    )


@query(
    """select event_id, json_extract_string(props, '$.k') as k, json_extract_string(props, '$.none') as missing,
       cast(null as varchar) as broken
from events"""
)
def json_field(spark, sf_dir):
    return inputs.table(spark, sf_dir, "events").select(
        "event_id",
        values.json_field(F.col("props"), "k").alias("k"),
        values.json_field(F.col("props"), "none").alias("missing"),
        values.json_field(F.col("event_type"), "k").alias("broken"),
    )


# Keys and notifications

_KEYS = """keyed as (
    select event_id,
           case when value < 10 then 's3:ObjectRemoved:Delete' when value > 100 then 's3:ObjectAccessed:Get'
                else 's3:ObjectCreated:Put' end as event_name,
           case event_type when 'click' then concat('lake//click/./', user_id, '/', event_id, '.parquet')
                when 'view' then concat('/lake/view/', event_id, '.parquet')
                when 'error' then concat('error-', event_id, '.parquet')
                when 'signup' then concat('./other/sign up/', user_id, '%20/', event_id, '.parquet')
                else concat('lake/../purchase/', event_id, '.csv/') end as key
    from events),
split as (
    select *, list_filter(string_split(key, '/'), lambda s: s not in ('', '.')) as s, key[1] = '/' as rooted from keyed)"""


def _keyed(spark, sf_dir):
    event, user = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    kind, value = F.col("event_type"), F.col("value")
    return inputs.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(value < 10, "s3:ObjectRemoved:Delete")
        .when(value > 100, "s3:ObjectAccessed:Get")
        .otherwise("s3:ObjectCreated:Put")
        .alias("event_name"),
        F.when(kind == "click", F.concat(F.lit("lake//click/./"), user, F.lit("/"), event, F.lit(".parquet")))
        .when(kind == "view", F.concat(F.lit("/lake/view/"), event, F.lit(".parquet")))
        .when(kind == "error", F.concat(F.lit("error-"), event, F.lit(".parquet")))
        .when(kind == "signup", F.concat(F.lit("./other/sign up/"), user, F.lit("%20/"), event, F.lit(".parquet")))
        .otherwise(F.concat(F.lit("lake/../purchase/"), event, F.lit(".csv/")))
        .alias("key"),
    )


@query(
    f"""with {_KEYS}
select event_id, key,
       (event_name like 's3:ObjectCreated:%' or event_name like 's3:ObjectRemoved:%') and key like '%.parquet'
           and not rooted and s[1] = 'lake' as is_subscribed,
       event_name like 's3:ObjectRemoved:%' as is_removal,
       case when rooted then '/' || array_to_string(s, '/') else array_to_string(s, '/') end as normalized,
       case when rooted then '/' else s[1] end as bucket,
       case when rooted then array_to_string(s, '/') when len(s) = 1 then '.'
            else array_to_string(s[2:], '/') end as object,
       case when rooted then '/' || array_to_string(s[:-2], '/') when len(s) = 1 then '.'
            else array_to_string(s[:-2], '/') end as parent
from split"""
)
def parse_keys(spark, sf_dir):
    key = F.col("key")
    return _keyed(spark, sf_dir).select(
        "event_id",
        "key",
        notifications.is_subscribed(F.col("event_name"), key, "lake").alias("is_subscribed"),
        notifications.is_removal(F.col("event_name")).alias("is_removal"),
        keys.normalized(key).alias("normalized"),
        keys.bucket_of(key).alias("bucket"),
        keys.object_of(key).alias("object"),
        keys.parent_of(key).alias("parent"),
    )


@query(
    f"""with {inputs.PART_NOTIFICATIONS}
select event_name, key, received_at,
       cast(7 * 4294967296 + row_number() over (order by received_at, key) as bigint) as seq
from notifications where key like '%.parquet' and event_name not like 's3:ObjectRemoved:%'"""
)
def arrival_order(spark, sf_dir):
    events = inputs.part_notifications(spark, sf_dir).drop("seq")
    return notifications.sequenced(
        notifications.created(notifications.subscribed(events)), 7, scratch_root(spark)
    )


# Registry


def _entities_as_text():
    return F.array_join(F.transform("entities", lambda e: F.concat(e["name"], F.lit(":"), e["type"])), ",")



@query(
    f"""with {inputs.REGISTRY}
select feature_table, timestamp_column, created_timestamp_column,
       string_agg(entity_name || ':' || entity_type, ',' order by entity_name, entity_type) as entities
from (select distinct entity_name, entity_type, feature_table, timestamp_column, created_timestamp_column
      from sources where file_url is not null)
group by feature_table, timestamp_column, created_timestamp_column"""
)
def registry_routes(spark, sf_dir):
    sources = registered_sources(inputs.registry(spark, sf_dir))
    return routes_of(sources, []).withColumn("entities", _entities_as_text())


@query(SQL["registry_routes"])
def registry_as_stored(spark, sf_dir):
    """The same from a registry that is written and read back as Parquet tables."""
    root, registry = scratch_root(spark), inputs.registry(spark, sf_dir)
    for name in TABLES:
        getattr(registry, name).write.parquet(f"{root}/{name}")
    return routes_of(registered_sources(read_registry(spark, root)), []).withColumn("entities", _entities_as_text())


@query(
    f"""with {inputs.REGISTRY}, {inputs.PART_NOTIFICATIONS}, {inputs.ROUTES}
select parent, feature_table, timestamp_column, created_timestamp_column, entities, n_candidates
from parents left join routes using (parent)"""
)
def route_for_parent(spark, sf_dir):
    events = notifications.created(inputs.part_notifications(spark, sf_dir).withColumn("event_name", F.lit("")))
    parents = events.select(keys.parent_of(F.col("key")).alias("parent")).distinct()
    routes = routes_for_parents(parents, inputs.registry(spark, sf_dir))
    return parents.join(routes, "parent", "left").withColumn("entities", _entities_as_text())


@query(SQL["route_for_parent"])
def route_after_registry_change(spark, sf_dir):
    """The same routes by stored postings: kept for an earlier registry, then brought up to this one.

    The earlier one lacks the sources of one brand and has those of another elsewhere.
    """
    registry = inputs.registry(spark, sf_dir)
    config = F.when(F.col("config").contains("Brand#3"), F.replace("config", F.lit("lake/"), F.lit("pond/"))).otherwise(F.col("config"))
    earlier = registry.data_sources.filter(~F.col("config").contains("Brand#2")).withColumn("config", config)
    postings = LocationPostings(spark, scratch_root(spark))
    postings.update(located_sources(replace(registry, data_sources=earlier)))
    events = notifications.created(inputs.part_notifications(spark, sf_dir).withColumn("event_name", F.lit("")))
    parents = events.select(keys.parent_of(F.col("key")).alias("parent")).distinct()
    routes = routes_for_parents(parents, registry, postings=postings)
    return parents.join(routes, "parent", "left").withColumn("entities", _entities_as_text())


@query(
    f"""with parents as (select distinct {inputs.LOOKALIKE.format("user_id")} as parent from events),
locations as (select 's3a://' || {inputs.LOOKALIKE.format("p_partkey")} || '/' as file_url from part)
select parent, file_url from parents join locations on file_url like '%' || parent || '%'"""
)
def route_for_lookalikes(spark, sf_dir):
    """Directories whose names differ in a few digits only: no more candidates than matches."""
    users = inputs.table(spark, sf_dir, "events").select(F.col("user_id")).distinct()
    parts = inputs.table(spark, sf_dir, "part")
    located = F.concat(F.lit("s3a://"), inputs.lookalike_directory(F.col("p_partkey")), F.lit("/"))
    return matching_locations(
        users.select(inputs.lookalike_directory(F.col("user_id")).alias("parent")), parts.select(located.alias("file_url"))
    )


@query(
    f"""with {inputs.REGISTRY}
select id, type, case upper(type) when 'INT64' then 'bigint' when 'BOOL' then 'boolean' end as id_type
from entities_v2"""
)
def type_check(spark, sf_dir):
    entities = inputs.registry(spark, sf_dir).entities_v2
    return entities.select("id", "type", values.id_type(F.col("type")).alias("id_type"))


def _outcomes(spark, sf_dir, entity_names):
    events = notifications.created(inputs.part_notifications(spark, sf_dir)).withColumn(
        "parent", keys.parent_of(F.col("key"))
    )
    route = ["feature_table", "timestamp_column", "created_timestamp_column"]
    # Found once per route: many files share one, and its entities may be many.
    routes = routes_for_parents(events, inputs.registry(spark, sf_dir)).select(
        "parent", "feature_table", checks.route_problem("entities", *route).alias("problem"), entity_names.alias("entity_names"), F.lit(True).alias("routed")
    )
    unrouted = F.when(F.col("routed").isNull(), checks.NO_ROUTE)
    return events.join(routes, "parent", "left").withColumn("problem", F.coalesce("problem", unrouted))


def _job_log(spark, sf_dir, entity_names):
    started = F.col("received_at")
    ended = values.from_epoch_micros(values.to_epoch_micros(started) + 1000 * F.length("key"))
    return jobs.job_rows(_outcomes(spark, sf_dir, entity_names), started, ended, F.col("entity_names"))


_JOBS = f"""{inputs.REGISTRY}, {inputs.PART_NOTIFICATIONS}, {inputs.ROUTES},
outcomes as (
    select *, {inputs.ROUTE_PROBLEM} as problem
    from (select *, regexp_replace(key, '/[^/]*$', '') as parent from notifications
          where key is not null and event_name not like 's3:ObjectRemoved:%')
    left join routes using (parent)),
jobs as (
    select seq as id, received_at as started, make_timestamp(epoch_us(received_at) + 1000 * length(key)) as ended,
           case when problem is null then 'success' else 'failed' end as status, problem as status_msg,
           entity_names, feature_table, key as path
    from outcomes)"""


@query(f"with {_JOBS} select * from jobs")
def job_log(spark, sf_dir):
    return _job_log(spark, sf_dir, F.array_join(jobs.names_of("entities"), ","))


@query(f"with {_JOBS} select id, status_msg, path from jobs where status = 'failed'")
def job_failures(spark, sf_dir):
    return jobs.failures(_job_log(spark, sf_dir, jobs.names_of("entities"))).select("id", "status_msg", "path")


@query(
    f"""with {_JOBS}
select feature_table, status, status_msg, cast(sum(n) as bigint) as n_jobs, min(started) as first_started,
       max(ended) as last_ended, cast(sum(epoch_us(ended) - epoch_us(started)) as bigint) / 1000000 as seconds
from (
    select feature_table, status, status_msg, date_trunc('hour', started) as started,
           date_trunc('hour', started) + interval 90 second as ended, count(*) as n
    from jobs group by all)
group by feature_table, status, status_msg"""
)
def job_summary(spark, sf_dir):
    """Files that arrive within an hour are one part here, and share their times."""
    hour = F.date_trunc("hour", F.col("started")).cast("timestamp_ntz")
    log = _job_log(spark, sf_dir, jobs.names_of("entities")).withColumn("started", hour)
    return jobs.job_summary(log.withColumn("ended", F.timestamp_add("SECOND", F.lit(90), F.col("started"))))


# Checks


def _day_number():
    return F.date_format(F.col("event_timestamp").cast("date"), "yyyyMMdd").cast("int")


_LINE_LOADS = """line_loads as (
    select cast(year(l_shipdate) * 100 + month(l_shipdate) as integer) as load, l_suppkey as id,
           l_returnflag as feature_table, l_shipdate as event_timestamp,
           date_trunc('month', o_orderdate) as created_timestamp
    from lineitem join orders on l_orderkey = o_orderkey)"""


@query(
    f"""with {_LINE_LOADS},
repeated as (
    select load from line_loads
    group by load, id, feature_table, event_timestamp, created_timestamp having count(*) > 1)
select load, count(*) as n_keys from repeated group by load"""
)
def duplicate_keys(spark, sf_dir):
    """Each month of shipping is a load; suppliers are its entity."""
    rows = entity_rows(
        inputs.order_lines(spark, sf_dir),
        {"supplier": F.col("l_suppkey")},
        F.col("l_shipdate"),
        F.trunc(F.col("o_orderdate").cast("date"), "month").cast("timestamp_ntz"),
        F.col("l_returnflag").alias("feature_table"),
        (F.year("l_shipdate") * 100 + F.month("l_shipdate")).alias("load"),
    )
    return checks.duplicate_key_loads(checks.key_holders(rows))


@query(
    f"""with {inputs.USER_INDEX},
stored as (select * from user_index where event_timestamp < timestamp '2024-01-20'),
arrived as (
    select cast(strftime(event_timestamp, '%Y%m%d') as integer) as load, *
    from user_index where event_timestamp >= timestamp '2024-01-10')
select load, count(*) as n_rows
from arrived join stored using (id, feature_table, event_timestamp, created_timestamp) group by load"""
)
def key_conflicts(spark, sf_dir):
    """Loads of the later days against an index of the earlier ones, some days being in both."""
    rows = inputs.user_index(spark, sf_dir).withColumn("entity", F.lit("user"))
    stored = rows.filter(F.col("event_timestamp") < F.lit("2024-01-20").cast("timestamp_ntz"))
    arrived = rows.filter(F.col("event_timestamp") >= F.lit("2024-01-10").cast("timestamp_ntz"))
    return checks.stored_key_loads(arrived.withColumn("load", _day_number()), stored)


@query(
    f"""with {inputs.USER_INDEX},
arrived as (
    select dense_rank() over (order by feature_table, cast(event_timestamp as date)) - 1 as load, * from user_index
    where cast(event_timestamp as date) in (date '2024-01-02', date '2024-01-29', date '2024-01-30')
        and feature_table in ('click', 'view'))
select load, count(*) as n_rows from arrived join (
    select * from user_index where event_timestamp < timestamp '2024-01-30') as stored
    using (id, feature_table, event_timestamp, created_timestamp)
group by load"""
)
def stored_key_conflicts(spark, sf_dir):
    """Old and new loads together against a stored index, by way of what ingest reads of it."""
    return _stored_key_conflicts(spark, sf_dir)


@query(SQL["stored_key_conflicts"])
def stored_key_conflicts_filtered(spark, sf_dir):
    """The same where the index knows the id bounds of its files: others than those near the ids are not opened."""
    return _stored_key_conflicts(spark, sf_dir, file_rows=1_000)


def _stored_key_conflicts(spark, sf_dir, **described):
    rows = inputs.user_index(spark, sf_dir)
    index = EntityIndex(spark, scratch_root(spark), **described)
    index.define({"user": "bigint"}, 0)
    index.append_entity("user", rows.filter(F.col("event_timestamp") < F.lit("2024-01-30").cast("timestamp_ntz")), 0)
    day = F.col("event_timestamp").cast("date").cast("string")
    arrived = rows.filter(day.isin("2024-01-02", "2024-01-29", "2024-01-30") & F.col("feature_table").isin("click", "view"))
    loads = sorted(tuple(r) for r in arrived.select("feature_table", day.alias("day")).distinct().collect())
    numbers = spark.createDataFrame([(i, *load) for i, load in enumerate(loads)], "load bigint, feature_table string, day string")
    staged = arrived.withColumn("day", day).join(numbers, ["feature_table", "day"]).withColumn("entity", F.lit("user"))
    files = [SimpleNamespace(feature_table=table, id_types={"user": "bigint"}) for table, _ in loads]
    if described:
        IdFiles(index, "user").describe(0)
    stored = stored_keys_near(index, [(row, files[row.load]) for row in profile_of(staged)], rows=staged)
    return checks.stored_key_loads(staged, stored)


@query(
    """select cast(strftime(ts, '%Y%m%d') as integer) as load, count(*) as n_rows
from events where value < 5 or event_type is null group by load"""
)
def null_keys(spark, sf_dir):
    rows = inputs.user_index(spark, sf_dir).withColumn("load", _day_number())
    events = inputs.table(spark, sf_dir, "events").filter(F.col("value") < 5)
    without_id = events.select(
        F.lit(None).cast("bigint").alias("id"),
        F.col("event_type").alias("feature_table"),
        F.col("ts").alias("event_timestamp"),
        inputs.day_of("ts").alias("created_timestamp"),
    ).withColumn("load", _day_number())
    return checks.null_key_loads(rows.drop("path").unionByName(without_id))


_ORDER_LOADS = """order_loads as (
    select cast((year(o_orderdate) - 1992) * 12 + month(o_orderdate) as bigint) as load, l_suppkey as id,
           l_returnflag as feature_table, l_shipdate as event_timestamp
    from lineitem join orders on l_orderkey = o_orderkey)"""


@query(
    f"""with {_ORDER_LOADS},
held as (select distinct * from order_loads),
contested as (
    select * from held where (id, feature_table, event_timestamp) in (
        select (id, feature_table, event_timestamp) from held
        group by id, feature_table, event_timestamp having count(*) > 1))
select a.load, count(distinct b.load) as n_sharers
from contested a join contested b using (id, feature_table, event_timestamp) group by a.load"""
)
def loads_sharing_keys(spark, sf_dir):
    """Each month of orders is a load; how many loads share a key with it, itself included."""
    rows = entity_rows(
        inputs.order_lines(spark, sf_dir),
        {"supplier": F.col("l_suppkey")},
        F.col("l_shipdate"),
        F.col("l_shipdate"),
        F.col("l_returnflag").alias("feature_table"),
        ((F.year("o_orderdate") - 1992) * 12 + F.month("o_orderdate")).cast("bigint").alias("load"),
    )
    return checks.key_sharers(checks.key_holders(rows)).select("load", F.bitmap_count("sharers").alias("n_sharers"))


# Streaming


@query(
    f"""with {inputs.USER_INDEX}
select id, feature_table, event_timestamp, created_timestamp,
       concat('lake/event_type=', feature_table, '/day=', cast(cast(event_timestamp as date) as varchar)) as parent
from user_index"""
)
def stream_ingest(spark, sf_dir):
    """Index rows of all events after streaming them in as files, several of them twice."""
    index = streamed_index(spark, sf_dir)
    return (
        index.entity("user")
        .withColumn("parent", keys.parent_of(F.col("path")))
        .drop("path", "event_month", "batch_id")
    )


@query(
    """with files as (
    select distinct event_type as feature_table, cast(cast(ts as date) as varchar) as day from events),
attempts as (
    select feature_table, day, 'success' as status, cast(null as varchar) as status_msg from files union all
    select feature_table, day, 'failed', 'key already indexed' from files where feature_table = 'click')
select status, status_msg, 'user' as entity_names, feature_table,
       concat('lake/event_type=', feature_table, '/day=', day) as parent
from attempts"""
)
def stream_jobs(spark, sf_dir):
    """The job log of the same stream."""
    index = streamed_index(spark, sf_dir)
    return index.jobs().select(
        "status",
        "status_msg",
        F.array_join("entity_names", ",").alias("entity_names"),
        "feature_table",
        keys.parent_of(F.col("path")).alias("parent"),
    )


@query(
    """select timestamp '2024-02-01 08:00:00' as started, timestamp '2024-02-01 08:00:30' as ended, 'success' as status,
       concat('lake/event_type=signup/day=', cast(cast(ts as date) as varchar)) as parent
from events where event_type = 'signup' group by cast(ts as date)"""
)
def job_times(spark, sf_dir):
    """When the files of one part were begun and done, by a local clock."""
    ticks = (datetime(2024, 2, 1, 8) + timedelta(seconds=30 * i) for i in count())
    log = clocked_index(spark, sf_dir, lambda: next(ticks)).jobs()
    return log.select("started", "ended", "status", keys.parent_of(F.col("path")).alias("parent"))


_IRREGULAR = """attempts as (
    select event_type as feature_table, cast(ts as date) as day,
           case event_type
               when 'click' then case when max(value) > 100 then 'duplicate key in file' end
               when 'error' then case when min(value) < 1 then 'null in key' end
               when 'purchase' then 'column missing: created_ts' end as status_msg
    from events group by event_type, cast(ts as date))"""


@query(
    f"""with {_IRREGULAR}
select case when status_msg is null then 'success' else 'failed' end as status, status_msg,
       case when feature_table = 'signup' then 'big,user' else 'user' end as entity_names, feature_table,
       concat('lake/event_type=', feature_table, '/day=', cast(day as varchar)) as parent
from attempts"""
)
def stream_irregular_jobs(spark, sf_dir):
    """The job log of files with NULL keys, duplicate keys, a missing column, several entities."""
    return irregular_index(spark, sf_dir).jobs().select(
        "status",
        "status_msg",
        F.array_join("entity_names", ",").alias("entity_names"),
        "feature_table",
        keys.parent_of(F.col("path")).alias("parent"),
    )


@query(
    f"""with {inputs.USER_INDEX}, {_IRREGULAR},
loaded as (
    select events.*, cast(ts as date) as day from events
    join attempts on event_type = feature_table and cast(ts as date) = day where status_msg is null)
select 'user' as entity, user_id as id, event_type as feature_table, ts as event_timestamp,
       cast(day as timestamp) as created_timestamp from loaded
union all
select distinct 'big', cast(value > 50 as bigint), event_type, ts, cast(day as timestamp) from loaded
where event_type = 'signup'"""
)
def stream_irregular_index(spark, sf_dir):
    """The index rows of the same files, for both entities."""
    index = irregular_index(spark, sf_dir)
    rows = [
        index.entity(name)
        .withColumn("id", F.col("id").cast("bigint"))
        .select(F.lit(name).alias("entity"), *ROW_KEY)
        for name in ("user", "big")
    ]
    return rows[0].unionByName(rows[1])


@query(_LATEST)
def stored_latest_view(spark, sf_dir):
    """Writes the index, defines its views and asks one of them in SQL."""
    index = EntityIndex(spark, scratch_root(spark))
    index.define({"user": "bigint"}, 0)
    index.append_entity("user", inputs.user_index(spark, sf_dir), 0)
    index.create_views()
    return spark.sql("select * from max_entity_user")


@query(_LATEST)
def published_view(spark, sf_dir):
    """Publishes the index as a database of the catalog and asks its latest view."""
    index = EntityIndex(spark, scratch_root(spark))
    index.define({"user": "bigint"}, 0)
    index.append_entity("user", inputs.user_index(spark, sf_dir), 0)
    database = f"entity_lookup_{uuid.uuid4().hex}"
    index.publish(database)
    return spark.sql(f"select * from {database}.max_entity_user")


_DIRECTORY = "concat('lake/event_type=', feature_table, '/day=', cast(cast(event_timestamp as date) as varchar))"


@query(
    f"""with {inputs.USER_INDEX},
loads as (
    select id, feature_table, created_timestamp, {_DIRECTORY} as parent, max(event_timestamp) as event_timestamp
    from user_index group by all)
select id, feature_table, event_timestamp, created_timestamp, parent from loads
qualify row_number() over (partition by id order by created_timestamp desc, parent desc) = 1"""
)
def stream_late_files(spark, sf_dir):
    """The latest view after older files came in behind newer ones."""
    rows = late_index(spark, sf_dir).latest("user")
    return rows.withColumn("parent", keys.parent_of(F.col("path"))).drop("path", "rk")


@query(
    """select case when value < 2 then concat('{broken ', event_id)
            else concat('{"EventName": "s3:ObjectCreated:Put", "size": ', event_id, '}') end as text
from events where value < 4"""
)
def stream_malformed(spark, sf_dir):
    """What the index keeps of messages that are no notification."""
    return malformed_index(spark, sf_dir).malformed().select("text")


@query(
    f"""with {inputs.USER_INDEX}
select id, feature_table, event_timestamp, created_timestamp, {_DIRECTORY} as parent from user_index
where feature_table <> 'click' or event_timestamp >= timestamp '2024-01-16'"""
)
def stream_with_removals(spark, sf_dir):
    """What is left after files were removed, and some of them came back."""
    index = removals_index(spark, sf_dir)
    rows = index.live(index.entity("user"))
    return rows.withColumn("parent", keys.parent_of(F.col("path"))).drop("path", "event_month", "batch_id")


@query(
    f"""with {inputs.USER_INDEX}
select id, feature_table, event_timestamp, created_timestamp, {_DIRECTORY} as parent from user_index
where feature_table <> 'click' or event_timestamp >= timestamp '2024-01-16'"""
)
def stored_after_compaction(spark, sf_dir):
    """The same index after its closed batches were merged: removed rows are gone for good."""
    index = removals_index(spark, sf_dir)
    index.compact(index.last_batch() + 1)
    return index.entity("user").withColumn("parent", keys.parent_of(F.col("path"))).drop("path", "event_month", "batch_id")


@query(
    f"""with {inputs.USER_INDEX},
loads as (
    select id, feature_table, created_timestamp, {_DIRECTORY} as parent, max(event_timestamp) as event_timestamp
    from user_index where feature_table <> 'click' or event_timestamp >= timestamp '2024-01-16' group by all)
select id, feature_table, event_timestamp, created_timestamp, parent from loads
qualify row_number() over (partition by id order by created_timestamp desc, parent desc) = 1"""
)
def latest_from_state(spark, sf_dir):
    """The latest view as kept batch by batch: late files, files removed and some returned, and a replay."""
    rows = state_index(spark, sf_dir).latest_from_state("user")
    return rows.withColumn("parent", keys.parent_of(F.col("path"))).drop("path", "rk")


_MESSAGES = """messages as (
    select ts, case when value < 3 then '{broken'
                    when value < 6 then concat('{"EventName": "s3:ObjectCreated:Put", "size": ', event_id, '}')
                    when value < 50 then concat('{"EventName": "s3:ObjectCreated:Put", "Key": "lake/', event_id,
                        '.parquet", "Records": [{"eventTime": "2024-02-01T00:00:00.250Z"}]}')
                    else concat('{"Key": "lake/', event_id, '.parquet", "EventName": "s3:ObjectRemoved:Delete"}')
               end as value
    from events),
read as (
    select case when json_valid(value) then json_extract_string(value, '$.EventName') end as event_name,
           case when json_valid(value) then json_extract_string(value, '$.Key') end as key,
           case when json_valid(value) and json_exists(value, '$.Records') then timestamp '2024-02-01 00:00:00.25'
                else ts end as received_at
    from messages)"""


@query(
    f"""with {_MESSAGES}
select 'malformed' as kind, * from read where event_name is null or key is null union all
select 'removed', * from read where key is not null and event_name like 's3:ObjectRemoved:%' union all
select 'created', * from read where key is not null and event_name not like 's3:ObjectRemoved:%'"""
)
def queue_messages(spark, sf_dir):
    """Messages of a queue as notifications, the broken ones included."""
    number, value = F.col("event_id").cast("string"), F.col("value")
    created = F.lit('{"EventName": "s3:ObjectCreated:Put", ')
    sent = F.lit('.parquet", "Records": [{"eventTime": "2024-02-01T00:00:00.250Z"}]}')
    text = (
        F.when(value < 3, "{broken")
        .when(value < 6, F.concat(created, F.lit('"size": '), number, F.lit("}")))
        .when(value < 50, F.concat(created, F.lit('"Key": "lake/'), number, sent))
        .otherwise(F.concat(F.lit('{"Key": "lake/'), number, F.lit('.parquet", "EventName": "s3:ObjectRemoved:Delete"}')))
    )
    # The queue's time stamps are zoned.
    arrived = F.timestamp_micros(values.to_epoch_micros(F.col("ts")))
    messages = inputs.table(spark, sf_dir, "events").select(arrived.alias("timestamp"), text.alias("value"))
    events = notifications.parse_notifications(messages)
    kinds = {"malformed": notifications.malformed, "removed": notifications.removed, "created": notifications.created}
    parts = [of(events).withColumn("kind", F.lit(kind)) for kind, of in kinds.items()]
    return union_all(parts).drop("text")

"""Incremental reads, paging checks and extraction state."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from tallyweave.catalogue.adapters import o_time, raw, rows_of, spark_sql, table
from tallyweave.catalogue.registry import query
from tallyweave.operators.incremental import (
    ExtractState, advance_watermark, created_since as created_since_in, cursor_page as cursor_page_of, cursor_range, cursor_ranges as cursor_ranges_of,
    effective_watermark as effective_watermark_of, extract_summary as extract_summary_of,
    incremental_read as incremental_read_of, latest_state, live_state, next_cursor as next_cursor_of,
    page_chain as page_chain_of, page_completeness as page_completeness_of,
)
from tallyweave.session import fresh_folder
from tallyweave.sources.landing import BATCH, EXTRACTED, FILE

WATERMARK = datetime(1999, 1, 1, 0, 0, 0, 250000, tzinfo=timezone.utc)


@query("incremental_read", """
    select o_orderkey, o_custkey, o_totalprice from orders where o_orderdate >= timestamp '1999-01-01 00:00:00'""")
def incremental_read(spark, folder):
    return incremental_read_of(
        table(spark, folder, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"], "o_orderdate", WATERMARK)


@query("incremental_limit", """
    select event_id, event_type from events where ts >= timestamp '2024-01-02 00:00:00' order by ts limit 500""")
def incremental_limit(spark, folder):
    return incremental_read_of(
        table(spark, folder, "events"), ["event_id", "event_type"], "ts",
        datetime(2024, 1, 2, tzinfo=timezone.utc), limit=500)


@query("created_since", f"""
    select id, created from {rows_of('billing_customers')} where {o_time('created')} >= '2024-01-01T00:00:00Z'""")
def created_since(spark, folder):
    rows = raw(spark, folder, "billing_customers").select("id", "created")
    return created_since_in(rows, datetime(2024, 1, 1, tzinfo=timezone.utc))


@query("cursor_page", "select c_custkey, c_name from customer where c_custkey > 50 order by c_custkey limit 100")
def cursor_page(spark, folder):
    return cursor_page_of(table(spark, folder, "customer").select("c_custkey", "c_name"), "c_custkey", 50, 100)


@query("next_cursor", """
    select count(*) as records, max(c_custkey) as next_cursor from (
      select c_custkey from customer where c_custkey > 50 order by c_custkey limit 100)""")
def next_cursor(spark, folder):
    return next_cursor_of(cursor_page(spark, folder), "c_custkey")


@query("cursor_batch", "select event_id, user_id from events where event_id > 100")
def cursor_batch(spark, folder):
    return cursor_range(table(spark, folder, "events").select("event_id", "user_id"), "event_id", 100, None)


@query("page_completeness", """
    with pages as (
      select event_type as chain, floor(event_id / 1000)::bigint as page, count(*) as n from events group by 1, 2),
    sizes as (select chain, count(*) as pages, sum(n)::bigint as records from pages group by chain)
    select chain, pages, records, records + case when chain = 'click' then 1 else 0 end as total_size,
      case when chain = 'error' then 1 else 0 end as missing_pages, chain not in ('click', 'error') as is_complete
    from sizes""")
def page_completeness(spark, folder):
    """Pages of events by type. The last page of ``error`` points on; ``click`` says one more."""
    events = table(spark, folder, "events").select(
        F.col("event_type").alias("chain"), F.floor(F.col("event_id") / 1000).alias("page"))
    pages = events.groupBy("chain", "page").agg(F.count(F.lit(1)).alias("records_in_page"))
    ends = pages.groupBy("chain").agg(
        F.min("page").alias("first"), F.max("page").alias("last"), F.sum("records_in_page").alias("size"))
    linked = pages.join(ends, "chain")
    points_on = (F.col("page") < F.col("last")) | (F.col("chain") == "error")
    return page_completeness_of(linked.select(
        "chain",
        F.when(F.col("page") > F.col("first"), F.concat(F.lit("/q/"), F.col("page"))).alias("locator"),
        F.when(points_on, F.concat(F.lit("/q/"), F.col("page") + 1)).alias("next_locator"),
        (F.col("size") + F.when(F.col("chain") == "click", 1).otherwise(0)).alias("total_size"),
        "records_in_page",
    ))


@query("extract_summary", """
    select event_type as batch_id, 'stripe' as source, 'events' as entity, count(*) as total_records,
      count(distinct floor(event_id / 500)) as files,
      strftime(min(ts), '%Y-%m-%dT%H:%M:%SZ') as start_time, strftime(max(ts), '%Y-%m-%dT%H:%M:%SZ') as end_time,
      epoch(date_trunc('second', max(ts)))::bigint - epoch(date_trunc('second', min(ts)))::bigint as duration_seconds
    from events group by event_type""")
def extract_summary(spark, folder):
    landed = table(spark, folder, "events").select(
        F.col("event_type").alias(BATCH),
        F.floor(F.col("event_id") / 500).cast("string").alias(FILE),
        F.col("ts").cast("string").alias(EXTRACTED))
    return extract_summary_of(landed, "stripe", "events")


# The event log read as a log of runs: an error is a reset, of everything or of one source in
# the first days, of one entity later.
_LOG = """
    select case when event_type = 'error' and ts < timestamp '2024-01-03 00:00:00' then null
                when event_type in ('view', 'click') or event_id % 2 = 0 then 'stripe' else 'salesforce' end as source,
      case when event_type = 'error' and ts < timestamp '2024-01-05 00:00:00' then null
           else 'user_' || cast(user_id as varchar) end as entity,
      case when event_id % 3 = 0 then substr(cast(ts as varchar), 1, 19) end as last_extracted_timestamp,
      case when event_id % 2 = 0 then 'cur_' || cast(event_id as varchar) end as last_cursor,
      ts as last_run_at, event_id as records_synced_last_run, event_type as status, event_type = 'error' as is_reset
    from events"""
_LIVE = f"""
    with log as ({_LOG}),
    everything as (select max(last_run_at) as t from log where is_reset and source is null),
    by_source as (select source, max(last_run_at) as t from log where is_reset and source is not null
      and entity is null group by source),
    by_entity as (select source, entity, max(last_run_at) as t from log where is_reset and source is not null
      and entity is not null group by source, entity),
    live as (
      select l.* from log l left join by_source s on l.source = s.source
        left join by_entity e on l.source = e.source and l.entity = e.entity
      where not l.is_reset and l.last_run_at > coalesce((select t from everything), timestamp '1970-01-01 00:00:00')
        and (s.t is null or l.last_run_at > s.t) and (e.t is null or l.last_run_at > e.t))"""


def _log(spark, folder):
    start = F.col("ts")
    error = F.col("event_type") == "error"
    user = F.concat(F.lit("user_"), F.col("user_id").cast("string"))
    billing = F.col("event_type").isin("view", "click") | (F.col("event_id") % 2 == 0)
    return table(spark, folder, "events").select(
        F.when(error & (start < "2024-01-03"), None).when(billing, "stripe").otherwise("salesforce").alias("source"),
        F.when(error & (start < "2024-01-05"), None).otherwise(user).alias("entity"),
        F.when(F.col("event_id") % 3 == 0, F.substring(start.cast("string"), 1, 19)).alias("last_extracted_timestamp"),
        F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("cur_"), F.col("event_id").cast("string"))).alias(
            "last_cursor"),
        start.cast("timestamp").alias("last_run_at"),
        F.col("event_id").alias("records_synced_last_run"),
        F.col("event_type").alias("status"),
        error.alias("is_reset"),
    )


_LATEST = f"""{_LIVE}
    select source, entity, arg_max_null(last_cursor, last_run_at) as last_cursor,
      arg_max(records_synced_last_run, last_run_at) as records_synced_last_run, arg_max(status, last_run_at) as status
    from live group by source, entity"""


@query("state_latest", _LATEST)
def state_latest(spark, folder):
    return latest_state(_log(spark, folder)).select(
        "source", "entity", "last_cursor", "records_synced_last_run", "status")


@query("state_compacted", _LATEST)
def state_compacted(spark, folder):
    """The same state when the log was taken into snapshots twice, each time before more runs and resets."""
    state = ExtractState(spark, fresh_folder(spark, "state"))
    rows = _log(spark, folder).withColumn("h", F.xxhash64("status", "last_run_at"))
    for part in range(3):
        rows.where(F.pmod("h", F.lit(3)) == part).drop("h").write.mode("append").parquet(state.path)
        if part < 2:
            state.compact()
    return state.latest().select("source", "entity", "last_cursor", "records_synced_last_run", "status")


@query("state_keep_previous", f"""{_LIVE}
    select source, entity, arg_max(last_extracted_timestamp, last_run_at) as last_extracted_timestamp
    from live group by source, entity""")
def state_keep_previous(spark, folder):
    return latest_state(_log(spark, folder)).select("source", "entity", "last_extracted_timestamp")


@query("state_after_reset", f"""{_LIVE}
    select source, count(*) as runs, count(distinct entity) as entities from live group by source""")
def state_after_reset(spark, folder):
    per_entity = live_state(_log(spark, folder)).groupBy("source", "entity").agg(F.count(F.lit(1)).alias("n"))
    return per_entity.groupBy("source").agg(F.sum("n").alias("runs"), F.count(F.lit(1)).alias("entities"))


@query("effective_watermark", f"""{_LIVE}
    select source, entity, strftime(coalesce(case when source = 'stripe' then timestamp '2024-01-20 00:00:00' end,
      try_cast(arg_max(last_extracted_timestamp, last_run_at) as timestamp)), '%Y-%m-%dT%H:%M:%SZ') as watermark
    from live group by source, entity""")
def effective_watermark(spark, folder):
    given = F.when(F.col("source") == "stripe", "2024-01-20 00:00:00")
    mark = effective_watermark_of(given, F.col("last_extracted_timestamp"))
    return latest_state(_log(spark, folder)).select(
        "source", "entity", F.date_format(mark, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("watermark"))


@query("next_watermark", f"""
    select max({o_time('created')}) as next_watermark from {rows_of('billing_charges')}""")
def next_watermark(spark, folder):
    return advance_watermark(raw(spark, folder, "billing_charges"), "created").select(
        F.date_format("next_watermark", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("next_watermark"))


# Pages of a hundred events by type, numbered per chain. ``error`` lacks its third page, the
# second half of ``click`` runs in a circle, and the second page of ``view`` names two next ones.
_RANKED = """
    select chain, row_number() over (partition by chain order by page) - 1 as r, count(*) over (partition by chain) - 1 as m
    from (select distinct event_type as chain, cast(floor(event_id / 100) as bigint) as page from {events})"""


@query("page_chain", f"""
    with p as ({_RANKED.replace("{events}", "events")})
    select chain, case when r > 0 then '/q/' || cast(r as varchar) end as locator,
      case when chain = 'error' and r > 2 or chain = 'click' and r >= (m + 1) // 2 then null else r end as page_number,
      case when chain = 'error' and r > 2 then 'orphaned' when chain = 'click' and r >= (m + 1) // 2 then 'cyclic' else 'chained' end as state,
      chain = 'view' and r = 1 as is_fork
    from p where not (chain = 'error' and r = 2)
    union all select 'view', '/q/other', 2, 'chained', false""")
def page_chain(spark, folder):
    """Chains with a gap, a loop and a fork: every page gets its number or what is wrong with it."""
    ranked = spark_sql(spark, folder, _RANKED)
    r, m, chain = F.col("r"), F.col("m"), F.col("chain")
    half = F.floor((m + 1) / 2)
    following = F.when((chain == "click") & (r == half - 1), None).when((chain == "click") & (r == m), half).when(r < m, r + 1)
    pages = ranked.where(~((chain == "error") & (r == 2))).select(
        "chain", F.when(r > 0, F.concat(F.lit("/q/"), r.cast("string"))).alias("locator"),
        F.concat(F.lit("/q/"), following.cast("bigint").cast("string")).alias("next_locator"))
    other = spark.createDataFrame([("view", "/q/1", "/q/other"), ("view", "/q/other", None)], pages.schema)
    return page_chain_of(pages.unionByName(other))


@query("cursor_ranges", """
    select 'events' as dataset, 16 as ranges, count(*) as n, true as is_once, true as is_even from events
    union all select 'customer', 7, count(*), true, true from customer""")
def cursor_ranges(spark, folder):
    """Ranges of numbers and of texts: every key is in one of them, and none is a tenth above the others."""
    def measured(rows, key, ranges):
        cuts = cursor_ranges_of(rows, key, ranges)
        inside = (F.col("after").isNull() | (F.col(key) > F.col("after"))) & (F.col("upto").isNull() | (F.col(key) <= F.col("upto")))
        per_key = rows.join(F.broadcast(cuts), inside, "left").groupBy(key).agg(F.count("range").alias("hits"), F.min("range").alias("range"))
        sizes = per_key.groupBy("range").agg(F.count(F.lit(1)).alias("n"), F.max("hits").alias("most"), F.min("hits").alias("least"))
        return sizes.agg(
            F.count(F.lit(1)).cast("int").alias("ranges"), F.sum("n").alias("n"), ((F.max("most") == 1) & (F.min("least") == 1)).alias("is_once"),
            (F.max("n") <= 1.1 * F.sum("n") / F.lit(ranges) + 1).alias("is_even"))

    events = measured(table(spark, folder, "events").select("event_id"), "event_id", 16)
    names = measured(table(spark, folder, "customer").select(F.concat(F.lit("cus_"), F.col("c_custkey").cast("string")).alias("id")), "id", 7)
    return events.select(F.lit("events").alias("dataset"), "*").unionByName(names.select(F.lit("customer").alias("dataset"), "*"))

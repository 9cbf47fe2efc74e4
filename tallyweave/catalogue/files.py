"""Landing zone, envelopes, raw checks and curated copies."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

from tallyweave.catalogue.adapters import AS_OF, COMPANY_NAMES, MAPPED, o_time, raw, rows_of, spark_sql, table
from tallyweave.catalogue.registry import query
from tallyweave.operators import mapping
from tallyweave.operators.incremental import ExtractState
from tallyweave.schemas import struct_of
from tallyweave.session import fresh_folder
from tallyweave.sources.curated import read_curated, write_curated
from tallyweave.sources.ingest import MAX_RECORD, RUN_END, ingest, ingestions
from tallyweave.sources.landing import (
    BATCH, ENVELOPE, LINES, broken_lists as broken_lists_of, entity_folder, envelopes, landed_batches, list_batches,
    read_landing, read_rejects, unwrap_list as unwrap_list_of, write_envelopes, write_landing,
)
from tallyweave.sources.raw_check import check_raw

_EVENT = struct_of("event_id long, user_id long, event_type string, value double, props string")


def _landed_events(spark, folder, compress: bool = True) -> str:
    """Events landed by day, one batch per event type, in files of at most 500 records."""
    root = fresh_folder(spark, "landing")
    events = table(spark, folder, "events")
    write_landing(
        events.select(*_EVENT.fieldNames(), "ts"), root, "Stripe", "Events", F.col("event_type"), F.col("ts"),
        page_size=500, compress=compress)
    return root


@query("landing_roundtrip", """
    select event_id, user_id, event_type, value, props, event_type as batch_id, year(ts) as year, month(ts) as month,
      day(ts) as day from events""")
def landing_roundtrip(spark, folder):
    landed = read_landing(spark, _landed_events(spark, folder), "stripe", "events", record=_EVENT)
    return landed.select(*_EVENT.fieldNames(), F.col(BATCH).alias("batch_id"), "year", "month", "day")


@query("landing_pruned", """
    select event_id, event_type from events where ts >= timestamp '2024-01-03 00:00:00'
      and ts < timestamp '2024-01-11 00:00:00'""")
def landing_pruned(spark, folder):
    root = _landed_events(spark, folder, compress=False)
    days = ("2024-01-03", "2024-01-10")
    return read_landing(spark, root, "stripe", "events", days=days, record=_EVENT).select("event_id", "event_type")


@query("batch_listing", "select event_type as batch_id, count(*) as record_count from events group by event_type")
def batch_listing(spark, folder):
    landed = read_landing(spark, _landed_events(spark, folder), "stripe", "events", record=_EVENT)
    return landed_batches(landed).groupBy(F.col(BATCH).alias("batch_id")).agg(
        F.sum("record_count").alias("record_count"))


@query("file_listing", "select count(distinct date_trunc('day', ts)) as days, true as all_gzip from events")
def file_listing(spark, folder):
    files = list_batches(spark, _landed_events(spark, folder), "stripe", "events")
    day = F.regexp_extract("path", "year=[0-9]{4}/month=[0-9]{2}/day=[0-9]{2}", 0)
    per_day = files.groupBy(day.alias("day")).agg(F.min(F.col("path").endswith(".json.gz")).alias("gz"))
    return per_day.agg(F.count_if(F.col("day") != "").alias("days"), F.min("gz").alias("all_gzip"))


@query("envelope_roundtrip", f"""
    select id, cast(amount as varchar) as amount, status, created, '2026-01-01' as day, true as page_is_full_or_last
    from {rows_of('billing_charges')}""")
def envelope_roundtrip(spark, folder):
    """Charges as page documents, written and read back; page sizes stay within the limit."""
    root = fresh_folder(spark, "landing")
    rows = raw(spark, folder, "billing_charges")
    pages = envelopes(rows, "stripe", "charges", "b1", F.lit(AS_OF), page_size=1000)
    write_envelopes(pages, root, "stripe", "charges")
    landed = read_landing(spark, root, "stripe", "charges", layout=ENVELOPE)
    return landed.select(
        "id", "amount", "status", "created", F.format_string("%04d-%02d-%02d", "year", "month", "day").alias("day"),
        (F.col("_seq") < 1000).alias("page_is_full_or_last"))


@query("unwrap_billing_list", """
    select floor(event_id / 1000)::bigint as page, 'sub_' || cast(event_id as varchar) as id, event_type as status,
      floor(event_id / 1000) < (select floor(max(event_id) / 1000) from events) as has_more
    from events""")
def unwrap_billing_list(spark, folder):
    """Events in list responses of a thousand ids, as JSON text, taken apart again."""
    events = table(spark, folder, "events")
    last = events.agg(F.floor(F.max("event_id") / 1000)).scalar()
    record = F.struct(F.concat(F.lit("sub_"), F.col("event_id").cast("string")).alias("id"),
                      F.col("event_type").alias("status"))
    pages = events.groupBy(F.floor(F.col("event_id") / 1000).alias("page")).agg(F.collect_list(record).alias("data"))
    lists = pages.select("page", F.to_json(F.struct(
        F.lit("list").alias("object"), "data", (F.col("page") < last).alias("has_more"))).alias("body"))
    return unwrap_list_of(lists, "body", "stripe", "subscriptions").select(
        "page", "record.id", "record.status", "has_more")


@query("unwrap_crm_result", """
    select floor(s_suppkey / 50)::bigint as page, 'con_' || cast(s_suppkey as varchar) as id, s_name as last_name,
      (select count(*) from supplier) as total_size,
      floor(s_suppkey / 50) = (select floor(max(s_suppkey) / 50) from supplier) as done,
      case when floor(s_suppkey / 50) < (select floor(max(s_suppkey) / 50) from supplier)
        then '/q/' || cast(floor(s_suppkey / 50)::bigint + 1 as varchar) end as next_records_url
    from supplier""")
def unwrap_crm_result(spark, folder):
    contacts = table(spark, folder, "supplier")
    last = contacts.agg(F.floor(F.max("s_suppkey") / 50)).scalar()
    size = contacts.agg(F.count(F.lit(1))).scalar()
    record = F.struct(
        F.struct(F.lit("Contact").alias("type")).alias("attributes"),
        F.concat(F.lit("con_"), F.col("s_suppkey").cast("string")).alias("Id"), F.col("s_name").alias("LastName"))
    pages = contacts.groupBy(F.floor(F.col("s_suppkey") / 50).alias("page")).agg(
        F.collect_list(record).alias("records"))
    results = pages.select("page", F.to_json(F.struct(
        size.alias("totalSize"), (F.col("page") == last).alias("done"),
        F.when(F.col("page") < last, F.concat(F.lit("/q/"), (F.col("page") + 1).cast("string"))).alias(
            "nextRecordsUrl"),
        "records")).alias("body"))
    return unwrap_list_of(results, "body", "salesforce", "contacts").select(
        "page", "record.Id", F.col("record.LastName").alias("last_name"), F.col("totalSize").alias("total_size"),
        "done", F.col("nextRecordsUrl").alias("next_records_url")).withColumnRenamed("Id", "id")


_RAW_JSON = """
    select o_orderkey,
      '{' || case when o_orderkey % 13 = 0 then '' else '"id":"ch_' || cast(o_orderkey as string) || '",' end
      || '"amount":' || case when o_orderkey % 17 = 0 then '"lots"'
           when o_orderkey % 3 = 0 then '"' || cast(cast(round(o_totalprice * 100) as bigint) as string) || '"'
           else cast(cast(round(o_totalprice * 100) as bigint) as string) end
      || ',"currency":"usd","status":"' || o_orderstatus || '","paid":'
      || case when o_orderkey % 19 = 0 then 'null' when o_orderstatus = 'F' then 'true' else '"false"' end
      || ',"attributes":{"type":"x"},"created":' || case when o_orderkey % 23 = 0 then '"never"'
           else cast(1704067200 + o_orderkey % 100000 as string) end
      || '}' as body
    from {orders}"""
_RAW_ERRORS = """concat_ws('; ',
      case when o_orderkey % 13 = 0 then 'id: missing' end, case when o_orderkey % 17 = 0 then 'amount: not a whole' end,
      case when o_orderkey % 19 = 0 then 'paid: null' end, case when o_orderkey % 23 = 0 then 'created: not a time' end)"""


@query("raw_schema_check", f"""
    select o_orderkey, {_RAW_ERRORS} as errors, {_RAW_ERRORS} = '' as is_valid,
      case when o_orderkey % 17 = 0 then 'lots' else cast(cast(round(o_totalprice * 100) as bigint) as varchar) end
        as amount,
      case when {_RAW_ERRORS} = '' then '0' end as amount_refunded,
      case when {_RAW_ERRORS} = '' then
        {o_time('cast(1704067200 + o_orderkey % 100000 as varchar)')}
        when o_orderkey % 23 = 0 then 'never' else cast(1704067200 + o_orderkey % 100000 as varchar) end as created,
      case when {_RAW_ERRORS} = '' then 'charge' end as object
    from orders""")
def raw_schema_check(spark, folder):
    checked = check_raw(spark_sql(spark, folder, _RAW_JSON), "body", "stripe", "charges")
    return checked.select(
        "o_orderkey", F.array_join("schema_errors", "; ").alias("errors"), F.col("is_schema_valid").alias("is_valid"),
        "record.amount", "record.amount_refunded", "record.created", "record.object")


@query("curated_roundtrip", f"""
    select 'parquet' as form, {', '.join(COMPANY_NAMES)} from ({MAPPED['crm_companies']})
    union all select 'json', {', '.join(COMPANY_NAMES)} from ({MAPPED['crm_companies']})""")
def curated_roundtrip(spark, folder):
    root = fresh_folder(spark, "curated")
    write_curated(mapping.crm_companies(raw(spark, folder, "crm_accounts"), AS_OF), root, "companies")
    forms = [read_curated(spark, root, "companies", f).select(F.lit(f).alias("form"), "*") for f in ("parquet", "json")]
    return forms[0].unionByName(forms[1])


_BROKEN = "o_orderkey % 7 = 0"


def _land_text(spark, texts, layout: str) -> str:
    """Texts as they are, as lines of one day's files or as a file each."""
    root = fresh_folder(spark, "landing")
    folder = f"{entity_folder(root, 'stripe', 'charges')}/year=2024/month=05/day=12"
    writer = texts.write.option("maxRecordsPerFile", 1) if layout == ENVELOPE else texts.write
    writer.text(folder)
    return root


def _good_and_broken(spark, root: str, layout: str):
    good = read_landing(spark, root, "stripe", "charges", layout=layout, on_broken="reject")
    rejects = read_rejects(spark, root, "stripe", "charges", layout=layout)
    return good.select(F.lit("good").alias("kind"), F.col("id").alias("value")).unionByName(
        rejects.select(F.lit("broken").alias("kind"), F.rtrim(F.regexp_replace("text", "\n", "")).alias("value")))


@query("broken_lines", f"""
    select case when {_BROKEN} then 'broken' else 'good' end as kind,
      case when {_BROKEN} then '{{"id":"ch_' || cast(o_orderkey as varchar) || '","_ba'
        else 'ch_' || cast(o_orderkey as varchar) end as value from orders""")
def broken_lines(spark, folder):
    """Lines of which every seventh is cut off: each line is a record or a reject."""
    texts = spark_sql(spark, folder, f"""
        select concat('{{"id":"ch_', o_orderkey, case when {_BROKEN} then '","_ba' else concat(
          '","_batch_id":"b1","_extracted_at":"2024-05-12T00:00:00","_seq":', o_orderkey, '}}') end) as value from {{orders}}""")
    return _good_and_broken(spark, _land_text(spark, texts, LINES), LINES)


_PAGES = "select cast(floor(o_orderkey / 1000) as bigint) as page, count(*) as n, max(o_orderkey) as last from {orders} group by 1"


@query("broken_envelopes", f"""
    select case when page % 3 = 0 then 'broken' else 'good' end as kind,
      case when page % 3 = 0 then '{{"metadata":{{"batch_id":"p' || cast(page as varchar) || '"}},"reco'
        else 'ch_' || cast(last as varchar) end as value from ({_PAGES.replace("{orders}", "orders")})""")
def broken_envelopes(spark, folder):
    """A document per thousand orders, every third of them cut off."""
    texts = spark_sql(spark, folder, f"""
        select concat('{{"metadata":{{"batch_id":"p', page, '"}},', case when page % 3 = 0 then '"reco' else concat(
          '"records":[{{"id":"ch_', last, '"}}]}}') end) as value from ({_PAGES})""")
    return _good_and_broken(spark, _land_text(spark, texts, ENVELOPE), ENVELOPE)


@query("broken_lists", f"""
    select case when page % 3 = 0 then 'broken' else 'good' end as kind,
      case when page % 3 = 0 then '{{"has_more":true,"da' || cast(page as varchar)
        else 'ch_' || cast(last as varchar) end as value from ({_PAGES.replace("{orders}", "orders")})""")
def broken_lists(spark, folder):
    """List responses of which every third is cut off."""
    bodies = spark_sql(spark, folder, f"""
        select concat('{{"has_more":true,"da', case when page % 3 = 0 then cast(page as string) else concat(
          'ta":[{{"id":"ch_', last, '"}}]}}') end) as body from ({_PAGES})""")
    good = unwrap_list_of(bodies, "body", "stripe", "charges", on_broken="reject")
    return good.select(F.lit("good").alias("kind"), F.col("record.id").alias("value")).unionByName(
        broken_lists_of(bodies, "body", "stripe").select(F.lit("broken").alias("kind"), F.col("body").alias("value")))


_ODD = ("123", "null", '"text"', "[]", "true", '[{"id":"ch_1"}]')
_ODD_VALUE = "case o_orderkey % 9 " + " ".join(f"when {k} then '{v}'" for k, v in enumerate(_ODD))


@query("odd_lines", f"""
    select case when o_orderkey % 9 < {len(_ODD)} then 'broken' else 'good' end as kind,
      {_ODD_VALUE} when {len(_ODD)} then null else 'ch_' || cast(o_orderkey as varchar) end as value from orders""")
def odd_lines(spark, folder):
    """Lines that are JSON but no object are rejects; an empty object is a record without values."""
    texts = spark_sql(spark, folder, f"""
        select {_ODD_VALUE} when {len(_ODD)} then '{{}}' else concat('{{"id":"ch_', o_orderkey, '"}}') end as value from {{orders}}""")
    return _good_and_broken(spark, _land_text(spark, texts, LINES), LINES)


# -- ingest: list responses to landed records, with their report and state ----------------------

_START, _END = datetime(2026, 1, 1, tzinfo=timezone.utc), datetime(2026, 1, 1, 0, 5, tzinfo=timezone.utc)


def _ingested(spark, pages: DataFrame, source: str, entity: str, mark: str, key: str, *columns: str) -> DataFrame:
    """Landed records, the note on the batch, and the state, as rows of (kind, value, detail, n)."""
    root = fresh_folder(spark, "landing")
    state = ExtractState(spark, f"{root}/state")
    result = ingest(pages, "body", root, source, entity, state, "b1", _START, _END, mark)
    landed = read_landing(spark, root, source, entity).select(
        F.lit("landed").alias("kind"), F.col(key).alias("value"), F.concat_ws("|", *columns).alias("detail"), F.lit(None).cast("long").alias("n"))
    note = ingestions(spark, root).select(F.lit("note").alias("kind"), F.col("status").alias("value"), F.concat_ws(
        "|", F.col("records_transformed").cast("string"), F.lit(str(result.broken)), F.lit(str(result.pages))).alias("detail"),
        F.col("records_extracted").alias("n"))
    now = state.latest().select(
        F.lit("state").alias("kind"), F.substring("last_extracted_timestamp", 1, 19).alias("value"), F.col("last_cursor").alias("detail"),
        F.col("records_synced_last_run").alias("n"))
    return landed.unionByName(note).unionByName(now)


_CHARGE = f"""select *, floor(o_orderkey / 1000)::bigint as page, {_RAW_ERRORS} as errors from orders"""


@query("ingest_billing", f"""
    with c as ({_CHARGE}), k as (select * from c where page % 3 <> 0)
    select 'landed' as kind, case when o_orderkey % 13 <> 0 then 'ch_' || cast(o_orderkey as varchar) end as value,
      concat_ws('|', case when o_orderkey % 17 = 0 then 'lots' else cast(cast(round(o_totalprice * 100) as bigint) as varchar) end,
        case when errors = '' then {o_time('cast(1704067200 + o_orderkey % 100000 as varchar)')}
          when o_orderkey % 23 = 0 then 'never' else cast(1704067200 + o_orderkey % 100000 as varchar) end) as detail, null::bigint as n
    from k
    union all select 'note', 'COMPLETED', cast(count(*) filter (where errors = '') as varchar) || '|' || cast(
      (select count(distinct page) from c where page % 3 = 0) as varchar) || '|' || cast((select count(distinct page) from c) as varchar), count(*) from k
    union all select 'state', strftime(make_timestamp(max(case when o_orderkey % 23 <> 0 then 1704067200 + o_orderkey % 100000 end)::bigint * 1000000), '%Y-%m-%dT%H:%M:%S'),
      max(case when o_orderkey % 13 <> 0 then 'ch_' || cast(o_orderkey as varchar) end), count(*) from k""")
def ingest_billing(spark, folder):
    """Pages of a thousand charges, some of them faulty; every third page is cut off."""
    charges = spark_sql(spark, folder, _RAW_JSON)
    page = F.floor(F.col("o_orderkey") / 1000)
    pages = charges.groupBy(page.alias("page")).agg(F.concat_ws(",", F.collect_list("body")).alias("items"))
    body = F.when(F.col("page") % 3 == 0, F.concat(F.lit('{"object":"list","da'), F.col("page").cast("string"))).otherwise(
        F.concat(F.lit('{"object":"list","has_more":true,"data":['), "items", F.lit("]}")))
    return _ingested(spark, pages.select(body.alias("body")), "stripe", "charges", MAX_RECORD, "id", "amount", "created")


@query("ingest_crm", """
    with k as (select *, s_suppkey % 4 <> 0 as sound, 'con_' || cast(s_suppkey as varchar) as id from supplier)
    select 'landed' as kind, id as value, case when sound then s_name || '|2024-01-02T00:00:00Z' else '2024-01-02 00:00:00' end as detail, null::bigint as n
    from k
    union all select 'note', 'COMPLETED', cast(count(*) filter (where sound) as varchar) || '|0|' || cast(
      count(distinct floor(s_suppkey / 50)) as varchar), count(*) from k
    union all select 'state', '2026-01-01T00:05:00', max(id), count(*) from k""")
def ingest_crm(spark, folder):
    """Pages of contacts, every fourth without its last name; the next run starts where this one ends."""
    name = F.when(F.col("s_suppkey") % 4 != 0, F.col("s_name"))
    day = F.lit("2024-01-02 00:00:00")
    record = F.struct(
        F.struct(F.lit("Contact").alias("type")).alias("attributes"), F.concat(F.lit("con_"), F.col("s_suppkey").cast("string")).alias("Id"),
        name.alias("LastName"), day.alias("CreatedDate"), day.alias("LastModifiedDate"))
    pages = table(spark, folder, "supplier").groupBy(F.floor(F.col("s_suppkey") / 50).alias("page")).agg(F.collect_list(record).alias("records"))
    bodies = pages.select(F.to_json(F.struct(F.lit(True).alias("done"), "records")).alias("body"))
    return _ingested(spark, bodies, "salesforce", "contacts", RUN_END, "Id", "LastName", "LastModifiedDate")

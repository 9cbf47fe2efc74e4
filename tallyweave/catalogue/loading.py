"""Upserts: as plans, as writes to warehouse tables, and as a stream."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tallyweave.catalogue.adapters import (
    AS_OF, CUSTOMER_NAMES, MAPPED, TRANSACTION_NAMES, raw, rows_of, spark_sql, table,
)
from tallyweave.catalogue.registry import query
from tallyweave.catalogue.resolved import FACTS, PROFILES, all_tables
from tallyweave.operators import mapping
from tallyweave.operators.merge import existing_keys as existing_keys_of, last_per_key, merge_counts, merge_plan
from tallyweave.operators.quality import ROW_RULES, row_is_valid
from tallyweave.operators.warehouse import Warehouse, load_summary as load_summary_of
from tallyweave.plans.run import run
from tallyweave.schemas import BILLING, CRM
from tallyweave.session import fresh_folder
from tallyweave.sources.curated import write_curated
from tallyweave.sources.landing import entity_folder, write_landing
from tallyweave.streaming.sync import rejects as rejects_of, sync

NOW = datetime(2026, 1, 1, tzinfo=timezone.utc)
# Two loads that overlap by one year: what was loaded before, and the batch.
_BEFORE = "o_orderdate < timestamp '2000-01-01 00:00:00'"
_BATCH = "o_orderdate >= timestamp '1999-01-01 00:00:00'"
_OLD = f"""select o_orderkey, o_totalprice as price, o_orderstatus as status, o_orderpriority as note,
      '2025-01-01 00:00:00' as updated_at from {{orders}} where {_BEFORE}"""
_NEW = f"""select o_orderkey, o_totalprice + 1 as price, lower(o_orderstatus) as status,
      case when o_orderstatus = 'P' then null else o_orderpriority end as note,
      '2025-06-01 00:00:00' as updated_at from {{orders}} where {_BATCH}"""
_OLD_SQL, _NEW_SQL = _OLD.replace("{orders}", "orders"), _NEW.replace("{orders}", "orders")


def _sides(spark, folder) -> tuple[DataFrame, DataFrame]:
    return spark_sql(spark, folder, _OLD), spark_sql(spark, folder, _NEW)


def _warehouse(spark, buckets: int = 16, **extra) -> Warehouse:
    name = f"tallyweave_{uuid.uuid4().hex[:12]}"
    return Warehouse(spark, name, fresh_folder(spark, name), buckets=buckets, **extra)


@query("dedupe_last_wins", """
    select id, r.a as partkey, r.b as suppkey, strftime(r.c, '%Y-%m-%d') as shipdate, r.d as price from (
      select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as id,
        max(struct_pack(a := l_partkey, b := l_suppkey, c := l_shipdate, d := l_extendedprice)) as r
      from lineitem group by 1)""")
def dedupe_last_wins(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"),
        F.col("l_partkey").alias("partkey"), F.col("l_suppkey").alias("suppkey"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipdate"), F.col("l_extendedprice").alias("price"))
    return last_per_key(rows, "id", ("partkey", "suppkey", "shipdate", "price"))


@query("existing_keys", f"select o_orderkey from orders where {_BEFORE} and {_BATCH}")
def existing_keys(spark, folder):
    return existing_keys_of(*_sides(spark, folder), "o_orderkey")


def _merge_sql(status: str, note: str) -> str:
    return f"""
      select coalesce(n.o_orderkey, o.o_orderkey) as o_orderkey,
        case when n.o_orderkey is not null then n.price else o.price end as price,
        {status} as status, {note} as note,
        case when n.o_orderkey is not null and o.o_orderkey is not null then '2026-01-01 00:00:00'
             else coalesce(n.updated_at, o.updated_at) end as updated_at,
        case when n.o_orderkey is null then 'keep' when o.o_orderkey is null then 'insert' else 'update' end as _op
      from ({_OLD_SQL}) o full join ({_NEW_SQL}) n on o.o_orderkey = n.o_orderkey"""


_REPLACE = _merge_sql("case when n.o_orderkey is not null then n.status else o.status end",
                      "case when n.o_orderkey is not null then n.note else o.note end")
_GIVEN = _merge_sql("case when o.o_orderkey is not null then o.status else n.status end",
                    "case when o.o_orderkey is not null then o.note else n.note end")
_STAMP = "2026-01-01 00:00:00"


@query("upsert_plan", _REPLACE)
def upsert_plan(spark, folder):
    return merge_plan(*_sides(spark, folder), "o_orderkey", F.lit(_STAMP))


@query("upsert_partial", _GIVEN)
def upsert_partial(spark, folder):
    return merge_plan(*_sides(spark, folder), "o_orderkey", F.lit(_STAMP), given=("o_orderkey", "price"))


@query("upsert_counts", f"""
    select count(*) filter (where _op <> 'keep') as rows_processed, count(*) filter (where _op = 'insert')
      as rows_inserted, count(*) filter (where _op = 'update') as rows_updated from ({_REPLACE})""")
def upsert_counts(spark, folder):
    return merge_counts(upsert_plan(spark, folder))


def _text_times(rows: DataFrame) -> DataFrame:
    """Timestamps as text, so that both engines give the same value."""
    return rows.select(*[
        F.date_format(f.name, "yyyy-MM-dd HH:mm:ss").alias(f.name) if f.dataType.typeName() == "timestamp"
        else F.col(f.name) for f in rows.schema.fields])


def _loaded_charges(warehouse: Warehouse, spark, folder) -> Warehouse:
    mapped = mapping.billing_charges(raw(spark, folder, "billing_charges"), AS_OF)
    charges = write_curated(mapped, fresh_folder(spark, "curated"), "transactions", json=False)
    day = F.substring("transaction_date", 1, 10)
    warehouse.upsert("transactions", charges.where(day < "2000-01-01"), "first", now=NOW)
    changed = charges.where(day >= "1999-01-01").withColumns({
        "amount": F.col("amount") + 1.0, "customer_email": F.lit("late@example.com")})
    warehouse.upsert("fact_transactions", changed, "second", now=NOW)
    return warehouse


_STORED_CHARGES = f"""
    select {', '.join({
        'amount': "case when transaction_date >= '1999-01-01' then amount + 1 else amount end as amount",
        'customer_email': "case when transaction_date >= '1999-01-01' then 'late@example.com' end as customer_email",
        'transaction_date': "replace(replace(transaction_date, 'T', ' '), 'Z', '') as transaction_date",
        'ingestion_timestamp': "'2026-01-01 00:00:00' as ingestion_timestamp",
    }.get(c, c) for c in TRANSACTION_NAMES)}, '2026-01-01 00:00:00' as updated_at
    from ({MAPPED['billing_charges']})"""


@query("upsert_write", _STORED_CHARGES)
def upsert_write(spark, folder):
    return _text_times(_loaded_charges(_warehouse(spark), spark, folder).read("transactions"))


@query("upsert_write_shuffled", _STORED_CHARGES)
def upsert_write_shuffled(spark, folder):
    """The same load as if the batch were too large to broadcast."""
    warehouse = _warehouse(spark, broadcast_keys=0)
    return _text_times(_loaded_charges(warehouse, spark, folder).read("transactions"))


@query("buckets_doubled", _STORED_CHARGES)
def buckets_doubled(spark, folder):
    """The same load in two parts, with the buckets doubled between them and afterwards."""
    warehouse = _warehouse(spark, buckets=4)
    mapped = mapping.billing_charges(raw(spark, folder, "billing_charges"), AS_OF)
    charges = write_curated(mapped, fresh_folder(spark, "curated"), "transactions", json=False)
    warehouse.upsert("transactions", charges.where(F.pmod(F.xxhash64("source_transaction_id"), F.lit(2)) == 0), "early", now=NOW)
    warehouse.double_buckets("transactions")
    _loaded_charges(warehouse, spark, folder)
    warehouse.double_buckets("transactions")
    return _text_times(warehouse.read("transactions"))


@query("load_audit", f"""
    with c as (select transaction_date as d from ({MAPPED['billing_charges']}))
    select 'first' as batch_id, 'fact_transactions' as target_table, count(*) as rows_processed,
      count(*) as rows_inserted, 0 as rows_updated, 'SUCCESS' as status from c where d < '2000-01-01'
    union all
    select 'second', 'fact_transactions', count(*), count(*) filter (where d >= '2000-01-01'),
      count(*) filter (where d < '2000-01-01'), 'SUCCESS' from c where d >= '1999-01-01'""")
def load_audit(spark, folder):
    return _loaded_charges(_warehouse(spark), spark, folder).audit().select(
        "batch_id", "target_table", "rows_processed", "rows_inserted", "rows_updated", "status")


_KEYS = f"""
    select 'dim_customers' as target_table, count(*) as n from ({PROFILES})
    union all select 'fact_transactions', count(distinct unified_transaction_id) from ({FACTS})
    union all select 'fact_subscriptions', count(*) from ({MAPPED['billing_subscriptions']})
      where source_customer_id is not null
    union all select 'dim_companies', count(*) from ({MAPPED['crm_companies']})"""


def _loaded_twice(spark, folder) -> Warehouse:
    """The valid rows of all four tables, loaded two times."""
    warehouse = _warehouse(spark)
    root = fresh_folder(spark, "curated")
    stored = {n: write_curated(t, root, n, json=False) for n, t in all_tables(spark, folder).items()}
    tables = {n: t.where(row_is_valid(t, ROW_RULES[n])) for n, t in stored.items()}
    order = {n: ("_row_key",) for n, t in tables.items() if "_row_key" in t.columns}
    for batch_id in ("first", "second"):
        warehouse.load_all(tables, batch_id, order_by=order, now=NOW)
    return warehouse


@query("replay_idempotent", f"""
    select 'first' as batch_id, target_table, n as rows_processed, n as rows_inserted, 0 as rows_updated from ({_KEYS})
    union all select 'second', target_table, n, 0, n from ({_KEYS})""")
def replay_idempotent(spark, folder):
    return _loaded_twice(spark, folder).audit().select(
        "batch_id", "target_table", "rows_processed", "rows_inserted", "rows_updated")


@query("load_summary", f"""
    select target_table, 2 as loads, 2 * n as rows_processed, n as rows_inserted, n as rows_updated,
      '2026-01-01T00:00:00Z' as last_synced_at from ({_KEYS})""")
def load_summary(spark, folder):
    return load_summary_of(_loaded_twice(spark, folder).audit())


# -- landed, then run or streamed -----------------------------------------------------------

# A record is landed one second after the one with the key before it, so "first landed" is
# the lowest key, which both engines can say.
_BY_KEY = PROFILES.replace("}, source_id)", "}, cast(substr(source_id, 5) as bigint))").replace(
    "), source_id)", "), cast(substr(source_id, 5) as bigint))")
_SYNCED = f"""
    select {', '.join("'2026-01-01 00:00:00' as ingestion_timestamp" if c == 'ingestion_timestamp' else
                      f"replace(replace({c}, 'T', ' '), 'Z', '') as {c}" if c.startswith('source_') and c.endswith('_at')
                      else c for c in CUSTOMER_NAMES)}
    from ({_BY_KEY})"""
_LANDED = (
    ((BILLING, "customers"), "billing_customers", "id"), ((CRM, "accounts"), "crm_accounts", "Id"),
    ((CRM, "contacts"), "crm_contacts", "Id"),
)


def _land_customers(spark, folder) -> str:
    root = fresh_folder(spark, "landing")
    for entity, adapter, key in _LANDED:
        rows = raw(spark, folder, adapter)
        number = F.substring(key, 5, 20).cast("bigint")
        write_landing(rows, root, *entity, batch_id="b1", extracted_at=F.timestamp_seconds(1704067200 + number))
    return root


@query("stream_sync", _SYNCED)
def stream_sync(spark, folder):
    """Landed files to warehouse through one stream per table."""
    warehouse = _warehouse(spark)
    sync(spark, _land_customers(spark, folder), warehouse, fresh_folder(spark, "progress"), AS_OF)
    return _text_times(warehouse.read("customers").drop("updated_at"))


@query("full_run", _SYNCED)
def full_run(spark, folder):
    """Landed files to warehouse in one run, through the quality gate."""
    warehouse = _warehouse(spark)
    run(spark, _land_customers(spark, folder), warehouse, batch_id="run", now=NOW)
    return _text_times(warehouse.read("customers").drop("updated_at"))


_VERSIONS = f"""
    select unified_transaction_id as id, status, amount from ({MAPPED['billing_charges']})
    union all select unified_account_id, 'company', null from ({MAPPED['crm_companies']})"""


@query("run_newest", _VERSIONS)
def run_newest(spark, folder):
    """Charges and accounts landed twice with other values before: a run loads the last versions."""
    warehouse, root = _warehouse(spark), fresh_folder(spark, "landing")
    charges, accounts = raw(spark, folder, "billing_charges"), raw(spark, folder, "crm_accounts")
    for batch, day, amount, name in (("z", "2024-05-12", 5, "old"), ("a", "2024-05-13", 0, None)):
        landed = charges.withColumn("amount", F.col("amount") + amount)
        landed = landed.withColumn("status", F.lit("pending")) if name else landed
        write_landing(landed, root, BILLING, "charges", batch, F.lit(day))
        write_landing(accounts.withColumn("Name", F.lit(name)) if name else accounts, root, CRM, "accounts", batch, F.lit(day))
    run(spark, root, warehouse, gate=False, batch_id="run", now=NOW)
    kept = warehouse.read("companies").where(~F.col("company_name").eqNullSafe("old"))
    return warehouse.read("transactions").select(F.col("unified_transaction_id").alias("id"), "status", "amount").unionByName(
        kept.select(F.col("unified_account_id").alias("id"), F.lit("company").alias("status"), F.lit(None).cast("double").alias("amount")))


@query("reused_batch_id", f"""
    with c as (select transaction_date as d from ({MAPPED['billing_charges']}))
    select count(*) filter (where d < '2000-01-01') as rows_inserted, 0 as rows_updated from c
    union all select count(*) filter (where d >= '2000-01-01'), 0 from c""")
def reused_batch_id(spark, folder):
    """Two loads of different rows under one batch id: each counts its own."""
    warehouse = _warehouse(spark)
    mapped = mapping.billing_charges(raw(spark, folder, "billing_charges"), AS_OF)
    day = F.substring("transaction_date", 1, 10)
    for part in (day < "2000-01-01", day >= "2000-01-01"):
        warehouse.upsert("transactions", mapped.where(part), "same", now=NOW)
    return warehouse.audit().select("rows_inserted", "rows_updated")


# -- two versions of everything, the newer one landing first ----------------------------------

_ENTITIES = (
    *_LANDED, ((BILLING, "charges"), "billing_charges", "id"), ((CRM, "opportunities"), "crm_opportunities", "Id"),
    ((CRM, "orders"), "crm_orders", "Id"), ((BILLING, "subscriptions"), "billing_subscriptions", "id"),
)
# What the older version says instead; customers and contacts are plain repeats.
_OLDER = {
    "billing_charges": {"status": "older", "amount": "1"}, "crm_opportunities": {"Amount": "2"}, "crm_orders": {"TotalAmount": "3"},
    "billing_subscriptions": {"status": "older"}, "crm_accounts": {"Name": "older", "AnnualRevenue": "4"},
}
_ALL_TABLES = f"""
    select 'customers' as dataset, unified_customer_id as id, full_name as label, null::double as amount from ({_BY_KEY})
    union all select 'transactions', unified_transaction_id, status, amount from ({FACTS})
      qualify row_number() over (partition by unified_transaction_id order by round(amount * 100) desc,
        case status when 'succeeded' then 2 when 'failed' then 1 else 0 end desc) = 1
    union all select 'subscriptions', unified_subscription_id, status, null from ({MAPPED['billing_subscriptions']})
      where source_customer_id is not null
    union all select 'companies', unified_account_id, company_name, annual_revenue from ({MAPPED['crm_companies']})"""


def _land_version(spark, folder, root: str, batch: str, day: int) -> None:
    for entity, adapter, key in _ENTITIES:
        rows = raw(spark, folder, adapter)
        number = F.substring(key, 5, 20).try_cast("bigint")
        if adapter == "crm_opportunities":      # keys stand in the table several times: the highest amount is the last
            won = F.when(F.col("IsWon"), 2).when(F.col("IsClosed"), 1).otherwise(0)
            number = F.round(F.coalesce("Amount", F.lit(0)) * 100).cast("bigint") * 3 + won
        rows = rows.withColumn("_number", F.coalesce(number, F.lit(0)))
        if batch == "older":
            rows = rows.withColumns({n: F.lit(v).cast(rows.schema[n].dataType) for n, v in _OLDER.get(adapter, {}).items()})
        at = F.timestamp_micros(F.lit((1704067200 + 86400 * day) * 1_000_000) + F.col("_number"))
        write_landing(rows.withColumn("_at", at).drop("_number"), root, *entity, batch, F.col("_at"))


def _all_tables(warehouse: Warehouse) -> DataFrame:
    columns = {
        "customers": ("unified_customer_id", "full_name", None), "transactions": ("unified_transaction_id", "status", "amount"),
        "subscriptions": ("unified_subscription_id", "status", None), "companies": ("unified_account_id", "company_name", "annual_revenue"),
    }
    frames = [
        warehouse.read(name).select(
            F.lit(name).alias("dataset"), F.col(key).alias("id"), F.col(label).alias("label"),
            (F.col(amount) if amount else F.lit(None)).cast("double").alias("amount"))
        for name, (key, label, amount) in columns.items()
    ]
    return reduce(DataFrame.unionByName, frames)


@query("sync_late_versions", _ALL_TABLES)
def sync_late_versions(spark, folder):
    """All entities in two versions, the older one landing and loading after the newer one."""
    warehouse, root, progress = _warehouse(spark, buckets=4), fresh_folder(spark, "landing"), fresh_folder(spark, "progress")
    for batch, day in (("newer", 1), ("older", 0)):
        _land_version(spark, folder, root, batch, day)
        sync(spark, root, warehouse, progress, AS_OF)
    return _all_tables(warehouse)


@query("run_late_versions", _ALL_TABLES)
def run_late_versions(spark, folder):
    """The same landings in one run; what the tables refuse is quarantined, the rest loaded."""
    warehouse, root = _warehouse(spark, buckets=4), fresh_folder(spark, "landing")
    for batch, day in (("newer", 1), ("older", 0)):
        _land_version(spark, folder, root, batch, day)
    run(spark, root, warehouse, gate=False, batch_id="run", now=NOW, on_broken="reject")
    return _all_tables(warehouse)


_BROKEN_CHARGE = "cast(substr(id, 4) as bigint) % 9"


@query("quarantine_replay", f"""
    select id as value, 'loaded' as kind from ({rows_of('billing_charges')}) where {_BROKEN_CHARGE} <> 4
    union all select 'held ' || cast(count(*) as varchar), 'mended' from ({rows_of('billing_charges')}) where {_BROKEN_CHARGE} = 3
    union all select 'held ' || cast(count(*) as varchar), 'open' from ({rows_of('billing_charges')}) where {_BROKEN_CHARGE} = 4""")
def quarantine_replay(spark, folder):
    """Charges of which every ninth line is cut off and every ninth is a list; the former are mended and land again."""
    root, progress, warehouse = fresh_folder(spark, "landing"), fresh_folder(spark, "progress"), _warehouse(spark, buckets=4)
    charges = raw(spark, folder, "billing_charges")
    sound = charges.select("id", F.to_json(F.struct(*charges.columns)).alias("text"))
    kind = F.substring("id", 4, 20).cast("bigint") % 9
    lines = sound.select("id", F.when(kind == 3, F.expr("left(text, length(text) - 5)")).when(
        kind == 4, F.concat(F.lit("["), "text", F.lit("]"))).otherwise(F.col("text")).alias("value"))
    lines.select("value").write.text(f"{entity_folder(root, BILLING, 'charges')}/year=2024/month=05/day=12")
    sync(spark, root, warehouse, progress, AS_OF)
    held = rejects_of(spark, progress)
    cut_off = held.rows().where(~F.col("text").startswith("[")).withColumn("id", F.regexp_extract("text", '"id":"([^"]+)"', 1))
    held.replay(cut_off.select("key", "id").join(sound, "id").select("key", "text"), root)
    sync(spark, root, warehouse, progress, AS_OF)
    counts = held.rows().where("reason = 'unreadable'").groupBy("is_mended").agg(F.count("*").alias("n"))
    return warehouse.read("transactions").select(F.col("source_transaction_id").alias("value"), F.lit("loaded").alias("kind")).unionByName(
        counts.select(F.concat_ws(" ", F.lit("held"), F.col("n").cast("string")).alias("value"),
                      F.when(F.col("is_mended"), "mended").otherwise("open").alias("kind")))


_MONTHS = f"""select unified_transaction_id as id, amount, substr(transaction_date, 1, 7) as month from ({MAPPED['billing_charges']})"""


@query("bounded_rewrite", f"""
    with c as ({_MONTHS}), last as (select max(month) as m from c where month < (select max(month) from c))
    select id, case when month = m then amount + 1 else amount end as amount, month = m as is_rewritten from c, last""")
def bounded_rewrite(spark, folder):
    """Charges kept by month; a batch that changes one month rewrites the files of that month alone."""
    warehouse = _warehouse(spark, buckets=2, monthly=True)
    charges = write_curated(mapping.billing_charges(raw(spark, folder, "billing_charges"), AS_OF), fresh_folder(spark, "curated"), "transactions", json=False)
    warehouse.upsert("transactions", charges, "first", now=NOW)
    stored_rows = spark.table(f"{warehouse.database}.fact_transactions")
    file = F.col("_metadata.file_path")
    before = write_curated(stored_rows.select(file.alias("file")).distinct(), fresh_folder(spark, "files"), "companies", json=False)
    month = F.substring("transaction_date", 1, 7)
    newest = charges.agg(F.max(month)).scalar()
    chosen = charges.where(month < newest).agg(F.max(month)).scalar()
    warehouse.upsert("transactions", charges.where(month == chosen).withColumn("amount", F.col("amount") + 1), "second", now=NOW)
    spark.catalog.refreshTable(f"{warehouse.database}.fact_transactions")
    after = spark.table(f"{warehouse.database}.fact_transactions").withColumn("file", file)
    return after.join(before.withColumn("is_old", F.lit(True)), "file", "left").select(
        F.col("unified_transaction_id").alias("id"), "amount", F.col("is_old").isNull().alias("is_rewritten"))

"""Alignment, unions, entity resolution and the whole canonical build."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tallyweave.catalogue.adapters import (
    AS_OF, CUSTOMER_NAMES, MAPPED, TRANSACTION_NAMES, o_email_key, raw, rows_of, table,
)
from tallyweave.catalogue.registry import query
from tallyweave.operators import mapping
from tallyweave.operators.align import align, union_loose
from tallyweave.operators.resolve import (
    merge_by_email, merge_transactions as merge_transactions_of, resolve_customers as resolve_customers_of,
)
from tallyweave.plans.canonical import build_canonical
from tallyweave.schemas import BILLING, CRM, struct_of

# The order that makes a row the first of its source: these columns are unique per source.
ORDER = ("source_id",)

_GROUPED = f"""
    select email,
      arg_min(struct_pack({{cols}}), source_id) filter (where source_system = 'stripe') as b,
      arg_min(struct_pack({{cols}}), source_id) filter (where source_system = 'salesforce') as c
    from source_rows where email is not null group by email""".replace(
    "{cols}", ", ".join(f"{n} := {n}" for n in CUSTOMER_NAMES if n != "email"))
_CRM_FIRST = ("full_name company_name phone billing_street billing_city billing_state billing_postal_code "
              "billing_country source_updated_at")
_MERGED = {
    "unified_customer_id": o_email_key("email"),
    "source_system": "case when b is not null and c is not null then 'merged' when b is not null then 'stripe' "
                     "when c is not null then 'salesforce' else 'unknown' end",
    "source_id": f"coalesce(b.source_id, c.source_id, {o_email_key('email')})",
    "stripe_customer_id": "b.stripe_customer_id",
    "salesforce_account_id": "c.salesforce_account_id",
    "salesforce_contact_id": "c.salesforce_contact_id",
    "email": "email",
    "first_name": "c.first_name", "last_name": "c.last_name",
    "preferred_currency": "coalesce(b.preferred_currency, 'USD')", "is_active": "true",
    "source_created_at": "coalesce(b.source_created_at, c.source_created_at)",
    "ingestion_timestamp": "coalesce(b.ingestion_timestamp, c.ingestion_timestamp)",
    **{n: f"coalesce(nullif(c.{n}, ''), nullif(b.{n}, ''))" for n in _CRM_FIRST.split()},
}
_BY_NAME = ", ".join(CUSTOMER_NAMES)
PROFILES = f"""
    with source_rows as (
      select {_BY_NAME} from ({MAPPED['billing_customers']})
      union all select {_BY_NAME} from ({MAPPED['crm_account_customers']})
      union all select {_BY_NAME} from ({MAPPED['crm_contacts']})),
    grouped as ({_GROUPED})
    select {', '.join(f'{_MERGED[n]} as {n}' for n in CUSTOMER_NAMES)} from grouped
    union all select {_BY_NAME} from source_rows where email is null"""
FACTS = " union all ".join(
    f"select {', '.join(TRANSACTION_NAMES)} from ({MAPPED[m]})"
    for m in ("billing_charges", "crm_opportunities", "crm_orders"))


def customer_rows(spark, folder) -> DataFrame:
    return union_loose([
        mapping.billing_customers(raw(spark, folder, "billing_customers"), AS_OF),
        mapping.crm_account_customers(raw(spark, folder, "crm_accounts"), AS_OF),
        mapping.crm_contacts(raw(spark, folder, "crm_contacts"), AS_OF),
    ])


def transactions(spark, folder) -> DataFrame:
    return merge_transactions_of(
        mapping.billing_charges(raw(spark, folder, "billing_charges"), AS_OF),
        mapping.crm_opportunities(raw(spark, folder, "crm_opportunities"), AS_OF),
        mapping.crm_orders(raw(spark, folder, "crm_orders"), AS_OF),
    )


@query("resolve_customers", PROFILES)
def resolve_customers(spark, folder):
    return resolve_customers_of(customer_rows(spark, folder), ORDER)


@query("profile_labels", f"""
    select source_system, count(*) as profiles, count(email) as with_email,
      count(stripe_customer_id) as billing_ids, count(salesforce_contact_id) as contact_ids
    from ({PROFILES}) group by source_system""")
def profile_labels(spark, folder):
    return resolve_customers(spark, folder).groupBy("source_system").agg(
        F.count(F.lit(1)).alias("profiles"), F.count("email").alias("with_email"),
        F.count("stripe_customer_id").alias("billing_ids"), F.count("salesforce_contact_id").alias("contact_ids"))


@query("resolve_hot_address", """
    with keyed as (
      select case when l_returnflag = 'A' then 'shared@example.com'
                  else 'order' || cast(l_orderkey as varchar) || '@example.com' end as email,
        case when l_linestatus = 'F' then 'stripe' else 'salesforce' end as source_system,
        l_orderkey * 10 + l_linenumber as seq, l_partkey, l_suppkey, l_shipdate, l_extendedprice
      from lineitem),
    firsts as (
      select email,
        min(struct_pack(a := seq, b := l_partkey, c := l_suppkey, d := l_shipdate, e := l_extendedprice))
          filter (where source_system = 'stripe') as b,
        min(struct_pack(a := seq, b := l_partkey, c := l_suppkey, d := l_shipdate, e := l_extendedprice))
          filter (where source_system = 'salesforce') as s
      from keyed group by email)
    select email, case when b is not null and s is not null then 'merged' when b is not null then 'stripe'
        else 'salesforce' end as source_system,
      coalesce(cast(b.a as varchar), cast(s.a as varchar)) as source_id,
      coalesce(cast(s.b as varchar), cast(b.b as varchar)) as full_name
    from firsts""")
def resolve_hot_address(spark, folder):
    """A third of all rows shares one address; they are combined before the shuffle."""
    rows = table(spark, folder, "lineitem").select(
        F.when(F.col("l_returnflag") == "A", "shared@example.com").otherwise(
            F.concat(F.lit("order"), F.col("l_orderkey").cast("string"), F.lit("@example.com"))).alias("email"),
        F.when(F.col("l_linestatus") == "F", BILLING).otherwise(CRM).alias("source_system"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
        "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
    ).withColumn("source_id", F.col("seq").cast("string")).withColumn(
        "full_name", F.col("l_partkey").cast("string"))
    order = ("seq", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    shaped = align(rows, struct_of(", ".join(f"{n} string" for n in CUSTOMER_NAMES)), order)
    return merge_by_email(shaped, order).select("email", "source_system", "source_id", "full_name")


@query("merge_transactions", FACTS)
def merge_transactions(spark, folder):
    return transactions(spark, folder)


@query("align_schema", """
    select cast(c_custkey as varchar) as id, try_cast(c_name as double) as score, cast(c_acctbal as double) as amount,
      cast(null as boolean) as is_active, try_cast(c_mktsegment as bigint) as size
    from customer""")
def align_schema(spark, folder):
    rows = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("score"), F.col("c_acctbal").alias("amount"),
        F.col("c_mktsegment").alias("size"), "c_nationkey")
    return align(rows, struct_of("id string, score double, amount double, is_active boolean, size long"))


@query("union_missing_columns", f"""
    select Id as id, Name as name, Website as website, cast(null as varchar) as email from {rows_of('crm_accounts')}
    union all
    select Id, cast(null as varchar), cast(null as varchar), Email from {rows_of('crm_contacts')}""")
def union_missing_columns(spark, folder):
    accounts = raw(spark, folder, "crm_accounts").select(
        F.col("Id").alias("id"), F.col("Name").alias("name"), F.col("Website").alias("website"))
    contacts = raw(spark, folder, "crm_contacts").select(F.col("Id").alias("id"), F.col("Email").alias("email"))
    return union_loose([accounts, contacts])


@query("split_on_email", f"""
    select email is null as is_anonymous, source_system, count(*) as n from (
      select email, source_system from ({MAPPED['billing_customers']})
      union all select email, source_system from ({MAPPED['crm_contacts']}))
    group by 1, 2""")
def split_on_email(spark, folder):
    rows = union_loose([
        mapping.billing_customers(raw(spark, folder, "billing_customers"), AS_OF),
        mapping.crm_contacts(raw(spark, folder, "crm_contacts"), AS_OF)])
    return rows.groupBy(F.col("email").isNull().alias("is_anonymous"), "source_system").agg(
        F.count(F.lit(1)).alias("n"))


def all_tables(spark, folder) -> dict[str, DataFrame]:
    """The canonical tables from the raw adapters, as the full run builds them."""
    entities = {
        (BILLING, "customers"): ("billing_customers", "id"), (CRM, "accounts"): ("crm_accounts", "Id"),
        (CRM, "contacts"): ("crm_contacts", "Id"), (BILLING, "charges"): ("billing_charges", "id"),
        (CRM, "opportunities"): ("crm_opportunities", "Id"), (CRM, "orders"): ("crm_orders", "Id"),
        (BILLING, "subscriptions"): ("billing_subscriptions", "id"),
    }
    frames = {e: raw(spark, folder, a).withColumn("_row_key", F.col(k)) for e, (a, k) in entities.items()}
    return build_canonical(frames, AS_OF, ("_row_key",))


@query("canonical_counts", f"""
    select 'customers' as dataset, count(*) as n, count(distinct unified_customer_id) as keys from ({PROFILES})
    union all select 'transactions', count(*), count(distinct unified_transaction_id) from ({FACTS})
    union all select 'subscriptions', count(*), count(distinct unified_subscription_id)
      from ({MAPPED['billing_subscriptions']})
    union all select 'companies', count(*), count(distinct unified_account_id) from ({MAPPED['crm_companies']})""")
def canonical_counts(spark, folder):
    # Keys are counted by grouping first: a distinct aggregate would expand every row.
    def count(name: str, rows: DataFrame) -> DataFrame:
        return rows.groupBy(rows.columns[0]).agg(F.count(F.lit(1)).alias("c")).agg(
            F.lit(name).alias("dataset"), F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
            F.count(F.lit(1)).alias("keys"))

    return reduce(DataFrame.unionByName, [count(n, t) for n, t in all_tables(spark, folder).items()])


@query("transaction_totals", f"""
    select source_system, status, currency, count(*) as n,
      sum(cast(round(amount * 100) as bigint))::bigint as amount_cents,
      sum(cast(round(net_amount * 100) as bigint))::bigint as net_cents
    from ({FACTS}) group by source_system, status, currency""")
def transaction_totals(spark, folder):
    def cents(name: str):
        return F.sum(F.round(F.col(name) * 100).cast("bigint"))

    return transactions(spark, folder).groupBy("source_system", "status", "currency").agg(
        F.count(F.lit(1)).alias("n"), cents("amount").alias("amount_cents"), cents("net_amount").alias("net_cents"))

"""Cleaning steps over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweave.catalogue.adapters import (
    o_currency, o_email, o_email_key, o_key, o_money, o_ref, o_time, o_trim, raw, rows_of, spark_sql, table,
)
from tallyweave.catalogue.registry import query
from tallyweave.functions.times import utc_iso
from tallyweave.functions import (
    compose_name, email_address, email_key, net_amount, or_default, source_key,
    to_long, trim_blank,
)
from tallyweave.functions.frames import (
    clean, clean_strings as clean_strings_in, impute_nulls as impute_nulls_in,
    normalize_emails as normalize_emails_in, standardize_amounts, standardize_currency,
    standardize_timestamps as standardize_timestamps_in,
)
from tallyweave.functions.keys import reference_key
from tallyweave.operators.mapping import order_is_done, order_status, won_closed_status


@query("clean_strings", f"""
    select id, {o_trim('email')} as email, {o_trim('name')} as name, {o_trim('phone')} as phone,
      {o_trim('description')} as description, {o_trim('currency')} as currency, {o_trim('created')} as created
    from {rows_of('billing_customers')}""")
def clean_strings(spark, folder):
    rows = raw(spark, folder, "billing_customers").drop("address", "balance")
    return clean_strings_in(rows)


@query("normalize_emails", f"""
    select id, email, {o_email('email')} as clean_email from {rows_of('billing_customers')}
    union all
    select Id, Email, {o_email('Email')} from {rows_of('crm_contacts')}""")
def normalize_emails(spark, folder):
    billing = raw(spark, folder, "billing_customers").select("id", "email")
    crm = raw(spark, folder, "crm_contacts").select(F.col("Id").alias("id"), F.col("Email").alias("email"))
    return normalize_emails_in(billing.unionAll(crm), "email", "clean_email")


@query("standardize_timestamps", f"""
    select id, {o_time('created')} as created from {rows_of('billing_customers')}
    union all select id, {o_time('created')} from {rows_of('billing_charges')}
    union all select Id, {o_time('LastModifiedDate')} from {rows_of('crm_accounts')}""")
def standardize_timestamps(spark, folder):
    accounts = raw(spark, folder, "crm_accounts")
    rows = raw(spark, folder, "billing_customers").select("id", "created").unionAll(
        raw(spark, folder, "billing_charges").select("id", "created")
    ).unionAll(accounts.select("Id", "LastModifiedDate"))
    return standardize_timestamps_in(rows, ["created", "not_there"])


@query("standardize_epochs", """
    select event_id,
      strftime(make_timestamp((1704067200 + event_id) * 1000000), '%Y-%m-%dT%H:%M:%SZ') as seconds,
      strftime(make_timestamp((1704067200 + event_id) * 1000000), '%Y-%m-%dT%H:%M:%SZ') as millis,
      strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as moment
    from events""")
def standardize_epochs(spark, folder):
    """Numeric and timestamp columns need no parsing of text."""
    seconds = F.lit(1704067200) + F.col("event_id")
    rows = table(spark, folder, "events").select(
        "event_id", seconds.alias("seconds"), (seconds * 1000 + 999).alias("millis"), F.col("ts").alias("moment"))
    return standardize_timestamps_in(rows, ["seconds", "millis", "moment"])


@query("amounts_cents", f"""
    select id, {o_money('amount', True)} as amount, {o_money('amount_refunded', True)} as refunded
    from {rows_of('billing_charges')}""")
def amounts_cents(spark, folder):
    rows = raw(spark, folder, "billing_charges").select("id", "amount", "amount_refunded")
    rows = standardize_amounts(rows, "amount", in_cents=True)
    return standardize_amounts(rows, "amount_refunded", in_cents=True, target_col="refunded").drop("amount_refunded")


@query("amounts_units", f"""
    select l_orderkey, l_linenumber, {o_money('l_extendedprice')} as price,
      {o_money("try_cast(case when l_returnflag = 'N' then 'n/a' else cast(l_tax as varchar) end as double)")} as tax
    from lineitem""")
def amounts_units(spark, folder):
    tax = F.when(F.col("l_returnflag") == "N", "n/a").otherwise(F.col("l_tax").cast("string"))
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"), tax.alias("tax"))
    return clean(rows, amounts={"price": "price", "tax": "tax"})


@query("net_amounts", f"""
    select id, {o_money('(amount - coalesce(amount_refunded, 0))', True)} as net from {rows_of('billing_charges')}""")
def net_amounts(spark, folder):
    rows = raw(spark, folder, "billing_charges").select("id", "amount", "amount_refunded")
    rows = clean(rows, cents={"amount": "amount", "amount_refunded": "amount_refunded"})
    return rows.select("id", net_amount(F.col("amount"), F.col("amount_refunded")).alias("net"))


@query("currency_codes", f"""
    select id, {o_currency('currency')} as currency, 'EUR' as fallback
    from {rows_of('billing_customers')}""")
def currency_codes(spark, folder):
    rows = raw(spark, folder, "billing_customers").select("id", "currency")
    return standardize_currency(standardize_currency(rows), "fallback", "EUR")


@query("impute_nulls", f"""
    select id, coalesce(amount_refunded, 0) as amount_refunded, coalesce(status, 'pending') as status,
      coalesce(paid, false) as paid
    from {rows_of('billing_charges')}""")
def impute_nulls(spark, folder):
    rows = raw(spark, folder, "billing_charges").select("id", "amount_refunded", "status", "paid")
    return impute_nulls_in(rows, {"amount_refunded": 0, "status": "pending", "paid": False, "gone": 1})


@query("deterministic_ids", f"""
    select id, {o_key('cust', 'stripe', 'id')} as customer_key, {o_key('tx', 'stripe', "nullif(email, '  ')")} as email_seed,
      {o_ref('cust', 'stripe', 'phone')} as reference, {o_email_key(o_email('email'))} as profile_key
    from {rows_of('billing_customers')}""")
def deterministic_ids(spark, folder):
    return raw(spark, folder, "billing_customers").select(
        "id",
        source_key("cust", "stripe", F.col("id")).alias("customer_key"),
        source_key("tx", "stripe", F.nullif(F.col("email"), F.lit("  "))).alias("email_seed"),
        reference_key("cust", "stripe", F.col("phone")).alias("reference"),
        email_key(email_address(F.col("email"))).alias("profile_key"),
    )


@query("flatten_struct", f"""
    select id, line1 as billing_street, city as billing_city, {o_trim('state')} as billing_state,
      postal_code as billing_postal_code, country as billing_country
    from {rows_of('billing_customers')}""")
def flatten_struct(spark, folder):
    part = {"line1": "street", "city": "city", "state": "state", "postal_code": "postal_code", "country": "country"}
    return raw(spark, folder, "billing_customers").select(
        "id", *[trim_blank(F.col(f"address.{k}")).alias(f"billing_{v}") for k, v in part.items()])


@query("compose_names", f"""
    select Id as id, case when FirstName is not null then FirstName || ' ' || {o_trim('LastName')}
      else {o_trim('LastName')} end as full_name
    from {rows_of('crm_contacts')}""")
def compose_names(spark, folder):
    name = compose_name(trim_blank(F.col("FirstName")), trim_blank(F.col("LastName")))
    return raw(spark, folder, "crm_contacts").select(F.col("Id").alias("id"), name.alias("full_name"))


@query("defaults", f"""
    select id, coalesce(nullif(currency, ''), 'USD') as currency, coalesce(amount_refunded, 0) as amount_refunded,
      coalesce(paid, false) as paid, coalesce(nullif(status, ''), 'pending') as status
    from {rows_of('billing_charges')}""")
def defaults(spark, folder):
    return raw(spark, folder, "billing_charges").select(
        "id",
        or_default(F.col("currency"), "USD").alias("currency"),
        F.coalesce("amount_refunded", F.lit(0)).alias("amount_refunded"),
        F.coalesce("paid", F.lit(False)).alias("paid"),
        or_default(F.col("status"), "pending").alias("status"),
    )


@query("integer_cast", f"""
    select Id as id, try_cast(NumberOfEmployees as bigint) as employees from {rows_of('crm_accounts')}""")
def integer_cast(spark, folder):
    return raw(spark, folder, "crm_accounts").select(
        F.col("Id").alias("id"), to_long(F.col("NumberOfEmployees")).alias("employees"))


@query("status_won_closed", f"""
    select status, is_paid, count(*) as n from (
      select case when IsWon then 'succeeded' when coalesce(IsClosed, false) then 'failed' else 'pending' end as status,
        coalesce(IsWon, false) as is_paid
      from {rows_of('crm_opportunities')})
    group by status, is_paid""")
def status_won_closed(spark, folder):
    won = F.coalesce("IsWon", F.lit(False))
    return raw(spark, folder, "crm_opportunities").select(
        won_closed_status(won, F.coalesce("IsClosed", F.lit(False))).alias("status"), won.alias("is_paid")
    ).groupBy("status", "is_paid").agg(F.count(F.lit(1)).alias("n"))


@query("status_order", f"""
    select status, is_paid, count(*) as n from (
      select case when {o_trim('Status')} = 'Activated' then 'succeeded' else 'pending' end as status,
        coalesce({o_trim('Status')} = 'Activated', false) as is_paid
      from {rows_of('crm_orders')})
    group by status, is_paid""")
def status_order(spark, folder):
    status = trim_blank(F.col("Status"))
    return raw(spark, folder, "crm_orders").select(
        order_status(status).alias("status"), order_is_done(status).alias("is_paid")
    ).groupBy("status", "is_paid").agg(F.count(F.lit(1)).alias("n"))


@query("status_lower", f"""
    select lower({o_trim('status')}) as status, count(*) as n from {rows_of('billing_subscriptions')} group by 1""")
def status_lower(spark, folder):
    return raw(spark, folder, "billing_subscriptions").groupBy(
        F.lower(trim_blank(F.col("status"))).alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("audit_columns", """
    select event_id, 'stripe' as source_system, '2026-01-01T00:00:00Z' as ingestion_timestamp,
      cast(null as varchar) as customer_email, true as is_active
    from events""")
def audit_columns(spark, folder):
    return spark_sql(spark, folder, "select event_id from {events}").select(
        "event_id", F.lit("stripe").alias("source_system"), F.lit("2026-01-01T00:00:00Z").alias("ingestion_timestamp"),
        F.lit(None).cast("string").alias("customer_email"), F.lit(True).alias("is_active"))


# Layouts of a date text, by the remainder of the order key.
_LAYOUTS = (
    "yyyyMMdd", "MM/dd/yyyy HH:mm", "M/d/yyyy h:mm a", "MMM d yyyy h:mm a", "yyyy-M-d", "d-MMM-yyyy", "M.d.yyyy",
    "EEE MMM d HH:mm:ss yyyy",
)


@query("standardize_layouts", "select o_orderkey, strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') as at from orders")
def standardize_layouts(spark, folder):
    """Order dates written in further layouts and read again."""
    orders = table(spark, folder, "orders")
    day = F.date_trunc("day", F.col("o_orderdate"))
    texts = [F.when(F.col("o_orderkey") % len(_LAYOUTS) == k, F.date_format(day, layout)) for k, layout in enumerate(_LAYOUTS)]
    return orders.select("o_orderkey", F.coalesce(*texts).alias("text")).select("o_orderkey", utc_iso(F.col("text")).alias("at"))

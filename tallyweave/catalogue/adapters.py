"""Raw billing and CRM rows derived from the test tables.

The adapters are SQL that both engines run; ``{customer}`` and so on stand for the tables.
They put in dirt on purpose: blanks, padding, upper case, broken e-mail addresses, nulls and
timestamps in several forms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
AS_OF = "2026-01-01T00:00:00Z"

ADAPTERS = {
    "billing_customers": """
        select 'cus_' || cast(c_custkey as string) as id,
          case c_custkey % 11
            when 0 then null
            when 1 then '  '
            when 2 then 'not-an-email'
            when 3 then upper('user' || cast(cast(floor(c_custkey / 5) as bigint) as string) || '@example.com')
            when 4 then chr(9) || ' user' || cast(cast(floor(c_custkey / 5) as bigint) as string)
                        || '@Example.com' || chr(160)
            else 'user' || cast(cast(floor(c_custkey / 5) as bigint) as string) || '@example.com'
          end as email,
          case when c_custkey % 17 = 0 then ' ' else '  ' || c_name || chr(9) end as name,
          case when c_custkey % 6 = 0 then null else '+1-555-' || cast(c_custkey as string) end as phone,
          c_mktsegment as description,
          case c_nationkey % 3 when 0 then 'usd' when 1 then ' EUR ' else '' end as currency,
          cast(round(c_acctbal * 100) as bigint) as balance,
          case c_custkey % 5
            when 0 then cast(1704067200 + (c_custkey % 5000) * 86400 as string)
            when 1 then cast((1704067200 + (c_custkey % 5000) * 3600) * cast(1000 as bigint) as string)
            when 2 then cast(date '2024-01-01' + cast(c_custkey % 365 as int) as string)
                        || 'T08:30:00.000+0000'
            when 3 then ' ' || cast(date '2023-06-01' + cast(c_custkey % 365 as int) as string)
                        || ' 15:45:10'
            else 'not-a-date'
          end as created,
          cast(c_custkey as string) || ' Main St' as line1,
          'City ' || cast(c_nationkey as string) as city,
          case when c_nationkey % 4 = 0 then '' else 'S' || cast(c_nationkey as string) end as state,
          cast(10000 + c_custkey % 90000 as string) as postal_code,
          case when c_custkey % 9 = 0 then null else 'N' || cast(c_nationkey as string) end as country
        from {customer}""",
    "crm_accounts": """
        select 'acc_' || cast(s_suppkey as string) as Id,
          case when s_suppkey % 13 = 0 then null else ' ' || s_name end as Name,
          case s_suppkey % 3 when 0 then 'Technology' when 1 then 'Financial Services' else ' ' end as Industry,
          case when s_suppkey % 10 = 0 then null else s_acctbal end as AnnualRevenue,
          case when s_suppkey % 5 = 0 then 'many' else cast(s_nationkey * 10 as string) end as NumberOfEmployees,
          'https://s' || cast(s_suppkey as string) || '.example.com' as Website,
          '+1-800-' || cast(s_suppkey as string) as Phone,
          cast(s_suppkey as string) || ' Market St' as BillingStreet,
          'Town ' || cast(s_nationkey as string) as BillingCity,
          cast(null as string) as BillingState,
          cast(20000 + s_suppkey % 70000 as string) as BillingPostalCode,
          n_name as BillingCountry,
          cast(date '2024-01-01' + cast(s_suppkey % 28 as int) as string) || 'T08:00:00.000+0000' as CreatedDate,
          cast(date '2024-02-01' + cast(s_suppkey % 28 as int) as string) || 'T08:00:00+05:30' as LastModifiedDate
        from {supplier} join {nation} on s_nationkey = n_nationkey""",
    "crm_contacts": """
        select 'con_' || cast(s_suppkey as string) as Id,
          'acc_' || cast(s_suppkey as string) as AccountId,
          case when s_suppkey % 4 = 0 then null else 'Jane' end as FirstName,
          case when s_suppkey % 9 = 0 then null else ' Doe ' || cast(s_suppkey as string) end as LastName,
          case when s_suppkey % 7 = 0 then null
               else 'User' || cast(s_suppkey * 5 as string) || '@EXAMPLE.com' end as Email,
          case when s_suppkey % 5 = 0 then '' else '+1-900-' || cast(s_suppkey as string) end as Phone,
          cast(date '2024-01-01' + cast(s_suppkey % 28 as int) as string) || 'T08:00:00.000+0000' as CreatedDate,
          cast(date '2024-03-01' + cast(s_suppkey % 28 as int) as string) || 'T20:15:00.000+0000' as LastModifiedDate
        from {supplier}""",
    "billing_charges": """
        select 'ch_' || cast(o_orderkey as string) as id,
          cast(round(o_totalprice * 100) as bigint) as amount,
          case when o_orderkey % 7 = 0 then 500 when o_orderkey % 5 = 0 then null else 0 end as amount_refunded,
          case when o_orderpriority = '1-URGENT' then 'eur' when o_orderpriority = '5-LOW' then ' ' else 'usd' end
            as currency,
          case when o_orderkey % 19 = 0 then null when o_orderkey % 23 = 0 then ' '
               else 'cus_' || cast(o_custkey as string) end as customer,
          case o_orderstatus when 'F' then 'Succeeded' when 'O' then ' FAILED ' else null end as status,
          case when o_orderkey % 11 = 0 then null else o_orderstatus = 'F' end as paid,
          o_orderkey % 7 = 0 as refunded,
          case when o_orderstatus = 'P' then null else 'card' end as payment_method,
          case o_orderstatus
            when 'F' then replace(cast(o_orderdate as string), ' ', 'T') || 'Z'
            when 'O' then cast(o_orderdate as string)
            else replace(cast(o_orderdate as string), ' ', 'T') || '.000+0000' end as created
        from {orders}""",
    "billing_subscriptions": """
        select 'sub_' || cast(event_id as string) as id,
          case when event_id % 29 = 0 then null else 'cus_' || cast(user_id as string) end as customer,
          case event_type when 'signup' then null when 'view' then 'Active' when 'click' then 'PAST_DUE'
               when 'error' then ' Canceled ' else 'trialing' end as status,
          substr(cast(ts as string), 1, 19) as current_period_start,
          case when event_type = 'purchase' then null
               else replace(substr(cast(ts as string), 1, 19), ' ', 'T') || 'Z' end as current_period_end,
          case when event_type = 'view' then null else event_type = 'error' end as cancel_at_period_end,
          replace(substr(cast(ts as string), 1, 19), ' ', 'T') || '.000+0000' as created
        from {events}""",
    "crm_opportunities": """
        select cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as Id,
          case when l_suppkey % 8 = 0 then '' else 'acc_' || cast(l_suppkey as string) end as AccountId,
          case when l_quantity = 1 then null else l_extendedprice end as Amount,
          l_returnflag = 'A' as IsWon,
          case when l_linestatus = 'O' then null else l_returnflag in ('A', 'R') end as IsClosed,
          replace(cast(l_shipdate as string), ' ', 'T') || '.000+0000' as CreatedDate
        from {lineitem}""",
    "crm_orders": """
        select 'ord_' || cast(o_orderkey as string) as Id,
          case when o_orderkey % 31 = 0 then null else 'acc_' || cast(o_custkey as string) end as AccountId,
          case o_orderstatus when 'F' then 'Activated' when 'O' then ' Activated ' else null end as Status,
          o_totalprice as TotalAmount,
          cast(o_orderdate as string) as CreatedDate
        from {orders}""",
}


def fill(sql: str, names: dict[str, str]) -> str:
    """Put table names into SQL text."""
    for name, value in names.items():
        sql = sql.replace("{" + name + "}", value)
    return sql


def spark_sql(spark: SparkSession, folder: str, sql: str) -> DataFrame:
    return spark.sql(fill(sql, {t: f"parquet.`{folder}/{t}.parquet`" for t in TABLES}))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw(spark: SparkSession, folder: str, adapter: str) -> DataFrame:
    """Rows of an adapter in the shape of the raw entity."""
    rows = spark_sql(spark, folder, ADAPTERS[adapter])
    if adapter == "billing_customers":
        parts = ("city", "country", "line1", "postal_code", "state")
        rows = rows.withColumn("address", F.struct(*parts)).drop(*parts)
    return rows


# --------------------------------------------------------------------------
# The same cleaning steps in the dialect of the checking engine
# --------------------------------------------------------------------------

_SPACES = "||".join(f"chr({c})" for c in (
    9, 10, 11, 12, 13, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288))
_FORM = "'%Y-%m-%dT%H:%M:%SZ'"


def plain(sql: str) -> str:
    """SQL text with the bare table names."""
    return fill(sql, {t: t for t in TABLES})


def rows_of(adapter: str) -> str:
    return f"({plain(ADAPTERS[adapter])})"


def o_trim(x: str) -> str:
    return f"nullif(trim({x}, {_SPACES}), '')"


def o_email(x: str) -> str:
    address = f"lower({o_trim(x)})"
    return (f"case when regexp_matches({address}, '^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\\.[a-zA-Z0-9-.]+$') "
            f"then {address} end")


def o_time(x: str) -> str:
    text = o_trim(x)
    number = f"try_cast({text} as double)"
    seconds = f"(case when {number} > 1e11 then {number} / 1000 else {number} end)"
    epoch = (f"case when {seconds} between -62135596800 and 253402300799 "
             f"then strftime(make_timestamp(cast(floor({seconds} * 1000000) as bigint)), {_FORM}) end")
    iso = (f"case when regexp_matches({text}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') "
           f"then strftime(make_timestamp(epoch_us(try_cast({text} as timestamptz))), {_FORM}) end")
    return f"case when {number} is not null then {epoch} else {iso} end"


def o_money(x: str, cents: bool = False) -> str:
    return f"coalesce(round({x}{'::double / 100::double' if cents else ''}, 2), 0)::double"


def o_currency(x: str) -> str:
    return f"coalesce(upper({o_trim(x)}), 'USD')"


def o_key(prefix: str, space: str, x: str) -> str:
    return f"'{prefix}_' || substr(sha256('{space}::' || coalesce({x}, 'None')), 1, 16)"


def o_ref(prefix: str, space: str, x: str) -> str:
    return f"case when {x} is not null then {o_key(prefix, space, x)} end"


def o_email_key(x: str) -> str:
    return f"'cust_' || substr(sha256('cust_email_' || {x}), 1, 16)"


# Canonical tables in the dialect of the checking engine. Columns that a mapping does not
# have are null.

def _columns(names: str, given: dict[str, str]) -> str:
    return ", ".join(f"{given.get(n, 'cast(null as varchar)')} as {n}" for n in names.split())


_CUSTOMER = (
    "unified_customer_id source_system source_id stripe_customer_id salesforce_account_id "
    "salesforce_contact_id email full_name first_name last_name company_name phone billing_street "
    "billing_city billing_state billing_postal_code billing_country preferred_currency is_active "
    "source_created_at source_updated_at ingestion_timestamp"
)
_TRANSACTION = (
    "unified_transaction_id source_system source_transaction_id unified_customer_id "
    "source_customer_id customer_email amount amount_refunded net_amount currency status "
    "payment_method is_paid is_refunded transaction_date ingestion_timestamp"
)
_SUBSCRIPTION = (
    "unified_subscription_id source_system source_subscription_id unified_customer_id "
    "source_customer_id status mrr_amount currency current_period_start current_period_end "
    "cancel_at_period_end created_at ingestion_timestamp"
)
_COMPANY = (
    "unified_account_id source_system source_account_id company_name industry annual_revenue "
    "employee_count website phone billing_country created_at updated_at ingestion_timestamp"
)
_NAME = f"coalesce({o_trim('Name')}, 'Unnamed Account')"
_LAST = f"coalesce({o_trim('LastName')}, 'Unknown')"

MAPPED = {
    "billing_customers": "select " + _columns(_CUSTOMER, {
        "unified_customer_id": o_key("cust", "stripe", "id"), "source_system": "'stripe'",
        "source_id": "id", "stripe_customer_id": "id", "email": o_email("email"),
        "full_name": o_trim("name"), "company_name": o_trim("description"), "phone": o_trim("phone"),
        "billing_street": o_trim("line1"), "billing_city": o_trim("city"), "billing_state": o_trim("state"),
        "billing_postal_code": o_trim("postal_code"), "billing_country": o_trim("country"),
        "preferred_currency": o_currency("currency"), "is_active": "true",
        "source_created_at": o_time("created"), "source_updated_at": o_time("created"),
        "ingestion_timestamp": f"'{AS_OF}'",
    }) + " from " + rows_of("billing_customers"),
    "crm_account_customers": "select " + _columns(_CUSTOMER, {
        "unified_customer_id": o_key("cust", "salesforce_acc", "Id"), "source_system": "'salesforce'",
        "source_id": "Id", "salesforce_account_id": "Id", "full_name": _NAME, "company_name": _NAME,
        "phone": o_trim("Phone"), "billing_street": o_trim("BillingStreet"),
        "billing_city": o_trim("BillingCity"), "billing_state": o_trim("BillingState"),
        "billing_postal_code": o_trim("BillingPostalCode"), "billing_country": o_trim("BillingCountry"),
        "preferred_currency": "'USD'", "is_active": "true", "source_created_at": o_time("CreatedDate"),
        "source_updated_at": o_time("LastModifiedDate"), "ingestion_timestamp": f"'{AS_OF}'",
    }) + " from " + rows_of("crm_accounts"),
    "crm_contacts": "select " + _columns(_CUSTOMER, {
        "unified_customer_id": o_key("cust", "salesforce_con", "Id"), "source_system": "'salesforce'",
        "source_id": "Id", "salesforce_account_id": "AccountId", "salesforce_contact_id": "Id",
        "email": o_email("Email"),
        "full_name": f"case when {o_trim('FirstName')} is not null then {o_trim('FirstName')} || ' ' || {_LAST} "
                     f"else {_LAST} end",
        "first_name": o_trim("FirstName"), "last_name": _LAST, "phone": o_trim("Phone"),
        "preferred_currency": "'USD'", "is_active": "true", "source_created_at": o_time("CreatedDate"),
        "source_updated_at": o_time("LastModifiedDate"), "ingestion_timestamp": f"'{AS_OF}'",
    }) + " from " + rows_of("crm_contacts"),
    "billing_charges": "select " + _columns(_TRANSACTION, {
        "unified_transaction_id": o_key("tx", "stripe", "id"), "source_system": "'stripe'",
        "source_transaction_id": "id", "unified_customer_id": o_ref("cust", "stripe", o_trim("customer")),
        "source_customer_id": o_trim("customer"), "amount": o_money("amount", True),
        "amount_refunded": o_money("amount_refunded", True),
        "net_amount": o_money("(amount - coalesce(amount_refunded, 0))", True),
        "currency": o_currency("currency"), "status": f"lower(coalesce({o_trim('status')}, 'pending'))",
        "payment_method": "payment_method", "is_paid": "coalesce(paid, false)",
        "is_refunded": "coalesce(refunded, false)", "transaction_date": o_time("created"),
        "ingestion_timestamp": f"'{AS_OF}'",
    }) + " from " + rows_of("billing_charges"),
    "crm_opportunities": "select " + _columns(_TRANSACTION, {
        "unified_transaction_id": o_key("tx", "salesforce_opp", "Id"), "source_system": "'salesforce'",
        "source_transaction_id": "Id",
        "unified_customer_id": o_ref("cust", "salesforce_acc", o_trim("AccountId")),
        "source_customer_id": o_trim("AccountId"), "amount": o_money("Amount"), "amount_refunded": "0::double",
        "net_amount": o_money("Amount"), "currency": "'USD'",
        "status": "case when IsWon then 'succeeded' when coalesce(IsClosed, false) then 'failed' else 'pending' end",
        "payment_method": "'Salesforce Invoice / Deal'", "is_paid": "coalesce(IsWon, false)",
        "is_refunded": "false", "transaction_date": o_time("CreatedDate"), "ingestion_timestamp": f"'{AS_OF}'",
    }) + " from " + rows_of("crm_opportunities"),
    "crm_orders": "select " + _columns(_TRANSACTION, {
        "unified_transaction_id": o_key("tx", "salesforce_ord", "Id"), "source_system": "'salesforce'",
        "source_transaction_id": "Id",
        "unified_customer_id": o_ref("cust", "salesforce_acc", o_trim("AccountId")),
        "source_customer_id": o_trim("AccountId"), "amount": o_money("TotalAmount"),
        "amount_refunded": "0::double", "net_amount": o_money("TotalAmount"), "currency": "'USD'",
        "status": f"case when coalesce({o_trim('Status')}, 'Draft') = 'Activated' then 'succeeded' else 'pending' end",
        "payment_method": "'Salesforce Direct Order'",
        "is_paid": f"coalesce({o_trim('Status')}, 'Draft') = 'Activated'", "is_refunded": "false",
        "transaction_date": o_time("CreatedDate"), "ingestion_timestamp": f"'{AS_OF}'",
    }) + " from " + rows_of("crm_orders"),
    "billing_subscriptions": "select " + _columns(_SUBSCRIPTION, {
        "unified_subscription_id": o_key("sub", "stripe", "id"), "source_system": "'stripe'",
        "source_subscription_id": "id", "unified_customer_id": o_ref("cust", "stripe", "customer"),
        "source_customer_id": "customer", "status": f"lower(coalesce({o_trim('status')}, 'active'))",
        "mrr_amount": "0::double", "currency": "'USD'", "current_period_start": o_time("current_period_start"),
        "current_period_end": o_time("current_period_end"),
        "cancel_at_period_end": "coalesce(cancel_at_period_end, false)", "created_at": o_time("created"),
        "ingestion_timestamp": f"'{AS_OF}'",
    }) + " from " + rows_of("billing_subscriptions"),
    "crm_companies": "select " + _columns(_COMPANY, {
        "unified_account_id": o_key("org", "salesforce", "Id"), "source_system": "'salesforce'",
        "source_account_id": "Id", "company_name": _NAME, "industry": o_trim("Industry"),
        "annual_revenue": o_money("AnnualRevenue"), "employee_count": "try_cast(NumberOfEmployees as bigint)",
        "website": o_trim("Website"), "phone": o_trim("Phone"), "billing_country": o_trim("BillingCountry"),
        "created_at": o_time("CreatedDate"), "updated_at": o_time("LastModifiedDate"),
        "ingestion_timestamp": f"'{AS_OF}'",
    }) + " from " + rows_of("crm_accounts"),
}
CUSTOMER_NAMES = _CUSTOMER.split()
TRANSACTION_NAMES = _TRANSACTION.split()
SUBSCRIPTION_NAMES = _SUBSCRIPTION.split()
COMPANY_NAMES = _COMPANY.split()

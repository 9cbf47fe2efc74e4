"""Raw entities to canonical tables.

Every mapping is one ``select`` of column expressions: no shuffle, no Python per row, and
usable on a stream. ``keep`` passes further columns through, such as the landing order.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from tallyweave.functions.frames import clean
from tallyweave.functions.keys import reference_key, source_key
from tallyweave.functions.numbers import net_amount, to_long
from tallyweave.functions.text import DEFAULT_CURRENCY, compose_name, or_default
from tallyweave.schemas import BILLING, CANONICAL, CRM

# The namespaces that go into the keys of CRM rows.
ACCOUNT_SPACE = "salesforce_acc"
CONTACT_SPACE = "salesforce_con"
OPPORTUNITY_SPACE = "salesforce_opp"
ORDER_SPACE = "salesforce_ord"
# Texts that the mappings write.
DEAL_METHOD = "Salesforce Invoice / Deal"
ORDER_METHOD = "Salesforce Direct Order"
SUCCEEDED, FAILED, PENDING, ACTIVE = "succeeded", "failed", "pending", "active"
ORDER_DONE = "Activated"
UNNAMED_ACCOUNT, UNKNOWN_NAME, DRAFT = "Unnamed Account", "Unknown", "Draft"


def _flag(name: str) -> Column:
    return F.coalesce(F.col(name).try_cast("boolean"), F.lit(False))


def _emit(raw: DataFrame, dataset: str, keep: Sequence[str], **columns: Any) -> DataFrame:
    """Select the canonical columns in order; plain values are constants, absent ones null."""
    out = []
    for field in CANONICAL[dataset].fields:
        value, kind = columns.get(field.name), field.dataType.simpleString()
        if value is None:
            out.append(F.expr(f"cast(null as {kind}) as {field.name}"))
        else:
            value = value if isinstance(value, Column) else F.lit(value)
            out.append(value.cast(kind).alias(field.name))
    return raw.select(*out, *keep)


def won_closed_status(won: Column, closed: Column) -> Column:
    return F.when(won, SUCCEEDED).when(closed, FAILED).otherwise(PENDING)


def order_is_done(status: Column) -> Column:
    return status.eqNullSafe(F.lit(ORDER_DONE))


def order_status(status: Column) -> Column:
    return F.when(order_is_done(status), SUCCEEDED).otherwise(PENDING)


def billing_customers(raw: DataFrame, as_of: str, keep: Sequence[str] = ()) -> DataFrame:
    parts = {
        "billing_street": "line1", "billing_city": "city", "billing_state": "state",
        "billing_postal_code": "postal_code", "billing_country": "country",
    }
    flat = raw.withColumns({name: F.col(f"address.{part}") for name, part in parts.items()})
    rows = clean(
        flat, text=["id", "name", "description", "phone", *parts], emails={"email": "email"},
        currencies={"currency": DEFAULT_CURRENCY}, times=["created"])
    return _emit(
        rows, "customers", keep,
        unified_customer_id=source_key("cust", BILLING, F.col("id")),
        source_system=BILLING,
        source_id=F.col("id"),
        stripe_customer_id=F.col("id"),
        email=F.col("email"),
        full_name=F.col("name"),
        company_name=F.col("description"),
        phone=F.col("phone"),
        preferred_currency=F.col("currency"),
        is_active=True,
        source_created_at=F.col("created"),
        source_updated_at=F.col("created"),
        ingestion_timestamp=as_of,
        **{name: F.col(name) for name in parts},
    )


def billing_charges(raw: DataFrame, as_of: str, keep: Sequence[str] = ()) -> DataFrame:
    rows = clean(
        raw, text=["id", "customer", "status", "payment_method"], times=["created"],
        cents={"amount": "amount", "amount_refunded": "amount_refunded"},
        currencies={"currency": DEFAULT_CURRENCY})
    customer = F.col("customer")
    return _emit(
        rows, "transactions", keep,
        unified_transaction_id=source_key("tx", BILLING, F.col("id")),
        source_system=BILLING,
        source_transaction_id=F.col("id"),
        unified_customer_id=reference_key("cust", BILLING, customer),
        source_customer_id=customer,
        amount=F.col("amount"),
        amount_refunded=F.col("amount_refunded"),
        net_amount=net_amount(F.col("amount"), F.col("amount_refunded")),
        currency=F.col("currency"),
        status=F.lower(F.coalesce("status", F.lit(PENDING))),
        payment_method=F.col("payment_method"),
        is_paid=_flag("paid"),
        is_refunded=_flag("refunded"),
        transaction_date=F.col("created"),
        ingestion_timestamp=as_of,
    )


def billing_subscriptions(raw: DataFrame, as_of: str, keep: Sequence[str] = ()) -> DataFrame:
    # An absent or empty status gets the default; one that is only blanks ends up null.
    rows = raw.withColumn("status", or_default(F.col("status").cast("string"), ACTIVE))
    rows = clean(
        rows, text=["id", "customer", "status"],
        times=["created", "current_period_start", "current_period_end"])
    customer = F.col("customer")
    return _emit(
        rows, "subscriptions", keep,
        unified_subscription_id=source_key("sub", BILLING, F.col("id")),
        source_system=BILLING,
        source_subscription_id=F.col("id"),
        unified_customer_id=reference_key("cust", BILLING, customer),
        source_customer_id=customer,
        status=F.lower("status"),
        mrr_amount=0.0,
        currency=DEFAULT_CURRENCY,
        current_period_start=F.col("current_period_start"),
        current_period_end=F.col("current_period_end"),
        cancel_at_period_end=_flag("cancel_at_period_end"),
        created_at=F.col("created"),
        ingestion_timestamp=as_of,
    )


_ADDRESS = {
    "billing_street": "BillingStreet", "billing_city": "BillingCity", "billing_state": "BillingState",
    "billing_postal_code": "BillingPostalCode", "billing_country": "BillingCountry",
}


_CHANGES = ("CreatedDate", "LastModifiedDate")


def crm_companies(raw: DataFrame, as_of: str, keep: Sequence[str] = ()) -> DataFrame:
    rows = clean(
        raw, text=["Id", "Name", "Industry", "NumberOfEmployees", "Website", "Phone", "BillingCountry"],
        times=_CHANGES, amounts={"AnnualRevenue": "AnnualRevenue"}, defaults={"Name": UNNAMED_ACCOUNT})
    return _emit(
        rows, "companies", keep,
        unified_account_id=source_key("org", CRM, F.col("Id")),
        source_system=CRM,
        source_account_id=F.col("Id"),
        company_name=F.col("Name"),
        industry=F.col("Industry"),
        annual_revenue=F.col("AnnualRevenue"),
        employee_count=to_long(F.col("NumberOfEmployees")),
        website=F.col("Website"),
        phone=F.col("Phone"),
        billing_country=F.col("BillingCountry"),
        created_at=F.col("CreatedDate"),
        updated_at=F.col("LastModifiedDate"),
        ingestion_timestamp=as_of,
    )


def crm_account_customers(raw: DataFrame, as_of: str, keep: Sequence[str] = ()) -> DataFrame:
    rows = clean(
        raw, text=["Id", "Name", "Phone", *_ADDRESS.values()], times=_CHANGES,
        defaults={"Name": UNNAMED_ACCOUNT})
    return _emit(
        rows, "customers", keep,
        unified_customer_id=source_key("cust", ACCOUNT_SPACE, F.col("Id")),
        source_system=CRM,
        source_id=F.col("Id"),
        salesforce_account_id=F.col("Id"),
        full_name=F.col("Name"),
        company_name=F.col("Name"),
        phone=F.col("Phone"),
        preferred_currency=DEFAULT_CURRENCY,
        is_active=True,
        source_created_at=F.col("CreatedDate"),
        source_updated_at=F.col("LastModifiedDate"),
        ingestion_timestamp=as_of,
        **{name: F.col(part) for name, part in _ADDRESS.items()},
    )


def crm_contacts(raw: DataFrame, as_of: str, keep: Sequence[str] = ()) -> DataFrame:
    rows = clean(
        raw, text=["Id", "AccountId", "FirstName", "LastName", "Phone"], emails={"Email": "Email"},
        times=_CHANGES, defaults={"LastName": UNKNOWN_NAME})
    return _emit(
        rows, "customers", keep,
        unified_customer_id=source_key("cust", CONTACT_SPACE, F.col("Id")),
        source_system=CRM,
        source_id=F.col("Id"),
        salesforce_account_id=F.col("AccountId"),
        salesforce_contact_id=F.col("Id"),
        email=F.col("Email"),
        full_name=compose_name(F.col("FirstName"), F.col("LastName")),
        first_name=F.col("FirstName"),
        last_name=F.col("LastName"),
        phone=F.col("Phone"),
        preferred_currency=DEFAULT_CURRENCY,
        is_active=True,
        source_created_at=F.col("CreatedDate"),
        source_updated_at=F.col("LastModifiedDate"),
        ingestion_timestamp=as_of,
    )


def _crm_transactions(
    rows: DataFrame, as_of: str, keep: Sequence[str], space: str, amount: str, method: str,
    status: Column, is_paid: Column,
) -> DataFrame:
    account = F.col("AccountId")
    return _emit(
        rows, "transactions", keep,
        unified_transaction_id=source_key("tx", space, F.col("Id")),
        source_system=CRM,
        source_transaction_id=F.col("Id"),
        unified_customer_id=reference_key("cust", ACCOUNT_SPACE, account),
        source_customer_id=account,
        amount=F.col(amount),
        amount_refunded=0.0,
        net_amount=F.col(amount),
        currency=DEFAULT_CURRENCY,
        status=status,
        payment_method=method,
        is_paid=is_paid,
        is_refunded=False,
        transaction_date=F.col("CreatedDate"),
        ingestion_timestamp=as_of,
    )


def crm_opportunities(raw: DataFrame, as_of: str, keep: Sequence[str] = ()) -> DataFrame:
    rows = clean(raw, text=["Id", "AccountId"], times=["CreatedDate"], amounts={"Amount": "Amount"})
    won = _flag("IsWon")
    return _crm_transactions(
        rows, as_of, keep, OPPORTUNITY_SPACE, "Amount", DEAL_METHOD,
        won_closed_status(won, _flag("IsClosed")), won)


def crm_orders(raw: DataFrame, as_of: str, keep: Sequence[str] = ()) -> DataFrame:
    rows = clean(
        raw, text=["Id", "AccountId", "Status"], times=["CreatedDate"],
        amounts={"TotalAmount": "TotalAmount"}, defaults={"Status": DRAFT})
    status = F.col("Status")
    return _crm_transactions(
        rows, as_of, keep, ORDER_SPACE, "TotalAmount", ORDER_METHOD, order_status(status), order_is_done(status))

"""From raw entities to the four canonical tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tallyweave.operators import mapping
from tallyweave.operators.align import align, union_loose
from tallyweave.operators.merge import last_per_key
from tallyweave.operators.resolve import merge_transactions, resolve_customers
from tallyweave.schemas import BILLING, COMPANIES, CRM, CUSTOMERS, SUBSCRIPTIONS

Raw = Mapping[tuple[str, str], DataFrame]

# Entity, the dataset it feeds, and its mapping.
STEPS: tuple[tuple[tuple[str, str], str, Callable[..., DataFrame]], ...] = (
    ((BILLING, "customers"), "customers", mapping.billing_customers),
    ((CRM, "accounts"), "customers", mapping.crm_account_customers),
    ((CRM, "contacts"), "customers", mapping.crm_contacts),
    ((BILLING, "charges"), "transactions", mapping.billing_charges),
    ((CRM, "opportunities"), "transactions", mapping.crm_opportunities),
    ((CRM, "orders"), "transactions", mapping.crm_orders),
    ((BILLING, "subscriptions"), "subscriptions", mapping.billing_subscriptions),
    ((CRM, "accounts"), "companies", mapping.crm_companies),
)


def source_rows(raw: Raw, dataset: str, as_of: str, keep: Sequence[str] = ()) -> DataFrame:
    """All source rows of one dataset in canonical form: maps and a union, no shuffle."""
    return union_loose([
        step(raw[entity], as_of, keep) for entity, name, step in STEPS if name == dataset and entity in raw
    ])


def build_canonical(
    raw: Raw, as_of: str, order_by: Sequence[str], customer_rows: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The canonical tables. ``order_by`` are columns of the raw tables that give their order.

    ``customer_rows`` stands in for the mapped customers when they have been stored before;
    resolving reads them twice. Facts and companies keep the order columns, so that a load can
    tell the versions of a record apart; of a customer without an address the last one stays.
    """
    if customer_rows is None:
        customer_rows = source_rows(raw, "customers", as_of, order_by)
    return {
        "customers": resolve_customers(newest_without_address(customer_rows, order_by), order_by),
        "transactions": merge_transactions(source_rows(raw, "transactions", as_of, order_by), keep=order_by),
        "subscriptions": align(source_rows(raw, "subscriptions", as_of, order_by), SUBSCRIPTIONS, order_by),
        "companies": align(source_rows(raw, "companies", as_of, order_by), COMPANIES, order_by),
    }


def newest_without_address(rows: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """All rows with an address, and the last version of each record without one."""
    key = CUSTOMERS.fieldNames()[0]
    plain = F.col("email").isNull() & F.col(key).isNotNull()
    return rows.where(~plain).unionByName(last_per_key(rows.where(plain), key, order_by))

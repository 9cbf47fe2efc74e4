"""One customer profile per e-mail address, and the union of transactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyweave.functions.keys import email_key
from tallyweave.functions.text import DEFAULT_CURRENCY
from tallyweave.operators.align import align, union_aligned
from tallyweave.schemas import BILLING, CRM, CUSTOMERS, MERGED, TRANSACTIONS, UNKNOWN

# Survivorship as data: for each column, the sources to ask, first answer wins. Empty text
# is no answer where two sources compete.
SURVIVORSHIP: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("source_id", (BILLING, CRM)),
    ("stripe_customer_id", (BILLING,)),
    ("salesforce_account_id", (CRM,)),
    ("salesforce_contact_id", (CRM,)),
    ("full_name", (CRM, BILLING)),
    ("first_name", (CRM,)),
    ("last_name", (CRM,)),
    ("company_name", (CRM, BILLING)),
    ("phone", (CRM, BILLING)),
    ("billing_street", (CRM, BILLING)),
    ("billing_city", (CRM, BILLING)),
    ("billing_state", (CRM, BILLING)),
    ("billing_postal_code", (CRM, BILLING)),
    ("billing_country", (CRM, BILLING)),
    ("preferred_currency", (BILLING,)),
    ("source_created_at", (BILLING, CRM)),
    ("source_updated_at", (CRM, BILLING)),
    ("ingestion_timestamp", (BILLING, CRM)),
)
_ROW_OF = {BILLING: "_billing", CRM: "_crm"}


def _first_row(source: str, order: Column) -> Column:
    """The first row of one source in a group, only with the columns that can survive.

    ``min_by`` is combined before the shuffle, so an address that holds a large part of all
    rows still reaches its reducer as one row per map task.
    """
    columns = [name for name, sources in SURVIVORSHIP if source in sources]
    return F.min_by(F.struct(*columns), F.when(F.col("source_system") == source, order)).alias(_ROW_OF[source])


def _survivor(name: str, sources: tuple[str, ...], last: Column | None) -> Column:
    options = [F.col(f"{_ROW_OF[s]}.{name}") for s in sources]
    if len(options) > 1 or last is not None:
        options = [F.nullif(o, F.lit("")) for o in options]
    if last is not None:
        options.append(last)
    return (F.coalesce(*options) if len(options) > 1 else options[0]).alias(name)


def merge_by_email(customers: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Profiles of the rows that have an address."""
    order = F.struct(*[F.col(c) for c in order_by])
    groups = customers.groupBy("email").agg(_first_row(BILLING, order), _first_row(CRM, order))
    billing, crm = F.col("_billing").isNotNull(), F.col("_crm").isNotNull()
    key = email_key(F.col("email"))
    last = {"source_id": key, "preferred_currency": F.lit(DEFAULT_CURRENCY)}
    survivors = {n: _survivor(n, s, last.get(n)) for n, s in SURVIVORSHIP}
    survivors.update(
        unified_customer_id=key.alias("unified_customer_id"),
        source_system=(
            F.when(billing & crm, MERGED).when(billing, BILLING).when(crm, CRM).otherwise(UNKNOWN)
        ).alias("source_system"),
        email=F.col("email"),
        is_active=F.lit(True).alias("is_active"),
    )
    return groups.select(*[survivors[f.name] for f in CUSTOMERS.fields])


def resolve_customers(customers: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Rows with an address become one profile per address; rows without pass through.

    ``order_by`` defines which row of a source is its first and has to be total; its columns
    may be outside the canonical schema. Rows without an address are never shuffled. The
    input is read once per branch, so hand in a stored table when it is costly to compute.
    """
    extra = [c for c in order_by if c not in CUSTOMERS.fieldNames()]
    rows = align(customers, CUSTOMERS, extra)
    known = merge_by_email(rows.where(F.col("email").isNotNull()), order_by)
    unknown = rows.where(F.col("email").isNull()).select(*CUSTOMERS.fieldNames())
    return known.unionByName(unknown)


def merge_transactions(*frames: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Bag union without removing duplicates; the load keeps the last row per key."""
    return union_aligned(frames, TRANSACTIONS, keep)

"""Table shapes. All names, types and constants here are fixed values of the data model."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import types as T

BILLING = "stripe"
CRM = "salesforce"
MERGED = "merged"
UNKNOWN = "unknown"

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "long": T.LongType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def struct_of(spec: str) -> T.StructType:
    """``"id string, amount double"`` as a StructType, without needing a session."""
    fields = []
    for part in spec.split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, _TYPES[kind], True))
    return T.StructType(fields)


# --------------------------------------------------------------------------
# Raw entities. kind: text, number, whole (integer), flag, time, address, tags
# --------------------------------------------------------------------------

@dataclass(frozen=True)
class RawField:
    name: str
    kind: str
    required: bool = False
    optional: bool = True       # False: an explicit JSON null is not accepted
    default: Any = None


def _need(name: str, kind: str) -> RawField:
    return RawField(name, kind, required=True, optional=False)


def _may(name: str, kind: str, default: Any = None) -> RawField:
    return RawField(name, kind, default=default)


def _set(name: str, kind: str, default: Any) -> RawField:
    return RawField(name, kind, optional=False, default=default)


ADDRESS_PARTS = ("city", "country", "line1", "line2", "postal_code", "state")

RAW_FIELDS: dict[tuple[str, str], tuple[RawField, ...]] = {
    (BILLING, "customers"): (
        _need("id", "text"), _set("object", "text", "customer"), _may("email", "text"),
        _may("name", "text"), _may("phone", "text"), _may("description", "text"),
        _may("currency", "text"), _may("balance", "whole", 0), _may("delinquent", "flag", False),
        _need("created", "time"), _may("address", "address"), _set("metadata", "tags", None),
    ),
    (BILLING, "charges"): (
        _need("id", "text"), _set("object", "text", "charge"), _need("amount", "whole"),
        _may("amount_refunded", "whole", 0), _need("currency", "text"), _may("customer", "text"),
        _may("description", "text"), _set("paid", "flag", True), _need("status", "text"),
        _set("refunded", "flag", False), _may("payment_method", "text"),
        _need("created", "time"), _set("metadata", "tags", None),
    ),
    (BILLING, "invoices"): (
        _need("id", "text"), _set("object", "text", "invoice"), _need("customer", "text"),
        _may("subscription", "text"), _need("amount_due", "whole"), _set("amount_paid", "whole", 0),
        _set("amount_remaining", "whole", 0), _set("subtotal", "whole", 0), _set("total", "whole", 0),
        _need("currency", "text"), _may("status", "text", "draft"), _set("paid", "flag", False),
        _may("period_start", "time"), _may("period_end", "time"), _need("created", "time"),
    ),
    (BILLING, "subscriptions"): (
        _need("id", "text"), _set("object", "text", "subscription"), _need("customer", "text"),
        _need("status", "text"), _need("current_period_start", "time"),
        _need("current_period_end", "time"), _set("cancel_at_period_end", "flag", False),
        _need("created", "time"), _set("metadata", "tags", None),
    ),
    (CRM, "accounts"): (
        _need("Id", "text"), _need("Name", "text"), _may("Type", "text"),
        _may("BillingStreet", "text"), _may("BillingCity", "text"), _may("BillingState", "text"),
        _may("BillingPostalCode", "text"), _may("BillingCountry", "text"), _may("Phone", "text"),
        _may("Website", "text"), _may("AnnualRevenue", "number"),
        _may("NumberOfEmployees", "whole"), _may("Industry", "text"),
        _need("CreatedDate", "time"), _need("LastModifiedDate", "time"),
        _may("SystemModstamp", "time"),
    ),
    (CRM, "contacts"): (
        _need("Id", "text"), _may("AccountId", "text"), _may("FirstName", "text"),
        _need("LastName", "text"), _may("Email", "text"), _may("Phone", "text"),
        _may("Title", "text"), _may("Department", "text"),
        _need("CreatedDate", "time"), _need("LastModifiedDate", "time"),
    ),
    (CRM, "opportunities"): (
        _need("Id", "text"), _may("AccountId", "text"), _need("Name", "text"),
        _may("Amount", "number", 0.0), _need("StageName", "text"),
        _may("Probability", "number", 0.0), _may("CloseDate", "text"), _may("Type", "text"),
        _set("IsClosed", "flag", False), _set("IsWon", "flag", False),
        _need("CreatedDate", "time"), _need("LastModifiedDate", "time"),
    ),
    (CRM, "orders"): (
        _need("Id", "text"), _may("AccountId", "text"), _need("OrderNumber", "text"),
        _need("Status", "text"), _may("TotalAmount", "number", 0.0), _may("EffectiveDate", "text"),
        _need("CreatedDate", "time"), _need("LastModifiedDate", "time"),
    ),
}

# The key column of each raw entity, and the column an incremental read filters on.
RAW_KEY = {BILLING: "id", CRM: "Id"}
RAW_WATERMARK = {BILLING: "created", CRM: "LastModifiedDate"}


def raw_schema(source: str, entity: str) -> T.StructType:
    """How a raw entity is read.

    A raw scalar may arrive as a number, a numeric string or a date text, so scalars are
    read as text and cast where they are used. ``address`` and ``metadata`` keep their shape.
    """
    fields = []
    for field in raw_fields(source, entity):
        if field.kind == "address":
            kind: T.DataType = T.StructType([T.StructField(p, T.StringType()) for p in ADDRESS_PARTS])
        elif field.kind == "tags":
            kind = T.MapType(T.StringType(), T.StringType())
        else:
            kind = T.StringType()
        fields.append(T.StructField(field.name, kind, True))
    return T.StructType(fields)


def raw_fields(source: str, entity: str) -> tuple[RawField, ...]:
    key = (source.lower(), entity.lower())
    if key not in RAW_FIELDS:
        known = ", ".join(f"{s}.{e}" for s, e in RAW_FIELDS)
        raise ValueError(f"no raw schema for '{source}.{entity}'; there are {known}")
    return RAW_FIELDS[key]


# --------------------------------------------------------------------------
# Canonical tables
# --------------------------------------------------------------------------

CUSTOMERS = struct_of(
    "unified_customer_id string, source_system string, source_id string,"
    "stripe_customer_id string, salesforce_account_id string, salesforce_contact_id string,"
    "email string, full_name string, first_name string, last_name string, company_name string,"
    "phone string, billing_street string, billing_city string, billing_state string,"
    "billing_postal_code string, billing_country string, preferred_currency string,"
    "is_active boolean, source_created_at string, source_updated_at string,"
    "ingestion_timestamp string"
)
TRANSACTIONS = struct_of(
    "unified_transaction_id string, source_system string, source_transaction_id string,"
    "unified_customer_id string, source_customer_id string, customer_email string,"
    "amount double, amount_refunded double, net_amount double, currency string, status string,"
    "payment_method string, is_paid boolean, is_refunded boolean, transaction_date string,"
    "ingestion_timestamp string"
)
SUBSCRIPTIONS = struct_of(
    "unified_subscription_id string, source_system string, source_subscription_id string,"
    "unified_customer_id string, source_customer_id string, status string, mrr_amount double,"
    "currency string, current_period_start string, current_period_end string,"
    "cancel_at_period_end boolean, created_at string, ingestion_timestamp string"
)
COMPANIES = struct_of(
    "unified_account_id string, source_system string, source_account_id string,"
    "company_name string, industry string, annual_revenue double, employee_count long,"
    "website string, phone string, billing_country string, created_at string, updated_at string,"
    "ingestion_timestamp string"
)
CANONICAL = {
    "customers": CUSTOMERS,
    "transactions": TRANSACTIONS,
    "subscriptions": SUBSCRIPTIONS,
    "companies": COMPANIES,
}


# --------------------------------------------------------------------------
# Warehouse tables
# --------------------------------------------------------------------------

NOW = "now"     # a default that is filled with the load time


@dataclass(frozen=True)
class TargetColumn:
    name: str
    kind: str
    length: int | None = None
    nullable: bool = True
    default: Any = None


def _text(name: str, length: int, nullable: bool = True, default: Any = None) -> TargetColumn:
    return TargetColumn(name, "string", length, nullable, default)


def _when(name: str, nullable: bool = True, default: Any = None) -> TargetColumn:
    return TargetColumn(name, "timestamp", None, nullable, default)


def _other(name: str, kind: str, nullable: bool = True, default: Any = None) -> TargetColumn:
    return TargetColumn(name, kind, None, nullable, default)


@dataclass(frozen=True)
class TargetTable:
    name: str
    alias: str
    columns: tuple[TargetColumn, ...]

    @property
    def key(self) -> str:
        return self.columns[0].name

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, _TYPES[c.kind], True) for c in self.columns])

    def has(self, name: str) -> bool:
        return any(c.name == name for c in self.columns)


TARGETS: tuple[TargetTable, ...] = (
    TargetTable("dim_customers", "customers", (
        _text("unified_customer_id", 64, False), _text("source_system", 32, False),
        _text("source_id", 128, False), _text("salesforce_account_id", 64),
        _text("salesforce_contact_id", 64), _text("stripe_customer_id", 64),
        _text("email", 255), _text("full_name", 255), _text("first_name", 128),
        _text("last_name", 128), _text("company_name", 255), _text("phone", 64),
        _text("billing_street", 255), _text("billing_city", 128), _text("billing_state", 128),
        _text("billing_postal_code", 32), _text("billing_country", 32),
        _text("preferred_currency", 8, False, "USD"), _other("is_active", "boolean", False, True),
        _when("source_created_at"), _when("source_updated_at"),
        _when("ingestion_timestamp", False, NOW), _when("updated_at", False, NOW),
    )),
    TargetTable("fact_transactions", "transactions", (
        _text("unified_transaction_id", 64, False), _text("source_system", 32, False),
        _text("source_transaction_id", 128, False), _text("unified_customer_id", 64),
        _text("source_customer_id", 128), _text("customer_email", 255),
        _other("amount", "double", False), _other("amount_refunded", "double", False, 0.0),
        _other("net_amount", "double", False, 0.0), _text("currency", 8, False, "USD"),
        _text("status", 32, False), _text("payment_method", 64),
        _other("is_paid", "boolean", False, True), _other("is_refunded", "boolean", False, False),
        _when("transaction_date", False), _when("ingestion_timestamp", False, NOW),
        _when("updated_at", False, NOW),
    )),
    TargetTable("fact_subscriptions", "subscriptions", (
        _text("unified_subscription_id", 64, False), _text("source_system", 32, False),
        _text("source_subscription_id", 128, False), _text("unified_customer_id", 64),
        _text("source_customer_id", 128, False), _text("status", 32, False),
        _other("mrr_amount", "double", False, 0.0), _text("currency", 8, False, "USD"),
        _when("current_period_start"), _when("current_period_end"),
        _other("cancel_at_period_end", "boolean", False, False), _when("created_at", False),
        _when("ingestion_timestamp", False, NOW), _when("updated_at", False, NOW),
    )),
    TargetTable("dim_companies", "companies", (
        _text("unified_account_id", 64, False), _text("source_system", 32, False),
        _text("source_account_id", 128, False), _text("company_name", 255, False),
        _text("industry", 128), _other("annual_revenue", "double"),
        _other("employee_count", "long"), _text("website", 255), _text("phone", 64),
        _text("billing_country", 32), _when("created_at"), _when("updated_at"),
        _when("ingestion_timestamp", False, NOW),
    )),
)


def target_table(name: str) -> TargetTable:
    """A warehouse table by its own name or by the canonical dataset name."""
    wanted = name.lower()
    for table in TARGETS:
        if wanted in (table.name, table.alias):
            return table
    options = [n for t in TARGETS for n in (t.name, t.alias)]
    raise ValueError(f"'{name}' is no warehouse table; there are {options}")


LOAD_AUDIT = struct_of(
    "audit_id long, batch_id string, target_table string, rows_processed long,"
    "rows_inserted long, rows_updated long, status string, duration_seconds double,"
    "error_message string, synced_at timestamp"
)
EXTRACT_STATE = struct_of(
    "source string, entity string, last_extracted_timestamp string, last_cursor string,"
    "last_run_at timestamp, records_synced_last_run long, status string, is_reset boolean"
)
INGESTION_METADATA = struct_of(
    "batch_id string, source string, entity string, records_extracted long,"
    "records_transformed long, s3_raw_path string, s3_transformed_path string,"
    "start_time timestamp, end_time timestamp, status string, error_message string"
)
QUALITY_REPORT = T.StructType([
    T.StructField("dataset_name", T.StringType()),
    T.StructField("total_records", T.LongType()),
    T.StructField("valid_records", T.LongType()),
    T.StructField("invalid_records", T.LongType()),
    T.StructField("null_counts_by_field", T.MapType(T.StringType(), T.LongType())),
    T.StructField("validation_errors", T.ArrayType(T.StringType())),
    T.StructField("quality_score_percent", T.DoubleType()),
    T.StructField("passed_threshold", T.BooleanType()),
])

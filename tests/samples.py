"""Raw billing and CRM entities from row formulas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

BASE = 1704067200       # 2024-01-01T00:00:00Z
BILLING, CRM = "stripe", "salesforce"

_BILLING_ROWS = {
    "customers": (25, """
        format_string('cus_%04d', i) as id, 'customer' as object,
        format_string('customer_%04d@example.com', i) as email, concat('Customer ', i) as name,
        concat('+1-555-', i) as phone, concat('Company ', i) as description, 'usd' as currency,
        if(i % 3 = 0, i * 100, 0) as balance, false as delinquent, {base} + i * 86400 as created,
        named_struct('city', if(i % 2 = 0, 'San Francisco', 'New York'), 'country', 'US', 'line1', concat(i, ' Main St'),
          'line2', cast(null as string), 'postal_code', cast(94000 + i as string),
          'state', if(i % 2 = 0, 'CA', 'NY')) as address,
        map('tier', 'gold') as metadata"""),
    "charges": (40, """
        format_string('ch_%04d', i) as id, 'charge' as object, 5000 + i * 250 as amount,
        if(i % 7 = 0, 500, 0) as amount_refunded, if(i % 4 = 0, 'eur', 'usd') as currency,
        format_string('cus_%04d', i % 25 + 1) as customer, 'Payment' as description, i % 10 <> 0 as paid,
        if(i % 10 = 0, 'failed', 'succeeded') as status, i % 7 = 0 as refunded, 'card' as payment_method,
        {base} + i * 43200 as created, map('order', 'x') as metadata"""),
    "invoices": (30, """
        format_string('in_%04d', i) as id, 'invoice' as object, format_string('cus_%04d', i % 25 + 1) as customer,
        12000 + i * 500 as amount_due, 'usd' as currency, if(i % 5 = 0, 'open', 'paid') as status,
        i % 5 <> 0 as paid, {base} + i * 86400 as created"""),
    "subscriptions": (20, """
        format_string('sub_%04d', i) as id, 'subscription' as object,
        format_string('cus_%04d', i % 25 + 1) as customer, if(i % 6 = 0, 'canceled', 'active') as status,
        {base} + i * 86400 as current_period_start, {base} + (i + 30) * 86400 as current_period_end,
        i % 4 = 0 as cancel_at_period_end, {base} + i * 86400 as created, map('plan', 'pro') as metadata"""),
}
_DAY = "format_string('2024-01-%02dT08:00:00.000+0000', i % 28 + 1)"
_CRM_ROWS = {
    "accounts": (25, """
        format_string('001%015d', i) as Id, concat('Account ', i) as Name, 'Customer' as Type,
        concat(i, ' Market St') as BillingStreet, 'Chicago' as BillingCity, 'IL' as BillingState,
        cast(60600 + i as string) as BillingPostalCode, 'US' as BillingCountry, concat('+1-800-', i) as Phone,
        concat('https://a', i, '.example.com') as Website, 1000000.0D + 250000 * i as AnnualRevenue,
        50 + 10 * i as NumberOfEmployees, if(i % 3 = 0, 'Technology', 'Financial Services') as Industry,
        {day} as CreatedDate, {day} as LastModifiedDate, {day} as SystemModstamp"""),
    "contacts": (30, """
        format_string('003%015d', i) as Id, format_string('001%015d', i % 25 + 1) as AccountId,
        if(i % 2 = 0, 'Jane', 'John') as FirstName, concat('Doe ', i) as LastName,
        format_string('contact_%04d@example.com', i) as Email, concat('+1-900-', i) as Phone, 'VP' as Title,
        'Finance' as Department, {day} as CreatedDate, {day} as LastModifiedDate"""),
    "opportunities": (20, """
        format_string('006%015d', i) as Id, format_string('001%015d', i % 25 + 1) as AccountId,
        concat('Deal ', i) as Name, 50000.0D + 10000 * i as Amount, if(i % 3 = 0, 'Closed Won', 'Open') as StageName,
        i % 3 = 0 as IsClosed, i % 3 = 0 as IsWon, {day} as CreatedDate, {day} as LastModifiedDate"""),
    "orders": (20, """
        format_string('801%015d', i) as Id, format_string('001%015d', i % 25 + 1) as AccountId,
        format_string('ORD-%05d', i) as OrderNumber, if(i % 4 = 0, 'Draft', 'Activated') as Status,
        25000.0D + 5000 * i as TotalAmount, {day} as CreatedDate, {day} as LastModifiedDate"""),
}


def entity(spark: SparkSession, source: str, name: str) -> DataFrame:
    count, columns = (_BILLING_ROWS if source == BILLING else _CRM_ROWS)[name]
    columns = columns.replace("{base}", str(BASE)).replace("{day}", _DAY)
    rows = spark.range(1, count + 1, numPartitions=2).withColumnRenamed("id", "i")
    return rows.selectExpr(*_split(columns))


def _split(columns: str) -> list[str]:
    """Column expressions of a select list, split at commas outside parentheses."""
    parts, depth, start = [], 0, 0
    for at, letter in enumerate(columns):
        depth += (letter == "(") - (letter == ")")
        if letter == "," and depth == 0:
            parts.append(columns[start:at])
            start = at + 1
    return [p.strip() for p in [*parts, columns[start:]]]


def entities(spark: SparkSession) -> dict[tuple[str, str], DataFrame]:
    names = [(BILLING, n) for n in _BILLING_ROWS] + [(CRM, n) for n in _CRM_ROWS]
    return {key: entity(spark, *key) for key in names}


def keyed(frames: dict) -> dict:
    """With a column that gives the rows an order."""
    return {k: f.withColumn("_row_key", F.col("id" if k[0] == BILLING else "Id")) for k, f in frames.items()}


def values(frame: DataFrame, column: str) -> list:
    return [r[column] for r in frame.select(column).collect()]

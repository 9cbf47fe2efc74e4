from pyspark.sql import functions as F
from samples import entity

from tallyweave.operators import mapping
from tallyweave.schemas import CANONICAL, raw_schema

AS_OF = "2024-06-01T00:00:00Z"


def raw(spark, source, name, *rows):
    schema = raw_schema(source, name)
    return spark.createDataFrame([tuple(r.get(f) for f in schema.fieldNames()) for r in rows], schema)


def test_customer(spark):
    row = mapping.billing_customers(raw(spark, "stripe", "customers", {
        "id": " cus_1 ", "email": " USER@Example.com", "name": " Ann ", "currency": "eur", "created": "1704067200",
        "description": "Acme", "address": ("Berlin", "DE", "Str 1", None, "10115", " "),
    }), AS_OF).head()
    assert (row.source_id, row.stripe_customer_id, row.email, row.full_name) == ("cus_1", "cus_1", "user@example.com", "Ann")
    assert (row.billing_street, row.billing_city, row.billing_state) == ("Str 1", "Berlin", None)
    assert (row.preferred_currency, row.is_active, row.company_name) == ("EUR", True, "Acme")
    assert row.source_created_at == row.source_updated_at == "2024-01-01T00:00:00Z"
    assert row.ingestion_timestamp == AS_OF and row.salesforce_account_id is None


def test_rows_without_id_share_a_key(spark):
    rows = mapping.billing_customers(raw(spark, "stripe", "customers", {"id": None}, {"id": ""}), AS_OF)
    assert rows.select("unified_customer_id").distinct().count() == 1
    assert rows.where(F.col("source_id").isNotNull()).isEmpty()


def test_charge(spark):
    rows = raw(spark, "stripe", "charges",
               {"id": "ch_1", "amount": "10000", "amount_refunded": "2000", "currency": "usd", "customer": "cus_1",
                "status": "Succeeded", "paid": "true", "created": "2024-01-15T10:30:00Z"},
               {"id": "ch_2", "amount": "abc", "status": "  ", "customer": " "})
    one, two = mapping.billing_charges(rows, AS_OF).orderBy("source_transaction_id").collect()
    assert (one.amount, one.amount_refunded, one.net_amount) == (100.0, 20.0, 80.0)
    assert (one.status, one.is_paid, one.is_refunded, one.currency) == ("succeeded", True, False, "USD")
    assert one.transaction_date == "2024-01-15T10:30:00Z"
    assert (two.amount, two.status, two.unified_customer_id, two.is_paid) == (0.0, "pending", None, False)


def test_charge_points_at_its_source_customer(spark):
    charge = mapping.billing_charges(raw(spark, "stripe", "charges", {"id": "ch_1", "customer": "cus_1"}), AS_OF).head()
    customer = mapping.billing_customers(raw(spark, "stripe", "customers", {"id": "cus_1"}), AS_OF).head()
    assert charge.unified_customer_id == customer.unified_customer_id


def test_subscription(spark):
    rows = raw(spark, "stripe", "subscriptions",
               {"id": "s1", "customer": "c1", "status": "PAST_DUE", "created": "1704067200", "cancel_at_period_end": "true"},
               {"id": "s2", "status": None}, {"id": "s3", "status": "  "})
    one, two, three = mapping.billing_subscriptions(rows, AS_OF).orderBy("source_subscription_id").collect()
    assert (one.status, one.mrr_amount, one.currency, one.cancel_at_period_end) == ("past_due", 0.0, "USD", True)
    assert (two.status, three.status, two.cancel_at_period_end) == ("active", None, False)


def test_account_gives_company_and_customer(spark):
    rows = raw(spark, "salesforce", "accounts",
               {"Id": "001", "Name": None, "AnnualRevenue": "1250000.5", "NumberOfEmployees": "many",
                "CreatedDate": "2024-01-15T10:30:00.000+0000"})
    company = mapping.crm_companies(rows, AS_OF).head()
    customer = mapping.crm_account_customers(rows, AS_OF).head()
    assert (company.company_name, company.annual_revenue, company.employee_count) == ("Unnamed Account", 1250000.5, None)
    assert company.created_at == "2024-01-15T10:30:00Z" and company.updated_at is None
    assert (customer.full_name, customer.company_name, customer.email) == ("Unnamed Account", "Unnamed Account", None)
    assert customer.salesforce_account_id == "001" and customer.unified_customer_id != company.unified_account_id


def test_contact(spark):
    rows = raw(spark, "salesforce", "contacts", {"Id": "003", "AccountId": "001", "FirstName": "Jane", "LastName": " Doe ",
                                                 "Email": "J@D.io"}, {"Id": "004"})
    one, two = mapping.crm_contacts(rows, AS_OF).orderBy("source_id").collect()
    assert (one.full_name, one.email, one.salesforce_contact_id) == ("Jane Doe", "j@d.io", "003")
    assert (two.full_name, two.last_name, two.first_name) == ("Unknown", "Unknown", None)


def test_opportunity(spark):
    rows = raw(spark, "salesforce", "opportunities",
               {"Id": "1", "Amount": "45000", "IsWon": "true", "IsClosed": "true", "AccountId": "001"},
               {"Id": "2", "IsClosed": "true"}, {"Id": "3", "Amount": "n/a"})
    one, two, three = mapping.crm_opportunities(rows, AS_OF).orderBy("source_transaction_id").collect()
    assert (one.status, one.is_paid, one.amount, one.net_amount, one.amount_refunded) == ("succeeded", True, 45000.0, 45000.0, 0.0)
    assert (two.status, two.is_paid, three.status, three.amount) == ("failed", False, "pending", 0.0)
    assert one.payment_method == "Salesforce Invoice / Deal"


def test_order(spark):
    rows = raw(spark, "salesforce", "orders", {"Id": "1", "Status": " Activated ", "TotalAmount": "12.345"}, {"Id": "2"})
    one, two = mapping.crm_orders(rows, AS_OF).orderBy("source_transaction_id").collect()
    assert (one.status, one.is_paid, one.amount) == ("succeeded", True, 12.35)
    assert (two.status, two.is_paid, two.unified_customer_id) == ("pending", False, None)


def test_typed_input_and_empty_input(spark):
    typed = entity(spark, "stripe", "charges")
    assert mapping.billing_charges(typed, AS_OF).where("amount > 0").count() == 40
    empty = mapping.billing_charges(typed.limit(0), AS_OF)
    assert empty.schema.fieldNames() == CANONICAL["transactions"].fieldNames() and empty.isEmpty()


def test_mapping_is_one_stage_without_python(spark):
    plan = mapping.billing_charges(entity(spark, "stripe", "charges"), AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "BatchEval" not in plan

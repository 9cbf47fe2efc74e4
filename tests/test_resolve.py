from pyspark.sql import functions as F, types as T
from samples import entities, keyed, values

from tallyweave.operators.align import align, union_aligned, union_loose
from tallyweave.operators.resolve import merge_transactions, resolve_customers
from tallyweave.plans.canonical import build_canonical, source_rows
from tallyweave.schemas import CUSTOMERS, struct_of

NAMES = CUSTOMERS.fieldNames()
AS_OF = "2024-06-01T00:00:00Z"


def rows(spark, *items):
    schema = T.StructType([*CUSTOMERS.fields, T.StructField("at", T.IntegerType())])
    return spark.createDataFrame([tuple(i.get(n) for n in [*NAMES, "at"]) for i in items], schema)


def billing(at, **more):
    return {"source_system": "stripe", "source_id": f"cus_{at}", "stripe_customer_id": f"cus_{at}", "at": at,
            "unified_customer_id": f"b{at}", "preferred_currency": "EUR", **more}


def crm(at, **more):
    return {"source_system": "salesforce", "source_id": f"003{at}", "salesforce_contact_id": f"003{at}", "at": at,
            "unified_customer_id": f"c{at}", "preferred_currency": "USD", **more}


def test_same_address_in_both_sources(spark):
    found = resolve_customers(rows(
        spark, billing(100, email="a@b.com", phone="1", full_name="Bill", source_created_at="c1", source_updated_at="u1"),
        crm(100, email="a@b.com", phone="2", first_name="Ann", source_created_at="c2", source_updated_at="u2")), ["at"])
    row = found.head()
    assert found.count() == 1 and row.source_system == "merged"
    assert (row.stripe_customer_id, row.salesforce_contact_id, row.phone) == ("cus_100", "003100", "2")
    assert (row.full_name, row.first_name, row.preferred_currency) == ("Bill", "Ann", "EUR")
    assert (row.source_id, row.source_created_at, row.source_updated_at) == ("cus_100", "c1", "u2")
    assert row.unified_customer_id == "cust_221095a037d589c8" and row.is_active is True


def test_empty_text_is_no_answer(spark):
    row = resolve_customers(rows(
        spark, billing(1, email="a@b.com", full_name="Bill"), crm(1, email="a@b.com", full_name="")), ["at"]).head()
    assert row.full_name == "Bill"


def test_first_row_of_a_source_wins(spark):
    row = resolve_customers(rows(
        spark, billing(3, email="a@b.com", phone="late"), billing(1, email="a@b.com", phone="early"),
        billing(2, email="a@b.com", phone="middle")), ["at"]).head()
    assert (row.source_id, row.phone, row.source_system) == ("cus_1", "early", "stripe")


def test_first_row_wins_whole_also_with_nulls(spark):
    row = resolve_customers(rows(spark, billing(1, email="a@b.com"), billing(2, email="a@b.com", phone="2")), ["at"]).head()
    assert row.phone is None


def test_rows_without_address_stay(spark):
    found = resolve_customers(rows(spark, billing(1), billing(1), crm(2, email=None)), ["at"])
    assert sorted(values(found, "unified_customer_id")) == ["b1", "b1", "c2"]


def test_other_label_gives_unknown(spark):
    row = resolve_customers(rows(spark, {**billing(1, email="a@b.com", phone="1"), "source_system": "merged"}), ["at"]).head()
    assert (row.source_system, row.phone, row.preferred_currency) == ("unknown", None, "USD")
    assert row.source_id == row.unified_customer_id


def test_one_address_with_a_third_of_all_rows(spark):
    many = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot@example.com").otherwise(F.concat("id", F.lit("@example.com"))).alias("email"),
        F.lit("stripe").alias("source_system"), F.col("id").cast("string").alias("source_id"), F.col("id").alias("at"))
    found = resolve_customers(many, ["at"])
    assert found.count() == 20001
    assert found.where("email = 'hot@example.com'").head().source_id == "0"


def test_combined_before_the_shuffle_and_no_collected_groups(spark):
    plan = resolve_customers(rows(spark, billing(1, email="a@b.com")), ["at"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "collect_list" not in plan and "Python" not in plan


def test_align_and_unions(spark):
    target = struct_of("id string, n long, flag boolean")
    one = spark.createDataFrame([(1, "x", 5)], "id int, n string, extra int")
    two = spark.createDataFrame([("b", 2)], "id string, n int")
    assert align(one, target).collect() == [("1", None, None)]
    assert sorted(union_aligned([one, two], target).collect()) == [("1", None, None), ("b", 2, None)]
    assert union_loose([one.select("id"), one.select("extra")]).columns == ["id", "extra"]


def test_transactions_are_not_deduplicated(spark):
    one = spark.createDataFrame([("t1", 1.0)], "unified_transaction_id string, amount double")
    assert merge_transactions(one, one).count() == 2


def test_golden_figures(spark):
    tables = build_canonical(keyed(entities(spark)), AS_OF, ["_row_key"])
    customers, facts = tables["customers"], tables["transactions"]
    assert {n: t.count() for n, t in tables.items()} == {
        "customers": 80, "transactions": 80, "subscriptions": 20, "companies": 25}
    money = facts.groupBy("source_system", "payment_method").agg(F.sum("amount"), F.sum("amount_refunded"), F.sum("net_amount"))
    assert {tuple(r) for r in money.collect()} == {
        ("stripe", "card", 4050.0, 25.0, 4025.0),
        ("salesforce", "Salesforce Invoice / Deal", 3100000.0, 0.0, 3100000.0),
        ("salesforce", "Salesforce Direct Order", 1550000.0, 0.0, 1550000.0)}
    count = {tuple(r) for r in facts.groupBy("status").count().collect()}
    assert count == {("succeeded", 57), ("pending", 19), ("failed", 4)}
    currency = {tuple(r) for r in facts.where("source_system = 'stripe'").groupBy("currency").count().collect()}
    assert currency == {("USD", 30), ("EUR", 10)}
    assert {tuple(r) for r in tables["subscriptions"].groupBy("status").count().collect()} == {("active", 17), ("canceled", 3)}
    assert tables["subscriptions"].where("cancel_at_period_end").count() == 5
    assert {tuple(r) for r in tables["companies"].groupBy("industry").count().collect()} == {
        ("Technology", 8), ("Financial Services", 17)}
    assert tables["companies"].agg(F.sum("annual_revenue")).head()[0] == 106250000.0
    assert facts.join(customers, "unified_customer_id", "left_semi").count() == 40
    assert customers.where("email is not null").count() == 55


def test_source_rows_have_no_shuffle(spark):
    plan = source_rows(keyed(entities(spark)), "transactions", AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan

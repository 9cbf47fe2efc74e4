import pytest
from pyspark.sql import functions as F
from samples import entities, keyed

from tallyweave.operators.quality import (
    ROW_RULES, QualityGateError, check_rows, error_sample, folded_reports, null_counts, quality_alerts, quality_gate, quality_report,
    quality_reports, quality_state, storage_rules,
)
from tallyweave.plans.canonical import build_canonical
from tallyweave.schemas import CANONICAL

AS_OF = "2024-06-01T00:00:00Z"
SOUND = {"unified_customer_id": "c1", "source_system": "stripe", "source_id": "1", "preferred_currency": "USD",
         "is_active": True, "ingestion_timestamp": AS_OF}


def table(spark, dataset, *items):
    schema = CANONICAL[dataset]
    return spark.createDataFrame([tuple(i.get(n) for n in schema.fieldNames()) for i in items], schema)


def customers(spark, *changes):
    return table(spark, "customers", *[{**SOUND, **c} for c in changes])


@pytest.mark.parametrize("change, fault", [
    ({}, None),
    ({"source_system": "merged"}, None),
    ({"source_system": "unknown"}, "source_system is not allowed"),
    ({"source_system": None}, "source_system is not allowed"),
    ({"source_id": None}, "source_id is required"),
    ({"is_active": None}, "is_active is required"),
    ({"preferred_currency": "LONGER"}, None),
    ({"source_created_at": "2024-01-01T00:00:00Z"}, None),
    ({"source_created_at": "soon"}, "source_created_at is not a timestamp"),
    ({"ingestion_timestamp": "10:30"}, "ingestion_timestamp is not a timestamp"),
])
def test_customer_rules(spark, change, fault):
    row = check_rows(customers(spark, change), ROW_RULES["customers"]).head()
    assert row.failed_rules == ([fault] if fault else []) and row.is_valid == (fault is None)


def test_transaction_rules(spark):
    sound = {"unified_transaction_id": "t", "source_system": "stripe", "source_transaction_id": "1", "amount": float("nan"),
             "amount_refunded": 0.0, "net_amount": 0.0, "currency": "USD", "status": "any", "is_paid": True,
             "is_refunded": False, "transaction_date": AS_OF, "ingestion_timestamp": AS_OF}
    found = check_rows(table(spark, "transactions", sound, {**sound, "transaction_date": None},
                             {**sound, "source_system": "merged"}), ROW_RULES["transactions"])
    assert [r.failed_rules for r in found.collect()] == [
        [], ["transaction_date is required"], ["source_system is not allowed"]]


def test_absent_columns(spark):
    rules = ROW_RULES["customers"]
    assert check_rows(customers(spark, {}).drop("is_active", "preferred_currency"), rules).head().is_valid
    assert check_rows(customers(spark, {}).drop("source_id"), rules).head().failed_rules == ["source_id is required"]


def test_storage_rules(spark):
    found = check_rows(customers(spark, {}, {"phone": "1" * 65}, {"source_system": None}), storage_rules("customers"))
    assert [r.failed_rules for r in found.collect()] == [
        [], ["phone is longer than 64"], ["source_system is required"]]


def test_report_of_sound_rows(spark):
    row = quality_report(customers(spark, {}, {"unified_customer_id": "c2"}), ROW_RULES["customers"], "Customers").head()
    assert (row.total_records, row.valid_records, row.invalid_records) == (2, 2, 0)
    assert (row.quality_score_percent, row.passed_threshold, row.validation_errors) == (100.0, True, [])
    assert row.null_counts_by_field["email"] == 2 and row.null_counts_by_field["source_id"] == 0
    assert len(row.null_counts_by_field) == 22


def test_report_of_empty_table(spark):
    row = quality_report(customers(spark, {}).limit(0), ROW_RULES["customers"], "Customers").head()
    assert (row.total_records, row.quality_score_percent, row.passed_threshold) == (0, 100.0, True)
    assert row.null_counts_by_field == {} and row.validation_errors == []


@pytest.mark.parametrize("bad, score, passed", [(5, 95.0, True), (6, 94.0, False), (0, 100.0, True)])
def test_pass_mark(spark, bad, score, passed):
    rows = customers(spark, *[{"unified_customer_id": f"c{i:03d}", "source_id": None if i < bad else "x"} for i in range(100)])
    row = quality_report(rows, ROW_RULES["customers"], "Customers").head()
    assert (row.quality_score_percent, row.passed_threshold, row.invalid_records) == (score, passed, bad)


@pytest.mark.parametrize("sizes", [(30, 0, 9), (0,), (1, 1, 1, 1)])
def test_folded_states_equal_the_report_of_all_rows(spark, sizes):
    rules, made, states = ROW_RULES["customers"], [], None
    for part, size in enumerate(sizes):
        own = [{"unified_customer_id": f"c{i:02d}{part}" if i else None, "source_id": None if i % 2 else "x"} for i in range(size)]
        made += own
        # The first part comes twice, as a repeated micro-batch.
        for _ in range(2 if part == 0 else 1):
            rows = customers(spark, *own) if own else customers(spark, {}).limit(0)
            state = quality_state(rows, rules, "Customers", str(part))
            states = states.unionByName(state) if states else state
    whole = quality_report(customers(spark, *made) if made else customers(spark, {}).limit(0), rules, "Customers")
    assert folded_reports(states).collect() == whole.collect()
    assert folded_reports(states.limit(0)).collect() == []


def test_verdict_uses_the_score_before_rounding(spark):
    rows = spark.range(100000).select(
        F.concat(F.lit("c"), "id").alias("unified_customer_id"), F.lit("stripe").alias("source_system"),
        F.when(F.col("id") >= 5001, "x").alias("source_id"))
    row = quality_report(rows, ROW_RULES["customers"], "Customers").head()
    assert (row.quality_score_percent, row.passed_threshold) == (95.0, False)


def test_error_sample_is_the_first_ten_by_key(spark):
    rows = customers(spark, *[{"unified_customer_id": f"c{i:03d}", "source_id": None} for i in range(40, 0, -1)],
                     {"unified_customer_id": None})
    found = error_sample(rows, ROW_RULES["customers"]).collect()
    assert [r.row_key for r in found] == [None] + [f"c{i:03d}" for i in range(1, 10)]
    assert found[0].error == "Row None failed: unified_customer_id is required"
    plan = error_sample(rows, ROW_RULES["customers"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_error_length(spark):
    rows = spark.createDataFrame([("c1",)], "unified_account_id string")
    error = error_sample(rows, ROW_RULES["companies"]).head().error
    assert len(error) <= len("Row c1 failed: ") + 150


def test_null_counts(spark):
    found = {r.column_name: r.null_count for r in null_counts(customers(spark, {}, {"email": "a@b.com"})).collect()}
    assert found["email"] == 1 and found["phone"] == 2 and found["source_id"] == 0


def test_gate_and_alerts(spark):
    good, bad = customers(spark, {}), customers(spark, {"source_id": None}, {"unified_customer_id": "c2"})
    reports = quality_reports([("Good", good, ROW_RULES["customers"]), ("Bad", bad, ROW_RULES["customers"])])
    with pytest.raises(QualityGateError, match=r"Data Quality Gate Failed for Bad: 50\.0%"):
        quality_gate(reports)
    quality_gate(reports.where("dataset_name = 'Good'"))
    alert, = quality_alerts(reports).collect()
    assert alert.summary == "Dataset 'Bad' score dropped to 50.0% (1/2 invalid records)."
    assert alert.error_message == "Row c1 failed: source_id is required"


def test_golden_tables_pass(spark):
    tables = build_canonical(keyed(entities(spark)), AS_OF, ["_row_key"])
    for row in quality_reports([(n, t, ROW_RULES[n]) for n, t in tables.items()]).collect():
        assert row.quality_score_percent == 100.0 and row.passed_threshold

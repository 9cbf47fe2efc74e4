from datetime import datetime, timezone

from pyspark.sql import functions as F
from samples import entity, values

from tallyweave.operators.incremental import (
    ExtractState, advance_watermark, created_since, cursor_page, cursor_range, extract_summary, incremental_read,
    latest_state, next_cursor, page_completeness,
)
from tallyweave.sources.landing import read_landing, write_landing


def utc(*parts):
    return datetime(*parts, tzinfo=timezone.utc)


def test_watermark_is_inclusive_in_whole_seconds_and_ordered(spark):
    rows = spark.createDataFrame(
        [("a", "2024-01-01T12:00:00Z"), ("b", "2024-01-01T11:59:59Z"), ("c", "2024-01-03T00:00:00.000+0000"),
         ("d", "2024-01-02T00:00:00Z")], "Id string, LastModifiedDate string")
    mark = utc(2024, 1, 1, 12, 0, 0, 900000)
    assert values(incremental_read(rows, ["Id"], "LastModifiedDate", mark), "Id") == ["a", "d", "c"]
    assert values(incremental_read(rows, ["Id"], "LastModifiedDate", mark, limit=2), "Id") == ["a", "d"]
    assert values(incremental_read(rows, ["Id"], "LastModifiedDate"), "Id") == ["b", "a", "d", "c"]
    assert incremental_read(rows, ["Id"], "LastModifiedDate", mark, ordered=False).count() == 3


def test_filter_reaches_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select("id", F.timestamp_seconds(F.col("id")).alias("at"), F.lit(1).alias("x")).write.parquet(path)
    read = incremental_read(spark.read.parquet(path), ["id"], "at", utc(1970, 1, 1, 0, 0, 50))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(at" in plan and "ReadSchema: struct<id:bigint,at:timestamp>" in plan
    assert read.count() == 50


def test_created_since(spark):
    charges = entity(spark, "stripe", "charges")
    assert created_since(charges, utc(2024, 1, 11)).count() == 21
    assert created_since(charges, None).count() == 40


def test_cursor_pages(spark):
    customers, cursor, pages = entity(spark, "stripe", "customers"), None, []
    while True:
        size, cursor = next_cursor(cursor_page(customers, "id", cursor, 10), "id").head()
        if not size:
            break
        pages.append((size, cursor))
    assert pages == [(10, "cus_0010"), (10, "cus_0020"), (5, "cus_0025")]
    assert cursor_range(customers, "id", "cus_0010", "cus_0020").count() == 10
    assert cursor_range(customers, "id", None, None).count() == 25
    plan = cursor_page(customers, "id", "cus_0010", 10)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_page_completeness(spark):
    rows = [("a", None, "/2", 3, 2), ("a", "/2", None, 3, 1), ("b", None, "/2", 3, 2), ("c", None, None, 2, 1)]
    pages = spark.createDataFrame(rows, "chain string, locator string, next_locator string, total_size long, records_in_page long")
    found = {r.chain: (r.pages, r.records, r.missing_pages, r.is_complete) for r in page_completeness(pages).collect()}
    assert found == {"a": (2, 3, 0, True), "b": (1, 2, 1, False), "c": (1, 1, 0, False)}


def test_extract_summary(spark, tmp_path):
    rows = entity(spark, "stripe", "charges").repartition(1)
    write_landing(rows, str(tmp_path), "stripe", "charges", "b1", F.lit("2024-05-12 14:30:00"), page_size=15)
    row = extract_summary(read_landing(spark, str(tmp_path), "stripe", "charges"), "stripe", "charges").head()
    assert (row.batch_id, row.total_records, row.files, row.start_time, row.duration_seconds) == (
        "b1", 40, 3, "2024-05-12T14:30:00Z", 0)


def test_state(spark, tmp_path):
    state = ExtractState(spark, str(tmp_path / "state"))
    assert state.watermark("stripe", "customers") is None and state.cursor("stripe", "customers") is None
    state.update("Stripe", "Customers", utc(2024, 1, 1), "cus_9", 5, at=utc(2024, 1, 1, 1))
    assert state.watermark("stripe", "customers") == utc(2024, 1, 1) and state.cursor("STRIPE", "customers") == "cus_9"
    state.update("stripe", "customers", None, None, 0, at=utc(2024, 1, 1, 2))
    assert state.watermark("stripe", "customers") == utc(2024, 1, 1) and state.cursor("stripe", "customers") is None
    assert state.watermark("stripe", "customers", utc(2023, 1, 1)) == utc(2023, 1, 1)
    row = state.latest().head()
    assert (row.records_synced_last_run, row.status) == (0, "COMPLETED")


def test_compacted_state(spark, tmp_path):
    state, whole = ExtractState(spark, str(tmp_path / "state")), ExtractState(spark, str(tmp_path / "whole"))
    state.compact()     # nothing there yet
    steps = [("stripe", "charges", 1, "a"), ("stripe", "charges", None, "b"), None, ("stripe", "refunds", 2, None),
             ("stripe", "charges", None, "c"), "compact", ("stripe", "charges", 3, None), "compact", "compact", None, ("salesforce", "leads", 4, "d")]
    for hour, step in enumerate(steps):
        if step == "compact":
            state.compact()
            assert state._rows(state.path).isEmpty() and len(state.log().inputFiles()) <= 8
            continue
        for one in (state, whole):
            if step:
                source, entity, day, cursor = step
                one.update(source, entity, utc(2024, 1, day) if day else None, cursor, hour, at=utc(2024, 2, 1, hour))
            else:
                one.reset("stripe", "refunds" if hour > 5 else None, at=utc(2024, 2, 1, hour))
        assert sorted(state.latest().collect()) == sorted(whole.latest().collect())
    assert state.log().count() <= 6
    # A late run that a reset covered stays covered.
    for one in (state, whole):
        one.update("stripe", "refunds", utc(2024, 1, 9), "late", at=utc(2024, 2, 1, 5))
    assert sorted(state.latest().collect()) == sorted(whole.latest().collect())


def test_state_resets(spark, tmp_path):
    state = ExtractState(spark, str(tmp_path / "state"))
    for source, entity_name in (("stripe", "customers"), ("stripe", "charges"), ("salesforce", "orders")):
        state.update(source, entity_name, utc(2024, 1, 1), at=utc(2024, 1, 1, 1))

    def known():
        return {(r.source, r.entity) for r in state.latest().collect()}

    state.reset("stripe", "charges", at=utc(2024, 1, 1, 2))
    assert known() == {("stripe", "customers"), ("salesforce", "orders")}
    state.reset("stripe", at=utc(2024, 1, 1, 3))
    assert known() == {("salesforce", "orders")}
    state.update("stripe", "charges", None, "x", at=utc(2024, 1, 1, 4))
    assert known() == {("stripe", "charges"), ("salesforce", "orders")}
    assert state.watermark("stripe", "charges") is None
    state.reset(at=utc(2024, 1, 1, 5))
    assert known() == set()


def test_unreadable_watermark_is_none(spark, tmp_path):
    state = ExtractState(spark, str(tmp_path / "state"))
    state._append(source="stripe", entity="customers", last_extracted_timestamp="soon", last_run_at="2024-01-01", is_reset=False)
    assert state.watermark("stripe", "customers") is None and latest_state(state.log()).count() == 1


def test_advance_watermark(spark):
    assert advance_watermark(entity(spark, "stripe", "charges"), "created").head()[0] == datetime(2024, 1, 21)

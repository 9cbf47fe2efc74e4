import gzip
import json

import pytest
from pyspark.sql import functions as F
from samples import entities, entity, values

from tallyweave.sources.curated import curated_path, read_curated, write_curated
from tallyweave.sources.landing import (
    ENVELOPE, LANDING_COLUMNS, envelopes, landed_batches, list_batches, read_landing, read_rejects, broken_lists, unwrap_list, write_envelopes,
    write_landing,
)
from tallyweave.sources.raw_check import check_raw
from tallyweave.operators.mapping import billing_charges, crm_companies

AT = F.lit


def put(root, path, document, pretty=False):
    file = root / path
    file.parent.mkdir(parents=True, exist_ok=True)
    text = json.dumps(document, indent=2 if pretty else None).encode()
    file.write_bytes(gzip.compress(text) if path.endswith(".gz") else text)


def envelope(batch, *records, at="2024-05-12T14:30:00+00:00"):
    return {"metadata": {"source": "stripe", "entity": "customers", "batch_id": batch, "record_count": len(records),
                         "extracted_at": at}, "records": list(records)}


def test_path_of_a_batch(spark, tmp_path):
    root = str(tmp_path)
    write_landing(entity(spark, "stripe", "customers"), root, "Stripe", "Customers", "batch_001",
                  AT("2024-05-12 14:30:00"))
    paths = values(list_batches(spark, root, "stripe", "customers"), "path")
    assert paths and all("/raw/stripe/customers/year=2024/month=05/day=12/" in p and p.endswith(".json.gz") for p in paths)


def test_lines_round_trip(spark, tmp_path):
    rows = entity(spark, "stripe", "customers").repartition(1)
    write_landing(rows, str(tmp_path), "stripe", "customers", "b1", AT("2024-05-12 14:30:00"), page_size=10, compress=False)
    found = read_landing(spark, str(tmp_path), "stripe", "customers")
    assert found.count() == 25 and list_batches(spark, str(tmp_path), "stripe", "customers").count() == 3
    row = found.where("id = 'cus_0003'").head()
    assert (row.created, row.balance, row.address.city) == (str(1704067200 + 3 * 86400), "300", "New York")
    assert (row._batch_id, row.year, row.month, row.day) == ("b1", 2024, 5, 12) and row.metadata == {"tier": "gold"}
    assert set(LANDING_COLUMNS) <= set(found.columns)
    assert [tuple(r)[3] for r in landed_batches(found).collect()] and sum(values(landed_batches(found), "record_count")) == 25


def test_foreign_envelopes_plain_and_gzip(spark, tmp_path):
    base = "raw/stripe/customers/year=2024/month=05/day=12/"
    put(tmp_path, base + "b1_p0001.json.gz", envelope("b1_p0001", {"id": "cus_1", "created": 1704067200}, {"id": "cus_2"}))
    put(tmp_path, base + "b1_p0002.json", envelope("b1_p0002", {"id": "cus_3", "created": "2024-01-01T00:00:00Z"}), pretty=True)
    put(tmp_path, base + "b1_p0003.json.gz", envelope("b1_p0003"))
    found = read_landing(spark, str(tmp_path), "stripe", "customers", layout=ENVELOPE)
    assert [(r.id, r.created, r._batch_id, r._seq) for r in found.orderBy("_batch_id", "_seq").collect()] == [
        ("cus_1", "1704067200", "b1_p0001", 0), ("cus_2", None, "b1_p0001", 1),
        ("cus_3", "2024-01-01T00:00:00Z", "b1_p0002", 0)]
    assert list_batches(spark, str(tmp_path), "stripe", "customers").count() == 3


def test_days_prune_partitions(spark, tmp_path):
    rows = spark.range(10).select(F.col("id").cast("string").alias("id"))
    for day in (11, 12, 13):
        write_landing(rows, str(tmp_path), "stripe", "charges", f"b{day}", AT(f"2024-05-{day} 00:00:00"))
    found = read_landing(spark, str(tmp_path), "stripe", "charges", days=("2024-05-12", "2024-05-13"))
    assert found.count() == 20 and {r[0] for r in found.select("day").distinct().collect()} == {12, 13}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_nothing_landed(spark, tmp_path):
    found = read_landing(spark, str(tmp_path), "salesforce", "orders")
    assert found.isEmpty() and "TotalAmount" in found.columns
    assert list_batches(spark, str(tmp_path), "salesforce", "orders").isEmpty()
    with pytest.raises(ValueError, match="no raw schema"):
        read_landing(spark, str(tmp_path), "stripe", "refunds")


def test_own_envelopes_round_trip(spark, tmp_path):
    rows = entity(spark, "stripe", "charges").repartition(2)
    pages = envelopes(rows, "stripe", "charges", "b1", AT("2024-05-12 14:30:00"), page_size=7)
    assert max(values(pages.select("metadata.record_count"), "record_count")) == 7
    write_envelopes(pages, str(tmp_path), "stripe", "charges")
    found = read_landing(spark, str(tmp_path), "stripe", "charges", layout=ENVELOPE)
    assert found.count() == found.select("id").distinct().count() == 40
    assert list_batches(spark, str(tmp_path), "stripe", "charges").count() == pages.count()
    assert billing_charges(found, "2024-06-01T00:00:00Z").where("amount < 50").isEmpty()


def test_page_size_is_limited(spark):
    with pytest.raises(ValueError):
        envelopes(spark.range(1), "stripe", "charges", "b", AT("2024-05-12"), page_size=5000)


def test_all_entities_land(spark, tmp_path):
    total = 0
    for (source, name), rows in entities(spark).items():
        write_landing(rows, str(tmp_path), source, name, "b1", AT("2024-05-12 14:30:00"))
        total += read_landing(spark, str(tmp_path), source, name).count()
    assert total == 210


def test_list_responses(spark):
    billing = json.dumps({"object": "list", "data": [{"id": "a"}, {"id": "b"}], "has_more": True})
    bodies = spark.createDataFrame(
        [(1, billing), (2, "broken"), (3, '{"data": []}'), (4, billing[:40]), (5, '{"error": 1}'), (6, None)], "n int, body string")
    found = unwrap_list(bodies, "body", "stripe", "customers", on_broken="reject")
    assert sorted(values(broken_lists(bodies, "body", "stripe"), "n")) == [2, 4, 5, 6]
    with pytest.raises(Exception, match="no list response"):
        unwrap_list(bodies, "body", "stripe", "customers").collect()
    assert [(r.n, r.has_more, r.pos, r.record.id) for r in found.collect()] == [(1, True, 0, "a"), (1, True, 1, "b")]
    crm = json.dumps({"totalSize": 5, "done": False, "nextRecordsUrl": "/q/2", "records": [{"Id": "1", "attributes": {"t": 1}}]})
    row = unwrap_list(spark.createDataFrame([(crm,)], "body string"), "body", "salesforce", "accounts").head()
    assert (row.totalSize, row.done, row.nextRecordsUrl, row.record.Id) == (5, False, "/q/2", "1")
    assert "attributes" not in row.record.asDict()


CHARGE = {"id": "ch_1", "amount": 100, "currency": "usd", "status": "succeeded", "created": 1704067200}


@pytest.mark.parametrize("change, errors", [
    ({}, []),
    ({"id": ...}, ["id: missing"]),
    ({"id": None}, ["id: null"]),
    ({"amount": "100"}, []),
    ({"amount": 100.0}, []),
    ({"amount": 100.5}, ["amount: not a whole"]),
    ({"amount": "lots"}, ["amount: not a whole"]),
    ({"amount_refunded": None}, []),
    ({"paid": None}, ["paid: null"]),
    ({"paid": "true"}, []),
    ({"paid": "maybe"}, ["paid: not a flag"]),
    ({"created": "2024-01-01T00:00:00Z"}, []),
    ({"created": "1704067200"}, []),
    ({"created": "never"}, ["created: not a time"]),
    ({"created": 1704067200000}, ["created: not a time"]),
    ({"metadata": None}, ["metadata: null"]),
    ({"unknown": 1}, []),
])
def test_raw_charge(spark, change, errors):
    record = {k: v for k, v in {**CHARGE, **change}.items() if v is not ...}
    row = check_raw(spark.createDataFrame([(json.dumps(record),)], "body string"), "body", "stripe", "charges").head()
    assert row.schema_errors == errors and row.is_schema_valid == (not errors)
    if not errors:
        assert (row.record.amount, row.record.created, row.record.object) == ("100", "2024-01-01T00:00:00Z", "charge")
    else:
        assert row.record.object is None and json.loads(row.body) == record


def test_raw_record_without_id_and_broken_text(spark):
    rows = spark.createDataFrame([('{"name": "No ID"}',), ("{broken",), (None,)], "body string")
    found = check_raw(rows, "body", "stripe", "customers").collect()
    assert [r.is_schema_valid for r in found] == [False] * 3
    assert found[0].record.name == "No ID" and "id: missing" in found[0].schema_errors


def test_raw_account(spark):
    record = {"Id": "001", "Name": "Acme", "AnnualRevenue": 5, "NumberOfEmployees": 3, "attributes": {"type": "Account"},
              "CreatedDate": "2024-01-15T10:30:00.000+0000", "LastModifiedDate": "2024-01-15T10:30:00.000+0000"}
    checked = check_raw(spark.createDataFrame([(json.dumps(record),)], "body string"), "body", "salesforce", "accounts")
    assert checked.head().is_schema_valid and checked.head().record.CreatedDate == "2024-01-15T10:30:00Z"
    company = crm_companies(checked.select("record.*"), "2024-06-01T00:00:00Z").head()
    assert (company.company_name, company.annual_revenue, company.employee_count) == ("Acme", 5.0, 3)


def test_curated_copies(spark, tmp_path):
    companies = crm_companies(entity(spark, "salesforce", "accounts"), "2024-06-01T00:00:00Z")
    assert write_curated(companies, str(tmp_path), "companies").count() == 25
    assert read_curated(spark, str(tmp_path), "companies").exceptAll(companies).isEmpty()
    assert read_curated(spark, str(tmp_path), "companies", "json").exceptAll(companies).isEmpty()
    assert write_curated(companies.limit(0), str(tmp_path / "none"), "companies") is None
    assert not (tmp_path / "none").exists() and curated_path("x/", "companies") == "x/curated/dim_companies.parquet"


@pytest.mark.parametrize("layout", ["lines", "envelope"])
def test_broken_text_is_raised_or_rejected(spark, tmp_path, layout):
    folder = tmp_path / "raw/stripe/charges/year=2024/month=05/day=12"
    folder.mkdir(parents=True)
    record = {"id": "ch_1", "amount": "not a number"}
    if layout == "lines":
        good = [json.dumps({**record, "_batch_id": "b", "_extracted_at": "2024-05-12T00:00:00Z", "_seq": 1})]
        (folder / "a.json").write_text("\n".join([*good, '{"id": "ch_2", "amo', "nonsense"]) + "\n")
    else:
        whole = json.dumps({"metadata": {"batch_id": "b", "extracted_at": "2024-05-12T00:00:00Z"}, "records": [{"id": "ch_1"}]})
        for name, text in (("a", whole), ("b", whole[:-9]), ("c", '{"metadata": {}}')):
            (folder / f"{name}.json").write_text(text)
    read = lambda how: read_landing(spark, str(tmp_path), "stripe", "charges", layout=layout, on_broken=how)
    assert values(read("reject"), "id") == ["ch_1"]
    assert read_rejects(spark, str(tmp_path), "stripe", "charges", layout=layout).count() == 2
    with pytest.raises(Exception, match="unreadable text"):
        read("raise").select("id").collect()


def test_a_landed_text_is_parsed_once(spark, tmp_path):
    """Also where a filter on what is broken stands above."""
    put(tmp_path, "raw/stripe/customers/year=2024/month=05/day=12/a.json", {"id": "c1"})
    for on_broken in ("raise", "reject", "keep"):
        found = read_landing(spark, str(tmp_path), "stripe", "customers", on_broken=on_broken)
        assert found._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
        assert values(found, "id") == ["c1"]
    assert read_rejects(spark, str(tmp_path), "stripe", "customers").isEmpty()


def test_landing_writes_days_side_by_side(spark, tmp_path):
    """A task does not sort its rows by their days, and keeps the session as it was."""
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    rows = spark.range(6, numPartitions=1).select(F.col("id").cast("string").alias("id"))
    days = F.timestamp_seconds(1715472000 + F.col("id").cast("bigint") % 3 * 86400)
    write_landing(rows, str(tmp_path), "stripe", "customers", "b1", days)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    found = read_landing(spark, str(tmp_path), "stripe", "customers").select("id", "_seq", "_extracted_at", "day").collect()
    assert sorted(tuple(r) for r in found) == [
        (str(k), k, f"2024-05-{12 + k % 3}T00:00:00.000000Z", 12 + k % 3) for k in range(6)]
    assert len(values(list_batches(spark, str(tmp_path), "stripe", "customers"), "path")) == 3

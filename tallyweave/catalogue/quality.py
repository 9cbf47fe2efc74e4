"""Row rules, reports and warnings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tallyweave.catalogue.adapters import (
    AS_OF, COMPANY_NAMES, CUSTOMER_NAMES, MAPPED, SUBSCRIPTION_NAMES, TRANSACTION_NAMES, raw,
)
from tallyweave.catalogue.registry import query
from tallyweave.catalogue.resolved import FACTS, PROFILES, all_tables, customer_rows
from tallyweave.operators import mapping
from tallyweave.operators.quality import gate_verdicts as gate_verdicts_of
from tallyweave.operators.quality import (
    ROW_RULES, check_rows, error_sample as error_sample_of, folded_reports, null_counts as null_counts_of,
    quality_alerts as quality_alerts_of, quality_reports, quality_state, row_is_valid, storage_rules,
)
from tallyweave.plans.run import REPORT_NAMES
from tallyweave.session import fresh_folder, stored

_TABLES = {
    "customers": (PROFILES, CUSTOMER_NAMES),
    "transactions": (FACTS, TRANSACTION_NAMES),
    "subscriptions": (MAPPED["billing_subscriptions"], SUBSCRIPTION_NAMES),
    "companies": (MAPPED["crm_companies"], COMPANY_NAMES),
}
_REQUIRED = {
    "customers": "unified_customer_id source_id preferred_currency is_active ingestion_timestamp",
    "transactions": "unified_transaction_id source_transaction_id amount amount_refunded net_amount currency "
                    "status is_paid is_refunded transaction_date ingestion_timestamp",
    "subscriptions": "unified_subscription_id source_subscription_id source_customer_id status mrr_amount "
                     "currency cancel_at_period_end created_at ingestion_timestamp",
    "companies": "unified_account_id source_account_id company_name created_at updated_at ingestion_timestamp",
}
_TIMES = {
    "customers": "source_created_at source_updated_at ingestion_timestamp",
    "transactions": "transaction_date ingestion_timestamp",
    "subscriptions": "current_period_start current_period_end created_at ingestion_timestamp",
    "companies": "created_at updated_at ingestion_timestamp",
}
_SOURCES = {n: "('stripe', 'salesforce')" for n in _TABLES} | {"customers": "('stripe', 'salesforce', 'merged')"}


def _faults(name: str) -> str:
    """The rules that a row breaks, as one text, in the checking dialect."""
    marks = [f"case when {c} is null then '{c} is required' end" for c in _REQUIRED[name].split()]
    marks.append(f"case when not coalesce(source_system in {_SOURCES[name]}, false) "
                 "then 'source_system is not allowed' end")
    marks += [f"case when {c} is not null and try_cast({c} as timestamptz) is null then '{c} is not a timestamp' end"
              for c in _TIMES[name].split()]
    return "concat_ws('; ', " + ", ".join(marks) + ")"


def _report(name: str, threshold: float) -> str:
    sql, columns = _TABLES[name]
    key = columns[0]
    nulls = " + ".join(f"(case when {c} is null then 1 else 0 end)" for c in columns)
    return f"""
      select '{REPORT_NAMES[name]}' as dataset_name, total as total_records, valid as valid_records,
        total - valid as invalid_records, nulls as null_cells,
        round(valid::double / total::double * 100, 2) as quality_score_percent,
        valid::double / total::double * 100 >= {threshold} as passed_threshold,
        coalesce((select string_agg(error, chr(10) order by row_key nulls first, error) from (
          select {key} as row_key, 'Row ' || coalesce({key}, 'None') || ' failed: ' || substr({_faults(name)}, 1, 150)
            as error
          from ({sql}) where {_faults(name)} <> '' order by 1 nulls first, 2 limit 10)), '') as errors
      from (select count(*) as total, count(*) filter (where {_faults(name)} = '') as valid,
              sum({nulls})::bigint as nulls
            from ({sql}))"""


def _flat(reports: DataFrame) -> DataFrame:
    """Reports without map and array columns."""
    nulls = F.aggregate(F.map_values("null_counts_by_field"), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return reports.select(
        "dataset_name", "total_records", "valid_records", "invalid_records", nulls.alias("null_cells"),
        "quality_score_percent", "passed_threshold", F.array_join("validation_errors", "\n").alias("errors"))


def subscriptions(spark, folder) -> DataFrame:
    return mapping.billing_subscriptions(raw(spark, folder, "billing_subscriptions"), AS_OF)


@query("quality_rows", f"""
    select unified_subscription_id, {_faults('subscriptions')} as broken, {_faults('subscriptions')} = '' as is_valid
    from ({MAPPED['billing_subscriptions']})""")
def quality_rows(spark, folder):
    return check_rows(subscriptions(spark, folder), ROW_RULES["subscriptions"]).select(
        "unified_subscription_id", F.array_join("failed_rules", "; ").alias("broken"), "is_valid")


@query("storage_constraints", f"""
    select unified_customer_id, length(billing_street) > 255 or length(phone) > 64 or length(preferred_currency) > 8
        or source_id is null as never, false as is_broken
    from ({MAPPED['billing_customers']})""")
def storage_constraints(spark, folder):
    rows = mapping.billing_customers(raw(spark, folder, "billing_customers"), AS_OF)
    checked = check_rows(rows, storage_rules("dim_customers"))
    never = (F.length("billing_street") > 255) | (F.length("phone") > 64) | (
        F.length("preferred_currency") > 8) | F.col("source_id").isNull()
    return checked.select("unified_customer_id", never.alias("never"), (~F.col("is_valid")).alias("is_broken"))


@query("quality_report", _report("subscriptions", 95.0))
def quality_report(spark, folder):
    name = "subscriptions"
    return _flat(quality_reports([(REPORT_NAMES[name], subscriptions(spark, folder), ROW_RULES[name])]))


@query("quality_all", " union all ".join(_report(n, 95.0) for n in _TABLES))
def quality_all(spark, folder):
    return _flat(quality_reports(
        [(REPORT_NAMES[n], t, ROW_RULES[n]) for n, t in all_tables(spark, folder).items()]))


@query("quality_folded", " union all ".join(_report(n, 95.0) for n in _TABLES))
def quality_folded(spark, folder):
    """The same reports folded from the states of three parts of each table, one of them stored twice."""
    path = fresh_folder(spark, "quality_states")
    for name, rows in all_tables(spark, folder).items():
        rules = ROW_RULES[name]
        dealt = rows.withColumn("_part", F.pmod(F.xxhash64(*rows.columns), F.lit(3)).cast("int"))
        # Kept by part, so that each state reads its own rows only.
        with stored(dealt, f"{name}_parts", "_part") as held:
            for part in (0, 1, 2, 1):
                own = held.where(F.col("_part") == part).drop("_part")
                quality_state(own, rules, REPORT_NAMES[name], str(part)).write.mode("append").parquet(path)
    return _flat(folded_reports(spark.read.parquet(path)))


@query("quality_alerts", f"""
    select dataset_name, total_records, invalid_records, quality_score_percent,
      'Data Quality Threshold Warning - ' || dataset_name as title,
      printf('Dataset ''%s'' score dropped to %.1f%% (%d/%d invalid records).', dataset_name, quality_score_percent,
        invalid_records, total_records) as summary,
      nullif(errors, '') as error_message
    from ({" union all ".join(_report(n, 99.5) for n in _TABLES)}) where not passed_threshold""")
def quality_alerts(spark, folder):
    """The pass mark is set high here, so that there is something to warn of."""
    return quality_alerts_of(quality_reports(
        [(REPORT_NAMES[n], t, ROW_RULES[n]) for n, t in all_tables(spark, folder).items()], threshold=99.5))


@query("null_counts", " union all ".join(
    f"select '{c}' as column_name, count(*) filter (where {c} is null) as null_count from ("
    f"select {', '.join(CUSTOMER_NAMES)} from ({MAPPED['billing_customers']}) "
    f"union all select {', '.join(CUSTOMER_NAMES)} from ({MAPPED['crm_account_customers']}) "
    f"union all select {', '.join(CUSTOMER_NAMES)} from ({MAPPED['crm_contacts']}))" for c in CUSTOMER_NAMES))
def null_counts(spark, folder):
    return null_counts_of(customer_rows(spark, folder))


@query("error_sample", f"""
    select unified_subscription_id as row_key,
      'Row ' || unified_subscription_id || ' failed: ' || substr({_faults('subscriptions')}, 1, 150) as error
    from ({MAPPED['billing_subscriptions']}) where {_faults('subscriptions')} <> ''
    order by 1 nulls first, 2 limit 10""")
def error_sample(spark, folder):
    return error_sample_of(subscriptions(spark, folder), ROW_RULES["subscriptions"])


@query("valid_by_table", " union all ".join(
    f"select '{n}' as dataset, {_faults(n)} = '' as is_valid, count(*) as n from ({_TABLES[n][0]}) group by 2"
    for n in _TABLES))
def valid_by_table(spark, folder):
    def count(name: str, rows: DataFrame) -> DataFrame:
        return rows.groupBy(row_is_valid(rows, ROW_RULES[name]).alias("is_valid")).agg(
            F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("dataset"), "is_valid", "n")

    return reduce(DataFrame.unionByName, [count(n, t) for n, t in all_tables(spark, folder).items()])


_LONG = {"phone": ("c_custkey % 7 = 0", 64), "billing_city": ("c_custkey % 5 = 0", 128), "preferred_currency": ("c_custkey % 3 = 0", 8)}


@query("storage_faults", f"""
    select 'cus_' || cast(c_custkey as varchar) as id, concat_ws('; ',
      case when c_custkey % 11 = 0 then 'source_id is required' end,
      {", ".join(f"case when {rule} then '{name} is longer than {n}' end" for name, (rule, n) in sorted(
          _LONG.items(), key=lambda x: ["phone", "billing_city", "preferred_currency"].index(x[0])))}) as broken
    from customer""")
def storage_faults(spark, folder):
    """Customers with values one character too long, just long enough, or missing: each row names what it breaks."""
    rows = mapping.billing_customers(raw(spark, folder, "billing_customers"), AS_OF)
    number = F.substring("stripe_customer_id", 5, 20).cast("bigint")
    for name, divisor in (("phone", 7), ("billing_city", 5), ("preferred_currency", 3)):
        limit = _LONG[name][1]
        rows = rows.withColumn(name, F.when(number % divisor == 0, F.repeat(F.lit("x"), F.lit(limit + 1))).otherwise(F.repeat(F.lit("x"), F.lit(limit))))
    rows = rows.withColumn("source_id", F.when(number % 11 != 0, F.col("source_id")))
    return check_rows(rows, storage_rules("dim_customers")).select(
        F.col("stripe_customer_id").alias("id"), F.array_join("failed_rules", "; ").alias("broken"))


@query("gate_verdicts", f"""
    with r as (select *, row_number() over () as at from (
      {" union all ".join(f"select {k} as k, * from ({_report(n, 99.5)})" for k, n in enumerate(_TABLES))})),
    f as (select min(k) as first from r where not passed_threshold)
    select dataset_name, quality_score_percent,
      case when k > first then 'not reached' when k = first then 'stopped' else 'passed' end as verdict from r, f""")
def gate_verdicts(spark, folder):
    """The gate as rows, with the pass mark set so high that it stops somewhere."""
    return gate_verdicts_of(quality_reports(
        [(REPORT_NAMES[n], t, ROW_RULES[n]) for n, t in all_tables(spark, folder).items()], threshold=99.5))

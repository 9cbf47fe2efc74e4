"""Row rules, quality reports, the quality gate and warning rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tallyweave.functions.numbers import round2
from tallyweave.functions.times import is_iso_time
from tallyweave.schemas import BILLING, CRM, MERGED, QUALITY_REPORT, TargetTable, target_table

# Pass mark, number of errors shown, and their length.
PASS_PERCENT = 95.0
ERRORS_SHOWN = 10
ERROR_LENGTH = 150


@dataclass(frozen=True)
class Rule:
    """One condition on one column; a row is valid when all rules hold."""

    name: str
    column: str
    check: str                      # required, one_of, time, max_length
    options: tuple = ()

    def holds(self) -> Column:
        value = F.col(self.column)
        if self.check == "required":
            return value.isNotNull()
        if self.check == "one_of":
            return F.coalesce(value.isin(*self.options), F.lit(False))
        if self.check == "time":
            return value.isNull() | is_iso_time(value)
        if self.check == "max_length":
            return F.coalesce(F.length(value) <= self.options[0], F.lit(True))
        raise ValueError(f"unknown check '{self.check}'")


@dataclass(frozen=True)
class RuleSet:
    """Rules of a table as data, with the columns that have a default when absent."""

    key: str
    rules: tuple[Rule, ...]
    defaulted: frozenset[str]

    def for_columns(self, columns: Iterable[str]) -> list[Rule]:
        """An absent column takes its default, if it has one, and then nothing is checked.

        Without a default it fails as a missing value does.
        """
        present = set(columns)
        return [r for r in self.rules if r.column in present or r.column not in self.defaulted]


def _rule_set(key: str, required: str, sources: Sequence[str], times: str, defaulted: str) -> RuleSet:
    rules = [Rule(f"{c} is required", c, "required") for c in required.split()]
    rules.append(Rule("source_system is not allowed", "source_system", "one_of", tuple(sources)))
    rules += [Rule(f"{c} is not a timestamp", c, "time") for c in times.split()]
    return RuleSet(key, tuple(rules), frozenset(defaulted.split()))


# Which columns must be present, parse as a timestamp, or have a default.
ROW_RULES: dict[str, RuleSet] = {
    "customers": _rule_set(
        "unified_customer_id",
        "unified_customer_id source_id preferred_currency is_active ingestion_timestamp",
        (BILLING, CRM, MERGED),
        "source_created_at source_updated_at ingestion_timestamp",
        "preferred_currency is_active source_created_at source_updated_at ingestion_timestamp",
    ),
    "transactions": _rule_set(
        "unified_transaction_id",
        "unified_transaction_id source_transaction_id amount amount_refunded net_amount currency "
        "status is_paid is_refunded transaction_date ingestion_timestamp",
        (BILLING, CRM),
        "transaction_date ingestion_timestamp",
        "amount_refunded net_amount currency is_paid is_refunded ingestion_timestamp",
    ),
    "subscriptions": _rule_set(
        "unified_subscription_id",
        "unified_subscription_id source_subscription_id source_customer_id status mrr_amount "
        "currency cancel_at_period_end created_at ingestion_timestamp",
        (BILLING, CRM),
        "current_period_start current_period_end created_at ingestion_timestamp",
        "mrr_amount currency current_period_start current_period_end cancel_at_period_end "
        "ingestion_timestamp",
    ),
    "companies": _rule_set(
        "unified_account_id",
        "unified_account_id source_account_id company_name created_at updated_at "
        "ingestion_timestamp",
        (BILLING, CRM),
        "created_at updated_at ingestion_timestamp",
        "ingestion_timestamp",
    ),
}


def storage_rules(table: TargetTable | str) -> RuleSet:
    """NOT NULL and length limits of a warehouse table."""
    table = target_table(table) if isinstance(table, str) else table
    rules = [Rule(f"{c.name} is required", c.name, "required") for c in table.columns if not c.nullable]
    rules += [
        Rule(f"{c.name} is longer than {c.length}", c.name, "max_length", (c.length,))
        for c in table.columns if c.length
    ]
    # An absent column is filled by the load: with its default, or null where null is allowed.
    filled = [c.name for c in table.columns if c.nullable or c.default is not None]
    return RuleSet(table.key, tuple(rules), frozenset(filled))


def _conditions(df: DataFrame, rules: RuleSet) -> list[tuple[str, Column]]:
    present = set(df.columns)
    return [
        (r.name, r.holds() if r.column in present else F.lit(False))
        for r in rules.for_columns(df.columns)
    ]


def row_is_valid(df: DataFrame, rules: RuleSet) -> Column:
    return reduce(lambda a, b: a & b, [c for _, c in _conditions(df, rules)], F.lit(True))


def failed_rules(df: DataFrame, rules: RuleSet) -> Column:
    """Names of the rules that a row breaks, in rule order."""
    marks = [F.when(~holds, F.lit(name)) for name, holds in _conditions(df, rules)]
    return F.array_compact(F.array(*marks)) if marks else F.array().cast("array<string>")


def check_rows(df: DataFrame, rules: RuleSet) -> DataFrame:
    """The table with ``failed_rules`` and ``is_valid``."""
    return df.withColumn("failed_rules", failed_rules(df, rules)).withColumn(
        "is_valid", F.size("failed_rules") == 0
    )


def null_counts(df: DataFrame) -> DataFrame:
    """One row ``(column_name, null_count)`` per column, from a single aggregation."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in df.columns
    ])
    return counts.select(F.inline(pairs))


def error_sample(df: DataFrame, rules: RuleSet, size: int = ERRORS_SHOWN) -> DataFrame:
    """The first failing rows by key, each with a short message; a top-k, not a full sort."""
    key = F.col("row_key")
    broken = F.array_join("failed_rules", "; ")
    message = F.concat(
        F.lit("Row "), F.coalesce(key, F.lit("None")), F.lit(" failed: "),
        F.substring(broken, 1, ERROR_LENGTH),
    )
    marked = df.select(F.col(rules.key).alias("row_key"), failed_rules(df, rules).alias("failed_rules"))
    # Failing rows sort first and sound ones are removed after the limit: a filter before it
    # would be pushed down and evaluate every rule a second time.
    first = (
        marked.select("row_key", message.alias("error"), (F.size("failed_rules") == 0).alias("is_valid"))
        .orderBy("is_valid", key.asc_nulls_first(), "error")
        .limit(size)
    )
    return first.where(~F.col("is_valid")).select("row_key", "error")


def _score(total: Column, valid: Column) -> Column:
    return F.when(total == 0, F.lit(100.0)).otherwise(
        valid.cast("double") / F.nullif(total, F.lit(0)).cast("double") * 100.0
    )


def quality_totals(
    df: DataFrame, rules: RuleSet, dataset: str, threshold: float = PASS_PERCENT
) -> DataFrame:
    """Counts, null counts, score and verdict in one pass over the table.

    The verdict compares the score before rounding. An empty table scores 100 and passes,
    with no null counts.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(row_is_valid(df, rules)).alias("valid_records"),
        F.struct(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).alias("_nulls"),
    )
    total, valid = F.col("total_records"), F.col("valid_records")
    pairs = []
    for c in df.columns:
        pairs += [F.lit(c), F.col(f"_nulls.{c}")]
    no_counts = F.create_map().cast(T.MapType(T.StringType(), T.LongType()))
    score = _score(total, valid)
    return counts.select(
        F.lit(dataset).alias("dataset_name"),
        "total_records",
        "valid_records",
        (total - valid).alias("invalid_records"),
        F.when(total > 0, F.create_map(*pairs)).otherwise(no_counts).alias("null_counts_by_field"),
        round2(score).alias("quality_score_percent"),
        (score >= threshold).alias("passed_threshold"),
    )


def quality_report(
    df: DataFrame, rules: RuleSet, dataset: str, threshold: float = PASS_PERCENT
) -> DataFrame:
    """The full one-row report: the totals, and the first errors from a bounded top-k."""
    totals = quality_totals(df, rules, dataset, threshold)
    errors = error_sample(df, rules).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("row_key", "error"))), lambda e: e["error"]
        ).alias("validation_errors"),
    )
    # A scalar subquery: at most ten short texts.
    return totals.withColumn("validation_errors", errors.scalar()).select(*QUALITY_REPORT.fieldNames())


def quality_reports(
    tables: Iterable[tuple[str, DataFrame, RuleSet]], threshold: float = PASS_PERCENT
) -> DataFrame:
    """One report row per ``(dataset name, table, rules)``."""
    return reduce(
        DataFrame.unionByName,
        [quality_report(df, rules, name, threshold) for name, df, rules in tables],
    )


def quality_state(df: DataFrame, rules: RuleSet, dataset: str, part: str) -> DataFrame:
    """What one part of a table, such as a micro-batch, adds to its report, as one row.

    ``folded_reports`` makes reports from many of them, without the rows. ``df`` is read twice.
    """
    errors = error_sample(df, rules).agg(F.collect_list(F.struct("row_key", "error")).alias("errors"))
    return quality_totals(df, rules, dataset).select(
        "dataset_name", F.lit(part).alias("part"), "total_records", "valid_records", "null_counts_by_field",
        errors.scalar().alias("errors"))


def folded_reports(states: DataFrame, threshold: float = PASS_PERCENT) -> DataFrame:
    """The reports of the tables whose parts are given, one row per dataset.

    A part that is there twice, as a repeated micro-batch leaves it, counts once. Parts of a
    table must not share rows; a key that stands in two parts is two rows. No states give no reports.
    """
    parts = states.dropDuplicates(["dataset_name", "part"])
    sums = parts.groupBy("dataset_name").agg(F.sum("total_records").alias("total_records"), F.sum("valid_records").alias("valid_records"))
    # Fields keep the order in which the parts name them.
    fields = parts.select("dataset_name", F.posexplode("null_counts_by_field").alias("at", "field", "n")).groupBy("dataset_name", "field").agg(
        F.min("at").alias("at"), F.sum("n").alias("n"))
    nulls = fields.groupBy("dataset_name").agg(F.array_sort(F.collect_list(F.struct("at", "field", "n"))).alias("_nulls"))
    first = Window.partitionBy("dataset_name").orderBy(F.col("row_key").asc_nulls_first(), "error")
    shown = parts.select("dataset_name", F.inline("errors")).withColumn("at", F.row_number().over(first)).where(F.col("at") <= ERRORS_SHOWN)
    errors = shown.groupBy("dataset_name").agg(F.array_sort(F.collect_list(F.struct("at", "error"))).alias("_errors"))
    total, valid = F.col("total_records"), F.col("valid_records")
    score = _score(total, valid)
    pairs = F.transform(F.coalesce("_nulls", F.array().cast("array<struct<at:int,field:string,n:bigint>>")), lambda x: F.struct(x["field"], x["n"]))
    return sums.join(nulls, "dataset_name", "left").join(errors, "dataset_name", "left").select(
        "dataset_name", "total_records", "valid_records", (total - valid).alias("invalid_records"),
        F.map_from_entries(pairs).alias("null_counts_by_field"),
        round2(score).alias("quality_score_percent"), (score >= threshold).alias("passed_threshold"),
        F.coalesce(F.transform("_errors", lambda e: e["error"]), F.array().cast("array<string>")).alias("validation_errors"),
    ).select(*QUALITY_REPORT.fieldNames())


class QualityGateError(ValueError):
    """A dataset scored below the pass mark."""


def quality_gate(reports: DataFrame) -> None:
    """Stop at the first dataset, in report order, that does not pass."""
    failing = reports.where(~F.col("passed_threshold")).select("dataset_name", "quality_score_percent")
    first = failing.head(1)
    if first:
        name, score = first[0]
        # Fixed value: the text of the gate.
        raise QualityGateError(f"Data Quality Gate Failed for {name}: {score:.1f}%")


def gate_verdicts(reports: DataFrame) -> DataFrame:
    """What the gate makes of each report: ``dataset_name``, ``quality_score_percent``, ``verdict``.

    ``passed``; ``stopped`` for the first dataset, in report order, that does not pass; and
    ``not reached`` for those behind it.
    """
    at = F.monotonically_increasing_id()
    ordered = reports.select("dataset_name", "quality_score_percent", "passed_threshold", at.alias("at"))
    stops = F.min(F.when(~F.col("passed_threshold"), F.col("at"))).over(Window.partitionBy())     # a row per dataset
    behind = F.col("at") > F.col("first")
    return ordered.withColumn("first", stops).select(
        "dataset_name", "quality_score_percent",
        F.when(behind, "not reached").when(F.col("at") == F.col("first"), "stopped").otherwise("passed").alias("verdict"))


def quality_alerts(reports: DataFrame) -> DataFrame:
    """A warning row per dataset that does not pass; delivery is up to the caller."""
    # Title and summary of a warning.
    return reports.where(~F.col("passed_threshold")).select(
        "dataset_name",
        "total_records",
        "invalid_records",
        "quality_score_percent",
        F.concat(F.lit("Data Quality Threshold Warning - "), F.col("dataset_name")).alias("title"),
        F.format_string(
            "Dataset '%s' score dropped to %.1f%% (%d/%d invalid records).",
            "dataset_name", round2(F.col("quality_score_percent"), 10.0), "invalid_records", "total_records",
        ).alias("summary"),
        F.nullif(F.array_join("validation_errors", "\n"), F.lit("")).alias("error_message"),
    )

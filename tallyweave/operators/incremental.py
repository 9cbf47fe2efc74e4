"""Incremental reads, paging checks and the extraction state."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tallyweave.functions.times import ISO_FORMAT, parse_time
from tallyweave.schemas import EXTRACT_STATE
from tallyweave.session import fresh_folder, stored
from tallyweave.sources.landing import BATCH, EXTRACTED, FILE

# -- incremental reads ---------------------------------------------------------


def _whole_second(moment: datetime) -> datetime:
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc).replace(microsecond=0)


def _not_before(df: DataFrame, column: str, watermark: datetime) -> Column:
    """``column >= watermark`` in the type of the column, so that it reaches the scan."""
    moment = _whole_second(watermark)
    kind = df.schema[column].dataType
    if isinstance(kind, T.NumericType):
        return F.col(column) >= F.lit(int(moment.timestamp()))
    bound = F.lit(moment.strftime("%Y-%m-%d %H:%M:%S"))
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return F.col(column) >= bound.cast(kind)
    return parse_time(F.col(column)) >= bound.cast("timestamp")


def incremental_read(
    df: DataFrame, fields: Sequence[str], watermark_col: str, watermark: datetime | None = None,
    limit: int | None = None, ordered: bool = True,
) -> DataFrame:
    """The named fields of rows changed at or after the watermark, oldest first.

    The watermark counts in whole seconds and is inclusive: boundary rows come again, and the
    upsert absorbs them. ``ordered=False`` saves the sort when the order does not matter.
    """
    rows = df if watermark is None else df.where(_not_before(df, watermark_col, watermark))
    if ordered:
        kind = df.schema[watermark_col].dataType
        order = parse_time(F.col(watermark_col)) if isinstance(kind, T.StringType) else F.col(watermark_col)
        rows = rows.orderBy(order.asc())
    rows = rows.select(*fields)
    return rows.limit(limit) if limit else rows


def created_since(df: DataFrame, watermark: datetime | None, created_col: str = "created") -> DataFrame:
    """Rows created at or after the watermark. Later changes to older rows are not seen."""
    return df if watermark is None else df.where(_not_before(df, created_col, watermark))


def cursor_page(df: DataFrame, key: str, cursor: str | int | None, limit: int) -> DataFrame:
    """The next ``limit`` rows after the cursor in key order: a top-k, never a full sort."""
    rows = df if cursor is None else df.where(F.col(key) > F.lit(cursor))
    return rows.orderBy(F.col(key).asc()).limit(limit)


def next_cursor(page: DataFrame, key: str) -> DataFrame:
    """One row: the size of a page and the cursor to go on from (null after an empty page)."""
    return page.agg(F.count(F.lit(1)).alias("records"), F.max(key).alias("next_cursor"))


def cursor_range(df: DataFrame, key: str, after: str | int | None, upto: str | int | None) -> DataFrame:
    """Rows with ``after < key <= upto``: the form for large batches."""
    if after is not None:
        df = df.where(F.col(key) > F.lit(after))
    return df if upto is None else df.where(F.col(key) <= F.lit(upto))


def page_completeness(pages: DataFrame) -> DataFrame:
    """Whether a chain of pages was landed whole, per ``chain``.

    ``pages`` has ``chain, locator, next_locator, total_size, records_in_page``, the first
    page with a null locator. A page is missing when another page points to it and it is not there.
    """
    links = pages.where(F.col("next_locator").isNotNull()).select("chain", F.col("next_locator").alias("locator"))
    missing = (
        links.join(pages.where(F.col("locator").isNotNull()).select("chain", "locator"),
                   ["chain", "locator"], "left_anti")
        .groupBy("chain").agg(F.count(F.lit(1)).alias("missing_pages"))
    )
    found = pages.groupBy("chain").agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum("records_in_page").alias("records"),
        F.max("total_size").alias("total_size"),
    )
    missing_pages = F.coalesce("missing_pages", F.lit(0)).cast("long")
    return found.join(missing, "chain", "left").select(
        "chain", "pages", "records", "total_size",
        missing_pages.alias("missing_pages"),
        ((missing_pages == 0) & (F.col("records") == F.col("total_size"))).alias("is_complete"),
    )


#: What a page is in its chain: reached from the first page, after a gap, or on or behind a loop.
CHAINED, ORPHANED, CYCLIC = "chained", "orphaned", "cyclic"


def page_chain(pages: DataFrame) -> DataFrame:
    """The place of every landed page in its chain: ``chain``, ``locator``, ``page_number``, ``state``, ``is_fork``.

    ``pages`` has ``chain, locator, next_locator``, the first page of a chain with a null
    locator. Numbers start at 0 and are null for pages that the first one does not lead to.
    ``is_fork`` marks a page that names several next ones, as when it was fetched twice and the
    source had moved on. A page named by several counts from the lowest of them. Repeated rows
    are one page.

    Places are found by pointer jumping: each page points to the one before it, and with every
    round to one twice as far, so the rounds grow with the logarithm of the longest chain. A
    round is one join on the page, stored in the shared folder.
    """
    start = ""      # a locator is never empty text
    links = pages.select("chain", F.coalesce("locator", F.lit(start)).alias("locator"), "next_locator").distinct()
    own = links.groupBy("chain", "locator").agg((F.count("next_locator") > 1).alias("is_fork"))
    before = links.where(F.col("next_locator").isNotNull()).groupBy("chain", F.col("next_locator").alias("locator")).agg(
        F.min("locator").alias("to"))
    nodes = own.join(before, ["chain", "locator"], "left").withColumn(
        "to", F.when(F.col("locator") != start, F.col("to")))       # nothing stands before the first page
    current = _written(nodes.select(
        "chain", "locator", "is_fork", "to", F.when(F.col("to").isNotNull(), 1).otherwise(0).cast("long").alias("steps"),
        F.col("locator").alias("head")), "chain")
    # Pages of the longest chain: after that many steps, only a loop is still on its way.
    longest = current.groupBy("chain").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).head()[0] or 0
    for _ in range(max(1, longest).bit_length()):
        there = current.select("chain", F.col("locator").alias("to"), F.col("to").alias("_to"), F.col("steps").alias("_steps"), F.col("head").alias("_head"))
        moved = current.join(there, ["chain", "to"], "left")
        jumps = F.col("to").isNotNull()
        # A page that is pointed to but has not landed heads nothing: its follower does.
        current = _written(moved.select(
            "chain", "locator", "is_fork", F.col("_to").alias("to"),
            (F.col("steps") + F.when(jumps, F.coalesce("_steps", F.lit(0))).otherwise(0)).alias("steps"),
            F.when(jumps, F.col("_head")).otherwise(F.col("head")).alias("head")), "chain")
    state = F.when(F.col("to").isNotNull(), CYCLIC).when(F.col("head") == start, CHAINED).otherwise(ORPHANED)
    return current.select(
        "chain", F.nullif("locator", F.lit(start)).alias("locator"),
        F.when(state == CHAINED, F.col("steps")).alias("page_number"), state.alias("state"), "is_fork")


def _written(df: DataFrame, label: str) -> DataFrame:
    folder = fresh_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def cursor_ranges(df: DataFrame, key: str, ranges: int) -> DataFrame:
    """Cursor ranges of like size over a table: ``range``, ``after``, ``upto`` (null: no bound).

    ``cursor_range`` reads one of them, so that a table can be extracted by ``ranges`` readers
    at once. Only the key column is read. Numbers go through a quantile sketch; other keys are
    sorted and counted range by range, as a sketch cannot hold them. A key that fills more than
    a range leaves fewer ranges. An empty table is one range without bounds.
    """
    keys = df.select(F.col(key).alias("key")).where(F.col("key").isNotNull())
    shares = [k / ranges for k in range(1, ranges)]
    if not shares:
        bounds = keys.limit(0)
    elif isinstance(df.schema[key].dataType, T.NumericType):
        bounds = keys.agg(F.percentile_approx("key", shares, 100 * ranges).alias("cuts")).select(F.explode("cuts").alias("key"))
    else:
        bounds = _cuts(keys, ranges)
    # As many rows as there are ranges.
    number = Window.orderBy("key")
    cuts = bounds.distinct().withColumns({
        "range": F.row_number().over(number) - 1, "after": F.lag("key").over(number)}).withColumnRenamed("key", "upto")
    last = cuts.agg(F.count(F.lit(1)).cast("int").alias("range"), F.max("upto").alias("after")).withColumn(
        "upto", F.lit(None).cast(df.schema[key].dataType))
    return cuts.select("range", "after", "upto").unionByName(last)


def _cuts(keys: DataFrame, ranges: int) -> DataFrame:
    """The keys at like distances in sorted order."""
    part = _written(keys.repartitionByRange("key").withColumn("part", F.spark_partition_id()), "keys")
    sizes = part.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)     # a row per partition
    starts = sizes.withColumns({"start": F.coalesce(F.sum("n").over(before), F.lit(0)), "total": F.sum("n").over(Window.partitionBy())})
    place = F.col("start") + F.row_number().over(Window.partitionBy("part").orderBy("key"))
    ranked = part.join(starts.drop("n"), "part").withColumn("place", place)
    # The last key of every range but the last.
    ends = F.floor(F.col("place") * ranges / F.col("total")) > F.floor((F.col("place") - 1) * ranges / F.col("total"))
    return ranked.where(ends & (F.col("place") < F.col("total"))).select("key")


def extract_summary(landed: DataFrame, source: str, entity: str) -> DataFrame:
    """Records, files, first and last extraction and seconds between them, per batch.

    Files are grouped first, so counting them needs no distinct over all records.
    """
    per_file = landed.groupBy(BATCH, FILE).agg(
        F.count(F.lit(1)).alias("n"), F.min(EXTRACTED).alias("lo"), F.max(EXTRACTED).alias("hi")
    )
    first, last = F.min("lo").try_cast("timestamp"), F.max("hi").try_cast("timestamp")
    return per_file.groupBy(F.col(BATCH).alias("batch_id")).agg(
        F.lit(source).alias("source"),
        F.lit(entity).alias("entity"),
        F.sum("n").alias("total_records"),
        F.count(F.lit(1)).alias("files"),
        F.date_format(first, ISO_FORMAT).alias("start_time"),
        F.date_format(last, ISO_FORMAT).alias("end_time"),
        (F.unix_timestamp(last) - F.unix_timestamp(first)).alias("duration_seconds"),
    )


# -- state ---------------------------------------------------------------------


def live_state(log: DataFrame) -> DataFrame:
    """Rows of the state log that no later reset covers.

    A reset row names a source and an entity, only a source, or neither (everything).
    """
    resets = log.where("is_reset")
    whole = resets.where(F.col("source").isNull()).agg(F.max("last_run_at").alias("t")).scalar()
    by_source = (
        resets.where(F.col("source").isNotNull() & F.col("entity").isNull())
        .groupBy("source").agg(F.max("last_run_at").alias("_source_reset"))
    )
    by_entity = (
        resets.where(F.col("source").isNotNull() & F.col("entity").isNotNull())
        .groupBy("source", "entity").agg(F.max("last_run_at").alias("_entity_reset"))
    )
    # ``greatest`` passes over nulls, so it is null only when there was no reset at all.
    last_reset = F.greatest("_source_reset", "_entity_reset", whole)
    return (
        log.where(~F.col("is_reset"))
        .join(by_source, "source", "left")
        .join(by_entity, ["source", "entity"], "left")
        .where(last_reset.isNull() | (F.col("last_run_at") > last_reset))
        .select(*log.columns)
    )


def latest_state(log: DataFrame) -> DataFrame:
    """Current state per source and entity.

    A run without a watermark keeps the one before; the cursor is that of the last run, also
    when it is null.
    """
    ran = F.col("last_run_at")
    marked = F.when(F.col("last_extracted_timestamp").isNotNull(), ran)
    last = F.max_by(F.struct("last_cursor", "records_synced_last_run", "status"), ran)
    return (
        live_state(log)
        .groupBy("source", "entity")
        .agg(
            F.max_by("last_extracted_timestamp", marked).alias("last_extracted_timestamp"),
            last.alias("_last"),
            F.max(ran).alias("last_run_at"),
        )
        .select(
            "source", "entity", "last_extracted_timestamp", "_last.last_cursor", "last_run_at",
            "_last.records_synced_last_run", "_last.status",
        )
    )


def compacted_log(log: DataFrame) -> DataFrame:
    """The rows of a state log that can still decide a later answer, at most two per key and kind.

    These are the last run, the last run with a watermark, and the last reset of every source
    and entity. A row with a later one of its kind is never asked for: a reset that covers the
    later one covers it as well. Whatever is added, the log gives the same state as before.
    """
    row, ran = F.struct(*log.columns), F.col("last_run_at")
    marked = F.when(F.col("last_extracted_timestamp").isNotNull(), ran)
    kept = log.groupBy("source", "entity", "is_reset").agg(F.max_by(row, ran).alias("last"), F.max_by(row, marked).alias("marked"))
    rows = F.array_distinct(F.array_compact(F.array("last", "marked")))
    return kept.select(F.explode(rows).alias("row")).select("row.*")


def effective_watermark(given: Column, stored: Column) -> Column:
    """The watermark asked for, else the stored one when it can be read."""
    return F.coalesce(given.try_cast("timestamp"), parse_time(stored))


def advance_watermark(df: DataFrame, watermark_col: str) -> DataFrame:
    """The newest change among the rows read: the watermark that misses nothing."""
    return df.agg(F.max(parse_time(F.col(watermark_col))).alias("next_watermark"))


class ExtractState:
    """State log at ``path`` and its snapshot beside it; every read takes the latest row per key.

    Each update adds a file, so ``compact`` should be called now and then: it leaves what still
    counts in the snapshot and an empty log.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.snapshot = f"{self.path}-snapshot"

    def _rows(self, path: str) -> DataFrame:
        try:
            return self.spark.read.schema(EXTRACT_STATE).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], EXTRACT_STATE)

    def log(self) -> DataFrame:
        """Snapshot and log. A row may stand in both, which changes no answer."""
        return self._rows(self.snapshot).unionByName(self._rows(self.path))

    def compact(self) -> None:
        """Take the log into the snapshot; not to be run beside updates.

        At every moment the log or the snapshot holds all rows that count, so what stops halfway
        loses nothing and can be repeated.
        """
        with stored(compacted_log(self.log()), "state") as kept:
            kept.write.mode("append").parquet(self.path)
            kept.write.mode("overwrite").parquet(self.snapshot)
            self.spark.createDataFrame([], EXTRACT_STATE).write.mode("overwrite").parquet(self.path)

    def latest(self) -> DataFrame:
        return latest_state(self.log())

    def _append(self, **values) -> None:
        row = {f.name: values.get(f.name) for f in EXTRACT_STATE.fields}
        frame = self.spark.range(1).select(
            *[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in EXTRACT_STATE.fields])
        frame.write.mode("append").parquet(self.path)

    def update(
        self, source: str, entity: str, watermark: datetime | None = None, cursor: str | None = None,
        records: int = 0, status: str = "COMPLETED", at: datetime | None = None,
    ) -> None:
        self._append(
            source=source.lower(), entity=entity.lower(),
            last_extracted_timestamp=watermark.isoformat() if watermark else None,
            last_cursor=cursor, last_run_at=_log_time(at), records_synced_last_run=records,
            status=status, is_reset=False,
        )

    def reset(self, source: str | None = None, entity: str | None = None, at: datetime | None = None) -> None:
        """Forget everything, one source, or one entity of a source."""
        self._append(
            source=source.lower() if source else None,
            entity=entity.lower() if source and entity else None,
            last_run_at=_log_time(at), is_reset=True,
        )

    def _entry(self, source: str, entity: str) -> DataFrame:
        return self.latest().where(
            (F.col("source") == source.lower()) & (F.col("entity") == entity.lower()))

    def watermark(self, source: str, entity: str, given: datetime | None = None) -> datetime | None:
        """The given watermark, else the stored one; null when there is none to read."""
        if given is not None:
            return _whole_second(given)
        rows = self._entry(source, entity).select(
            F.date_format(parse_time(F.col("last_extracted_timestamp")), ISO_FORMAT).alias("w")).head(1)
        if not rows or rows[0]["w"] is None:
            return None
        return datetime.fromisoformat(rows[0]["w"].replace("Z", "+00:00"))

    def cursor(self, source: str, entity: str) -> str | None:
        rows = self._entry(source, entity).select("last_cursor").head(1)
        return rows[0]["last_cursor"] if rows else None


def _log_time(at: datetime | None) -> str:
    at = at or datetime.now(timezone.utc)
    if at.tzinfo is not None:
        at = at.astimezone(timezone.utc)
    return at.strftime("%Y-%m-%d %H:%M:%S.%f")

"""List responses to landed records: unwrap, check, land, report, and move the state on."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tallyweave.functions.text import WHITE_SPACE
from tallyweave.functions.times import ISO_FORMAT, parse_time
from tallyweave.operators.incremental import ExtractState
from tallyweave.schemas import BILLING, INGESTION_METADATA, RAW_KEY, RAW_WATERMARK
from tallyweave.session import prepare, stored
from tallyweave.sources.landing import entity_folder, write_landing
from tallyweave.sources.quarantine import UNREADABLE, Quarantine, rejected
from tallyweave.sources.raw_check import check_raw

#: What the next extraction starts from: the newest change among the records, which misses
#: nothing, or the end of this run, as sources without a change date need it.
MAX_RECORD, RUN_END = "max_record", "run_end"
COMPLETED, FAILED = "COMPLETED", "FAILED"


@dataclass(frozen=True)
class Ingested:
    batch_id: str
    pages: int
    records: int
    invalid: int
    broken: int
    watermark: datetime | None
    cursor: str | None


def _items(responses: DataFrame, json_col: str, source: str) -> DataFrame:
    """One row per item of every list, as JSON text; a text that is no list response is one row itself."""
    name = "data" if source == BILLING else "records"
    parsed = responses.select(F.col(json_col).alias("_page"), F.try_variant_get(
        F.try_parse_json(json_col), f"$.{name}", "array<variant>").alias("_items"))
    split = parsed.select("_page", F.col("_items").isNull().alias("_is_broken"), F.posexplode_outer("_items").alias("_pos", "_item"))
    text = F.when(F.col("_is_broken"), F.col("_page")).otherwise(F.coalesce(F.to_json("_item"), F.lit("null")))
    # An empty list is a page without items.
    return split.where(F.col("_is_broken") | F.col("_pos").isNotNull()).select(
        text.alias("_text"), (~F.col("_is_broken") & F.btrim(text, F.lit(WHITE_SPACE)).startswith("{")).alias("_is_record"))


def ingest(
    responses: DataFrame, json_col: str, root: str, source: str, entity: str, state: ExtractState, batch_id: str,
    started: datetime, ended: datetime | None = None, mark: str = MAX_RECORD,
) -> Ingested:
    """Land the records of list responses (JSON text, a page per row) as one batch.

    Every record lands, checked or not, as the mapping copes with both: a valid one typed and
    with its defaults, another as it came. What is no record goes to the quarantine of the root.
    Counts, watermark and cursor come out of the pass that stores the records. The state moves
    on after the batch has landed, so a failure before that extracts again, and is noted; a
    repeated batch lands again and loads as one.
    """
    if mark not in (MAX_RECORD, RUN_END):
        raise ValueError(f"mark is '{MAX_RECORD}' or '{RUN_END}', not '{mark}'")
    source, entity = source.lower(), entity.lower()
    spark = prepare(responses.sparkSession)
    folder = entity_folder(root, source, entity)
    try:
        found = _land(responses, json_col, root, source, entity, batch_id, started)
        ended = ended or datetime.now(timezone.utc)
        pages = responses.count()
        newest = datetime.fromisoformat(found["watermark"].replace("Z", "+00:00")) if found["watermark"] else None
    except Exception as error:
        ended = ended or datetime.now(timezone.utc)
        state.update(source, entity, cursor=state.cursor(source, entity), status=FAILED, at=ended)
        _note(spark, root, batch_id=batch_id, source=source, entity=entity, records_extracted=0, start_time=started,
              end_time=ended, status=FAILED, error_message=str(error)[:1000])
        raise
    result = Ingested(
        batch_id, pages, found["records"], found["invalid"], found["broken"], ended if mark == RUN_END else newest, found["cursor"])
    state.update(source, entity, result.watermark, result.cursor, result.records, COMPLETED, ended)
    _note(spark, root, batch_id=batch_id, source=source, entity=entity, records_extracted=result.records,
          records_transformed=result.records - result.invalid, s3_raw_path=folder, start_time=started, end_time=ended, status=COMPLETED)
    return result


def _land(
    responses: DataFrame, json_col: str, root: str, source: str, entity: str, batch_id: str, started: datetime,
) -> dict:
    checked = check_raw(_items(responses, json_col, source), "_text", source, entity)
    is_record = F.col("_is_record")
    changed = parse_time(F.when(is_record, F.col(f"record.{RAW_WATERMARK[source]}")))
    seen = Observation(f"ingest-{batch_id}")
    observed = checked.observe(
        seen,
        F.count_if(is_record).alias("records"),
        F.count_if(is_record & ~F.col("is_schema_valid")).alias("invalid"),
        F.count_if(~is_record).alias("broken"),
        F.date_format(F.max(changed), ISO_FORMAT).alias("watermark"),
        F.max(F.when(is_record, F.col(f"record.{RAW_KEY[source]}"))).alias("cursor"),
    )
    at = F.lit(started.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f"))
    with stored(observed, f"{entity}_checked") as rows:
        found = seen.get
        if found["broken"]:
            name = f"{source}/{entity}"
            Quarantine(responses.sparkSession, f"{root.rstrip('/')}/rejects").add(rows.where(~is_record).select(*rejected(
                F.lit(name), F.lit(batch_id), F.col("_text"), F.lit(UNREADABLE))), f"ingest/{batch_id}")
        if found["records"]:
            write_landing(rows.where(is_record).select("record.*"), root, source, entity, batch_id, at)
    return found


def _note(spark, root: str, **values) -> None:
    """A row per batch of ``<root>/ingestions``; a repeated batch replaces its row."""
    def value(name: str) -> Column:
        given = values.get(name)
        if isinstance(given, datetime):
            given = given.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
        return F.lit(given).cast(INGESTION_METADATA[name].dataType).alias(name)

    row = spark.range(1).select(*[value(n) for n in INGESTION_METADATA.fieldNames()])
    row.write.mode("overwrite").parquet(f"{root.rstrip('/')}/ingestions/{values['source']}-{values['entity']}-{values['batch_id']}")


def ingestions(spark, root: str) -> DataFrame:
    """Every ingestion of a root with its outcome."""
    return spark.read.schema(INGESTION_METADATA).option("recursiveFileLookup", True).parquet(f"{root.rstrip('/')}/ingestions")

"""The raw landing zone: ``<root>/raw/<source>/<entity>/year=YYYY/month=MM/day=DD/``.

Two layouts are read. ``lines`` is what this library writes: one record per JSON line with
the batch in columns of its own, splittable over many writers. ``envelope`` is one JSON
document per page, ``{metadata, records[]}``, as other producers land it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyweave.functions.text import WHITE_SPACE
from tallyweave.schemas import BILLING, raw_schema, struct_of
from tallyweave.session import FAST_GZIP, OPEN_FILES, setting

LINES, ENVELOPE = "lines", "envelope"
# What happens to text that is no record: an error, left out and read by the functions for
# rejects, or kept as a row with its text, to be told apart by it.
RAISE, REJECT, KEEP = "raise", "reject", "keep"
BROKEN, TEXT, _AT = "_broken", "_text", "_landed_at"
BATCH, EXTRACTED, SEQ, FILE = "_batch_id", "_extracted_at", "_seq", "_file"
# The landing order of a record: what "first" and "last" mean for landed rows.
LANDING_ORDER = (EXTRACTED, BATCH, FILE, SEQ)
LANDING_COLUMNS = (*LANDING_ORDER, "year", "month", "day")
# Fixed value: the largest page of the two sources; an envelope never holds more records.
LARGEST_PAGE = 2000

_LINE_COLUMNS = T.StructType([
    T.StructField(BATCH, T.StringType()),
    T.StructField(EXTRACTED, T.StringType()),
    T.StructField(SEQ, T.LongType()),
])
_DATE_COLUMNS = T.StructType([T.StructField(c, T.IntegerType()) for c in ("year", "month", "day")])
_LISTING = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modified_at", T.TimestampType()),
])
_METADATA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("entity", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("record_count", T.LongType()),
    T.StructField("extracted_at", T.StringType()),
])


def entity_folder(root: str, source: str, entity: str) -> str:
    return f"{root.rstrip('/')}/raw/{source.lower()}/{entity.lower()}"


def _dated(df: DataFrame, at: Column) -> DataFrame:
    """Partition columns, with month and day padded to two digits in the path."""
    return df.withColumns({
        "year": F.date_format(at, "yyyy"), "month": F.date_format(at, "MM"), "day": F.date_format(at, "dd"),
    })


def _write(df: DataFrame, folder: str, compress: bool, per_file: int | None) -> None:
    writer = df.write.mode("append").partitionBy("year", "month", "day")
    writer = writer.options(**FAST_GZIP) if compress else writer.option("compression", "none")
    # A batch has few days: a task writes them side by side, instead of sorting its rows by them.
    with setting(df.sparkSession, OPEN_FILES, "8"):
        (writer.option("maxRecordsPerFile", per_file) if per_file else writer).json(folder)


def write_landing(
    records: DataFrame, root: str, source: str, entity: str, batch_id: str | Column,
    extracted_at: Column, page_size: int | None = None, compress: bool = True,
) -> str:
    """Append a batch as JSON lines; with ``page_size`` no file holds more records than that."""
    rows = records.withColumn(_AT, extracted_at.cast("timestamp")).withColumns({
        BATCH: batch_id if isinstance(batch_id, Column) else F.lit(batch_id),
        EXTRACTED: F.date_format(_AT, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"),
        SEQ: F.monotonically_increasing_id(),
    })
    folder = entity_folder(root, source, entity)
    _write(_dated(rows, F.col(_AT)).drop(_AT), folder, compress, page_size)
    return folder


def _by_seq(a: Column, b: Column) -> Column:
    """A record may hold a map, which has no order, so only the row number is compared."""
    return F.when(a[SEQ] < b[SEQ], -1).when(a[SEQ] > b[SEQ], 1).otherwise(0)


def envelopes(
    records: DataFrame, source: str, entity: str, batch_id: str, extracted_at: Column,
    page_size: int = LARGEST_PAGE,
) -> DataFrame:
    """Pages of at most ``page_size`` records, each as one ``{metadata, records[]}`` row.

    A page is a run of rows of one input partition, so a group never grows beyond the page.
    """
    if not 0 < page_size <= LARGEST_PAGE:
        raise ValueError(f"page_size must be between 1 and {LARGEST_PAGE}")
    rows = records.select(
        F.struct(*records.columns).alias("record"), F.monotonically_increasing_id().alias(SEQ)
    )
    # The id is the partition number followed by a 33-bit row number.
    part = F.shiftright(F.col(SEQ), 33)
    page = F.floor(F.col(SEQ).bitwiseAND(F.lit(2**33 - 1)) / page_size)
    grouped = rows.groupBy(part.alias("part"), page.alias("page")).agg(
        F.array_sort(F.collect_list(F.struct(SEQ, "record")), _by_seq).alias("items")
    )
    return grouped.select(
        F.struct(
            F.lit(source).alias("source"),
            F.lit(entity).alias("entity"),
            F.format_string("%s_p%05d_%04d", F.lit(batch_id), "part", F.col("page") + 1).alias("batch_id"),
            F.size("items").cast("long").alias("record_count"),
            F.date_format(extracted_at.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("extracted_at"),
        ).alias("metadata"),
        F.transform("items", lambda i: i["record"]).alias("records"),
    )


def write_envelopes(pages: DataFrame, root: str, source: str, entity: str, compress: bool = True) -> str:
    """Append pages, one document per file."""
    folder = entity_folder(root, source, entity)
    _write(_dated(pages, F.col("metadata.extracted_at").cast("timestamp")), folder, compress, 1)
    return folder


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _flat(documents: DataFrame, record_fields: Sequence[str], further: Sequence[str]) -> DataFrame:
    # A text that is no envelope has no records; it stays as one row where it is to be kept.
    explode = F.posexplode_outer if further else F.posexplode
    return documents.select(explode("records"), "metadata", FILE, *further, *_DATE_COLUMNS.fieldNames()).select(
        *[F.col(f"col.{n}").alias(n) for n in record_fields],
        F.col("metadata.extracted_at").alias(EXTRACTED),
        F.col("metadata.batch_id").alias(BATCH),
        FILE,
        F.col("pos").cast("long").alias(SEQ),
        *_DATE_COLUMNS.fieldNames(), *further,
    )


def _parsed(texts: DataFrame, record: T.StructType, layout: str) -> DataFrame:
    """Lines or documents with their columns; what is no record has ``_broken``, its text.

    A record is a JSON object. The reader of JSON files would turn other values into rows of
    nulls and drop an empty list, so files are read as text. A value of another type than its
    column makes that value null, not the record unreadable.
    """
    if layout == LINES:
        shape = [*record.fields, *_LINE_COLUMNS.fields]
    elif layout == ENVELOPE:
        shape = [T.StructField("metadata", _METADATA), T.StructField("records", T.ArrayType(record))]
    else:
        raise ValueError(f"unknown layout '{layout}'")
    schema = T.StructType([*shape, T.StructField(BROKEN, T.StringType())])
    # Trimming takes each character of a line, so it is left to lines that begin with something else.
    opens, trimmed = F.col(TEXT).startswith("{"), F.btrim(TEXT, F.lit(WHITE_SPACE))
    # Exploded, as a filter on a plain column would be pushed below it and parse every text again.
    parsed = F.explode(F.array(F.from_json(TEXT, schema, {"columnNameOfCorruptRecord": BROKEN})))
    rows = texts.where(opens | (F.length(trimmed) > 0)).select("*", parsed.alias("_json"))
    # The parser marks a record with a value of another type too; that one is JSON all the same.
    bad = ~(opens | trimmed.startswith("{")) | (F.col(f"_json.{BROKEN}").isNotNull() & F.try_parse_json(TEXT).isNull())
    if layout == ENVELOPE:
        bad = bad | F.col("_json.records").isNull() | F.exists("_json.records", lambda r: r.isNull())
    bad = F.coalesce(bad, F.lit(True))
    columns = {f.name: F.col(f"_json.{f.name}") for f in shape}
    if layout == ENVELOPE:
        columns["records"] = F.when(~bad, columns["records"])
    return rows.select(
        *[c.alias(n) for n, c in columns.items()], F.when(bad, F.col(TEXT)).alias(BROKEN), FILE, *_DATE_COLUMNS.fieldNames())


def _records(texts: DataFrame, record: T.StructType, layout: str, on_broken: str) -> DataFrame:
    if on_broken not in (RAISE, REJECT, KEEP):
        raise ValueError(f"on_broken is '{RAISE}', '{REJECT}' or '{KEEP}', not '{on_broken}'")
    rows, further = _parsed(texts, record, layout), [BROKEN] if on_broken == KEEP else []
    if on_broken == REJECT:
        rows = rows.where(F.col(BROKEN).isNull())
    elif on_broken == RAISE:
        where = F.concat(F.lit("unreadable text in "), F.col(FILE))
        rows = rows.where(F.when(F.col(BROKEN).isNotNull(), F.raise_error(where).cast("boolean")).otherwise(True))
    if layout == ENVELOPE:
        return _flat(rows, record.fieldNames(), further)
    return rows.select(*record.fieldNames(), *LANDING_COLUMNS, *further)


def read_landing(
    spark: SparkSession, root: str, source: str, entity: str, layout: str = LINES,
    days: tuple[str, str] | None = None, record: T.StructType | None = None, on_broken: str = RAISE,
) -> DataFrame:
    """All landed records of an entity with their landing order.

    ``days`` (first and last, ``YYYY-MM-DD``) prunes partitions. An entity without files is
    empty. Plain and gzip files may be mixed. A line or document that is no JSON object is an
    error, with ``on_broken="reject"`` left to ``read_rejects``, or with ``"keep"`` a row with
    its text in ``_broken``. Blank lines are passed over.
    """
    record = record or raw_schema(source, entity)
    texts = _texts(spark, root, source, entity, layout)
    if days:
        texts = texts.where(_day_filter(*days))
    return _records(texts, record, layout, on_broken)


# A stream has to name the columns of the paths, and texts have no other type than text.
_TEXTS = struct_of("value string")
_STREAMED_TEXTS = struct_of("value string, year string, month string, day string")


def _named(files: DataFrame) -> DataFrame:
    """Texts with their file and day; a folder may be there without any day."""
    days = [
        F.col(f.name) if f.name in files.columns and files.schema[f.name].dataType == f.dataType
        else (F.col(f.name) if f.name in files.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in _DATE_COLUMNS.fields
    ]
    return files.select(F.col("value").alias(TEXT), F.col("_metadata.file_path").alias(FILE), *days)


def _texts(spark: SparkSession, root: str, source: str, entity: str, layout: str) -> DataFrame:
    """Lines or documents as text with their file and day; no rows where nothing has landed."""
    # An envelope may span lines, so a file is one document there.
    reader = spark.read.schema(_TEXTS)
    try:
        return _named(reader.text(entity_folder(root, source, entity), wholetext=layout == ENVELOPE))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    return _empty(spark, T.StructType([
        T.StructField(TEXT, T.StringType()), T.StructField(FILE, T.StringType()), *_DATE_COLUMNS.fields]))


def read_rejects(
    spark: SparkSession, root: str, source: str, entity: str, layout: str = LINES,
    days: tuple[str, str] | None = None,
) -> DataFrame:
    """Text that ``read_landing`` cannot read as records: file, landing day and the text itself."""
    texts = _texts(spark, root, source, entity, layout)
    if days:
        texts = texts.where(_day_filter(*days))
    return _parsed(texts, raw_schema(source, entity), layout).where(F.col(BROKEN).isNotNull()).select(
        FILE, *_DATE_COLUMNS.fieldNames(), F.col(BROKEN).alias("text"))


def _day_filter(first: str, last: str) -> Column:
    """A range over the three partition columns, prunable as it uses nothing else."""
    def number(day: str) -> int:
        return int(day.replace("-", ""))
    day = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
    return day.between(number(first), number(last))


def stream_landing(
    spark: SparkSession, root: str, source: str, entity: str, layout: str = LINES,
    files_per_batch: int | None = None, record: T.StructType | None = None, on_broken: str = RAISE,
) -> DataFrame:
    """``read_landing`` as a stream: each file is read once per checkpoint.

    An entity without files is a stream without rows until the first ones land.
    """
    record = record or raw_schema(source, entity)
    reader = spark.readStream.schema(_STREAMED_TEXTS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    folder = entity_folder(root, source, entity)
    try:
        files = reader.text(folder, wholetext=layout == ENVELOPE)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        _empty(spark, record).coalesce(1).write.mode("append").json(folder)     # makes the folder
        files = reader.text(folder, wholetext=layout == ENVELOPE)
    return _records(_named(files), record, layout, on_broken)


def list_batches(spark: SparkSession, root: str, source: str, entity: str) -> DataFrame:
    """Landed files of an entity. Only the file listing is used; no content is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json*")
    try:
        files = reader.load(entity_folder(root, source, entity))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return _empty(spark, _LISTING)
    return files.select("path", "length", F.col("modificationTime").alias("modified_at"))


def landed_batches(landed: DataFrame) -> DataFrame:
    """Batches of a landed table with their size, from the records themselves."""
    return landed.groupBy(BATCH, EXTRACTED, FILE).agg(F.count(F.lit(1)).alias("record_count"))


def _no_list(json_col: str, items: str) -> Column:
    """Whether a text is no JSON document with a list of that name."""
    return F.coalesce(F.try_variant_get(F.try_parse_json(json_col), f"$.{items}", "array<variant>").isNull(), F.lit(True))


def broken_lists(df: DataFrame, json_col: str, source: str) -> DataFrame:
    """The rows whose text is no list response."""
    return df.where(_no_list(json_col, "data" if source.lower() == BILLING else "records"))


def unwrap_list(df: DataFrame, json_col: str, source: str, entity: str, on_broken: str = RAISE) -> DataFrame:
    """Records of list responses held as JSON text, one row each, with the paging fields.

    Billing lists carry ``has_more``; CRM results carry ``totalSize``, ``done`` and
    ``nextRecordsUrl``. Text that is no list response is an error, or with
    ``on_broken="reject"`` left to ``broken_lists``.
    """
    record = T.ArrayType(raw_schema(source, entity))
    if source.lower() == BILLING:
        paging, items = [T.StructField("has_more", T.BooleanType())], "data"
    else:
        paging, items = [
            T.StructField("totalSize", T.LongType()),
            T.StructField("done", T.BooleanType()),
            T.StructField("nextRecordsUrl", T.StringType()),
        ], "records"
    shape = T.StructType([*paging, T.StructField(items, record)])
    bad = _no_list(json_col, items)
    if on_broken == REJECT:
        df = df.where(~bad)
    else:
        df = df.where(F.when(bad, F.raise_error(F.lit("a text is no list response")).cast("boolean")).otherwise(True))
    others = [c for c in df.columns if c != json_col]
    parsed = df.select(*others, F.from_json(json_col, shape).alias("_list"))
    return parsed.select(
        *others,
        *[F.col(f"_list.{f.name}").alias(f.name) for f in paging],
        F.posexplode(f"_list.{items}").alias("pos", "record"),
    )

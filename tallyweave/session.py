"""Session helpers: the time zone the library relies on, and shared scratch space."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
from contextlib import ExitStack, contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
STAGING_DATABASE = "tallyweave_staging"
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# What a task reads of files and of shuffles at most, where it sorts whole rows (some twenty times that in memory).
TASK_SIZES = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
TASK_BYTES = 16 << 20
# A Parquet file is read in whole row groups, so these are small in what is sorted after it is read.
ROW_GROUPS = {"parquet.block.size": 8 << 20}
# JSON lines are packed for little time, not for the last byte.
FAST_GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Lets a join accept sides that are partitioned by the bucket alone.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the library relies on.

    Every text timestamp in the canonical tables is UTC, so the session must be too. The JVM
    does not compile methods of more than 8000 bytes; with this limit Spark splits the code of
    a wide projection instead of leaving one long method to be interpreted.
    """
    for key, value in SETTINGS.items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a session on one machine (tests) may go without the setting and gets a folder of its
    own. On a cluster that folder would be a different one on each machine: an error.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tallyweave-")
        spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; nothing is created until Spark writes to it."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def staging_database(spark: SparkSession) -> str:
    """One database per shared folder, so that a later setting is followed."""
    return f"{STAGING_DATABASE}_{hashlib.md5(shared_folder(spark).encode()).hexdigest()[:8]}"


def short_lived(spark: SparkSession):
    """Drop the shuffle files of every job of a block as it ends, not when the driver next collects garbage.

    For steps that run each of their frames once: a second run would shuffle again.
    """
    return setting(spark, CLEAN_UP, "true")


def size_of(text: str) -> int:
    """Bytes of a size as Spark's settings give it, such as ``16m``."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", text.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


@contextmanager
def small_tasks(spark: SparkSession):
    """Deal files and shuffles out in parts of ``TASK_BYTES`` for the length of a block; smaller settings stay.

    A task that sorts its rows holds them all. A compressed Parquet file of the usual split size
    can have millions.
    """
    with ExitStack() as stack:
        for key in TASK_SIZES:
            if size_of(spark.conf.get(key)) > TASK_BYTES:
                stack.enter_context(setting(spark, key, f"{TASK_BYTES}b"))
        yield


@contextmanager
def stored(df: DataFrame, label: str, parts: str | None = None):
    """The frame as a table in the shared folder for the length of a block.

    It is computed once and its lineage ends here: what is lost with an executor is read
    again, not computed again. ``parts`` names a column of few values; a filter on it reads
    only what it asks for.
    """
    spark = df.sparkSession
    folder, database = shared_folder(spark), staging_database(spark)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{folder}/{database}'")
    name = f"{database}.{label}_{uuid.uuid4().hex[:12]}"
    try:
        writer = df.write.format("parquet").option("compression", "zstd").options(**ROW_GROUPS)
        # A task writes its few parts side by side, instead of sorting its rows by them.
        with short_lived(spark), small_tasks(spark), setting(spark, OPEN_FILES, "8") if parts else nullcontext():
            (writer.partitionBy(parts) if parts else writer).saveAsTable(name)
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """Set one session option for the length of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)

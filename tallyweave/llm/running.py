"""Tables written in the shared folder, and running sums over a whole sorted table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.session import fresh_folder


def laid(df: DataFrame, label: str) -> DataFrame:
    """The frame as Parquet in the folder all executors share; its lineage ends here.

    Readers get the columns they ask for only, and what a lost executor held is read again.
    """
    folder = fresh_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def running(df: DataFrame, order: Sequence[str], out: str, weight: Column | None = None, within: Sequence[str] = ()) -> DataFrame:
    """Adds the sum of ``weight`` (rows, if none is given) over all rows before a row.

    Rows are dealt to ranges of ``order`` and summed range by range; the sums of ranges, one row
    per range and group of ``within``, give each range its start. So no group meets in one task.
    ``within`` must be the first columns of ``order``, without nulls. Rows alike in ``order`` get
    places in any order among themselves. An empty table gives no rows.
    """
    weight = F.lit(1) if weight is None else weight
    held = laid(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    sums = held.groupBy("_part", *within).agg(F.sum(weight).alias("_sum"))
    before = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("_start", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    own = Window.partitionBy("_part", *within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = held.withColumn("_own", F.coalesce(F.sum(weight).over(own), F.lit(0)))
    summed = placed.join(starts, ["_part", *within]).withColumn(out, (F.col("_start") + F.col("_own")).cast("long"))
    return summed.drop("_part", "_own", "_start")

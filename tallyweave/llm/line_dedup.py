"""Removal of lines that many sites share, found by sketches of the sites of each line."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.common import WORD, cut
from tallyweave.llm.rows import IDENTITY, bound, join_rows, wrapped

#: A line on so many sites is boilerplate.
LEAST_SITES = 10
#: Lines without a word are left alone, others only if the caller says so.
LEAST_WORDS = 1
#: Logarithm of the number of registers of a sketch.
REGISTERS = 12
#: Relative error beyond which an estimate is trusted: four standard deviations.
MARGIN = 4 * 1.04 / math.sqrt(2**REGISTERS)


def without_boilerplate(
    docs: DataFrame, key: str = "doc_id", site: str = "source", text: str = "text", least_sites: int = LEAST_SITES,
    removed: str | None = None, least_words: int = LEAST_WORDS,
) -> DataFrame:
    """All rows, their texts without the boilerplate lines.

    A line is what stands between line feeds, compared exactly. One of at least ``least_words``
    words (runs of anything but ASCII white space, so a line in a script without spaces is one) that stands on ``least_sites`` distinct sites or more is boilerplate; it stays where
    it stands first (lowest key, then lowest hash of the text, then first place) and goes
    everywhere else. Sites are counted by a HyperLogLog sketch per line hash, merged by partial
    aggregation; where the estimate is within ``MARGIN`` of the threshold, exactly.

    ``removed`` names a column for the number of removed lines. A null text stays null; a text
    may become empty. Rows without a site do not count as one, but lose boilerplate too. A
    repeated row is treated like its twin. All columns stay as they are, whatever their names.
    """
    rows = wrapped(docs, key, text)
    lines = rows.select(*IDENTITY, F.col(f"_row.{site}").cast("string").alias("_site"), F.posexplode(F.split("_text", "\n")).alias("_at", "_line"))
    lines = lines.where(F.regexp_count("_line", F.lit(WORD)) >= least_words).select(
        *IDENTITY, "_site", "_at", F.xxhash64("_line").alias("_hash"), F.hash("_line").alias("_hash2"),
    )
    line = ["_hash", "_hash2"]
    spread = lines.groupBy(*line).agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("_site", F.lit(REGISTERS))).alias("_sites"),
        F.min(F.struct(*IDENTITY, "_at")).alias("_first"),
    )
    likely = cut(spread.where(F.col("_sites") >= least_sites * (1 - MARGIN)))
    near = likely.where(F.col("_sites") <= least_sites * (1 + MARGIN))
    exact = (
        lines.where(F.col("_site").isNotNull()).select(*line, "_site").distinct()     # combined before the shuffle
        .join(near.select(*line), line, "left_semi").groupBy(*line).agg(F.count("*").alias("_exact"))
    )
    # Stored, so that the next join has plain shuffles on both sides and a hot line can be split.
    boilerplate = cut(
        likely.join(exact, line, "left")
        .where(F.coalesce(F.col("_exact"), F.col("_sites")) >= least_sites).select(*line, "_first")
    )
    again = lines.join(boilerplate, line).where(~F.struct(*IDENTITY, "_at").eqNullSafe(F.col("_first")))
    gone = again.groupBy(*IDENTITY).agg(F.collect_set("_at").alias("_gone"))

    parts = F.split("_text", "\n")
    stays = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("_gone"))
    left = bound(parts, lambda own: F.array_join(F.transform(stays, lambda k: F.get(own, k)), "\n"))
    cleaned = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(left)
    joined = join_rows(rows, gone, "left")
    columns = [cleaned.alias(c) if c == text else F.col("_row")[c].alias(c) for c in docs.columns if c != removed]
    if removed:
        columns.append(F.coalesce(F.size(F.when(F.col("_gone").isNotNull(), F.col("_gone"))), F.lit(0)).alias(removed))
    return joined.select(*columns)

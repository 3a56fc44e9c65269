"""Levels over frames, quiet runs, and the chunks of rows that words or sound leave."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .intervals import merge_intervals
from .sessions import islands, sessionize


def frame_levels(df: DataFrame, keys: list[str], at: str, value: str, width: int, hop: int) -> DataFrame:
    """Per frame [k * hop, k * hop + width) the number of values, their root mean square and their largest size."""
    last = F.floor(F.col(at) / hop)
    first = F.greatest(F.floor((F.col(at) - width) / hop) + 1, F.lit(0))
    spread = df.withColumn("frame", F.explode(F.sequence(first, last)))
    v = F.col(value).cast("double")
    return spread.groupBy(*keys, "frame").agg(F.count("*").alias("n"), F.sqrt(F.sum(v * v) / F.count("*")).alias("rms"), F.max(F.abs(F.col(value))).alias("peak"))


def low_islands(frames: DataFrame, keys: list[str], start: str, end: str, low: Column, least) -> DataFrame:
    """Runs of neighbouring low frames, merged where they touch, of ``least`` length."""
    runs = islands(frames.withColumn("_low", low), keys, "_low", [start]).filter("_low").groupBy(*keys, "island").agg(F.min(start).alias(start), F.max(end).alias(end))
    return merge_intervals(runs, keys, start, end).filter(F.col(end) - F.col(start) >= least)


def word_chunks(words: DataFrame, rows: DataFrame, keys: list[str], start: str, end: str, gap, early: Column, early_gap, order: list[str], pad, least) -> DataFrame:
    """Chunks (keys, start, end) of each row's words between pauses, padded, clipped to [row_start, row_end), of
    ``least`` length. Words are clipped to their row first; ``early`` words split at the smaller gap."""
    inside = words.join(rows, keys).withColumns({start: F.greatest(start, "row_start"), end: F.least(end, "row_end")}).filter(F.col(end) > F.col(start))
    cut = sessionize(inside, keys, start, end, gap, order, early, early_gap, "chunk")
    padded = cut.groupBy(*keys, "chunk").agg(
        F.greatest(F.first("row_start"), F.min(start) - pad).alias("start"), F.least(F.first("row_end"), F.max(end) + pad).alias("end"))
    return padded.filter(F.col("end") - F.col("start") >= least).drop("chunk")


def or_whole(chunks: DataFrame, rows: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """The chunks, and each row without any as a whole; ``whole`` tells which."""
    bare = rows.join(chunks.select(*keys).distinct(), keys, "left_anti")
    return chunks.withColumn("whole", F.lit(False)).unionByName(bare.select(*keys, F.col("row_start").alias(start), F.col("row_end").alias(end), F.lit(True).alias("whole")))

"""Helpers shared by the corpus operators: table access, durable cuts, row identity, size-checked joins."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.operators.durable import durable  # noqa: F401  the operators of this part take it from here

#: A side of a join is broadcast only when it was counted and has at most this many rows.
BROADCAST_ROWS = 200_000

#: ASCII white space of the contracts: space and U+0009 to U+000D.
WHITESPACE = "\t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the input folder, read through Spark so that any file system works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_join(left: DataFrame, right: DataFrame, on, how: str = "inner", rows: int | None = None) -> DataFrame:
    """Join with a side that is usually small: broadcast when its counted size allows, shuffled beyond that."""
    rows = right.count() if rows is None else rows
    return left.join(F.broadcast(right) if rows <= BROADCAST_ROWS else right, on, how)


def text_groups(column: pa.Array, chars: int) -> Iterator[list[str]]:
    """The texts of an Arrow column in groups of at most ``chars`` characters, or one text; null is empty."""
    group, size = [], 0
    for value in column:
        text = value.as_py() or ""
        if group and size + len(text) > chars:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def row_identity(*columns: str) -> list[Column]:
    """Two 64-bit hashes naming a row by the given columns; nulls differ from every value."""
    parts = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(F.lit(1), *parts).alias("row_a"), F.xxhash64(F.lit(2), *parts).alias("row_b")]


def spaced(text: Column) -> Column:
    """Text with every ASCII white space character turned into a space; null becomes the empty text."""
    out = F.coalesce(text.cast("string"), F.lit(""))
    for c in WHITESPACE:
        out = F.replace(out, F.lit(c), F.lit(" "))
    return out


def space_words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in order."""
    return F.array_remove(F.split(spaced(text), " "), "")

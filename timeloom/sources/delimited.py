"""Delimited files: sniffed and fixed separators, column aliases, typed transcript tables, and the writers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def choose_delimiter(line: str) -> str:
    """The separator of a first line: ``;`` when as frequent as any, else ``,``, else tab or bar, else ``;``."""
    counts = {d: line.count(d) for d in ";,\t|"}
    if counts[";"] and counts[";"] >= counts[","]:
        return ";"
    if counts[","]:
        return ","
    best = max("\t|", key=counts.get)
    return best if counts[best] else ";"


def read_delimited(spark: SparkSession, path: str, delimiter: str | None = None) -> DataFrame:
    """All-text table with trimmed header names; the separator is read off the first non-blank line."""
    if delimiter is None:
        first = spark.read.text(path).filter(F.trim("value") != "").limit(1).collect()
        delimiter = choose_delimiter(first[0][0] if first else "")
    df = spark.read.csv(path, sep=delimiter, header=True, multiLine=True, escape='"')
    return df.toDF(*[c.strip().lstrip("﻿") for c in df.columns])


def canonical_header(name: str) -> str:
    return "".join(c for c in name.lower() if c.isalnum())


def resolve(df: DataFrame, *aliases: str, required: bool = True) -> Column:
    """The first column that one of the aliases names, whatever its case and punctuation."""
    by_name = {canonical_header(c): c for c in reversed(df.columns)}
    for a in aliases:
        if canonical_header(a) in by_name:
            return F.col(f"`{by_name[canonical_header(a)]}`")
    if required:
        raise AnalysisException(f"none of the columns {', '.join(aliases)} is in {', '.join(df.columns)}")
    return F.lit(None).cast("string")


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """The table itself if it has all the columns; else an error that names the missing ones."""
    missing = [n for n in names if canonical_header(n) not in {canonical_header(c) for c in df.columns}]
    if missing:
        raise AnalysisException(f"missing columns: {', '.join(missing)}")
    return df


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """(speaker, start, end, text) of a transcript; rows with blank text go."""
    df = read_delimited(spark, path)
    out = df.select(
        resolve(df, "Speaker Name", "Speaker", required=False).alias("speaker"), resolve(df, "Start Time", "Start").alias("start"),
        resolve(df, "End Time", "End").alias("end"), F.trim(resolve(df, "Text", "Transcript")).alias("text"),
    )
    return out.filter(F.coalesce("text", F.lit("")) != "")


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """(word, start, end) of a word list; blank words go."""
    df = read_delimited(spark, path)
    out = df.select(F.trim(resolve(df, "Word", "Token")).alias("word"), resolve(df, "Start Time", "Start").alias("start"), resolve(df, "End Time", "End").alias("end"))
    return out.filter(F.coalesce("word", F.lit("")) != "")


def words_path(path: str) -> str:
    """The word list beside a transcript: ``<stem>_words.csv``."""
    stem, dot, suffix = path.rpartition(".")
    return f"{stem}_words.{suffix}" if dot else f"{path}_words"


def write_delimited(df: DataFrame, path: str, header: list[str], delimiter: str = ";", quote_all: bool = False) -> None:
    """Writes the columns in the given order with a header; null becomes the empty cell."""
    df.select(*[F.col(f"`{h}`").cast("string").alias(h) for h in header]).write.mode("overwrite").csv(path, sep=delimiter, header=True, quoteAll=quote_all, escape='"', nullValue="", emptyValue="")

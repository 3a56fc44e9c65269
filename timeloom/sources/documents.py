"""Nested and listed sources: transcription and manifest JSON, XML and OTIO timelines, folders; and their writers."""

from __future__ import annotations

import io
import zipfile
from html import escape
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.functions.timecode import parse_name_stamp

_WORD = "array<struct<word: string, start: double, end: double>>"
_SEGMENT = f"array<struct<start: double, end: double, text: string, words: {_WORD}>>"
TRANSCRIPTION = f"text string, segments {_SEGMENT}, words {_WORD}, results struct<segments: {_SEGMENT}, words: {_WORD}>, data struct<segments: {_SEGMENT}, words: {_WORD}>"


def read_transcription(spark: SparkSession, path: str) -> DataFrame:
    """One row per file with ``segments`` and ``words``, from the top level or from ``results`` or ``data``."""
    raw = spark.read.schema(TRANSCRIPTION).json(path, multiLine=True).withColumn("file", F.input_file_name())
    segments = F.coalesce("segments", "results.segments", "data.segments")
    words = F.coalesce("words", "results.words", "data.words", F.flatten(F.transform(segments, lambda s: F.coalesce(s["words"], F.array().cast(_WORD)))))
    return raw.select("file", segments.alias("segments"), words.alias("words"))


def transcription_words(files: DataFrame) -> DataFrame:
    """(file, word_no, word, start, end); an end before its start becomes the start, blank words go."""
    w = files.select("file", F.posexplode("words").alias("word_no", "w"))
    return w.select("file", "word_no", F.trim("w.word").alias("word"), "w.start", F.greatest("w.start", "w.end").alias("end")).filter("word <> ''")


def transcription_segments(files: DataFrame) -> DataFrame:
    """(file, segment_no, text, start, end) of non-blank segments."""
    s = files.select("file", F.posexplode("segments").alias("segment_no", "s"))
    return s.select("file", "segment_no", F.trim("s.text").alias("text"), "s.start", F.greatest("s.start", "s.end").alias("end")).filter("text <> ''")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per entry of JSON files with an ``entries`` list; files without one give none."""
    df = spark.read.json(path, multiLine=True)
    if "entries" not in df.columns:
        return spark.createDataFrame([], "file string")
    return df.select(F.input_file_name().alias("file"), F.inline("entries"))


def newest_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The entries of the newest JSON file of a folder that has an ``entries`` list; the name decides between files of
    one time. Folders without such a file give none."""
    df = spark.read.json(f"{folder}/*.json", multiLine=True)
    if "entries" not in df.columns or not df.schema["entries"].dataType.simpleString().startswith("array<struct"):
        return spark.createDataFrame([], "file string")
    named = df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("_at"), "entries").filter("entries IS NOT NULL")
    newest = named.groupBy().agg(F.max_by("file", F.struct("_at", "file")).alias("file"))
    return named.join(F.broadcast(newest), "file").select("file", F.inline("entries"))  # one row


def valid_spans(entries: DataFrame, start: str, end: str) -> DataFrame:
    """Entries with a positive span, in time order."""
    return entries.filter(F.col(end) > F.col(start)).orderBy("file", start, end)


def read_clips(spark: SparkSession, path: str, media: str = "video") -> DataFrame:
    """One row per clip item of an XML edit list with the number of its track in the media; empty spans go."""
    clip = "struct<name: string, start: long, end: long, in: long, out: long>"
    tracks = spark.read.format("xml").option("rowTag", media).schema(f"track array<struct<clipitem: array<{clip}>>>").load(path)
    rows = tracks.select(F.posexplode("track").alias("track", "t")).select("track", F.posexplode("t.clipitem").alias("clip_no", "c"))
    return rows.select("track", "clip_no", "c.*").filter(F.col("end") > F.col("start"))


def read_otio(spark: SparkSession, path: str) -> DataFrame:
    """One row per clip of an OTIO timeline: track, clip_no, name, start and duration in seconds."""
    time = "struct<value: double, rate: double>"
    clip = f"struct<OTIO_SCHEMA: string, name: string, source_range: struct<start_time: {time}, duration: {time}>>"
    df = spark.read.schema(f"tracks struct<children: array<struct<name: string, children: array<{clip}>>>>").json(path, multiLine=True)
    tracks = df.select(F.posexplode("tracks.children").alias("track", "t"))
    clips = tracks.select("track", F.posexplode("t.children").alias("clip_no", "c"))
    seconds = lambda c: F.col(f"{c}.value") / F.col(f"{c}.rate")
    return clips.select("track", "clip_no", F.col("c.name").alias("name"), F.col("c.OTIO_SCHEMA").startswith("Gap").alias("is_gap"), seconds("c.source_range.start_time").alias("start"), seconds("c.source_range.duration").alias("duration"))


def list_folder(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, name, modified, stamp): files of a folder with the time their names begin with."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", F.col("modificationTime").alias("modified"))
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", name.alias("name"), "modified", parse_name_stamp(name).alias("stamp"))


def latest_file(spark: SparkSession, path: str, pattern: str = "*") -> str | None:
    """Path of the file changed last; ties go to the greatest path."""
    row = list_folder(spark, path, pattern).agg(F.max(F.struct("modified", "path")).alias("m")).first()
    return row["m"]["path"] if row and row["m"] else None


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Entries of ``new`` in place of those with the same key, the rest kept."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def write_rows_with_summary(rows: DataFrame, summary: DataFrame, path: str) -> None:
    """JSON lines of the rows in ``rows`` and of the one-row summary in ``summary`` below the path."""
    rows.write.mode("overwrite").json(f"{path}/rows")
    summary.write.mode("overwrite").json(f"{path}/summary")


def write_clips(clips: DataFrame, path: str) -> None:
    """An XML edit list: one ``clipitem`` element per row."""
    clips.write.mode("overwrite").format("xml").option("rootTag", "sequence").option("rowTag", "clipitem").save(path)


def write_otio(clips: DataFrame, path: str, rate: float) -> None:
    """A timeline of clips and gaps as JSON, one line per track: clips (track, name, start, length, source_start) in
    frames; a gap stands before a clip that starts behind the cursor, and one that starts before it is left out.

    The cursor is the end of the clips kept so far; tracks are dealt by key and their rows sorted.
    """
    from timeloom.operators.layout import track_with_gaps

    kinds = dict(clips.dtypes)
    spans = clips.select("track", "name", "start", (F.col("start") + F.col("length")).alias("end"), "source_start")
    schema = f"track {kinds['track']}, name string, start bigint, end bigint, source_start bigint, kind string"
    rows = track_with_gaps(spans, ["track"], "start", "end", ["start", "name"], schema)
    time = lambda c: F.struct(F.lit("RationalTime.1").alias("OTIO_SCHEMA"), c.cast("double").alias("value"), F.lit(float(rate)).alias("rate"))
    gap = F.col("kind") == "gap"
    item = F.struct(
        F.when(gap, "Gap.1").otherwise("Clip.2").alias("OTIO_SCHEMA"), F.when(~gap, F.col("name")).alias("name"),
        F.struct(time(F.when(gap, F.lit(0)).otherwise(F.col("source_start"))).alias("start_time"), time(F.col("end") - F.col("start")).alias("duration")).alias("source_range"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("start", F.when(gap, 0).otherwise(1).alias("k"), item.alias("item")))), lambda x: x["item"])
    track = rows.groupBy("track").agg(ordered.alias("children")).select(F.lit("Track.1").alias("OTIO_SCHEMA"), F.col("track").cast("string").alias("name"), "children")
    track.write.mode("overwrite").json(path)


def read_texts(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, html) of plain-text and word-processor files: a paragraph element per line or paragraph.

    Other kinds of files give null. A file is read in the task that holds it.
    """

    @F.pandas_udf("string")
    def as_html(path: pd.Series, content: pd.Series) -> pd.Series:
        return pd.Series([paragraphs_html(p, bytes(c)) for p, c in zip(path, content, strict=True)])

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select("path", as_html("path", "content").alias("html"))


def paragraphs_html(name: str, content: bytes) -> str | None:
    """Paragraph elements of a ``.txt`` or ``.docx`` file, of an ``.html`` file its text; null of others or broken ones."""
    kind = name.lower().rsplit(".", 1)[-1]
    if kind in ("html", "htm"):
        return content.decode("utf-8", "ignore")
    if kind == "txt":
        lines = content.decode("utf-8-sig", "ignore").splitlines()
    elif kind == "docx":
        space = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
        try:
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                body = ElementTree.fromstring(z.read("word/document.xml"))
        except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
            return None
        lines = ["".join(t.text or "" for t in p.iter(f"{space}t")) for p in body.iter(f"{space}p")]
    else:
        return None
    return "".join(f"<p>{escape(x.strip())}</p>" for x in lines if x.strip())


def retained(df: DataFrame, folder: str, stage: str) -> DataFrame:
    """Writes a stage's rows below the folder and goes on from what was written."""
    df.write.mode("overwrite").parquet(f"{folder}/{stage}")
    return df.sparkSession.read.parquet(f"{folder}/{stage}")


def write_canonical(df: DataFrame, folder: str, stem: str, stamp: str, stage: str) -> str:
    """Writes rows under the canonical name ``<stem>_<stamp>_<stage>`` beside other outputs; returns the path."""
    path = f"{folder}/{stem}_{stamp}_{stage}"
    df.write.mode("overwrite").option("header", True).csv(path, sep=";")
    return path


def lookup_table(spark: SparkSession, values: dict[str, str], key: str = "key", value: str = "value") -> DataFrame:
    """A small dimension table of fixed values."""
    return spark.createDataFrame(list(values.items()), f"{key} string, {value} string")

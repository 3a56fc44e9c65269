"""Gap sessions, chains and islands: neighbouring rows that belong together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec


def _ordered(keys: list[str], order: list[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def sessionize(df: DataFrame, keys: list[str], start: str, end: str, gap, order: list[str], early: Column | None = None, early_gap=None, name: str = "session") -> DataFrame:
    """Numbers sessions 1, 2, ... per key: a row opens one when it starts ``gap`` or more after the previous end.

    ``early`` is a condition on the previous row under which the smaller ``early_gap`` already splits.
    """
    w = _ordered(keys, order)
    pause = F.col(start) - F.lag(end).over(w)
    split = F.lag(end).over(w).isNull() | (pause >= gap)
    if early is not None:
        split |= F.coalesce(F.lag(early).over(w), F.lit(False)) & (pause >= early_gap)
    return df.withColumn("_open", F.when(split, 1).otherwise(0)).withColumn(name, F.sum("_open").over(w)).drop("_open")


def session_spans(sessions: DataFrame, keys: list[str], start: str, end: str, session: str = "session") -> DataFrame:
    """One row per session with its ``start``, ``end``, ``n`` and the ``pause`` since the one before (null for the first)."""
    spans = sessions.groupBy(*keys, session).agg(F.min(start).alias("start"), F.max(end).alias("end"), F.count("*").alias("n"))
    return spans.withColumn("pause", F.col("start") - F.lag("end").over(_ordered(keys, [session])))


def session_rows(sessions: DataFrame, keys: list[str], start: str, end: str, gap, session: str = "session") -> DataFrame:
    """One ``speech`` row per session and one ``silence`` row for each pause of ``gap`` or more between them.

    Rows are numbered in time order per key (row_no); n counts the rows of a session.
    """
    speech = sessions.groupBy(*keys, session).agg(F.min(start).alias("start"), F.max(end).alias("end"), F.count("*").alias("n"))
    w = _ordered(keys, [session])
    silence = speech.select(
        *keys, session, F.lag("end").over(w).alias("_s"), F.col("start").alias("_e")
    ).filter(F.col("_e") - F.col("_s") >= gap).select(*keys, F.col(session), F.lit("silence").alias("kind"), F.col("_s").alias("start"), F.col("_e").alias("end"), F.lit(0).cast("long").alias("n"))
    both = speech.select(*keys, session, F.lit("speech").alias("kind"), "start", "end", "n").unionByName(silence)
    at = _ordered(keys, [session, "kind"])  # a pause stands before the session that it ends at
    return both.withColumn("row_no", F.row_number().over(at)).drop(session)


def window_groups(df: DataFrame, keys: list[str], start: str, end: str, tolerance, order: list[str], name: str = "grp") -> DataFrame:
    """Numbers groups: a row opens one when it starts more than ``tolerance`` after the latest end so far."""
    w = _ordered(keys, order)
    latest = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(latest.isNull() | (F.col(start) > latest + tolerance), 1).otherwise(0)
    return df.withColumn("_open", opens).withColumn(name, F.sum("_open").over(w)).drop("_open")


def chain_clusters(df: DataFrame, keys: list[str], near: Column, order: list[str], name: str = "cluster") -> DataFrame:
    """Numbers chains: a row joins the previous row's cluster when ``near`` holds.

    ``near`` may use columns of the row and, through ``previous(column)``, of the row before.
    """
    w = _ordered(keys, order)
    return df.withColumn("_open", F.when(F.coalesce(near, F.lit(False)), 0).otherwise(1)).withColumn(name, F.sum("_open").over(w)).drop("_open")


def previous(column: str, keys: list[str], order: list[str], steps: int = 1) -> Column:
    """The column's value in an earlier row of the same key."""
    return F.lag(column, steps).over(_ordered(keys, order))


def islands(df: DataFrame, keys: list[str], value: str, order: list[str], name: str = "island") -> DataFrame:
    """Numbers runs of rows with one value."""
    w = _ordered(keys, order)
    change = F.when(F.lag(value).over(w).eqNullSafe(F.col(value)), 0).otherwise(1)
    return df.withColumn("_open", change).withColumn(name, F.sum("_open").over(w)).drop("_open")


def contiguous_members(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    """Per key whether its members stand next to each other: max - min + 1 equals their number."""
    return df.groupBy(*keys).agg((F.max(position) - F.min(position) + 1 == F.count("*")).alias("contiguous"), F.count("*").alias("n"))


def batches(df: DataFrame, size: int, position: str, name: str = "batch") -> DataFrame:
    """Numbers consecutive batches of ``size`` positions."""
    return df.withColumn(name, F.floor(F.col(position) / size))


def sliding_frames(df: DataFrame, keys: list[str], at: str, value: str, width: int, hop: int) -> DataFrame:
    """Mean and number of values in frames [k * hop, k * hop + width): each row goes to the frames it lies in."""
    last = F.floor(F.col(at) / hop)
    first = F.greatest(F.floor((F.col(at) - width) / hop) + 1, F.lit(0))
    spread = df.withColumn("frame", F.explode(F.sequence(first, last)))
    return spread.groupBy(*keys, "frame").agg(F.count("*").alias("n"), F.sum(value).alias("total"))

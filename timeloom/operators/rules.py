"""Row rules: keep marks, blanking, added columns, gates, tag events, caps and first kept rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def filled(c: Column) -> Column:
    """Whether a cell holds more than white space."""
    return F.trim(F.coalesce(c, F.lit(""))) != ""


def keep_mark(reference: Column, text: Column, polarity: str) -> Column:
    """``x`` where a row is to be kept (``keep``: both texts are there) or where it has no reference (``missing``)."""
    holds = filled(reference) & filled(text) if polarity == "keep" else ~filled(reference)
    return F.when(holds, "x").otherwise("")


def kept_row(reference: Column, text: Column, eliminated: Column, status: Column) -> Column:
    """Both texts there, not eliminated, and a status that doesn't say unmatched."""
    return filled(reference) & filled(text) & ~filled(eliminated) & ~F.upper(F.coalesce(status, F.lit(""))).contains("UNMATCHED")


def blank_unkept(df: DataFrame, columns: list[str], kept: Column) -> DataFrame:
    """The columns emptied where the row isn't kept."""
    return df.withColumns({c: F.when(kept, F.col(c)).otherwise("") for c in columns})


def reset_columns(df: DataFrame, columns: list[str], value: str = "") -> DataFrame:
    """Columns added where missing, and set to the value whether they were there or not."""
    return df.withColumns({c: F.lit(value) for c in columns})


def gates(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(gate, passed) of conditions on aggregates of the whole table, one row each."""
    row = df.agg(*[F.coalesce(c, F.lit(False)).alias(n) for n, c in checks.items()])
    return row.select(F.explode(F.array(*[F.struct(F.lit(n).alias("gate"), F.col(n).alias("passed")) for n in checks])).alias("g")).select("g.*")


def require(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """The table itself when every gate passes; names the first that fails otherwise."""
    failed = [r["gate"] for r in gates(df, checks).collect() if not r["passed"]]  # a row per gate
    if failed:
        raise ValueError(f"gates not passed: {', '.join(failed)}")
    return df


def tag_events(df: DataFrame, keys: list[str], start: str, end: str, tags: dict[str, str], once: tuple[str, ...] = (), used: DataFrame | None = None) -> DataFrame:
    """One event per filled tag cell: (keys, at, tag, value, order_no).

    ``tags`` names the anchor of each column, ``start`` or ``end``; tags listed in ``once`` count the first time
    per key only. Events of one time are numbered in column order from 1, or on from the highest number that
    ``used`` (keys, at, order_no) holds there. Of a value the first word counts.
    """
    cells = F.array(*[F.struct(F.lit(i).alias("tag_no"), F.lit(c).alias("tag"), F.col(start if at == "start" else end).alias("at"), F.col(c).cast("string").alias("cell")) for i, (c, at) in enumerate(tags.items())])
    events = df.select(*keys, F.explode(cells).alias("e")).select(*keys, "e.*").filter(filled(F.col("cell")))
    first = F.row_number().over(Window.partitionBy(*keys, "tag").orderBy("at", "cell"))
    if once:
        events = events.withColumn("_nth", first).filter(~F.col("tag").isin(*once) | (F.col("_nth") == 1)).drop("_nth")
    no = F.row_number().over(Window.partitionBy(*keys, "at").orderBy("tag_no", "cell"))
    events = events.withColumn("order_no", no)
    if used is not None:
        highest = used.groupBy(*keys, "at").agg(F.max("order_no").alias("_used"))
        events = events.join(highest, [*keys, "at"], "left").withColumn("order_no", F.col("order_no") + F.coalesce("_used", F.lit(0))).drop("_used")
    return events.select(*keys, "at", "tag", F.split_part(F.trim("cell"), F.lit(" "), F.lit(1)).alias("value"), "order_no")


def capped(df: DataFrame, keys: list[str], order: list, most: int) -> DataFrame:
    """At most so many rows of each key, the first ones in the order."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_r") <= most).drop("_r")


def first_kept(df: DataFrame, keys: list[str], position: str, kept: Column) -> DataFrame:
    """Per key the position of its first kept row, 0 where none is."""
    return df.groupBy(*keys).agg(F.coalesce(F.min(F.when(kept, F.col(position))), F.lit(0)).alias("first_kept"))


def supported_window(df: DataFrame, keys: list[str], index: str, supported: Column) -> DataFrame:
    """The rows between the first and the last supported index of their key."""
    w = Window.partitionBy(*keys)
    held = df.withColumns({"_lo": F.min(F.when(supported, F.col(index))).over(w), "_hi": F.max(F.when(supported, F.col(index))).over(w)})
    return held.filter(F.col(index).between(F.col("_lo"), F.col("_hi"))).drop("_lo", "_hi")


def occurrences(values: DataFrame, keys: list[str], text: str, row: str) -> DataFrame:
    """Per key the text of its first row, its rows in order, and how many they are."""
    ordered = F.sort_array(F.collect_set(F.struct(row, text)))
    out = values.groupBy(*keys).agg(ordered.alias("_o"))
    return out.select(*keys, F.get("_o", F.lit(0))[text].alias("first_text"), F.array_distinct(F.transform("_o", lambda x: x[row])).alias("rows"), F.size(F.array_distinct(F.transform("_o", lambda x: x[row]))).alias("n_rows"))


def scale_of_sequence(df: DataFrame, keys: list[str], order: list[str], code: str) -> DataFrame:
    """Adds ``scale`` of zoom codes: z1 opens a sequence that a following z2, and a z3 after it, join.

    A full sequence is scaled 1.11, 1.26, 1.38, one of two 1.15, 1.30; a code outside a sequence has its own
    scale, others 1.25.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    near = lambda n: F.coalesce(F.lag(F.lower(code), n).over(w) if n > 0 else F.lead(F.lower(code), -n).over(w), F.lit(""))
    c = F.lower(F.col(code))
    pair = F.when(c == "z1", (near(-1) == "z2") & (near(-2) != "z3")).when(c == "z2", (near(1) == "z1") & (near(-1) != "z3"))
    scale = F.when(pair, F.when(c == "z1", 1.15).otherwise(1.30)).when(c == "z1", 1.11).when(c == "z2", 1.26).when(c == "z3", 1.38).otherwise(1.25)
    return df.withColumn("scale", scale)


def cluster_ranks(df: DataFrame, keys: list[str], cluster: str, order: list[str]) -> DataFrame:
    """Adds ``level``: Z of a row alone in its cluster, else Z1, Z2, and Z3 from the third on."""
    w = Window.partitionBy(*keys, cluster)
    rank = F.least(F.row_number().over(w.orderBy(*order)), F.lit(3)).cast("string")
    return df.withColumn("level", F.when(F.count("*").over(w) == 1, "Z").otherwise(F.concat(F.lit("Z"), rank)))

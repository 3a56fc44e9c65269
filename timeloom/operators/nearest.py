"""Point-in-interval, as-of and nearest-neighbour lookups by one pass over a sorted union."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .layout import fold


def neighbours(points: DataFrame, marks: DataFrame, keys: list[str], at: str, mark: str, value: str) -> DataFrame:
    """Adds for each point the mark at or before it, the one at or after it, and the nearer (ties: the earlier).

    Columns: before_at, before_value, after_at, after_value, nearest_at, nearest_value. Of marks at one place
    the smallest value counts. No pair of point and mark is ever formed.
    """
    distinct = marks.groupBy(*keys, mark).agg(F.min(value).alias("_v")).select(*keys, F.col(mark).alias("_at"), F.lit(0).alias("_kind"), F.struct(F.col(mark).alias("at"), F.col("_v").alias("value")).alias("_m"))
    rows = points.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.struct(*points.columns).alias("_row"))
    both = distinct.unionByName(rows, allowMissingColumns=True)
    back = Window.partitionBy(*keys).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*keys).orderBy(F.col("_at").desc(), "_kind").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumns({"_b": F.last("_m", ignorenulls=True).over(back), "_a": F.last("_m", ignorenulls=True).over(ahead)}).filter("_kind = 1")
    to_b, to_a = F.col("_at") - F.col("_b.at"), F.col("_a.at") - F.col("_at")
    near = F.when(F.col("_a").isNull() | (to_b <= to_a), F.col("_b")).otherwise(F.col("_a"))
    return found.withColumn("_n", near).select(
        "_row.*", F.col("_b.at").alias("before_at"), F.col("_b.value").alias("before_value"), F.col("_a.at").alias("after_at"),
        F.col("_a.value").alias("after_value"), F.col("_n.at").alias("nearest_at"), F.col("_n.value").alias("nearest_value"),
    )


def containing(points: DataFrame, spans: DataFrame, keys: list[str], at: str, start: str, end: str, value: str) -> DataFrame:
    """Adds ``inside``: the value of the span [start, end) that holds the point; spans of a key don't overlap."""
    marks = spans.select(*keys, F.col(start).alias("_s"), F.struct(F.col(end).alias("e"), F.col(value).alias("v")).alias("_sv"))
    found = neighbours(points, marks, keys, at, "_s", "_sv")
    inside = F.when(F.col(at) < F.col("before_value.e"), F.col("before_value.v"))
    return found.select(*points.columns, inside.alias("inside"))


def with_neighbours(df: DataFrame, keys: list[str], order: list[str], known: str, value: str) -> DataFrame:
    """Adds prev_known and next_known: the value in the nearest earlier and later rows where ``known`` holds."""
    v = F.when(F.col(known), F.col(value))
    # later rows come first in the reversed order: a frame that ends with the key is read anew for each of its rows
    behind = lambda by: F.last(v, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumns({"prev_known": behind(order), "next_known": behind([F.desc(c) for c in order])})


def merge_tolerance(left: DataFrame, right: DataFrame, keys: list[str], at: str, left_id: str, right_id: str, tolerance: float) -> DataFrame:
    """(keys, left_id, right_id, at): rows of two sides paired within the tolerance in order, each used once.

    Both sides run along the axis together: the first open rows of either side pair when they are within the
    tolerance, else the earlier one stays alone (null on the other side). Only one side can have open rows at a
    time, and those are no older than the tolerance, so a key of any length streams through one pass. Rows at the
    same place go by their ids; null places stay alone.
    """
    side = lambda df, own, other: df.select(*keys, F.col(at).alias("at"), F.col(own).alias(own), F.lit(None).cast((left if other == left_id else right).schema[other].dataType).alias(other))
    both = side(left, left_id, right_id).unionByName(side(right, right_id, left_id))

    def step(rows: Iterator[dict]) -> Iterator[dict]:
        held: deque[dict] = deque()
        for r in rows:
            if r["at"] is None:
                yield r
                continue
            while held and held[0]["at"] < r["at"] - tolerance:
                yield held.popleft()
            if held and (held[0][left_id] is None) != (r[left_id] is None):
                first = held.popleft()
                yield r | {"at": first["at"], left_id: first[left_id] if r[left_id] is None else r[left_id], right_id: first[right_id] if r[right_id] is None else r[right_id]}
            else:
                held.append(r)
        yield from held

    kinds = {f.name: f.dataType.simpleString() for f in both.schema}
    return fold(both, keys, ["at", left_id, right_id], ", ".join(f"{c} {kinds[c]}" for c in (*keys, left_id, right_id, "at")), step)

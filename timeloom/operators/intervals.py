"""Interval algebra on [start, end) pairs held in two numeric columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .sessions import window_groups


def merge_intervals(df: DataFrame, keys: list[str], start: str, end: str, tolerance=0, drop_empty: bool = True) -> DataFrame:
    """Union of the intervals per key; touching ones merge, and with a tolerance near ones too."""
    rows = df.filter(F.col(end) > F.col(start)) if drop_empty else df
    grouped = window_groups(rows, keys, start, end, tolerance, [start, end])
    return grouped.groupBy(*keys, "grp").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("grp")


def gaps_between(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Complement inside the covered span: the pauses between the merged intervals."""
    w = Window.partitionBy(*keys).orderBy(start)
    merged = merge_intervals(df, keys, start, end)
    return merged.select(*keys, F.lag(end).over(w).alias("_s"), F.col(start).alias("_e")).filter("_s IS NOT NULL").select(*keys, F.col("_s").alias(start), F.col("_e").alias(end))


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], bucket: int, how: str = "inner") -> DataFrame:
    """Pairs of one key whose [l_start, l_end) and [r_start, r_end) overlap.

    Both sides are dealt to buckets of the time axis, so the join has an equality besides the key; a pair is
    kept in the first bucket that both reach.
    """
    def dealt(df: DataFrame, s: str, e: str) -> DataFrame:
        return df.filter(F.col(e) > F.col(s)).withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(s) / bucket), F.floor((F.col(e) - 1) / bucket))))

    pairs = dealt(left, "l_start", "l_end").join(dealt(right, "r_start", "r_end"), [*keys, "_bucket"], how)
    first = F.floor(F.greatest("l_start", "r_start") / bucket)
    return pairs.filter((F.col("l_start") < F.col("r_end")) & (F.col("l_end") > F.col("r_start")) & (F.col("_bucket") == first)).drop("_bucket")


def clip(df: DataFrame, start: str, end: str, low: Column, high: Column, in_point: str | None = None) -> DataFrame:
    """Cuts intervals to [low, high), drops what is left empty, and moves the source in-point along."""
    s, e = F.greatest(F.col(start), low), F.least(F.col(end), high)
    moved = {start: s, end: e} | ({in_point: F.col(in_point) + s - F.col(start)} if in_point else {})
    return df.withColumns(moved).filter(F.col(end) > F.col(start))


def subtract(df: DataFrame, removed: DataFrame, keys: list[str], row: str, start: str, end: str, least=0, bucket=None) -> DataFrame:
    """Pieces of each interval (named by ``row``) outside the removed intervals of its key, of ``least`` length.

    With a ``bucket`` width rows and cuts are dealt to the buckets of the axis that they reach, so a row meets the
    cuts near it only, and long keys spread; a pair counts in the first bucket of both.
    """
    cuts = merge_intervals(removed, keys, start, end).select(*keys, F.col(start).alias("_rs"), F.col(end).alias("_re"))
    base = df.select(*keys, row, start, end)
    touch = (F.col("_rs") < F.col(end)) & (F.col("_re") > F.col(start))
    if bucket is None:
        hit = base.join(cuts, keys).filter(touch)
    else:
        dealt = lambda x, a, b: x.filter(F.col(b) >= F.col(a)).withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(a) / bucket), F.floor(F.col(b) / bucket))))
        first = F.floor(F.greatest(start, "_rs") / bucket)
        hit = dealt(base, start, end).join(dealt(cuts, "_rs", "_re"), [*keys, "_bucket"]).filter(touch & (F.col("_bucket") == first)).drop("_bucket")
    edges = base.select(*keys, row, F.col(start).alias("_from"), F.col(end).alias("_stop"), F.lit(None).cast(dict(df.dtypes)[start]).alias("_rs"))
    # a piece begins at the row's start or at the end of a cut, and lasts to the next cut or the row's end
    points = edges.unionByName(hit.select(*keys, row, F.col("_re").alias("_from"), F.col(end).alias("_stop"), "_rs"))
    w = Window.partitionBy(*keys, row).orderBy(F.col("_rs").asc_nulls_first())
    pieces = points.withColumn("_next", F.coalesce(F.lead("_rs").over(w), F.col("_stop")))
    return pieces.select(*keys, row, F.col("_from").alias(start), F.least("_next", "_stop").alias(end)).filter(F.col(end) - F.col(start) > least)


def kept_takes(markers: DataFrame, keys: list[str], start: str, end: str, strength: str, total: Column, least: int = 3) -> DataFrame:
    """(keys, start, end) of the takes that stay: those before a marker of ``least`` strength or more, and the tail
    behind the last marker up to ``total``; takes before weaker markers go, and empty ones too.

    One window over a key's markers, merged beforehand so that they don't overlap.
    """
    w = Window.partitionBy(*keys).orderBy(start, end)
    own = markers.withColumns({"_from": F.coalesce(F.lag(end).over(w), F.lit(0)), "_last": F.lead(start).over(w).isNull(), "_total": total})
    before = F.when(F.col(strength) >= least, F.struct(F.col("_from").alias("s"), F.col(start).alias("e")))
    tail = F.when(F.col("_last"), F.struct(F.col(end).alias("s"), F.col("_total").alias("e")))
    takes = own.select(*keys, F.explode(F.array_compact(F.array(before, tail))).alias("_t"))
    return takes.select(*keys, F.col("_t.s").alias(start), F.col("_t.e").alias(end)).filter(F.col(end) > F.col(start))


def collapse_points(points: DataFrame, removed: DataFrame, keys: list[str], at: str, start: str, end: str) -> DataFrame:
    """Moves points to the clock on which the removed intervals take no time; adds ``collapsed`` (0 at least).

    One pass over the union of points and merged cuts: the removed time before a point is a running sum, and
    a cut that the point lies in counts up to the point.
    """
    cuts = merge_intervals(removed, keys, start, end)
    cut_rows = cuts.select(*keys, F.col(start).alias("_at"), F.lit(0).alias("_kind"), F.col(start).alias("_cs"), F.col(end).alias("_ce"))
    rows = points.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.struct(*points.columns).alias("_row"))
    w = Window.partitionBy(*keys).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    both = cut_rows.unionByName(rows, allowMissingColumns=True)
    ended = F.sum(F.when(F.col("_kind") == 0, F.col("_ce") - F.col("_cs"))).over(w)
    last_end = F.max("_ce").over(w)
    gone = F.coalesce(ended, F.lit(0)) - F.greatest(F.coalesce(last_end - F.col("_at"), F.lit(0)), F.lit(0))
    return both.withColumn("_gone", gone).filter("_kind = 1").select("_row.*", F.greatest(F.col("_at") - F.col("_gone"), F.lit(0)).alias("collapsed"))


def remap(pairs: DataFrame) -> DataFrame:
    """Overlapping pairs (see ``overlap_join``) moved to the left clip's timeline clock.

    Needs l_timeline, the timeline position of l_start; adds ov_start, ov_end, tl_start and tl_end.
    """
    s, e = F.greatest("l_start", "r_start"), F.least("l_end", "r_end")
    return pairs.withColumns({"ov_start": s, "ov_end": e, "tl_start": F.col("l_timeline") + s - F.col("l_start"), "tl_end": F.col("l_timeline") + e - F.col("l_start")})


def split_and_shift(clips: DataFrame, keys: list[str], start: str, end: str, boundary: Column, by: Column) -> DataFrame:
    """Splits clips that the boundary lies strictly inside, and moves everything from the boundary on by ``by``."""
    inside = (F.col(start) < boundary) & (boundary < F.col(end))
    parts = F.when(inside, F.array(F.struct(F.col(start).alias("s"), boundary.alias("e"), F.lit(0).alias("part")), F.struct((boundary + by).alias("s"), (F.col(end) + by).alias("e"), F.lit(1).alias("part"))))
    shift = F.when(F.col(start) >= boundary, by).otherwise(F.lit(0))
    whole = F.array(F.struct((F.col(start) + shift).alias("s"), (F.col(end) + shift).alias("e"), F.lit(0).alias("part")))
    others = [c for c in clips.columns if c not in (start, end)]
    return clips.withColumn("_p", F.explode(F.coalesce(parts, whole))).select(*others, F.col("_p.s").alias(start), F.col("_p.e").alias(end), F.col("_p.part").alias("part"))


def dominated(df: DataFrame, keys: list[str], row: str, start: str, end: str, score: str, bucket: int) -> DataFrame:
    """Rows strictly inside another of their key with an equal or better score are dropped.

    An outer interval is dealt to the buckets it covers, an inner one only to the bucket of its start.
    """
    reach = F.sequence(F.floor(F.col(start) / bucket), F.floor(F.col(end) / bucket))
    other = df.select(*keys, F.col(start).alias("_s"), F.col(end).alias("_e"), F.col(score).alias("_v"), F.explode(reach).alias("_bucket"))
    inner = df.withColumn("_bucket", F.floor(F.col(start) / bucket))
    inside = (other["_s"] <= F.col(start)) & (F.col(end) <= other["_e"]) & (other["_e"] - other["_s"] > F.col(end) - F.col(start)) & (other["_v"] >= F.col(score))
    same = [inner[c].eqNullSafe(other[c]) for c in [*keys, "_bucket"]]
    return inner.join(other, [*same, inside], "left_anti").drop("_bucket")


def superseded(df: DataFrame, keys: list[str], start: str, end: str, order: str, score: str, anchor: Column, margin: float = 0.5) -> DataFrame:
    """Of rows with equal spans, a row goes when a later one (by ``order``) scores more than ``margin`` better, or as
    well within it and is an anchor, which the row is not. One window over the rows of a span."""
    ahead = Window.partitionBy(*keys, start, end).orderBy(order).rowsBetween(1, Window.unboundedFollowing)
    best, best_anchor = F.max(score).over(ahead), F.max(F.when(anchor, F.col(score))).over(ahead)
    gone = (best > F.col(score) + margin) | (~anchor & (best_anchor >= F.col(score) - margin))
    return df.withColumn("_gone", F.coalesce(gone, F.lit(False))).filter(~F.col("_gone")).drop("_gone")


def drop_past(df: DataFrame, start: str, end: str, cutoff: Column, tolerance, stays: Column) -> DataFrame:
    """Drops intervals that begin at or end past the cutoff and its tolerance, instead of trimming them."""
    limit = cutoff + tolerance
    return df.filter(stays | ((F.col(start) < limit) & (F.col(end) <= limit)))

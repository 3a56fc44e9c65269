"""Layout on a clock: durations, offsets, interpolation, packing."""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from collections.abc import Callable, Collection, Iterator
from itertools import count, groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

#: Rows that a fold hands back at once.
BATCH = 10_000


def lead_bounded(df: DataFrame, keys: list[str], start: str, longest) -> DataFrame:
    """``duration``: up to the next strictly later start of the key, ``longest`` at most."""
    later = Window.partitionBy(*keys).orderBy(start).rangeBetween(1, Window.unboundedFollowing)
    return df.withColumn("duration", F.least(F.coalesce(F.min(start).over(later) - F.col(start), F.lit(longest)), F.lit(longest)))


def prefix_layout(df: DataFrame, keys: list[str], duration: str, order: list[str]) -> DataFrame:
    """``at``: each row starts where the rows before it end, the first at 0."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("at", F.coalesce(F.sum(duration).over(w), F.lit(0)))


def running_offset(df: DataFrame, keys: list[str], flag: Column, duration: str, start: str, order: list[str]) -> DataFrame:
    """``shifted``: start plus the durations of the flagged rows before."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("shifted", F.col(start) + F.coalesce(F.sum(F.when(flag, F.col(duration))).over(w), F.lit(0)))


def fill_forward(df: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """``filled``: the value, or the last known one before it."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("filled", F.last(value, ignorenulls=True).over(w))


def shift_to_zero(df: DataFrame, keys: list[str], start: str) -> DataFrame:
    """``zeroed``: start minus the smallest start of the key."""
    return df.withColumn("zeroed", F.col(start) - F.min(start).over(Window.partitionBy(*keys)))


def overlaps_previous(df: DataFrame, keys: list[str], start: str, end: str, order: list[str]) -> DataFrame:
    """``overlaps``: whether the previous row ends after this one starts (the previous row only)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("overlaps", F.coalesce(F.lag(end).over(w) > F.col(start), F.lit(False)))


def fill_gaps(df: DataFrame, keys: list[str], start: str, end: str, order: list[str], low: Column, high: Column) -> DataFrame:
    """Runs of rows without times share the room between the known end before and the known start after evenly.

    ``low`` and ``high`` bound runs at the edges. Adds start_filled and end_filled.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    known = F.col(start).isNotNull()
    run = df.withColumn("_known", known.cast("int")).withColumn("_run", F.sum("_known").over(w))
    before = F.last(F.when(known, F.col(end)), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first(F.when(known, F.col(start)), ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    run = run.withColumns({"_b": F.coalesce(before, low), "_a": F.coalesce(after, high)})
    gap = Window.partitionBy(*keys, "_run", "_known")
    run = run.withColumns({"_i": F.row_number().over(gap.orderBy(*order)) - 1, "_n": F.count("*").over(gap)})
    step = F.greatest(F.col("_a") - F.col("_b"), F.lit(0)) / F.col("_n")
    return run.withColumns({
        "start_filled": F.when(known, F.col(start)).otherwise(F.col("_b") + step * F.col("_i")),
        "end_filled": F.when(known, F.col(end)).otherwise(F.col("_b") + step * (F.col("_i") + 1)),
    }).drop("_known", "_run", "_b", "_a", "_i", "_n")


def spread_tokens(df: DataFrame, tokens: str, start: str, end: str) -> DataFrame:
    """One row per token of the array, with even shares of [start, end): token_no, token, token_start, token_end."""
    n = F.size(tokens)
    step = (F.col(end) - F.col(start)) / n
    out = df.withColumn("_n", n).withColumn("_step", step).select("*", F.posexplode(tokens).alias("token_no", "token"))
    return out.withColumns({
        "token_start": F.col(start) + F.col("_step") * F.col("token_no"),
        "token_end": F.when(F.col("token_no") == F.col("_n") - 1, F.col(end)).otherwise(F.col(start) + F.col("_step") * (F.col("token_no") + 1)),
    }).drop("_n", "_step")


# ----------------------------------------------------------------- folds: state that depends on what was kept
def fold(df: DataFrame, keys: list[str], order: list[str], schema: str, step: Callable[[Iterator[dict]], Iterator[dict]]) -> DataFrame:
    """Runs a generator over each key's rows in order.

    Rows are dealt by key and sorted by Spark, and stream through the generator, so a task holds one batch and
    the generator's own state, however long a key's run of rows is.
    """
    names = [c.split()[0] for c in schema.split(", ")]
    rows = df.select(*dict.fromkeys([*keys, *order, *df.columns])).repartition(*keys).sortWithinPartitions(*keys, *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = to_arrow_schema(result)
        flow = (r for batch in batches for r in batch.to_pylist())
        out: list[dict] = []
        for _, group in groupby(flow, key=lambda r: tuple(r[k] for k in keys)):
            for r in step(group):
                out.append(r)
                if len(out) >= BATCH:
                    yield pa.RecordBatch.from_pylist([{n: x[n] for n in names} for x in out], kinds)
                    out = []
        if out:
            yield pa.RecordBatch.from_pylist([{n: x[n] for n in names} for x in out], kinds)

    result = df.sparkSession.createDataFrame([], schema).schema
    return rows.mapInArrow(run, result)


def throttle(df: DataFrame, keys: list[str], at: str, order: list[str], least: float, schema: str) -> DataFrame:
    """Keeps a row when it comes ``least`` or more after the last row kept."""

    def step(rows: Iterator[dict]) -> Iterator[dict]:
        last = None
        for r in rows:
            if last is None or r[at] - last >= least:
                last = r[at]
                yield r

    return fold(df, keys, order, schema, step)


def window_best(df: DataFrame, keys: list[str], start: str, end: str, score: str, order: list[str], within: float, schema: str) -> DataFrame:
    """One row per window: a row that starts within ``within`` of the kept row's end replaces it if better."""

    def step(rows: Iterator[dict]) -> Iterator[dict]:
        kept = None
        for r in rows:
            if kept is None or r[start] > kept[end] + within:
                if kept is not None:
                    yield kept
                kept = r
            elif r[score] > kept[score]:
                kept = r
        if kept is not None:
            yield kept

    return fold(df, keys, order, schema, step)


def accumulate_targets(df: DataFrame, keys: list[str], duration: str, rate: float, order: list[str], schema: str, most: int = 3) -> DataFrame:
    """``target``: the running sum of duration * rate pays out its whole part (1 to ``most``) and keeps the rest."""

    def step(rows: Iterator[dict]) -> Iterator[dict]:
        held = 0.0
        for r in rows:
            held += r[duration] * rate
            target = max(1, min(most, int(held))) if held >= 0.999 else 0
            held -= target
            yield r | {"target": target}

    return fold(df, keys, order, schema, step)


def pack_tracks(df: DataFrame, keys: list[str], start: str, end: str, order: list[str], schema: str, base: int = 0, reserved: Collection[int] = ()) -> DataFrame:
    """``track``: the lowest track from ``base`` on, but none of the reserved ones, whose last clip ends by this start."""

    def step(rows: Iterator[dict]) -> Iterator[dict]:
        ends: list[float] = []
        numbers = (t for t in count(base) if t not in reserved)
        tracks: list[int] = []
        for r in rows:
            i = next((i for i, e in enumerate(ends) if e <= r[start]), len(ends))
            if i == len(ends):
                tracks.append(next(numbers))
            ends[i : i + 1] = [r[end]]
            yield r | {"track": tracks[i]}

    return fold(df, keys, order, schema, step)


def track_with_gaps(df: DataFrame, keys: list[str], start: str, end: str, order: list[str], schema: str) -> DataFrame:
    """Clips and the gaps before them in order; a clip that starts before the cursor is skipped. Adds ``kind``."""

    def step(rows: Iterator[dict]) -> Iterator[dict]:
        cursor = 0
        for r in rows:
            if r[start] < cursor:
                continue
            if r[start] > cursor:
                yield r | {start: cursor, end: r[start], "kind": "gap"}
            yield r | {"kind": "clip"}
            cursor = r[end]

    return fold(df, keys, order, schema, step)


def hold_until_free(df: DataFrame, keys: list[str], start: str, end: str, blocks: str, order: list[str]) -> DataFrame:
    """Moves rows behind the active block: rows flagged ``blocks`` hold the time up to their end, and stay."""
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    held = df.withColumn("_guard", F.max(F.when(F.col(blocks), F.col(end))).over(before))
    by = F.when(~F.col(blocks) & (F.col(start) < F.col("_guard")), F.col("_guard") - F.col(start)).otherwise(F.lit(0))
    return held.withColumn("_by", by).withColumns({start: F.col(start) + F.col("_by"), end: F.col(end) + F.col("_by")}).drop("_guard", "_by")


def plan_chunks(df: DataFrame, keys: list[str], start: str, end: str, order: list[str], schema: str, most: int = 12, longest: float = 45.0) -> DataFrame:
    """Greedy chunks of the timeline: boundaries at starts and ends, at most ``most`` overlays and ``longest`` long.

    A key's starts and ends are held as sorted numbers; each chunk is found by bisection. Clips end at or after their
    start.
    """

    def step(rows: Iterator[dict]) -> Iterator[dict]:
        clips = list(rows)
        if not clips:
            return
        key = {k: clips[0][k] for k in keys}
        starts, ends = sorted(r[start] for r in clips), sorted(r[end] for r in clips)
        active = lambda a, b: bisect_left(starts, b) - bisect_right(ends, a)  # noqa: E731  clips that reach into (a, b)
        stop = ends[-1]
        points = sorted({0, *starts, *ends})
        begin, no = points[0], 0
        while begin < stop:
            close = min(stop, begin + longest)
            first, last = bisect_right(points, begin), bisect_right(points, close)
            # more clips are active up to a later point, so the first point with too many is found by bisection
            over = bisect_right(range(first, last), most, key=lambda i: active(begin, points[i])) + first
            if over < last:
                close = float(points[over - 1] if over > first else points[over])
            yield key | {"chunk": no, start: float(begin), end: float(close), "n": active(begin, close)}
            begin, no = close, no + 1

    return fold(df, keys, order, schema, step)

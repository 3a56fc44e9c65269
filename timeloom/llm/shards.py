"""Operator 4, sharding by sampled splitters.

Records are ordered by one long key: the leading 40 bits hash the text, so copies lie together, and the
other 24 hash the doc_id and the record's place, so that one text held by a third of all rows still spreads.
A sample of keys, each drawn with a chance proportional to its size, gives the quantile boundaries of ranges;
bytes and rows of every range are then counted exactly. A range that is too full for the boundary of a shard
that lies in it is subdivided by a sample drawn from it alone, until it holds less than TOLERANCE of a shard or
one key. The boundaries nearest to the equal shares split the shards, and a record's shard is the range that
holds its key. So sizes differ by about TOLERANCE or one record from shard to shard (law ``bytes``).

A shard is a range of keys, so a group of equal texts that holds a boundary lies in two neighbouring shards;
that is meant, as a group may be larger than a shard. Places inside a shard are counted in partitions of the
key's order, as many as the rows ask for; one row per partition is summed for the places before it.

Defined results: a null text has 8 bytes, and the checksum of the empty text; null and repeated ids are
records like others; an empty table gives an empty result. Other columns are ignored. Ranges that can't be
brought below the tolerance in ROUNDS rounds raise an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import durable, table

#: Ranges per shard at first and of a subdivision, sampled keys per range (expected), the share of a shard that a
#: range with a boundary may hold, and rounds of subdivision.
RANGES, SUBRANGES, SAMPLES, TOLERANCE, ROUNDS = 8, 16, 40, 0.002, 40
#: Rows that a partition of the ordered table holds about.
PARTITION_ROWS = 50_000


def _sample(rows: DataFrame, size: str, key: str, part: Column, wanted: dict[int, float]) -> dict[int, list[int]]:
    """Sorted keys by ``part``, each drawn with a chance of wanted[part] * size: the expected number per part is
    given by the caller, so what comes to the driver is bounded."""
    chance = F.element_at(F.create_map(*[F.lit(x).cast(t) for p, w in wanted.items() for x, t in ((p, "int"), (w, "double"))]), F.col("_part"))
    draw = F.pmod(F.xxhash64(F.lit(77), key), F.lit(1 << 30)) / float(1 << 30)
    drawn = rows.withColumn("_part", part.cast("int")).filter(F.col("_part").isNotNull()).filter(draw < F.col(size) * chance).select("_part", key).collect()
    out: dict[int, list[int]] = {}
    for p, k in drawn:
        out.setdefault(p, []).append(k)
    return {p: sorted(ks) for p, ks in out.items()}


def _quantiles(keys: list[int], ranges: int) -> set[int]:
    return {keys[len(keys) * i // ranges] for i in range(1, ranges)} if keys else set()


def range_of(key: str, bounds: list[int]) -> Column:
    """Number of boundaries at or below the key, as nested comparisons (a binary search)."""

    def search(low: int, high: int):
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(F.col(key) < bounds[mid], search(low, mid)).otherwise(search(mid + 1, high))

    return search(0, len(bounds))


def _within(key: str, spans: list[tuple[int, int]]) -> Column:
    """The number of the closed span that holds the key (spans in order), else null."""
    at = range_of(key, [low for low, _ in spans]) - 1
    high = F.element_at(F.array(*[F.lit(h).cast("long") for _, h in spans]), F.greatest(at + 1, F.lit(1)))
    return F.when((at >= 0) & (F.col(key) <= high), at)


def _counted(rows: DataFrame, part: Column, size: str, key: str) -> dict[int, tuple[int, int, int]]:
    found = rows.withColumn("_part", part).filter(F.col("_part").isNotNull()).groupBy("_part").agg(F.sum(size), F.min(key), F.max(key)).collect()  # a row per range
    return {r[0]: (r[1], r[2], r[3]) for r in found}


def splitters(rows: DataFrame, n_shards: int, size: str = "size", key: str = "key", tolerance: float = TOLERANCE) -> list[int]:
    """Boundary keys of shards with near equal sums of ``size``; shard k starts at the k-th of them."""
    total = rows.agg(F.sum(size)).first()[0] or 0
    if not total or n_shards < 2:
        return []
    mean = total / n_shards
    first = _sample(rows, size, key, F.lit(0), {0: n_shards * RANGES * SAMPLES / total}).get(0, [])
    bounds = sorted(_quantiles(first, n_shards * RANGES))
    # ranges in order of keys: sum, least and largest key
    ranges = [v for _, v in sorted(_counted(rows, range_of(key, bounds), size, key).items())]
    for _ in range(ROUNDS):
        starts, full = [0], []
        for b, _, _ in ranges:
            starts.append(starts[-1] + b)
        for i, (b, low, high) in enumerate(ranges):
            holds = int(starts[i] // mean) != int((starts[i + 1] - 1) // mean)
            if holds and b > tolerance * mean and low < high:
                full.append(i)
        if not full:
            targets = [k * mean for k in range(1, n_shards)]
            ends = [(abs(starts[i] - t), i) for t in targets for i in [min(range(len(starts)), key=lambda i: abs(starts[i] - t))]]
            return [ranges[i][1] if i < len(ranges) else ranges[-1][2] + 1 for _, i in ends]
        spans = [ranges[i][1:] for i in full]
        drawn = _sample(rows, size, key, _within(key, spans), {n: SUBRANGES * SAMPLES / ranges[i][0] for n, i in enumerate(full)})
        inner: list[int] = []
        for n, (low, high) in enumerate(spans):
            cuts = {c for c in _quantiles(drawn.get(n, []), SUBRANGES) if low < c <= high}
            inner += sorted({low, *cuts, high})  # the last key alone: progress where the sample holds one key only
        parts = [v for _, v in sorted(_counted(rows, F.when(_within(key, spans).isNotNull(), range_of(key, inner)), size, key).items())]
        ranges = sorted([r for i, r in enumerate(ranges) if i not in set(full)] + parts, key=lambda r: r[1])
    raise RuntimeError("ranges stay overfull")


def numbered(rows: DataFrame, size: str = "size", key: str = "key", groups: list[str] | None = None) -> DataFrame:
    """Adds ``place`` (rows before) and ``offset`` (sizes before) in the order of the groups and the key.

    Partitions hold ranges of the order; running sums stay inside a partition, and the sums before each, a row
    per partition, are joined to it.
    """
    order = [*(groups or []), key]
    n = rows.count()
    dealt = durable(rows.repartitionByRange(max(1, -(-n // PARTITION_ROWS)), *order).withColumn("_pid", F.spark_partition_id()))
    within = Window.partitionBy("_pid").orderBy(*order)
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # over a row per partition
    sums = dealt.groupBy("_pid").agg(F.count("*").alias("_n"), F.sum(size).alias("_b"))
    bases = sums.select("_pid", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}0") for c in ("_n", "_b")])
    return dealt.join(F.broadcast(bases), "_pid").withColumns({
        "place": F.row_number().over(within) - 1 + F.col("_n0"),
        "offset": F.sum(size).over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col(size) + F.col("_b0"),
    }).drop("_pid", "_n0", "_b0")


def shard_by_splitters(rows: DataFrame, n_shards: int, size: str = "size", key: str = "key") -> DataFrame:
    """Adds ``shard`` and gapless ``slot``; contiguous ranges of the key with near equal sums of ``size``."""
    split = rows.withColumn("shard", range_of(key, splitters(rows, n_shards, size, key)).cast("int"))
    placed = durable(numbered(split, size, key))
    first = placed.groupBy("shard").agg(F.min("place").alias("_first"))  # a row per shard
    return placed.join(F.broadcast(first), "shard").withColumn("slot", (F.col("place") - F.col("_first")).cast("long")).drop("place", "offset", "_first")


def keyed_records(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, key) of every record."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lead = F.shiftleft(F.shiftright(F.xxhash64(text), 24), 24)
    rest = F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.monotonically_increasing_id()).bitwiseAND(F.lit((1 << 24) - 1))
    return docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), lead.bitwiseOR(rest).alias("key"))


def op4_sampled_splitters(spark, sf_dir: str, n_shards: int = 24) -> DataFrame:
    """Contract query: every document's shard and slot under the law of near equal bytes."""
    rows = durable(keyed_records(table(spark, sf_dir, "documents")))
    sharded = shard_by_splitters(rows, n_shards)
    return sharded.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

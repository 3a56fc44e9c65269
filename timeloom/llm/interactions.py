"""Operator 11, filter interaction audit.

Each document has one failure flag per filter. Rows are first counted by part and flags, so what follows is as
large as parts x flag combinations, whatever the number of documents. A CUBE over the flags and the part sums
those counts for every subset of flags; its rows in which all selected flags are false are the documents that a
set of filters leaves. What a filter removes behind a set of earlier filters is the difference of two such
subsets, with and without it; every step of every order is one of those pairs.

Defined results: null texts are empty texts, and equal to them; a null part is the empty string; a document with
a null id equals no smaller id, and has no labels; repeated ids are documents of their own, and count as labelled
if any label row of the id says so. An empty table has no parts, so no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import durable, small_join, space_words, table

#: Filters that an audit can take at most: orders grow as their factorial.
MOST_FILTERS = 6


def repeats_smaller(rows: DataFrame, key: str, order: str, flag: str) -> DataFrame:
    """Adds whether an equal ``key`` has a smaller ``order``.

    Groups are reduced to their smallest order before anything is shuffled by key; only keys held twice or more
    come back to the rows, broadcast if they are few, else joined (a hot key is split by the adaptive join).
    """
    first = rows.groupBy(key).agg(F.min(order).alias("_first"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    joined = small_join(rows, durable(first), [key], "left")
    return joined.withColumn(flag, F.coalesce(F.col(order) > F.col("_first"), F.lit(False))).drop("_first")


def subset_survivors(flagged: DataFrame, flags: Sequence[str], part: str, measures: Sequence[str] = ()) -> DataFrame:
    """(part, chosen, documents, one count per boolean measure): what each set of filters leaves of each part.

    ``chosen`` has bit i for flags[i]. Sets that leave nothing have a row of zeros.
    """
    if len(flags) > MOST_FILTERS:
        raise ValueError(f"at most {MOST_FILTERS} filters")
    n, counts = len(flags), ["documents", *measures]
    counted = durable(flagged.groupBy(part, *flags).agg(F.count("*").alias("documents"), *[F.count_if(m).alias(m) for m in measures]))
    cube = counted.cube(*flags, part).agg(F.grouping_id().alias("_rolled"), *[F.sum(c).alias(c) for c in counts])

    def rolled(bit: int) -> Column:
        return F.shiftright("_rolled", bit).bitwiseAND(F.lit(1))

    for i, f in enumerate(flags):
        cube = cube.filter((rolled(n - i) == 1) | ~F.col(f))
    chosen = sum(((1 - rolled(n - i)) * (1 << i) for i in range(n)), F.lit(0)).cast("int")
    left = cube.filter(rolled(0) == 0).select(part, chosen.alias("chosen"), *counts)
    grid = counted.select(part).distinct().withColumn("chosen", F.explode(F.sequence(F.lit(0), F.lit((1 << n) - 1))))
    return grid.join(left, [part, "chosen"], "left").fillna(0, counts)


def removals(survivors: DataFrame, n_filters: int, part: str, measures: Sequence[str] = ()) -> DataFrame:
    """One row per part, filter and set of earlier filters: (part, filter, before, kept, removed, removed_<measure>).

    Joins the pair of subsets that differ by the filter.
    """
    spark, counts = survivors.sparkSession, ["documents", *measures]
    pairs = [(i, b, b | 1 << i) for i in range(n_filters) for b in range(1 << n_filters) if not b >> i & 1]
    steps = spark.createDataFrame(pairs, "filter int, before int, after int")
    without = survivors.select(part, F.col("chosen").alias("before"), *[F.col(c).alias(f"_{c}") for c in counts])
    behind = survivors.withColumnRenamed("chosen", "after")
    both = without.join(F.broadcast(steps), "before").join(behind, [part, "after"])  # at most 192 steps
    return both.select(part, "filter", "before", F.col("documents").alias("kept"), (F.col("_documents") - F.col("documents")).alias("removed"), *[(F.col(f"_{m}") - F.col(m)).alias(f"removed_{m}") for m in measures])


def filter_orders(flagged: DataFrame, flags: Sequence[str], part: str, measures: Sequence[str] = ()) -> DataFrame:
    """One row per part, order of the filters and step, zeros included.

    kept, removed, removed_<measure> at this step; redundant (failing its filter, removed earlier), unique_fails
    (failing its filter only), shapley (its filter's removed, summed over all orders).
    """
    n = len(flags)
    gone = removals(subset_survivors(flagged, flags, part, measures), n, part, measures)
    alone = Window.partitionBy(part, "filter")
    size = F.bit_count("before")
    orders_with = F.element_at(F.array(*[F.lit(math.factorial(b) * math.factorial(n - 1 - b)) for b in range(n)]), size + 1)
    gone = gone.withColumns({
        "failing": F.max(F.when(F.col("before") == 0, F.col("removed"))).over(alone),
        "unique_fails": F.max(F.when(size == n - 1, F.col("removed"))).over(alone),
        "shapley": F.sum(F.col("removed") * orders_with).over(alone),
    })
    listed = [("".join(flags[i] for i in p), k + 1, p[k], sum(1 << i for i in p[:k])) for p in permutations(range(n)) for k in range(n)]
    orders = flagged.sparkSession.createDataFrame(listed, "filter_order string, step int, filter int, before int")
    rows = gone.join(F.broadcast(orders), ["filter", "before"])  # at most 4,320 orders and steps
    return rows.select(part, "filter_order", "step", "kept", "removed", (F.col("failing") - F.col("removed")).alias("redundant"), "unique_fails", *[f"removed_{m}" for m in measures], "shapley")


def failure_flags(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, A, B, C, D, E, good, toxic) of each document, by the conditions of the contract."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"), space_words(F.col("text")).alias("words"))
    rows = rows.select(
        "doc_id", "part", "digest",
        (F.size("words") < 50).alias("A"),
        (100 * F.size(F.array_distinct("words")) < 65 * F.size("words")).alias("B"),
        (100 * F.regexp_count("text", F.lit("[A-Z]")) > 5 * F.length("text")).alias("C"),
        F.col("text").rlike("[#$%&*|]").alias("D"),
    )
    marks = labels.groupBy("doc_id").agg(F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    labelled = durable(rows.join(marks, "doc_id", "left").fillna(False, ["good", "toxic"]))
    return repeats_smaller(labelled, "digest", "doc_id", "E").drop("doc_id", "digest")


def op11_filter_cube(spark, sf_dir: str) -> DataFrame:
    """Contract query: five filters over all documents, in all 120 orders, by source."""
    flagged = failure_flags(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    out = filter_orders(flagged, list("ABCDE"), "part", ["good", "toxic"])
    return out.withColumnsRenamed({"removed_good": "good_lost", "removed_toxic": "toxic_lost"})


OP11_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]') IF x <> ''] AS words FROM documents),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words), 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t),
    regexp_matches(t, '[#$%&*|]'), coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)] AS fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM d LEFT JOIN l ON l.doc_id = d.doc_id),
m AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL),
o AS (SELECT '' AS filter_order UNION ALL SELECT filter_order || x FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) WHERE NOT contains(filter_order, x)),
s AS (SELECT filter_order, step, ascii(filter_order[step]) - 64 AS own, [ascii(x) - 64 FOR x IN string_split(filter_order[1:step - 1], '') IF x <> ''] AS earlier FROM o, range(1, 6) r(step) WHERE length(filter_order) = 5),
p AS (
  SELECT part, filter_order, step, own, sum(CASE WHEN NOT gone AND NOT fails[own] THEN n ELSE 0 END) AS kept, sum(CASE WHEN NOT gone AND fails[own] THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN gone AND fails[own] THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails[own] AND len([x FOR x IN fails IF x]) = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN NOT gone AND fails[own] THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN NOT gone AND fails[own] THEN toxic ELSE 0 END) AS toxic_lost
  FROM (SELECT m.*, s.*, len([x FOR x IN earlier IF fails[x]]) > 0 AS gone FROM m, s) GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM p
"""

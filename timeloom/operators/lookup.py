"""Lookups, overrides, first-wins and row-level rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def cascade(entries: DataFrame, entry: str, tiers: list[tuple[DataFrame, list[str]]], value: str, rank: list[Column]) -> DataFrame:
    """The value of the first tier that has a match, the best of it by ``rank``; adds value and tier (1, 2, ...)."""
    found = None
    for i, (table, on) in enumerate(tiers, 1):
        hit = entries.join(table, on).select(entry, F.lit(i).alias("tier"), value, *rank)
        found = hit if found is None else found.unionByName(hit, allowMissingColumns=True)
    names = [c for c in found.columns if c not in (entry, "tier", value)]
    w = Window.partitionBy(entry).orderBy("tier", *names)
    best = found.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select(entry, "tier", value)
    return entries.join(best, entry, "left")


def override(base: DataFrame, newer: DataFrame, key: str) -> DataFrame:
    """Rows of ``newer``, and those of ``base`` whose key isn't among them."""
    return base.join(newer.select(key).distinct(), key, "left_anti").unionByName(newer)


def with_issues(left: DataFrame, right: DataFrame, on: list[str], present: str, issue: str) -> tuple[DataFrame, DataFrame]:
    """(matches, misses): rows with a partner, and rows without one, named by ``issue``."""
    joined = left.join(right, on, "left")
    return joined.filter(F.col(present).isNotNull()), joined.filter(F.col(present).isNull()).select(*left.columns, F.lit(issue).alias("issue"))


def first_by(df: DataFrame, keys: list, order: list) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_r = 1").drop("_r")


def drop_with_previous(df: DataFrame, keys: list[str], cue: Column, skip: Column, order: list[str], row: str) -> DataFrame:
    """Drops each cue row and the nearest row before it that isn't skipped (nor a cue)."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    target = F.last(F.when(~skip & ~cue, F.col(row)), ignorenulls=True).over(w)
    marked = df.withColumn("_t", F.when(cue, target))
    gone = marked.filter(cue).select(F.explode(F.array(F.col(row), F.col("_t"))).alias(row)).filter(F.col(row).isNotNull()).distinct()
    return df.join(gone, row, "left_anti")


def unpivot_cells(df: DataFrame, ids: list[str], columns: list[str], separator: str = r"\|") -> DataFrame:
    """One row per non-blank value of the multi-value cells, in column and value order."""
    cells = F.array(*[F.struct(F.lit(i).alias("column_no"), F.lit(c).alias("column"), F.col(c).cast("string").alias("cell")) for i, c in enumerate(columns)])
    rows = df.select(*ids, F.explode(cells).alias("c")).select(*ids, "c.*")
    split = F.filter(F.transform(F.split("cell", separator), lambda x: F.trim(x)), lambda x: x != "")
    return rows.select(*ids, "column_no", "column", F.posexplode(split).alias("value_no", "value"))


def repivot_cells(values: DataFrame, ids: list[str], columns: list[str], separator: str = " | ") -> DataFrame:
    """The inverse: values joined back into one cell per column."""
    ordered = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("column") == c, F.struct("value_no", "value")))), lambda x: x["value"]), separator)
    return values.groupBy(*ids).agg(*[ordered(c).alias(c) for c in columns])

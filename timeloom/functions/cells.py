"""Cells that hold lists (`` | `` between values) or maps (``k=v`` between bars), and percent, keep and range cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_values(c: Column) -> Column:
    """Trimmed non-blank values of a cell."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"\|"), lambda x: F.trim(x)), lambda x: x != "")


def distinct_ignoring_case(values: Column) -> Column:
    """Values whose lower-cased form wasn't met before, in order."""
    return F.filter(values, lambda x, i: F.array_position(F.transform(values, lambda y: F.lower(y)), F.lower(x)) == i + 1)


def merge_values(*cells: Column) -> Column:
    """All values of the cells, case-insensitively distinct, as one cell."""
    return F.array_join(distinct_ignoring_case(F.concat(*[split_values(c) for c in cells])), " | ")


def parse_notes(c: Column) -> Column:
    """Map of a notes cell; later keys win, items without ``=`` and blank values are left out."""
    items = F.filter(split_values(c), lambda x: F.locate("=", x) > 1)
    pairs = F.transform(items, lambda x: F.struct(F.trim(F.substring_index(x, "=", 1)).alias("k"), F.trim(F.regexp_replace(x, "^[^=]*=", "")).alias("v")))
    # the last item of a key wins
    last = F.filter(pairs, lambda p, i: F.size(F.filter(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["k"] == p["k"])) == 0)
    return F.map_from_entries(F.filter(last, lambda p: p["v"] != ""))


def render_notes(m: Column) -> Column:
    """Cell of a map, keys in order."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), " | ")


def set_note(c: Column, key: str, value: Column) -> Column:
    """The cell with the key set; a blank or null value removes it."""
    rest = F.map_filter(parse_notes(c), lambda k, _: k != key)
    return render_notes(F.when(F.coalesce(value, F.lit("")) != "", F.map_concat(rest, F.create_map(F.lit(key), value))).otherwise(rest))


def note_range(c: Column, key: str) -> Column:
    """A closed range ``3-7`` or ``3`` held by a note, as struct (lo, hi); null when absent or malformed."""
    v = F.element_at(parse_notes(c), key)
    lo = F.regexp_extract(v, r"^(\d+)(?:-(\d+))?$", 1)
    hi = F.regexp_extract(v, r"^(\d+)(?:-(\d+))?$", 2)
    return F.when(v.rlike(r"^\d+(-\d+)?$"), F.struct(lo.try_cast("int").alias("lo"), F.when(hi != "", hi).otherwise(lo).try_cast("int").alias("hi")))


def percent(c: Column) -> Column:
    """``95.3%`` as 0.953, a comma taken as the decimal point; unreadable is 0."""
    return F.coalesce(F.regexp_replace(F.replace(c, F.lit(","), F.lit(".")), r"[%\s]", "").try_cast("double") / 100, F.lit(0.0))


#: Fixed marks of keep cells.
KEEP, DROP = ("x", "✓", "✔", "keep", "1", "yes", "true"), ("✗", "✕", "delete", "drop", "cut", "no", "0", "false")


def keep_flag(c: Column) -> Column:
    """Whether a keep cell says keep; unknown marks don't."""
    return F.lower(F.trim(F.coalesce(c, F.lit("")))).isin(*KEEP)

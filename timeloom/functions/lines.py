"""List lines, calls to action, token windows and precision of dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed marks of list lines, in the order in which they are tried: type, pattern, signals.
LIST_MARKS = [
    ("check", r"^\s*(\[(?:x|X| )\]|☐|☑|☒|✅|✔|✓)\s*(.+?)\s*$", "case | check mark"),
    ("number", r"^\s*((?:[0-9]+|[A-Za-z])[.)])\s*(.+?)\s*$", "keypoint | numbered"),
    ("dash", r"^\s*([-–—])\s*(.+?)\s*$", "-"),
    ("bullet", r"^\s*([•◦▪▫◾◽◉○◯◆◇*])\s*(.+?)\s*$", "keypoint | puce"),
]


def parse_list_line(line: Column) -> Column:
    """Struct (list_type, signals, item) of a list line, null of any other; an open check box has no check mark."""
    out = F.lit(None).cast("struct<list_type:string,signals:string,item:string>")
    for kind, pattern, signals in reversed(LIST_MARKS):
        said = F.lit(signals)
        if kind == "check":
            said = F.when(F.regexp_extract(line, pattern, 1).isin("[ ]", "☐"), "case").otherwise(signals)
        found = F.struct(F.lit(kind).alias("list_type"), said.alias("signals"), F.trim(F.regexp_extract(line, pattern, 2)).alias("item"))
        out = F.when(line.rlike(pattern), found).otherwise(out)
    return out


#: Fixed words of calls to action; they count as whole words.
CALLS = {
    "comment": "comment(ez|e|er|aire|airez|aires)?",
    "subscribe": "abonn(e|é|ez|er|ement|ements)([- ]?(toi|vous))?|subscribe|sub",
    "donate": "tipee+|patreon|dons?|soutiens?|soutenez|supportez|support|donate",
}
WHOLE_WORD = r"(?i)(^|[^\p{L}\p{N}_])(%s)($|[^\p{L}\p{N}_])"


def calls_to_action(c: Column) -> Column:
    """Which calls a text makes, in the fixed order."""
    return F.array_compact(F.array(*[F.when(c.rlike(WHOLE_WORD % p), F.lit(k)) for k, p in CALLS.items()]))


def token_window(tokens: Column, phrase: Column) -> Column:
    """The first place (from 0) at which the phrase's tokens stand one after the other; null if nowhere or blank."""
    n = F.size(phrase)
    at = F.filter(F.sequence(F.lit(1), F.greatest(F.size(tokens) - n + 1, F.lit(1))), lambda i: F.slice(tokens, i, n) == phrase)
    return F.when(n > 0, F.array_min(at) - 1)


def undominated(df: DataFrame, keys: list[str], rank: str, date: str) -> DataFrame:
    """Dates of precision 0 (day), 1 (month), 2 (year) that no finer one of their key lies in.

    Finer dates are turned into the months and years that they rule out, so the join is an equality.
    """
    month, year = F.struct(F.lit(1).alias(rank), F.trunc(date, "month").alias(date)), F.struct(F.lit(2).alias(rank), F.trunc(date, "year").alias(date))
    ruled = df.filter(F.col(rank) < 2).select(*keys, F.explode(F.when(F.col(rank) == 0, F.array(month, year)).otherwise(F.array(year))).alias("r")).select(*keys, "r.*").distinct()
    return df.join(ruled, [*keys, rank, date], "left_anti")

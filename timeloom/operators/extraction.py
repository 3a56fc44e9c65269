"""Dates, numbers and quotes of texts as rows with their places: (ids, kind, start, end, value).

A pattern's matches and the gaps between them come from built-in functions; their lengths, summed in order within a
text, are the places. Spans of one kind that overlap those of another are left out by one pass over both in order,
without pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from timeloom.functions.display import MONTHS

#: Fixed patterns (Java syntax; U: Unicode classes). Units that may stand behind a number, and the nine quote styles.
_UNIT = r"(?:\s?(?:%|€|euros?|dollars?|millions?|milliards?|milliers?))?"
NUMBERS = {
    "grouped": r"(?iU)\b\d{1,3}(?:[  ]\d{3})+(?:[.,]\d+)?" + _UNIT,
    "simple": r"(?iU)\b\d+(?:[.,]\d+)?" + _UNIT,
}
PLAIN_DATES = {
    "slash": r"(?U)\b\d{1,2}/\d{1,2}(?:/\d{2,4})?\b",
    "iso": r"(?U)\b\d{4}-\d{2}-\d{2}\b",
    "year": r"(?U)\b(?:1[5-9]\d{2}|20\d{2})\b",
}
QUOTES = {
    "straight": r'"[^"]+"',
    "single": r"(?U)(?<!\w)'[^']+'(?!\w)",
    "double": "“[^”]+”",
    "low double": "„[^“]+“",
    "angle": "«[^»]+»",
    "single angle": "‹[^›]+›",
    "low single": "‚[^‘]+‘",
    "curved": "‘[^’]+’",
    "typed angle": "<<[^>]+>>",
}
#: Characters and words that a quote holds at least.
QUOTE_CHARS, QUOTE_WORDS = 8, 3


def month_dates(languages: list[str] | None = None) -> dict[str, str]:
    """Patterns of dates with month names: a day before the name, or a year behind it."""
    names = "|".join(sorted({n for lang in languages or MONTHS for n in MONTHS[lang]}, key=lambda n: (-len(n), n)))
    return {"day month": rf"(?iU)\b\d{{1,2}}(?:er|e)?\s+(?:{names})(?:\s+\d{{2,4}})?", "month year": rf"(?iU)\b(?:{names})\s+\d{{4}}\b"}


def located(texts: DataFrame, ids: list[str], text: str, patterns: dict[str, str]) -> DataFrame:
    """(ids, form, start, end, value): every match of every pattern; offsets in code points, end exclusive."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    each = [F.struct(F.lit(n).alias("form"), F.regexp_extract_all(t, F.lit(p), F.lit(0)).alias("found"), F.split(t, p, -1).alias("gaps")) for n, p in patterns.items()]
    forms = texts.select(*ids, F.explode(F.array(*each)).alias("_f")).filter(F.size("_f.found") > 0)
    rows = forms.select(*ids, "_f.form", F.posexplode(F.arrays_zip(F.col("_f.found").alias("value"), F.col("_f.gaps").alias("gap"))).alias("_i", "_m")).filter("_m.value IS NOT NULL")
    past = F.sum(F.length("_m.gap") + F.length("_m.value")).over(Window.partitionBy(*ids, "form").orderBy("_i")).cast("int")
    return rows.select(*ids, "form", (past - F.length("_m.value")).alias("start"), past.alias("end"), F.col("_m.value").alias("value"))


def _trimmed(spans: DataFrame) -> DataFrame:
    """Spans without the white space at their ends."""
    blank = lambda pattern: F.length(F.regexp_extract("value", pattern, 0))
    cut = spans.withColumns({"start": F.col("start") + blank(r"(?U)^\s+"), "end": F.col("end") - blank(r"(?U)\s+$")})
    return cut.withColumn("value", F.regexp_replace("value", r"(?U)^\s+|\s+$", ""))


def _distinct(spans: DataFrame, ids: list[str], kind: str) -> DataFrame:
    """One of the spans with an equal start and text, case ignored; the first form listed would find it first, and all
    give the same end."""
    return spans.groupBy(*ids, "start", F.lower("value").alias("_k")).agg(F.min("end").alias("end"), F.min("value").alias("value")).select(*ids, F.lit(kind).alias("kind"), "start", "end", "value")


def outside(spans: DataFrame, others: DataFrame, ids: list[str]) -> DataFrame:
    """The spans that overlap none of the others: going by their ends, nothing that began before reaches past their start."""
    marks = others.select(*ids, F.col("start").alias("_at"), F.lit(1).alias("_order"), F.col("end").alias("_reach"))
    rows = spans.select(*ids, F.col("end").alias("_at"), F.lit(0).alias("_order"), F.struct(*[c for c in spans.columns if c not in ids]).alias("_row"))
    before = Window.partitionBy(*ids).orderBy("_at", "_order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = rows.unionByName(marks, allowMissingColumns=True).withColumn("_furthest", F.max("_reach").over(before))
    return both.filter(F.col("_row").isNotNull() & F.coalesce(F.col("_furthest") <= F.col("_row.start"), F.lit(True))).select(*ids, "_row.*")


def date_spans(texts: DataFrame, ids: list[str], text: str, languages: list[str] | None = None) -> DataFrame:
    """Dates with month names of the languages (all by default), with slashes, in ISO form, and single years; parts of
    a longer date count too."""
    return _distinct(_trimmed(located(texts, ids, text, month_dates(languages) | PLAIN_DATES)).filter(F.length("value") >= 2), ids, "date")


def number_spans(texts: DataFrame, ids: list[str], text: str, dates: DataFrame) -> DataFrame:
    """Numbers in groups of three digits and single ones, with the unit behind them, outside the dates."""
    found = located(texts, ids, text, NUMBERS)
    return _distinct(_trimmed(outside(found, dates, ids)), ids, "number")


def quote_spans(texts: DataFrame, ids: list[str], text: str) -> DataFrame:
    """Passages in one of nine kinds of quote marks, marks included, that hold 8 characters and three words."""
    found = located(texts, ids, text, QUOTES)
    width = F.when(F.col("form") == "typed angle", 2).otherwise(1)
    inner = F.regexp_replace(F.substring(F.col("value"), width + 1, F.length("value") - 2 * width), r"(?U)^\s+|\s+$", "")
    enough = (F.length(inner) >= QUOTE_CHARS) & (F.size(F.regexp_extract_all(inner, F.lit(r"(?U)\w+"), F.lit(0))) >= QUOTE_WORDS)
    return _distinct(_trimmed(found.filter(enough)), ids, "quote")


def text_spans(texts: DataFrame, ids: list[str], text: str, languages: list[str] | None = None) -> DataFrame:
    """All dates, numbers outside them, and quotes."""
    dates = date_spans(texts, ids, text, languages)
    return dates.unionByName(number_spans(texts, ids, text, dates)).unionByName(quote_spans(texts, ids, text))


def is_money(value: Column) -> Column:
    """Whether a text names a currency by sign or word."""
    return F.coalesce(value.rlike(r"(?iU)[$€£¥₩₽₹₺₫₦₱₪₭₲₵₴฿₮₸]|\b(?:dollars?|euros?|pounds?|yen|yuan|won|rupees?|pesos?|real|reais|lira|francs?|bitcoin|btc)\b"), F.lit(False))

"""Pattern extraction: all matches, spaces collapsed, distinct ignoring case, in order of appearance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cells import distinct_ignoring_case

#: Fixed patterns of the extractors (Java syntax, Unicode classes).
_NUMBER = r"[0-9]+(?:[.,][0-9]+)*"
PATTERNS = {
    "hashtag": r"(?U)#\w+",
    "percent": rf"{_NUMBER} ?(?:%|percent\b|pour ?cent\b)",
    "decibel": rf"(?i){_NUMBER} ?(?:dB|decibels?)\b",
    "speed": rf"(?i){_NUMBER} ?(?:km/h|kmh|mph|m/s)",
    "weight": rf"(?i){_NUMBER} ?(?:kg|kilograms?|kilos?|tonnes?|grams?|g|lbs?|pounds?)\b",
    "distance": rf"(?i){_NUMBER} ?(?:km|kilometers?|kilometres?|m|meters?|metres?|cm|mm|miles?)\b(?!/|²|\^2)",
    "temperature": rf"(?i){_NUMBER} ?(?:°C|°F|degrees?\b|degrés?\b)",
    "surface": rf"(?i){_NUMBER} ?(?:m²|km²|m2|km2|hectares?|acres?)",
    "volume": rf"(?i){_NUMBER} ?(?:liters?|litres?|cl|ml|m³|m3|gallons?)\b",
    "money": rf"(?:[$€£] ?{_NUMBER}|(?i:{_NUMBER} ?(?:[$€£]|dollars?\b|euros?\b|pounds?\b)))",
    "duration": rf"(?i){_NUMBER} ?(?:seconds?|minutes?|hours?|days?|weeks?|months?|years?)\b",
    "ranking": r"(?i)\b(?:first|second|third|[0-9]+(?:st|nd|rd|th)|n° ?[0-9]+|top ?[0-9]+)\b",
    "url": r"https?://[^\s<>\"']+",
    "iso_date": r"\b[0-9]{4}-[0-9]{2}-[0-9]{2}\b",
    "slash_date": r"\b[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\b",
    "year": r"\b(?:1[5-9]|20)[0-9]{2}\b",
    "number": _NUMBER,
    "quote": r"[\"“«]([^\"”»]{8,})[\"”»]",
    "timecode": r"\b[0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?\b",
    "spoken_url": r"(?i)\b[a-z][a-z0-9_-]+\.(?:com|fr|net|org|io|eu|uk|de|es|it|be|ch|ca|au|co|tv|news|info|biz|me|app|edu|gov)\b",
    "bullet": r"(?m)^[ >*-]{0,3}[-•*][ \t]+[^\n]+",
    "social": r"(?i)\b(?:youtube|instagram|twitter|tiktok|facebook|linkedin|twitch)\b",
}


def find_all(c: Column, pattern: str) -> Column:
    """Distinct matches in order."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(pattern), F.lit(0))
    return distinct_ignoring_case(F.transform(found, lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))))


def extract(c: Column, kind: str) -> Column:
    return find_all(c, PATTERNS[kind])


def quotes(c: Column) -> Column:
    """Quoted passages of at least 8 characters and 3 words."""
    inner = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(PATTERNS["quote"]), F.lit(1))
    return distinct_ignoring_case(F.filter(inner, lambda x: F.size(F.split(F.trim(x), r"\s+")) >= 3))


def pure_distances(c: Column) -> Column:
    """Distances whose number wasn't already given as a speed or a surface."""
    digits = lambda arr: F.transform(arr, lambda x: F.regexp_extract(x, "^[0-9]+", 0))
    taken = F.concat(digits(extract(c, "speed")), digits(extract(c, "surface")))
    return F.filter(extract(c, "distance"), lambda x: ~F.array_contains(taken, F.regexp_extract(x, "^[0-9]+", 0)))


def plain_numbers(c: Column) -> Column:
    """Numbers outside dates."""
    rest = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), PATTERNS["iso_date"], " "), PATTERNS["slash_date"], " ")
    return find_all(rest, PATTERNS["number"])


def signals(c: Column) -> Column:
    """Which of ``...``, ``!`` and ``?`` a text holds, in this order."""
    t = F.coalesce(c, F.lit(""))
    return F.array_compact(F.array(F.when(t.contains("...") | t.contains("…"), "..."), F.when(t.contains("!"), "!"), F.when(t.contains("?"), "?")))

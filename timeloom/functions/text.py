"""Text normalisation, tokens and overlap measures as native expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _latin_pairs() -> tuple[str, str]:
    """Accented letters of the Latin blocks and their base letters, from the Unicode tables."""
    src, dst = [], []
    for cp in range(0xC0, 0x250):
        base = unicodedata.normalize("NFD", chr(cp))[0]
        if base != chr(cp) and base.isascii():
            src.append(chr(cp))
            dst.append(base)
    return "".join(src), "".join(dst)


_FROM, _TO = _latin_pairs()
#: Letters that lose an accent and become one of a to z.
ACCENTED = _FROM


def strip_accents(c: Column) -> Column:
    """Latin letters without their accents; combining marks go."""
    return F.regexp_replace(F.translate(c, _FROM, _TO), r"\p{Mn}+", "")


def collapse_spaces(c: Column) -> Column:
    """Runs of white space, non-breaking included, become one space; ends trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def script_paragraph(c: Column) -> Column:
    """A paragraph on one line without addresses; the empty text where it announces an excerpt or an insert."""
    line = collapse_spaces(F.coalesce(c, F.lit("")))
    announces = F.upper(line).rlike("^(?:EXTRAIT|INSERT)")
    return F.when(announces, "").otherwise(collapse_spaces(F.regexp_replace(line, r"(?i)https?://\S+|www\.\S+", " ")))


def without_title(c: Column) -> Column:
    """A script without blank lines at its start and, if that comes first, the line of its title."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"(?i)\A(?:[^\S\n]*\n)*(?:[^\S\n]*TITRE[^\n]*(?:\n|\z))?(?:[^\S\n]*\n)*", "")


def normalize(c: Column) -> Column:
    """Canonical text for comparisons: no accents, lower case, everything but letters and digits a space."""
    return F.trim(F.regexp_replace(F.lower(strip_accents(F.coalesce(c, F.lit("")))), "[^a-z0-9]+", " "))


def lookup_key(c: Column) -> Column:
    """As ``normalize``, but ``#`` stays."""
    return F.trim(F.regexp_replace(F.lower(strip_accents(F.coalesce(c, F.lit("")))), "[^a-z0-9#]+", " "))


def joined_key(c: Column, mark: str = "_") -> Column:
    """The canonical words joined by a mark, for names of places and files."""
    return F.replace(normalize(c), F.lit(" "), F.lit(mark))


def tokenize(c: Column) -> Column:
    """Tokens ``[a-z0-9]+`` of the canonical text; text without Latin letters or digits has none."""
    return F.regexp_extract_all(normalize(c), F.lit("[a-z0-9]+"), F.lit(0))


def overlap(left: Column, right: Column) -> Column:
    """Number of distinct common tokens of two arrays."""
    return F.size(F.array_intersect(left, right))


def set_overlap(left: Column, right: Column) -> Column:
    """Distinct common tokens over the smaller number of distinct tokens; 0 when either is empty."""
    least = F.least(F.size(F.array_distinct(left)), F.size(F.array_distinct(right)))
    return F.when(least > 0, overlap(left, right) / least).otherwise(F.lit(0.0))


def overlap_of_left(left: Column, right: Column) -> Column:
    """Distinct common tokens over the distinct tokens of the left."""
    n = F.size(F.array_distinct(left))
    return F.when(n > 0, overlap(left, right) / n).otherwise(F.lit(0.0))


def overlap_of_longer(left: Column, right: Column) -> Column:
    """Distinct common tokens over the larger number of distinct tokens."""
    n = F.greatest(F.size(F.array_distinct(left)), F.size(F.array_distinct(right)))
    return F.when(n > 0, overlap(left, right) / n).otherwise(F.lit(0.0))


def length_ratio(left: Column, right: Column) -> Column:
    """Smaller over larger number of tokens; 0 when either is empty."""
    low, high = F.least(F.size(left), F.size(right)), F.greatest(F.size(left), F.size(right))
    return F.when(low > 0, low / high).otherwise(F.lit(0.0))


def multiset_overlap(left: Column, right: Column) -> Column:
    """Common tokens counted with repeats: the sum over tokens of the smaller count."""
    count = lambda arr, t: F.size(F.filter(arr, lambda x: x == t))
    return F.aggregate(F.array_intersect(left, right), F.lit(0), lambda n, t: n + F.least(count(left, t), count(right, t)))


def ends_sentence(c: Column) -> Column:
    """Whether the text ends with one of ``. ? ! : ;``."""
    return F.coalesce(c.rlike(r"[.?!:;]\s*$"), F.lit(False))


def padded(c: Column) -> Column:
    """The canonical text with a space on either side of each word."""
    return F.concat(F.lit(" "), F.replace(normalize(c), F.lit(" "), F.lit("  ")), F.lit(" "))


def phrase_count(text: Column, phrase: Column) -> Column:
    """Occurrences of the canonical phrase in the canonical text at word bounds, without overlaps."""
    p = padded(phrase)
    n = (F.length(padded(text)) - F.length(F.replace(padded(text), p, F.lit("")))) / F.length(p)
    return F.when(normalize(phrase) == "", 0).otherwise(n.cast("int"))


#: Fixed code point ranges by which letters are counted per script.
SCRIPTS = {
    "latin": "A-Za-zÀ-ɏ",
    "greek": "Ͱ-Ͽ",
    "cyrillic": "Ѐ-ӿ",
    "hebrew": "֐-׿",
    "arabic": "؀-ۿ",
}


def script_count(c: Column, script: str) -> Column:
    return F.length(F.regexp_replace(F.coalesce(c, F.lit("")), f"[^{SCRIPTS[script]}]", ""))


def script_ratio(c: Column, script: str) -> Column:
    """Letters of the script over the letters of all scripts listed; 0 without letters."""
    total = sum((script_count(c, s) for s in SCRIPTS), F.lit(0))
    return F.when(total > 0, script_count(c, script) / total).otherwise(F.lit(0.0))


def dominant_script(c: Column) -> Column:
    """The script with the most letters, the first listed on ties; null without letters."""
    best = F.greatest(*[script_count(c, s) for s in SCRIPTS])
    out = F.lit(None).cast("string")
    for s in reversed(SCRIPTS):
        out = F.when(script_count(c, s) == best, F.lit(s)).otherwise(out)
    return F.when(best > 0, out)


#: Fixed marker words and letters of the language guess, in the order in which ties are decided.
LANGUAGES = {
    "fr": ([" le ", " la ", " les ", " des ", " est ", " pas ", " avec ", " pour ", " que ", " qui ", " une ", " dans ", " aux ", " sur "], "àâäçéèêëîïôöùûüÿœ«»"),
    "en": ([" the ", " and ", " with ", " that ", " you ", " are ", " for ", " from ", " this ", " have ", " which ", " were ", " will ", " into "], ""),
}


def occurrences(c: Column, part: str) -> Column:
    """How often the part is found, without overlaps."""
    return ((F.length(c) - F.length(F.replace(c, F.lit(part), F.lit("")))) / len(part)).cast("int")


def language_scores(c: Column) -> dict[str, Column]:
    """Per language the marker words as they stand in the lower-case text, and 1.5 for each of its own letters."""
    low = F.lower(F.coalesce(c, F.lit("")))
    score = {}
    for lang, (words, letters) in LANGUAGES.items():
        score[lang] = sum((occurrences(low, w) for w in words), F.lit(0.0))
        if letters:
            score[lang] += 1.5 * F.length(F.regexp_replace(low, f"[^{letters}]", ""))
    return score


def first_highest(scores: dict[str, Column]) -> Column:
    """The name with the highest score, the first listed on ties."""
    best, names = F.greatest(*scores.values()), list(scores)
    out = F.lit(names[0])
    for name in reversed(names):
        out = F.when(scores[name] == best, F.lit(name)).otherwise(out)
    return out


def guess_language(c: Column) -> Column:
    """The language with the highest score, the first listed on ties, so also for blank texts."""
    return first_highest(language_scores(c))

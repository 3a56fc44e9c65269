"""Values as they are shown: calendar dates, currencies, percents, gains, scales, authors, titles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapse_spaces, normalize, strip_accents

#: Fixed month names by language; the first language that knows a name decides.
MONTHS = {
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre".split(),
    "en": "January February March April May June July August September October November December".split(),
}

#: Fixed symbols of currencies and the words that stand for them; longer symbols are looked for first.
CURRENCIES = {
    "$": "usd dollar dollars buck bucks", "€": "eur euro euros", "£": "gbp pound pounds sterling", "¥": "cny jpy yen yens yuan renminbi", "₩": "krw won", "₹": "inr rupee rupees",
    "₽": "rub ruble rubles rouble roubles", "₺": "try lira lire", "R$": "brl real reais", "C$": "cad canadian", "A$": "aud australian", "CHF": "chf franc francs", "kr": "sek nok dkk krona kronor krone kroner",
}


def full_year(year: Column) -> Column:
    """A year of two digits in full: below 30 of this century, else of the last; longer ones as they are."""
    y = year.cast("int")
    return F.when(y < 30, y + 2000).when(y < 100, y + 1900).otherwise(y)


def numeric_date(c: Column, default_year: int) -> Column:
    """Date of ``day/month[/year]`` with ``/``, ``.`` or ``-``; null where there is none or it is no date."""
    plain = F.regexp_replace(F.coalesce(c, F.lit("")), "[.-]", "/")
    part = lambda i: F.regexp_extract(plain, r"([0-9]{1,2})/([0-9]{1,2})(?:/([0-9]{2,4}))?", i)
    year = F.when(part(3) == "", F.lit(default_year)).otherwise(full_year(part(3).try_cast("int")))
    return F.try_to_date(F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(part(2), 2, "0"), F.lpad(part(1), 2, "0")))


def textual_date(c: Column, default_year: int) -> Column:
    """(date, precision, language) of a text with a month name, day before or behind it and year behind it.

    Without a day the precision is ``month`` and the date its first day; null without a month, or with neither.
    """
    low = F.lower(strip_accents(F.coalesce(c, F.lit(""))))
    low = F.regexp_replace(low, r"([0-9]+)\s*(?:er|eme|st|nd|rd|th)\b", "$1")
    names = F.array(*[F.struct(F.lit(_plain(n)).alias("name"), F.lit(f"{i:02d}").alias("month"), F.lit(lang).alias("language")) for lang, all_ in MONTHS.items() for i, n in enumerate(all_, 1)])

    def read(t: Column) -> Column:
        """The first month, in the order of the languages and the year, that has a day or a year beside it."""
        part = lambda before, x, behind: F.call_function("regexp_extract", t, F.concat(F.lit(before), x["name"], F.lit(behind)), F.lit(1))

        def tried(x: Column) -> Column:
            days = (part(r"\b([0-9]{1,2})\b[^0-9]*\b", x, r"\b"), part(r"\b", x, r"\b[^0-9]*\b([0-9]{1,2})\b"))
            day = F.coalesce(*[F.when(d.try_cast("int").between(1, 31), d.try_cast("int")) for d in days])
            y = part(r"\b", x, r"\b(?:[^0-9]+[0-9]{1,2}\b)?[^0-9]+([0-9]{4})\b").try_cast("int")
            date = F.try_to_date(F.concat_ws("-", F.coalesce(y, F.lit(default_year)).cast("string"), x["month"], F.lpad(F.coalesce(day, F.lit(1)).cast("string"), 2, "0")))
            known = F.regexp_like(t, F.concat(F.lit(r"\b"), x["name"], F.lit(r"\b"))) & (day.isNotNull() | y.isNotNull())
            return F.when(known, F.struct(date.alias("date"), F.when(day.isNull(), "month").otherwise("day").alias("precision"), x["language"].alias("language")))

        return F.get(F.array_compact(F.transform(F.filter(names, lambda x: F.contains(t, x["name"])), tried)), F.lit(0))

    return F.get(F.transform(F.array(low), read), F.lit(0))


def _plain(name: str) -> str:
    import unicodedata

    return "".join(c for c in unicodedata.normalize("NFD", name.lower()) if not unicodedata.combining(c))


def display_date(date: Column, precision: Column, language: Column) -> Column:
    """``5 mars 2021`` or ``March 5 2021``, with less where the precision is ``month`` or ``year``."""
    names = {lang: F.array(*map(F.lit, MONTHS[lang])) for lang in MONTHS}
    month = F.when(language == "en", F.element_at(names["en"], F.month(date))).otherwise(F.element_at(names["fr"], F.month(date)))
    day, year = F.dayofmonth(date).cast("string"), F.year(date).cast("string")
    whole = F.when(language == "en", F.concat_ws(" ", month, day, year)).otherwise(F.concat_ws(" ", day, month, year))
    return F.when(precision == "day", whole).when(precision == "month", F.concat_ws(" ", month, year)).otherwise(year)


def currency_symbol(c: Column) -> Column:
    """The symbol in the text, longer ones first, else that of its first currency word; null without."""

    def of_word(w: Column) -> Column:
        out = F.lit(None).cast("string")
        for s, kws in CURRENCIES.items():
            out = F.when(w.isin(*kws.split()), F.lit(s)).otherwise(out)
        return out

    def read(text: Column) -> Column:
        out = F.get(F.array_compact(F.transform(F.split(normalize(text), " "), of_word)), F.lit(0))
        for s in sorted(CURRENCIES, key=len):
            out = F.when(text.rlike(rf"\b{s}\b") if s.isalpha() else text.contains(s), F.lit(s)).otherwise(out)
        return out

    # the text is bound and its words are looked up once, else each symbol would read it anew
    return F.get(F.transform(F.array(F.coalesce(c, F.lit(""))), read), F.lit(0))


def percent_value(c: Column) -> Column:
    """The first percentage of a text, between 0 and 100, a comma taken as the decimal point; null without one."""
    raw = F.regexp_extract(F.coalesce(c, F.lit("")), r"([0-9]+(?:[.,][0-9]+)?) *(?:%|percent|pour *cent)", 1)
    return F.when(raw != "", F.least(F.lit(100.0), F.replace(raw, F.lit(","), F.lit(".")).try_cast("double")))


def percent_display(value: Column) -> Column:
    """Whole percents without decimals, others with one."""
    whole = F.bround(value)
    return F.when(F.abs(value - whole) < 1e-6, F.concat(whole.cast("int").cast("string"), F.lit("%"))).otherwise(F.concat(F.format_number(value, 1), F.lit("%")))


def peak_gain(peak_db: Column, target_db: float = -3.0, floor_db: float = -90.0) -> Column:
    """Multiplier that moves the peak to the target; 1 for silence and unknown peaks."""
    return F.when(peak_db > floor_db, F.pow(F.lit(10.0), (target_db - peak_db) / 20)).otherwise(1.0)


def gain_units(multiplier: Column) -> Column:
    """Hundredths of a decibel of a multiplier; null (muted) for none."""
    return F.when(multiplier > 0, F.bround(2000 * F.log10(multiplier)).cast("int"))


def fill_scale(width: Column, height: Column, frame_width: int, frame_height: int) -> Column:
    """Percent by which a picture fills the frame; 100 where a size isn't positive, the frame's size where null."""
    w, h = F.coalesce(width, F.lit(frame_width)), F.coalesce(height, F.lit(frame_height))
    return F.when((w > 0) & (h > 0), 100 * F.greatest(frame_width / w, frame_height / h)).otherwise(100.0)


def trim_window(length: Column, fps: int, start: Column, end: Column) -> Column:
    """(start, end) inside a medium, at least one frame long and never empty; an unknown length counts as 5."""
    total = F.when(length > 0, length).otherwise(5.0)
    frame = 1.0 / fps
    s0 = F.greatest(F.lit(0.0), F.coalesce(start, F.lit(0.0)))
    s = F.when(s0 >= total, F.greatest(F.lit(0.0), total - frame)).otherwise(s0)
    e0 = F.least(total, F.greatest(s, F.coalesce(end, total)))
    e = F.when(e0 - s < frame, F.least(total, s + frame)).otherwise(e0)
    return F.struct(s.alias("start"), e.alias("end"))


def authors(c: Column) -> Column:
    """Names of an author line: split at commas and ands, without ``by``, staff and newsletter lines left out."""
    parts = F.split(F.coalesce(c, F.lit("")), r"(?i)\s*(?:,|;| and | et |&|\|)\s*")
    clean = F.transform(parts, lambda x: F.trim(F.regexp_replace(collapse_spaces(x), r"(?i)^(?:by|par)\s+", ""), F.lit(" ,;:-|")))
    named = F.transform(clean, lambda x: F.when(F.lower(x).isin("afp", "ap"), F.upper(x)).otherwise(x))
    kept = F.filter(named, lambda x: (x != "") & ~F.lower(x).isin("staff", "editorial staff", "admin", "le monde") & ~F.lower(x).rlike("subscribe|newsletter"))
    return F.array_distinct(kept)


#: Fixed titles and marks of pages that only block.
BLOCK_TITLES = ["client challenge", "just a moment", "attention required", "access denied", "security check"]
BLOCK_MARKS = ["cf-challenge", "cloudflare", "captcha", "client challenge", "enable javascript and cookies", "checking if the site connection is secure"]


def is_block_page(title: Column, html: Column) -> Column:
    """Whether a page is a challenge in place of its content."""
    marks = [F.contains(F.lower(F.coalesce(html, F.lit(""))), F.lit(m)) for m in BLOCK_MARKS]
    out = F.lower(F.trim(F.coalesce(title, F.lit("")))).isin(BLOCK_TITLES)
    for m in marks:
        out |= m
    return out


def best_title(candidates: Column) -> Column:
    """The best of title candidates, in order: a later one wins when it is 20 characters shorter, or more than 12
    where it holds the best so far; of equal canonical titles the first counts."""
    key = lambda x: normalize(x)
    named = F.filter(candidates, lambda x: key(x) != "")
    unique = F.filter(named, lambda x, i: F.array_position(F.transform(named, key), key(x)) == i + 1)

    def better(best: Column, x: Column) -> Column:
        shorter = F.length(best) - F.length(x)
        wins = F.when(F.contains(key(x), key(best)) & (shorter > 12), True).when(F.contains(key(best), key(x)) & (shorter < -12), False).otherwise(shorter >= 20)
        return F.when(wins, x).otherwise(best)

    return F.aggregate(F.slice(unique, 2, F.greatest(F.size(unique) - 1, F.lit(0))), F.get(unique, F.lit(0)), better)


#: Fixed phrases that cut the take before them.
CUT_PHRASES = ["automontage zap", "auto montage zap"]


def says_cut(c: Column) -> Column:
    """Whether a row says the cutting phrase, hyphens and case ignored."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[-\s]+", " "), r"[^\p{L}\p{N}_ ]", ""))
    return plain.contains(CUT_PHRASES[0]) | plain.contains(CUT_PHRASES[1])

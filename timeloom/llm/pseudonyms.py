"""Operator 10, PII: format-preserving Feistel pseudonyms.

Numbers and dates that pass their validation are replaced by a keyed permutation of their own format: a card
number becomes another number with the same first digit and a right check digit, a date another date written
the same way. A Feistel network whose two halves are counted in the radices of the format permutes the value;
where a format holds gaps, the walk goes on until it meets a valid value. Equal values so get equal pseudonyms
in all documents, different values different ones, whatever punctuation they are written with, and the holder
of the key can go back.

Kinds, the earlier one taking an overlap: international telephone numbers (+, country code, 8 to 15 digits),
payment cards (Luhn), IBAN (mod 97), social security numbers (areas in use), IPv4 addresses (octets), calendar
dates of the years 1000 to 2999, national telephone numbers (bracketed area, three-three-four, or a leading
zero with 9 to 12 digits in groups), and the local parts of mail addresses. In a row of digit groups every
place where a group starts and ends is tried, the first start and its longest end winning, so a value beside
other numbers is found. Dates may be written year first, day first, or month first where day first is no date
(between ``- / .``), or with month names in English, French, German and Spanish; a date keeps how many digits
its day and month have, so its width stays whatever its form. Two-digit years are left alone.

The key is a parameter; who holds it can go back, so it belongs into configuration, not into code. The query
takes ``timeloom.pseudonyms.key`` of the session and draws a fresh key for the run where that is unset: equal
values are then linked within the run and nobody can go back.

Defined results: a null text stays null, an empty one empty; values that fail validation are left alone;
repeated rows change alike; other columns are kept by the operator in a struct and ignored by the query.
"""

from __future__ import annotations

import datetime
import hashlib
import re
import secrets
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

ROUNDS = 8
#: Numbers of fewer values than this are turned by a keyed step that is never zero.
SMALL = 100
KEY_SETTING = "timeloom.pseudonyms.key"


# ------------------------------------------------------------------------------------------ permutations
def _draw(key: bytes, tweak: str, step: int, value: int, modulus: int) -> int:
    digest = hashlib.blake2b(f"{tweak}:{step}:{value}".encode(), key=key, digest_size=32).digest()
    return int.from_bytes(digest, "big") % modulus


def feistel(key: bytes, tweak: str, value: int, left: int, right: int, inverse: bool = False) -> int:
    """Keyed permutation of 0 .. left * right - 1; the halves are counted in ``left`` and ``right``."""
    a, b = divmod(value, right)
    for step in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
        sign = -1 if inverse else 1
        if step % 2 == 0:
            a = (a + sign * _draw(key, tweak, step, b, left)) % left
        else:
            b = (b + sign * _draw(key, tweak, step, a, right)) % right
    return a * right + b


def permute_digits(key: bytes, tweak: str, digits: list[int], radices: list[int], inverse: bool = False) -> list[int]:
    """Keyed permutation of the numbers with the given radices, digit by digit in place."""
    half = len(digits) // 2
    sizes = [1, 1]
    value = 0
    for i, (d, r) in enumerate(zip(digits, radices, strict=True)):
        value = value * r + d
        sizes[i >= half] *= r
    n = sizes[0] * sizes[1]
    if 1 < n < SMALL:
        step = 1 + _draw(key, f"{tweak}:{radices}", 0, n, n - 1)
        value = (value + (-step if inverse else step)) % n
    else:
        value = feistel(key, f"{tweak}:{radices}", value, sizes[0], sizes[1], inverse)
    out = []
    for r in reversed(radices):
        value, d = divmod(value, r)
        out.append(d)
    return out[::-1]


def walk(step: Callable[[int], int], value: int, valid: Callable[[int], bool]) -> int:
    """Steps of a permutation from a valid value until the next valid one: a permutation of the valid values."""
    value = step(value)
    while not valid(value):
        value = step(value)
    return value


def _fill(shape: str, digits: list[int]) -> str:
    """The shape with its digits replaced, one after the other."""
    rest = iter(digits)
    return "".join([str(next(rest)) if c.isdigit() else c for c in shape])


# ----------------------------------------------------------------------------------------------- formats
def luhn_check(digits: list[int]) -> int:
    """The check digit that completes the digits."""
    total = sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits)))
    return -total % 10


def _digits(text: str) -> list[int]:
    return [int(c) for c in text if c.isdigit()]


def card(text: str, key: bytes, inverse: bool) -> str | None:
    d = _digits(text)
    if not 13 <= len(d) <= 19 or luhn_check(d[:-1]) != d[-1] or len(set(d)) == 1:
        return None
    inner = permute_digits(key, "card", d[1:-1], [10] * (len(d) - 2), inverse)
    return _fill(text, [d[0], *inner, luhn_check([d[0], *inner])])


def _iban_number(country: str, check: str, rest: str) -> int:
    return int("".join(str(int(c, 36)) for c in rest + country + check))


def iban(text: str, key: bytes, inverse: bool) -> str | None:
    plain = text.replace(" ", "")
    country, check, rest = plain[:2], plain[2:4], plain[4:]
    if not 15 <= len(plain) <= 34 or _iban_number(country, check, rest) % 97 != 1:
        return None
    at = [i for i, c in enumerate(rest) if c.isdigit()]
    if len(at) < 2:
        return None
    new = list(rest)
    for i, d in zip(at, permute_digits(key, f"iban{country}", [int(rest[i]) for i in at], [10] * len(at), inverse), strict=True):
        new[i] = str(d)
    check = f"{98 - _iban_number(country, '00', ''.join(new)) % 97:02d}"
    chars = iter(country + check + "".join(new))
    return "".join([c if c == " " else next(chars) for c in text])


def _ssn_valid(n: int) -> bool:
    area, group, serial = n // 1_000_000, n // 10_000 % 100, n % 10_000
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


def ssn(text: str, key: bytes, inverse: bool) -> str | None:
    n = int("".join(map(str, _digits(text))))
    if not _ssn_valid(n):
        return None
    n = walk(lambda v: feistel(key, "ssn", v, 31_250, 32_000, inverse), n, _ssn_valid)
    return _fill(text, [int(c) for c in f"{n:09d}"])


#: Country codes of one and of two digits; the others have three.
ONE_DIGIT = "1 7".split()
TWO_DIGITS = "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()


def world_phone(text: str, key: bytes, inverse: bool) -> str | None:
    d = _digits(text)
    code = "".join(map(str, d[:2]))
    n = 1 if code[:1] in ONE_DIGIT else 2 if code in TWO_DIGITS else 3
    if not 8 <= len(d) <= 15:
        return None
    return _fill(text, [*d[:n], *permute_digits(key, f"phone{n}", d[n:], [10] * (len(d) - n), inverse)])


def home_phone(text: str, key: bytes, inverse: bool) -> str | None:
    d = _digits(text)
    zeros = next((i for i, x in enumerate(d) if x), len(d))  # trunk zeros stay, and the digit after them is none
    if not 9 <= len(d) <= 12 or zeros == len(d):
        return None
    first, *rest = permute_digits(key, f"phone0{zeros}", [d[zeros] - 1, *d[zeros + 1 :]], [9, *[10] * (len(d) - zeros - 1)], inverse)
    return _fill(text, [*[0] * zeros, first + 1, *rest])


def ip(text: str, key: bytes, inverse: bool) -> str | None:
    parts = text.split(".")
    octets = [int(x) for x in parts]
    if max(octets) > 255 or any(len(x) > 1 and x[0] == "0" for x in parts):
        return None
    return ".".join(map(str, permute_digits(key, "ip", octets, [256] * 4, inverse)))


#: Month names in four languages.
MONTHS = {
    "en": "January February March April May June July August September October November December".split(),
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre".split(),
    "de": "Januar Februar März April Mai Juni Juli August September Oktober November Dezember".split(),
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre".split(),
}
_MONTH = "|".join(sorted({n for names in MONTHS.values() for n in names}, key=len, reverse=True))
#: The first days of the year ranges that are permuted in themselves.
_ERAS = [datetime.date(y, 1, 1).toordinal() for y in (1000, 1900, 2100, 3000)]
_NUMBERS = re.compile("[0-9]+")


def other_day(day: datetime.date, key: bytes, inverse: bool = False) -> datetime.date | None:
    """Another day of the same range of years whose day and month have as many digits; a day above 12 stays above, so
    that the order of day and month is read alike."""
    n = day.toordinal()
    era = next((i for i, (a, b) in enumerate(zip(_ERAS, _ERAS[1:], strict=False)) if a <= n < b), None)
    if era is None:
        return None
    first, days = _ERAS[era], _ERAS[era + 1] - _ERAS[era]
    half = int(days**0.5) + 1

    def like(v: int) -> bool:
        if v >= days:
            return False
        d = datetime.date.fromordinal(first + v)
        return (d.day > 9, d.day > 12, d.month > 9) == (day.day > 9, day.day > 12, day.month > 9)

    return datetime.date.fromordinal(first + walk(lambda v: feistel(key, f"date{era}", v, half, half, inverse), n - first, like))


def date(text: str, key: bytes, inverse: bool) -> str | None:
    numbers = _NUMBERS.findall(text)
    name = re.search(_MONTH, text, re.IGNORECASE)
    if name:
        languages = [k for k, names in MONTHS.items() if name[0].lower() in map(str.lower, names)]
        month = [x.lower() for x in MONTHS[languages[0]]].index(name[0].lower()) + 1
        orders = [(numbers[1], month, numbers[0])]
    elif len(numbers[0]) == 4:
        orders = [tuple(numbers)]
    else:
        orders = [(numbers[2], numbers[1], numbers[0]), (numbers[2], numbers[0], numbers[1])]
    for at, (y, m, d) in enumerate(orders):
        try:
            new = other_day(datetime.date(int(y), int(m), int(d)), key, inverse)
        except ValueError:
            continue
        if new is None:
            return None
        if name:
            named = MONTHS[languages[0]][new.month - 1]
            named = named.upper() if name[0].isupper() else named.lower() if name[0].islower() else named.capitalize()
            values = [new.day, new.year]
            before, after = (_NUMBERS.sub(lambda _: str(values.pop(0)), part) for part in (text[: name.start()], text[name.end() :]))
            return before + named + after
        values = [new.year, new.month, new.day] if len(numbers[0]) == 4 else [new.month, new.day, new.year] if at else [new.day, new.month, new.year]
        widths = [len(x) for x in numbers]
        return _NUMBERS.sub(lambda _: f"{values.pop(0):0{widths.pop(0)}d}", text)
    return None


def mail(text: str, key: bytes, inverse: bool) -> str | None:
    local, domain = text.rsplit("@", 1)
    sets = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    at = [(i, s) for i, c in enumerate(local) for s in sets if c in s]
    if not at:
        return None
    new = list(local)
    moved = permute_digits(key, f"mail{domain.lower()}", [s.index(local[i]) for i, s in at], [len(s) for _, s in at], inverse)
    for (i, s), d in zip(at, moved, strict=True):
        new[i] = s[d]
    return "".join(new) + "@" + domain


_LEFT, _RIGHT = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
_DAY = r"[0-9]{1,2}(?:st|nd|rd|th|er|\.)?"
#: Kind, pattern, change, and digits up to which parts of a row of digit groups are tried (0: the match as it is).
FINDERS: list[tuple[str, re.Pattern, Callable, int]] = [
    ("phone", re.compile(r"(?<![0-9A-Za-z+])\+[0-9]{1,3}(?:[ .-]?\([0-9]{1,4}\))?(?:[ .-]?[0-9]{1,14})+" + _RIGHT), world_phone, 15),
    ("card", re.compile(_LEFT + r"(?<!\+)[0-9]+(?:[ -][0-9]+)*" + _RIGHT), card, 19),
    ("iban", re.compile(_LEFT + r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _RIGHT), iban, 0),
    ("ssn", re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"), ssn, 0),
    ("ip", re.compile(r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9A-Za-z])"), ip, 0),
    ("date", re.compile(
        _LEFT + r"(?:[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4}"
        rf"|{_DAY}(?: de)? (?i:{_MONTH})(?: de|,)? [0-9]{{4}}|(?i:{_MONTH}) {_DAY},? [0-9]{{4}})" + _RIGHT), date, 0),
    ("phone", re.compile(r"(?<![0-9A-Za-z+])(?:\([0-9]{2,5}\)[ .-]?[0-9]{2,8}(?:[ .-][0-9]{2,8}){0,3}|[0-9]{3}([ .-])[0-9]{3}\1[0-9]{4}|0[1-9][0-9]{0,3}(?:[ .-][0-9]{2,8}){1,4})" + _RIGHT), home_phone, 0),
    ("mail", re.compile(r"(?<![0-9A-Za-z._%+-])[0-9A-Za-z._%+-]{1,64}@(?:[0-9A-Za-z-]+\.)+[A-Za-z]{2,}"), mail, 0),
]
_ANY_DIGIT = re.compile("[0-9]")


def _parts(text: str, start: int, least: int, most: int, first_only: bool = False) -> Iterator[tuple[int, int]]:
    """(start, end) of the runs of whole digit groups of ``least`` to ``most`` digits, first starts and longest ends
    first. Unless ``first_only``, just those with a valid check digit: sums of the digits, each second one doubled,
    are kept for both parities, so a run is tried by one difference."""
    groups = [(m.start() + start, m.end() + start) for m in _NUMBERS.finditer(text)]
    upto, sums = [0], ([0], [0])
    for a, b in groups:
        for c in text[a - start : b - start]:
            d, odd = int(c), len(sums[0]) % 2
            doubled = d * 2 - 9 * (d > 4)
            sums[odd].append(sums[odd][-1] + d)
            sums[1 - odd].append(sums[1 - odd][-1] + doubled)
        upto.append(upto[-1] + b - a)
    for i, (s, _) in enumerate(groups[:1] if first_only else groups):
        ends = []
        for j in range(i, len(groups)):
            digits = upto[j + 1] - upto[i]
            if digits > most:
                break
            held = sums[upto[j + 1] % 2]  # the last digit counts once
            if digits >= least and (first_only or (held[upto[j + 1]] - held[upto[i]]) % 10 == 0):
                ends.append(groups[j][1])
        yield from ((s, e) for e in reversed(ends))


def pseudonymise(text: str, key: bytes, inverse: bool = False) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with its validated values replaced, and (start, end, kind) of each in the text given."""
    found: list[tuple[int, int, str, str]] = []
    digits, mails = _ANY_DIGIT.search(text), "@" in text
    if not (digits or mails):
        return text, []
    taken = bytearray(len(text))

    def take(s: int, e: int, kind: str, change: Callable) -> bool:
        if taken.find(1, s, e) >= 0 or (new := change(text[s:e], key, inverse)) is None:
            return False
        taken[s:e] = b"\1" * (e - s)
        found.append((s, e, kind, new))
        return True

    for kind, pattern, change, most in FINDERS:
        if not (mails if kind == "mail" else digits):
            continue
        for m in pattern.finditer(text):
            s, e = m.span()
            if not most:
                take(s, e, kind, change)
            elif m[0][0] == "+":  # such a number starts at its mark
                any(take(s, end, kind, change) for _, end in _parts(m[0], s, 8, most, first_only=True))
            else:
                reached = s
                for start, end in _parts(m[0], s, 13, most):
                    if start >= reached and take(start, end, kind, change):
                        reached = end
    if not found:
        return text, []
    found.sort()
    parts, at = [], 0
    for s, e, _, new in found:
        parts += [text[at:s], new]
        at = e
    return "".join([*parts, text[at:]]), [f[:3] for f in found]


_OUT = {"text": T.StringType(), "n_values": T.LongType(), "spans": T.StringType()}


def pseudonymised(docs: DataFrame, key: bytes, keep: list[str] | None = None) -> DataFrame:
    """``row`` (kept columns as a struct), the new text, the number of values and kind:start:end of each."""
    rows = docs.select(F.struct(*(["doc_id"] if keep is None else keep)).alias("row"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, spans = [], [], []
            for value in batch.column(1):
                text = value.as_py()
                new, found = (None, []) if text is None else pseudonymise(text, key)
                texts.append(new)
                counts.append(len(found))
                spans.append(",".join(f"{k}:{s}:{e}" for s, e, k in found))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(spans, pa.string())], names=["row", *_OUT])

    return rows.mapInArrow(run, T.StructType([rows.schema["row"], *(T.StructField(n, t) for n, t in _OUT.items())]))


def op10_feistel_pseudonyms(spark, sf_dir: str) -> DataFrame:
    """Every document with its validated numbers, dates and mail names replaced."""
    key = spark.conf.get(KEY_SETTING, None)
    key = key.encode() if key else secrets.token_bytes(32)
    return pseudonymised(table(spark, sf_dir, "documents"), key).select("row.doc_id", *_OUT)

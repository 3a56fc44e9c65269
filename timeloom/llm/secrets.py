"""Operator 7, secret scans: fixed patterns plus dictionary-primed zstandard novelty.

Base spans come from three patterns. Beyond them, every run of key-like characters that stands near a
sensitive word is a candidate. Its marginal cost is measured as the bytes that zstandard needs for it with a
raw dictionary made of common identifiers and of the text around it: names, words and repeated strings
compress well against that dictionary, random keys do not. Candidates that cost nearly as much as a random
order of their own characters are reported as kind ``novel``, whatever their length and alphabet. A sensitive
word also counts for the key lines that follow one another below it.

Defined results: null counts as the empty text; base spans are never changed; a candidate that overlaps a
base span is not reported again; repeated rows are scanned alike; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

KINDS = ("assign", "access", "hex", "novel")
_WORD = {w: "".join(f"[{c}{c.upper()}]" for c in w) for w in ("password", "passwd", "secret", "token", "api", "key", "credential", "private", "auth", "bearer")}
ASSIGN = re.compile(
    f"({_WORD['password']}|{_WORD['passwd']}|{_WORD['secret']}|{_WORD['token']}|{_WORD['api']}_?{_WORD['key']})"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so this equals dropping shorter runs
_NEEDLES = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Candidates: runs of key characters of this length at least, holding a letter.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Sensitive words, and the characters around a candidate in which one must stand.
SENSITIVE = re.compile("|".join(_WORD.values()))
CONTEXT, AROUND = 48, 256
#: Share of the cost of its characters in random order from which a candidate counts as incompressible. A short
#: random key is stored as literals, a byte each; a longer one or one of few symbols is coded in less, and so is
#: its random order. Strings made of known parts cost far less than theirs.
NOVELTY = 0.9
#: Short words outside the dictionary are literals too. A string counts as words when this share of its letter pairs
#: is known from the identifiers and the text around, or, if it is made of parts, when PART_LETTERS of its letters
#: stand in parts of PART or more whose pairs are known to the share KNOWN_IN_PARTS and letters and digits take turns
#: TURNS times at most. Parts end at signs, digits and capitals behind small letters; random strings fall into parts
#: too short to count, or change between letters and digits too often.
KNOWN_PAIRS, PART, PART_LETTERS, KNOWN_IN_PARTS, TURNS = 0.75, 4, 0.75, 0.5, 4
_PART, _RUN = re.compile("[A-Z]?[a-z]+|[A-Z]+"), re.compile("[A-Za-z]+|[0-9]+")
#: White space between lines of one key.
LINE_BREAK = re.compile(r"[ \t]*\r?\n[ \t]*")
#: Identifier dictionary of the compressor: common names of code and configuration, separated by spaces.
IDENTIFIERS = (
    "abstract access_token address api_key apiVersion application argument array assert async attribute authorization await "
    "authentication background base64 boolean bootstrap break buffer callback catch certificate char class client_id client_secret client component "
    "config configuration connection const constructor container content-type continue controller copyright count create credential "
    "database datetime debug default delete description development dictionary directory document double element else enable encoding "
    "endpoint environment error example exception execute export extends false field file final finally float for format from function "
    "generate get getElementById global handler hash header height hostname http https identifier if implements import include index "
    "initialize input instance int integer interface iterator javascript json key keyword lambda language length library list localhost "
    "logger long main manager map master message metadata method middleware model module namespace native new node null number object "
    "operation option organization output override package parameter parent parse password path pattern payload permission port prefix "
    "primary private process production project property protected protocol provider public python query queue random read readonly "
    "record reference register release repository request require resource response result return role route runtime schema script "
    "secret secret_key select self sequence server service session set setting short signature size source standard start state static "
    "status storage stream string struct subject submit super switch synchronized system table target task template test this thread "
    "throw timeout timestamp token transaction transform transient true try type undefined unique update upload url user username uuid "
    "validate value var variable vector version virtual void volatile while width window workflow workspace write xmlns yaml yield "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0000000000000000 xxxxxxxxxxxxxxxx ----------------"
).encode()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the three patterns, in order."""
    out = []
    low = text.lower()
    if any(n in low for n in _NEEDLES):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def marginal_bytes(candidate: bytes, around: bytes) -> int:
    """Bytes that the candidate adds when its surroundings and the identifiers are known."""
    import zstandard

    primed = zstandard.ZstdCompressionDict(IDENTIFIERS + b" " + around, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    params = zstandard.ZstdCompressionParameters.from_level(19, min_match=3, write_content_size=False, write_checksum=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
    coder = zstandard.ZstdCompressor(dict_data=primed, compression_params=params)
    return max(0, len(coder.compress(candidate)) - len(coder.compress(b"")))


def _letter_pairs(text: str) -> list[str]:
    return re.findall("(?=([a-z]{2}))", text.lower())


_PAIRS = frozenset(_letter_pairs(IDENTIFIERS.decode().replace("abcdefghijklmnopqrstuvwxyz", "")))


def _is_words(value: str, around: str) -> bool:
    known = _PAIRS.union(_letter_pairs(around))
    share = lambda x: sum(p in known for p in _letter_pairs(x)) / max(len(x) - 1, 1)
    parts = _PART.findall(value)
    if len(parts) == 1 and len(re.findall("[0-9]", value)) < 2:
        return share(parts[0]) >= KNOWN_PAIRS
    if len(_RUN.findall(re.sub("[^0-9A-Za-z]", "", value))) > TURNS + 1:
        return False
    words = sum(len(x) for x in parts if len(x) >= PART and share(x) >= KNOWN_IN_PARTS)
    return words >= PART_LETTERS * sum(map(len, parts))


def incompressible(value: str, around: str) -> bool:
    """Whether the value costs about as much as its characters in random order."""
    primer = around.encode()
    cost = marginal_bytes(value.encode(), primer)
    if cost >= NOVELTY * len(value):
        return True
    shuffled = list(value)
    random.Random(value).shuffle(shuffled)
    return cost >= NOVELTY * marginal_bytes("".join(shuffled).encode(), primer)


def novel_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates in a sensitive context that are incompressible."""
    out, at = [], 0
    block, sensitive = -1, False  # end of the candidate before, and whether a sensitive word stands at it or at a line above
    for m in CANDIDATE.finditer(text):
        s, e = m.span()
        sensitive = sensitive and LINE_BREAK.fullmatch(text, block, s) is not None
        sensitive = sensitive or SENSITIVE.search(text, max(0, s - CONTEXT), min(len(text), e + CONTEXT)) is not None
        block = e
        while at < len(base) and max(x[2] for x in base[at : at + 1]) <= s:
            at += 1
        if not sensitive or any(b[0] < e and b[2] > s for b in base[at : at + 8]):
            continue
        value, around = m[0], text[max(0, s - AROUND) : s] + " " + text[e : e + AROUND]
        if not re.search("[A-Za-z]", value) or _is_words(value, around):
            continue
        if incompressible(value, around):
            out.append((s, 3, e))
    return out


def _line(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


_OUT = {"n_assign": T.LongType(), "n_access": T.LongType(), "n_hex": T.LongType(), "base_sha256": T.StringType(), "spans": T.StringType()}


def scan_secrets(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``row`` (kept columns as a struct), counts of base spans, their digest, and all spans."""
    rows = docs.select(F.struct(*(["doc_id"] if keep is None else keep)).alias("row"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column(1):
                text = value.as_py() or ""
                base = base_spans(text)
                spans = sorted(base + novel_spans(text, base))
                counts = [sum(k == i for _, k, _ in base) for i in range(3)]
                out.append((*counts, hashlib.sha256(_line(base).encode()).hexdigest(), _line(spans)))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=["row", *_OUT])

    return rows.mapInArrow(run, T.StructType([rows.schema["row"], *(T.StructField(n, t) for n, t in _OUT.items())]))


def op7_secret_novelty(spark, sf_dir: str) -> DataFrame:
    """Contract query: base and novel secrets of every document."""
    return scan_secrets(table(spark, sf_dir, "documents")).select("row.*", *_OUT)

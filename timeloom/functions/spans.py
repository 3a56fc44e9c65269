"""Script text cut into spans with their places, and repair of damaged JSON texts."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timeloom.operators.align import canonical

#: Fixed marks and words at which script text is cut, and from how many tokens on.
STRONG, SOFT, SOFT_TOKENS = ".?!:;", ",…", 8
CONNECTORS, CONNECTOR_TOKENS, SIDE_TOKENS = re.compile(r"\b(?:and|but|or|so|because|then|et|mais|ou|donc|car|puis|alors|avec|pour|vers)\b", re.IGNORECASE), 14, 6

Span = tuple[str, int, int]


def _count(text: str) -> int:
    return len(canonical(text).split())


def _trimmed(block: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """The stretch without white space at its ends, if anything is left."""
    part = block[start:end]
    if part.strip():
        yield start + len(part) - len(part.lstrip()), end - len(part) + len(part.rstrip())


def _at_marks(block: str, start: int, end: int, marks: str) -> Iterator[tuple[int, int]]:
    at = start
    for i in range(start, end):
        if block[i] in marks:
            yield from _trimmed(block, at, i + 1)
            at = i + 1
    yield from _trimmed(block, at, end)


def _at_connectors(block: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    at = start
    if _count(block[start:end]) >= CONNECTOR_TOKENS:
        for m in CONNECTORS.finditer(block, start, end):
            if _count(block[at : m.start()]) >= SIDE_TOKENS and _count(block[m.start() : end]) >= SIDE_TOKENS:
                yield from _trimmed(block, at, m.start())
                at = m.start()
    yield from _trimmed(block, at, end)


def spans_of(block: str) -> list[Span]:
    """(text, start, end): cut at strong marks, at soft ones where 8 tokens or more are left, and before connectors
    where 14 or more are left and both sides have 6. Texts have single spaces; places are those in the block."""
    out = []
    for s, e in _at_marks(block, 0, len(block), STRONG):
        for s2, e2 in _at_marks(block, s, e, SOFT) if _count(block[s:e]) >= SOFT_TOKENS else [(s, e)]:
            out += [(" ".join(block[a:b].split()), a, b) for a, b in _at_connectors(block, s2, e2)]
    return out


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("text", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))
def script_spans(block: pd.Series) -> pd.Series:
    """Array of the spans of a text block; none of null."""
    return pd.Series([[dict(zip(("text", "start", "end"), s, strict=True)) for s in spans_of(b or "")] for b in block])


# -------------------------------------------------------------------------------------------------- JSON
_STRING = re.compile(r'"(?:[^"\\]|\\.)*(?:"|\Z)', re.DOTALL)


def _strings_apart(text: str) -> list[str]:
    """Alternating stretches outside and inside quotes."""
    out, at = [], 0
    for m in _STRING.finditer(text):
        out += [text[at : m.start()], m[0]]
        at = m.end()
    return [*out, text[at:]]


def _closed(text: str) -> str:
    """The text with the brackets that are still open closed."""
    missing: list[str] = []
    for part in _strings_apart(text)[::2]:
        for c in part:
            if c in "{[":
                missing.append("}" if c == "{" else "]")
            elif c in "}]" and missing:
                missing.pop()
    return text + "".join(reversed(missing))


def repaired_json(raw: str | None) -> str | None:
    """The JSON text in an answer: fences and prose around it go, commas before closing brackets too; then, one
    remedy at a time, missing commas between objects, line ends inside strings, and brackets left open are mended.
    Null where nothing helps."""
    text = "\n".join(x for x in (raw or "").splitlines() if not x.startswith("```"))
    first, last = text.find("{"), text.rfind("}")
    if 0 <= first <= last:
        text = text[first : last + 1]
    text = re.sub(r",\n([}\]])", r"\n\1", text)
    joined = "".join(x if i % 2 == 0 else x.replace("\n", "\\n").replace("\r", "\\r") for i, x in enumerate(_strings_apart(text)))
    for candidate in (text, re.sub(r"}(\s+){", r"},\1{", text), joined, _closed(text)):
        try:
            json.loads(candidate)
        except ValueError:
            continue
        return candidate
    return None


@F.pandas_udf(T.StringType())
def repair_json(raw: pd.Series) -> pd.Series:
    return raw.map(repaired_json)

"""Operator 13, fill-in-middle transformation with a sparse checkpoint index.

While the units of a text (code points, or matches of a pattern) are counted, the byte and the code-point offset
of every EVERY-th unit are recorded. A cut at any unit, byte or code point searches these checkpoints by bisection
and rescans fewer than EVERY units from the one at or before it, so the text is never turned into a list of units
and a cut costs the same in a short and in a very long text.

Defined results: a null text is the empty text and stays plain; a null id draws as the empty string; repeated ids
draw alike; an empty table gives no rows. Texts that hold one of the marks stay plain, as they couldn't be rebuilt.
Other columns are ignored by the query and kept by the operator in a struct.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table, text_groups

#: Units from one checkpoint to the next, bytes that are counted at a time, characters of the outputs held together.
EVERY, BLOCK, GROUP_CHARS = 1024, 1 << 20, 4_000_000
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 documents, those that are transformed, and of 100 of these, those whose suffix comes first.
TRANSFORMED, SUFFIX_FIRST = 90, 20


class Checkpoints:
    """Sparse index of a text's units: ``units[k]`` starts at byte ``bytes_at[k]`` and code point ``chars_at[k]``."""

    def __init__(self, text: str, every: int = EVERY, unit: str | None = None):
        self.data, self.every, self.unit = text.encode(), every, regex.compile(unit) if unit else None
        self.text = text if unit else None
        self.bytes_at, self.chars_at = [0], [0]
        self.n = self._count_matches(text) if unit else self._count_code_points()
        self.units = range(0, len(self.bytes_at) * every, every)

    def _count_code_points(self) -> int:
        data, n = np.frombuffer(self.data, np.uint8), 0
        for at in range(0, len(data), BLOCK):
            starts = np.flatnonzero((data[at : at + BLOCK] & 0xC0) != 0x80)
            for i in range(-n % self.every, len(starts), self.every):
                if n + i:
                    self.bytes_at.append(at + int(starts[i]))
                    self.chars_at.append(n + i)
            n += len(starts)
        return n

    def _count_matches(self, text: str) -> int:
        n, byte, char = 0, 0, 0
        for n, m in enumerate(self.unit.finditer(text), 1):  # noqa: B007
            if (n - 1) % self.every == 0:
                byte, char = byte + len(text[char : m.start()].encode()), m.start()
                if n == 1:
                    self.bytes_at[0], self.chars_at[0] = byte, char
                else:
                    self.bytes_at.append(byte)
                    self.chars_at.append(char)
        return n

    def cut(self, unit: int) -> tuple[int, int]:
        """Byte and code-point offset at which a unit starts; those of the text's end behind the last one."""
        if not 0 <= unit <= self.n:
            raise IndexError(unit)
        k = bisect_right(self.units, unit) - 1
        if k < 0 or unit == self.n and self.unit:
            return len(self.data), len(self.text or "")
        byte, char, ahead = self.bytes_at[k], self.chars_at[k], unit - self.units[k]
        if self.unit is None:
            window = np.frombuffer(self.data, np.uint8, min(4 * (ahead + 1), len(self.data) - byte), byte)
            starts = np.flatnonzero((window & 0xC0) != 0x80)
            return (byte + int(starts[ahead]) if ahead < len(starts) else len(self.data)), char + ahead
        for i, m in enumerate(self.unit.finditer(self.text, char)):
            if i == ahead:
                return byte + len(self.text[char : m.start()].encode()), m.start()
        raise IndexError(unit)

    def unit_at(self, offset: int, axis: str = "byte") -> int:
        """Units that start before a byte or code-point offset: the largest cut that doesn't pass it is this one or less."""
        places = self.bytes_at if axis == "byte" else self.chars_at
        k = max(bisect_right(places, offset) - 1, 0)
        low, high = self.units[k], min(self.units[k] + self.every, self.n)
        side = 0 if axis == "byte" else 1
        while low < high:  # a few cuts between two checkpoints
            mid = (low + high) // 2
            low, high = (mid + 1, high) if self.cut(mid)[side] < offset else (low, mid)
        return low


def draws(key: str, seed: str) -> list[int]:
    """Four numbers of 32 bits from a seed and a key."""
    digits = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return [int(digits[i : i + 8], 16) for i in (0, 8, 16, 24)]


def transformed(text: str, key: str, seed: str = "1", every: int = EVERY, unit: str | None = None, rate: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    index = Checkpoints(text, every, unit)
    h1, h2, h3, h4 = draws(key, seed)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= rate:
        return index.n, "plain", None, None, text
    low, high = sorted((h1 % (index.n + 1), h2 % (index.n + 1)))
    (a, chars_a), (b, chars_b) = index.cut(low), index.cut(high)
    prefix, middle, suffix = (x.decode() for x in (index.data[:a], index.data[a:b], index.data[b:]))
    if h4 % 100 < suffix_first:
        form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return index.n, form, chars_a, chars_b - chars_a, output


def restored(output: Column, form: Column) -> Column:
    """The exact text rebuilt from an output and its form."""

    def between(start: str, end: str | None) -> Column:
        tail = F.split_part(output, F.lit(start), F.lit(2))
        return F.split_part(tail, F.lit(end), F.lit(1)) if end else tail

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


_OUT = {"n": T.LongType(), "form": T.StringType(), "prefix_chars": T.LongType(), "middle_chars": T.LongType(), "output": T.StringType()}


def fill_in_middle(docs: DataFrame, key: str = "doc_id", keep: list[str] | None = None, **parameters) -> DataFrame:
    """``row`` (kept columns as a struct), n units, form, prefix_chars, middle_chars and the output text.

    ``parameters``: seed, every, unit (a pattern; code points without), rate and suffix_first of ``transformed``.
    """
    rows = docs.select(F.struct(*([key] if keep is None else keep)).alias("row"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in text_groups(batch.column(2), GROUP_CHARS):
                keys = batch.column(1).slice(at, len(texts)).to_pylist()
                out = zip(*(transformed(t, k, **parameters) for t, k in zip(texts, keys, strict=True)), strict=True)
                columns = [pa.array(list(c), t) for c, t in zip(out, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), *columns], names=["row", *_OUT])
                at += len(texts)

    return rows.mapInArrow(run, T.StructType([rows.schema["row"], *(T.StructField(n, t) for n, t in _OUT.items())]))


def op13_checkpoint_middle(spark, sf_dir: str) -> DataFrame:
    """Contract query: every document's form, cuts, and digests of its output and of the text rebuilt from it."""
    out = fill_in_middle(table(spark, sf_dir, "documents"))
    return out.select("row.doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


OP13_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
h AS (SELECT *, ('0x' || x[1:8])::BIGINT % (n + 1) AS h1, ('0x' || x[9:16])::BIGINT % (n + 1) AS h2, ('0x' || x[17:24])::BIGINT % 100 AS h3, ('0x' || x[25:32])::BIGINT % 100 AS h4 FROM d),
f AS (SELECT doc_id, t, n, least(h1, h2) AS a, greatest(h1, h2) AS b, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain' WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substring(t, 1, a) AS prefix, substring(t, a + 1, b - a) AS middle, substring(t, b + 1) AS suffix FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""

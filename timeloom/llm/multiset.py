"""Operator 12, document fingerprints by a homomorphic multiset hash of paragraphs.

A paragraph (a stretch between line feeds, empty ones included) is hashed to a wide vector, and a document's
fingerprint is the sum of its paragraphs' vectors, lane by lane modulo a power of two. Order doesn't matter,
equal paragraphs count as often as they occur, and a paragraph is inserted or deleted by adding or subtracting its
vector alone. The vector has two parts:

* EXACT lanes modulo 2^64, from a 512-bit hash of the paragraph: two multisets of paragraphs are equal if and only
  if these agree (but for a chance of about 2^-512);
* LANES lanes modulo 2^16, each the signed count of the paragraph's GRAM-character stretches that fall into it.
  The cosine of two such vectors estimates the cosine of the two multisets of stretches, whatever the lengths of
  the texts, with a standard error of LANES^-1/2 (0.04). That is the likeness.

Paragraphs shorter than 2 GRAM take stretches of half the length, and those shorter than that are one stretch. A lane wraps when a stretch occurs over 32,767 times more often than
others of its lane; equality holds then too, likeness may be off.

Defined results: a null text is the empty text. Likeness is 1 for equal fingerprints; unequal ones without any
character in common, and those of a text without characters, have 0 but for the error above. The order of the next
document puts null ids first and repeated ids by a hash of their text; equal rows follow one another. A single
document is its own next one; an empty table gives no rows. Other columns are ignored by the query and kept by the
operator in a struct.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

LANES, EXACT, GRAM = 512, 8, 16
#: Code points hashed, and paragraphs summed, at a time.
CHUNK = 1 << 20
#: Bytes of text in a block of neighbours, the largest number of blocks (larger tables get larger blocks), and keys
#: drawn for each block's boundary.
BLOCK_BYTES, MOST_BLOCKS, SAMPLES = 4 << 20, 1 << 16, 8
OUTPUT_ROWS = 1000

_BASE, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)


class Fingerprint:
    """A sum of paragraph vectors; supports ``+``, ``-`` and equality."""

    __slots__ = ("exact", "lanes")

    def __init__(self, exact: np.ndarray | None = None, lanes: np.ndarray | None = None):
        self.exact = np.zeros(EXACT, np.uint64) if exact is None else exact
        self.lanes = np.zeros(LANES, np.uint16) if lanes is None else lanes

    @classmethod
    def of(cls, text: str) -> Fingerprint:
        out, paragraphs = cls(), text.split("\n")
        for at in range(0, len(paragraphs), CHUNK):
            digests = b"".join([hashlib.blake2b(p.encode()).digest() for p in paragraphs[at : at + CHUNK]])
            out.exact += np.frombuffer(digests, "<u8").reshape(-1, EXACT).sum(axis=0, dtype=np.uint64)
        out.lanes += _lanes(text)
        return out

    @classmethod
    def read(cls, written: str) -> Fingerprint:
        exact, lanes = bytes.fromhex(written[: 16 * EXACT]), bytes.fromhex(written[16 * EXACT :])
        return cls(np.frombuffer(exact, ">u8").astype(np.uint64), np.frombuffer(lanes, ">u2").astype(np.uint16))

    def __str__(self) -> str:
        return self.exact.astype(">u8").tobytes().hex() + self.lanes.astype(">u2").tobytes().hex()

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.exact + other.exact, self.lanes + other.lanes)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.exact - other.exact, self.lanes - other.lanes)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Fingerprint) and np.array_equal(self.exact, other.exact) and np.array_equal(self.lanes, other.lanes)

    __hash__ = None

    def likeness(self, other: Fingerprint) -> float:
        """Cosine of the signed lanes, not below 0; 1 if equal."""
        if self == other:
            return 1.0
        a, b = (x.lanes.view(np.int16).astype(np.float64) for x in (self, other))
        size = float(a @ a) * float(b @ b)
        return min(max(float(a @ b) / size**0.5, 0.0), 1.0) if size else 0.0

    def edited(self, text: str, keep: int, more: str) -> Fingerprint:
        """This fingerprint of ``text`` once all behind its first ``keep`` code points is replaced by ``more``: the
        paragraphs from the cut on are deleted, the new ones inserted."""
        start = text.rfind("\n", 0, keep) + 1
        return self - Fingerprint.of(text[start:]) + Fingerprint.of(text[start:keep] + more)


def _lanes(text: str) -> np.ndarray:
    """Signed counts of the stretches of GRAM characters inside paragraphs, by lane."""
    letters = np.frombuffer(text.encode("utf-32-le"), "<u4") if text else np.zeros(0, np.uint32)
    breaks = letters == 10
    paragraph = np.cumsum(breaks, dtype=np.int64)[~breaks]
    letters = letters[~breaks]
    n, out = len(letters), np.zeros(2 * LANES, np.int64)
    sizes = np.bincount(paragraph) if n else paragraph
    for at in range(0, n, CHUNK):
        end = min(at + CHUNK, n)
        own = paragraph[at : end + GRAM - 1]
        h, width = letters[at : end + GRAM - 1].astype(np.uint64) + np.uint64(1), 1
        short, starts = (sizes < 2 * GRAM)[own], np.ones(len(own), bool)
        starts[1:] = own[1:] != own[:-1]
        starts[0] = at == 0 or own[0] != paragraph[at - 1]
        while width < GRAM:  # a stretch of twice the width from two neighbours
            wider = h * np.uint64(pow(_BASE, width, 1 << 64))
            wider[:-width] += h[width:] * (own[width:] == own[:-width])
            h, width = (np.where(short, h, wider) if width == GRAM // 2 else wider), 2 * width
        whole = np.zeros(len(own), bool)
        for reach, here in ((GRAM // 2 - 1, short), (GRAM - 1, ~short)):  # all stretches that end in the paragraph
            if len(own) > reach:
                whole[: len(own) - reach] |= here[: len(own) - reach] & (own[reach:] == own[: len(own) - reach])
        h = h[: end - at][(whole | starts)[: end - at]]
        h = (h ^ (h >> np.uint64(32))) * _MIX
        out += np.bincount((h >> np.uint64(64 - (2 * LANES - 1).bit_length())).astype(np.int64), minlength=2 * LANES)
    return (out[:LANES] - out[LANES:]).astype(np.uint16)


# ------------------------------------------------------------------------------------------------- documents
def fingerprint_documents(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``row`` (kept columns as a struct) and ``fingerprint``; equal paragraph multisets have equal ones."""
    rows = docs.select(F.struct(*(["doc_id"] if keep is None else keep)).alias("row"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [str(Fingerprint.of(t.as_py() or "")) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.string())], names=["row", "fingerprint"])

    return rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("fingerprint", T.StringType())]))


def update_fingerprints(fingerprints: DataFrame, changes: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, fingerprint) after paragraphs were inserted or deleted, without reading the texts.

    ``changes`` has (key, paragraph, times): how often a paragraph comes in, or goes if negative. Vectors are summed
    in each partition before they travel, so a key with a third of all changes sends one vector per partition.
    A key without a fingerprint starts from no paragraph at all; null keys are a key of their own.
    """
    schema = T.StructType([fingerprints.schema[key], T.StructField("fingerprint", T.StringType())])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums neighbours with an equal key; a paragraph or a written fingerprint is a summand."""
        key_type, at, total, open_ = None, None, None, False

        def out():
            return pa.RecordBatch.from_arrays([pa.array([at], key_type), pa.array([str(total)])], names=[key, "fingerprint"])

        for batch in batches:
            key_type = batch.column(0).type
            for k, written, paragraph, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not open_ or k != at:
                    if open_:
                        yield out()
                    at, total, open_ = k, Fingerprint(), True
                if written is not None:
                    total = total + Fingerprint.read(written)
                elif times:
                    one, n = Fingerprint.of(paragraph or ""), int(times)
                    total = total + Fingerprint(one.exact * np.uint64(n % (1 << 64)), one.lanes * np.uint16(n % (1 << 16)))
        if open_:
            yield out()

    nothing = [F.lit(None).cast("string").alias("paragraph"), F.lit(0).cast("long").alias("times")]
    partial = changes.select(F.col(key), F.lit(None).cast("string").alias("fingerprint"), F.col("paragraph").cast("string").alias("paragraph"), F.col("times").cast("long").alias("times"))
    partial = partial.sortWithinPartitions(key).mapInArrow(summed, schema)
    both = partial.unionByName(fingerprints.select(key, "fingerprint")).select(key, "fingerprint", *nothing)
    return both.repartition(key).sortWithinPartitions(key).mapInArrow(summed, schema)


# -------------------------------------------------------------------------------------------------- neighbours
def _order(values: tuple) -> tuple:
    """A sort key with nulls first."""
    return tuple((x is not None, x) for x in values)


def neighbour_blocks(rows: DataFrame, order: list[str], size: Column) -> DataFrame:
    """Adds ``block`` and ``ahead``: blocks are ranges of the order, and hold the first row of the next one ahead.

    So every pair of neighbours meets in one block, and rows travel once. Boundaries are keys drawn in proportion to
    size; there are at most MOST_BLOCKS of them. Behind the last block comes the first row of all.
    """
    total, first = rows.agg(F.sum(size), F.min(F.struct(*order))).first()
    target = max(BLOCK_BYTES, (total or 0) / MOST_BLOCKS)
    draw = F.pmod(F.xxhash64(F.lit(5), *order), F.lit(1 << 30)) / float(1 << 30)
    drawn = sorted(_order(tuple(r)) for r in rows.filter(draw < size * (SAMPLES / target)).select(*order).collect()) if first and total > target else []
    least = _order(tuple(first)) if first else None
    bounds = sorted({k for k in drawn[SAMPLES // 2 :: SAMPLES] if k != least})

    @F.pandas_udf("array<int>")
    def blocks(*columns: pd.Series) -> pd.Series:
        out = []
        for values in zip(*(c.astype(object).where(c.notna(), None) for c in columns), strict=True):
            k = _order(values)
            block = bisect_right(bounds, k)
            out.append([block] + [-block] * (block > 0 and bounds[block - 1] == k) + [-len(bounds) - 1] * (k == least))
        return pd.Series(out)

    placed = rows.withColumn("_in", F.explode(blocks(*order)))
    ahead = F.col("_in") < 0
    return placed.select(*rows.columns, F.when(ahead, -F.col("_in") - 1).otherwise(F.col("_in")).alias("block"), ahead.alias("ahead"))


def edited_by_next(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, and that of its edited text, whose last half comes from the next document.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next). Texts are shuffled
    once, to blocks of neighbours; a task streams its sorted rows and holds two texts at a time.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("hash"), text.alias("text"))
    dealt = neighbour_blocks(rows, ["doc_id", "hash"], F.octet_length("text") + 8).repartition("block").sortWithinPartitions("block", "ahead", "doc_id", "hash")
    fields = {"n_chars": T.LongType(), "edited_sha256": T.StringType(), "fingerprint": T.StringType(), "edited_fingerprint": T.StringType(), "near_edited": T.DoubleType(), "near_next": T.DoubleType()}
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(n, t) for n, t in fields.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out, key_type = None, [], None

        def written() -> pa.RecordBatch:
            columns = [pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), (key_type, pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()), strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", *fields])

        for batch in batches:
            key_type = batch.column(0).type
            for doc_id, block, ahead, value in zip(batch.column(0), batch.column(1), batch.column(2), batch.column(3), strict=True):
                block, ahead, value = block.as_py(), ahead.as_py(), value.as_py()
                mark = Fingerprint.of(value)
                if held and held[1] == block:
                    of, _, before, own = held
                    keep = len(before) - len(before) // 2
                    more = value[: len(before) // 2]
                    edited = own.edited(before, keep, more)
                    out.append((of.as_py(), len(before), hashlib.sha256((before[:keep] + more).encode()).hexdigest(), str(own), str(edited), own.likeness(edited), own.likeness(mark)))
                    if len(out) == OUTPUT_ROWS:
                        yield written()
                        out.clear()
                held = None if ahead else (doc_id, block, value, mark)
        if out:
            yield written()

    return dealt.select("doc_id", "block", "ahead", "text").mapInArrow(run, schema)


def op12_multiset_hash(spark, sf_dir: str) -> DataFrame:
    """Contract query: fingerprints of all documents and of their edited texts, and their likeness."""
    return edited_by_next(table(spark, sf_dir, "documents"))

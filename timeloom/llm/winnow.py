"""Operator 3, benchmark decontamination by winnowing.

Words become 64-bit hashes in Arrow batches. Of every ``w`` consecutive k-gram hashes the smallest (the
rightmost of equals) is kept as a fingerprint, so any shared span of ``w + k - 1`` words, the length of a
window, leaves at least one fingerprint at the same place in both texts. Fingerprints of training and test
texts are joined by Spark; a match names a document, an item and a diagonal (difference of positions). On
each diagonal the hit is extended to the maximal runs of equal words, and runs of a window or more count.
Items shorter than a window are matched whole, by n-grams of just their length.

Defined results: null and word-less texts have no words and no hits; items without words are ignored; a
null item_id is written as the empty string; repeated items count once per item_id, repeated documents are
judged separately and alike; with an empty benchmark nothing is contaminated. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_ROWS, durable, row_identity, table

WINDOW, GRAM = 10, 5
#: Texts hashed together; a longer text is a group of its own.
GROUP_BYTES = 1 << 20
#: Characters of benchmark text in matched pairs up to which they are broadcast.
BROADCAST_CHARS = 8_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_rng = np.random.Generator(np.random.PCG64(20240))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)

_OUT = {"n_words": T.LongType(), "n_hit": T.LongType(), "n_items": T.LongType(), "items_sha256": T.StringType(), "contaminated": T.BooleanType()}


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray = _IS_WORD) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word number of each text and the total) of texts lying end to end.

    A-Z count as a-z; ``letters`` tells for each byte of the lower-cased text whether it belongs to a word.
    """
    data = _LOWER[data]
    is_word = letters[data]
    start = is_word.copy()
    start[1:] &= ~is_word[:-1]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    start[edges] = is_word[edges]
    at = np.flatnonzero(is_word)
    first = np.flatnonzero(start[at])
    if not len(first):
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    lengths = np.diff(np.append(first, len(at)))
    place = np.arange(len(at)) - np.repeat(first, lengths)
    power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(int(lengths.max()) - 1, _STEP))), dtype=np.uint64)
    h = np.add.reduceat(_BYTE[data[at]] * power[place], first)
    return _mix(h + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), np.searchsorted(at[first], offsets)


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive word hashes."""
    out = np.zeros(max(len(h) - k + 1, 0), np.uint64)
    for i in range(k):
        out = _mix(out * _STEP + h[i : len(h) - k + 1 + i])
    return out


def winnow(h: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the fingerprints of one text's word hashes."""
    g = gram_hashes(h, k)
    n = len(g) - w + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    least, where = g[:n].copy(), np.arange(n)
    for i in range(1, w):
        better = g[i : n + i] <= least
        least = np.where(better, g[i : n + i], least)
        where = np.where(better, np.arange(i, n + i), where)
    where = np.unique(where)
    return where, g[where]


def grouped_texts(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for groups of rows of a text column; null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + GROUP_BYTES, side="right")) - 1)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def fingerprints(rows: DataFrame, ids: list[str], short: list[int], window: int = WINDOW, k: int = GRAM) -> DataFrame:
    """Ids and (f, pos) of every fingerprint; texts shorter than a window give one per length in ``short``.

    For each length in ``short`` every n-gram of that length is a fingerprint too (a window of one).
    """
    rows = rows.select(*ids, F.col("text").cast("binary").alias("_text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]), "f bigint", "pos int"])
    names = [*ids, "f", "pos"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in grouped_texts(batch.column(len(ids))):
                h, firsts = word_hashes(data, offsets)
                which, places, found = [], [], []
                for i in range(len(offsets) - 1):
                    words = h[firsts[i] : firsts[i + 1]]
                    parts = [winnow(words, k, window - k + 1)] if len(words) >= window else []
                    for n in short:
                        g = gram_hashes(words, n) if len(words) >= n else np.empty(0, np.uint64)
                        parts.append((np.arange(len(g)), _mix(g + np.uint64(n))))
                    for p, f in parts:
                        which.append(np.full(len(p), row + i))
                        places.append(p)
                        found.append(f)
                if which and (take := np.concatenate(which)).size:
                    kept = [c.take(pa.array(take)) for c in batch.columns[:-1]]
                    yield pa.RecordBatch.from_arrays([*kept, pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(places).astype(np.int32))], names=names)

    return rows.mapInArrow(run, schema)


def _runs(equal: np.ndarray, least: int) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], equal.view(np.int8), [0]))))
    return [(a, b) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True) if b - a >= least]


def _judge(words: np.ndarray, pairs: list[dict], window: int) -> tuple[int, set[str]]:
    """Hit words and occurring items of one document, by extending its matches along their diagonals."""
    hit, items = np.zeros(len(words), bool), set()
    for pair in pairs:
        item, _ = word_hashes(np.frombuffer(pair["item_text"], np.uint8), np.array([0, len(pair["item_text"])]))
        for shift in pair["shifts"]:
            low, high = max(0, shift), min(len(words), len(item) + shift)
            if low < high:
                for a, b in _runs(words[low:high] == item[low - shift : high - shift], min(window, len(item))):
                    hit[low + a : low + b] = True
                    items.add(pair["item_key"])
    return int(hit.sum()), items


def contamination(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, window: int = WINDOW, k: int = GRAM) -> DataFrame:
    """The kept columns (doc_id unless named), n_words, n_hit, n_items, items_sha256 and contaminated."""
    return _judged(docs, benchmark, ["doc_id"] if keep is None else keep, window, k).select("row.*", *_OUT)


def _judged(docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int = WINDOW, k: int = GRAM) -> DataFrame:
    """``row``, the kept columns as a struct (so that their names can't clash), and the verdict."""
    items = durable(
        benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_key"), F.col("text").cast("binary").alias("text"))
        .filter("text is not null").distinct().withColumn("item_no", F.xxhash64("item_key", "text"))
    )
    lengths = items.select("text").mapInArrow(_short_lengths(window), "n int").distinct()
    short = sorted(r[0] for r in lengths.collect())  # at most window - 1 numbers
    tests = durable(fingerprints(items, ["item_no"], short, window, k).withColumnRenamed("pos", "item_pos").distinct())
    n_tests = tests.count()
    named = docs.select(F.struct(*keep).alias("row"), "text", row_identity("doc_id", "text")[0].alias("row_key"))  # verdicts are exact, so equal keys do no harm
    train = fingerprints(named, ["row_key"], short, window, k)
    hits = train.join(F.broadcast(tests) if n_tests <= BROADCAST_ROWS else tests, "f")
    pairs = hits.groupBy("row_key", "item_no").agg(F.collect_set(F.col("pos") - F.col("item_pos")).alias("shifts"))
    by_row = durable(
        pairs.join(items.withColumnRenamed("text", "item_text"), "item_no")
        .groupBy("row_key").agg(F.collect_list(F.struct("item_key", "item_text", "shifts")).alias("pairs"))
    )
    size = by_row.agg(F.count("*"), F.sum(F.aggregate("pairs", F.lit(0).cast("long"), lambda a, p: a + F.length(p["item_text"]) + 4 * F.size(p["shifts"])))).first()
    if (size[1] or 0) <= BROADCAST_CHARS and size[0] <= BROADCAST_ROWS:
        joined = named.join(F.broadcast(by_row), "row_key", "left")
    else:  # hash join: the side with texts isn't sorted
        joined = named.join(by_row.hint("shuffle_hash"), "row_key", "left")
    joined = joined.select("row", F.col("text").cast("binary").alias("text"), "pairs")
    schema = T.StructType([joined.schema["row"], *(T.StructField(n, t) for n, t in _OUT.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            matched = batch.column(2)
            for row, data, offsets in grouped_texts(batch.column(1)):
                h, firsts = word_hashes(data, offsets)
                for i in range(len(offsets) - 1):
                    words = h[firsts[i] : firsts[i + 1]]
                    pairs = matched[row + i].as_py() or []
                    n_hit, found = _judge(words, pairs, window) if pairs else (0, set())
                    rows.append((len(words), n_hit, len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), n_hit > 0))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=["row", *_OUT])

    return joined.mapInArrow(run, schema)


def _short_lengths(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in grouped_texts(batch.column(0)):
                n = np.unique(np.diff(word_hashes(data, offsets)[1]))
                yield pa.RecordBatch.from_arrays([pa.array(n[(n > 0) & (n < window)].astype(np.int32))], names=["n"])

    return run


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that no benchmark window occurs in, all columns unchanged."""
    return _judged(docs, benchmark, docs.columns).filter(~F.col("contaminated")).select("row.*")


def op3_winnowing(spark, sf_dir: str) -> DataFrame:
    """Contract query: contamination of every document by the whole benchmark."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')"
OP3_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS w FROM benchmark),
s AS (SELECT item, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0),
g AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM s),
p AS (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n),
h AS (SELECT DISTINCT rid, i, p.n, item FROM p JOIN g ON g.n = p.n AND g.g = array_to_string(p.w[i:i + p.n - 1], ' ')),
c AS (SELECT rid, count(DISTINCT place) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS place FROM h) GROUP BY rid),
t AS (SELECT rid, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS sha FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, coalesce(sha, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN t USING (rid)
"""

"""Operator 6, byte-level BPE: encoding and decoding by DuckDB recursive queries in each partition.

Texts are cut at their spaces and line ends into chunks that split into the same pieces wherever they stand;
texts with other white space are split whole. Arrow numbers the different chunks of a group of texts, so that
only those are looked up, and lays their ids and bytes side by side again. Pieces not met before in this worker go to DuckDB as rows
(piece, position, token). A recursive query joins neighbouring tokens with the merge table and contracts, in
each piece, the leftmost pair of the smallest rank, until no pair merges. Ordered aggregation then gives the
ids of each piece and, through the vocabulary, the bytes that these ids decode to; a piece that is a token
itself enters the query as that token. Answers are remembered in caches of bounded size.

Long pieces (words without end, texts without spaces) are contracted in overlapping windows. Tokens that stand
side by side in the encoding of any text stand so wherever their joint text is encoded, and a row of tokens in
which all neighbours stand so is the encoding of the whole; so two windows may be joined behind a token that
both hold at the same place. Where they share none, a window is laid that starts at an accepted token, and
reaches further back until it begins with that token or with the piece. A query never keeps more than about
QUERY_ROWS rows, whatever the pieces.

The ids are those of the public library for the same ranks and pattern without special tokens. Defined
results: null counts as the empty text, with no ids; repeated rows are encoded alike; pieces may have any
length; other columns are ignored by the query and kept by the operator in a struct.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

#: Chunks and pieces that a worker remembers in the younger of two generations, and the length from which they
#: are forgotten after use.
CHUNKS, PIECES, CACHED_CHARS = 150_000, 150_000, 200
#: Texts encoded together, and rows that one recursive query may keep (a piece keeps about half its length squared).
GROUP_CHARS, QUERY_ROWS = 4_000_000, 3_000_000
#: Pieces from LONG bytes on are contracted in windows of LONG - 1 bytes, STRIDE bytes apart.
LONG, STRIDE = 128, 64

#: Texts that are split whole: with white space side by side, or other than spaces and line ends.
WHOLE = "[ \n][ \n]|[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

#: Contracts the pieces of ``base`` for {rounds} rounds; rank and position share one number of {kind}.
CONTRACT = """
WITH RECURSIVE s AS (
  SELECT w, pos, tok, 0 AS step FROM base
  UNION ALL
  SELECT w, pos, tok, step FROM (
    SELECT p.w, p.pos, CASE WHEN p.pos = h.best % {positions} THEN (h.best // {positions})::INTEGER ELSE p.tok END AS tok,
           p.step + 1 AS step, p.before, h.best % {positions} AS at_pos
    FROM (SELECT *, CASE WHEN lag(w) OVER () = w THEN lag(pos) OVER () END AS before FROM s) p
    JOIN (
      SELECT w, min(m.merged::{kind} * {positions} + pos) AS best
      FROM (SELECT w, pos, tok, CASE WHEN lead(w) OVER () = w THEN lead(tok) OVER () END AS next FROM s WHERE step < {rounds}) q
      JOIN merges m ON m.a = q.tok AND m.b = q.next
      GROUP BY w) h USING (w))
  WHERE before IS NULL OR before <> at_pos),
done AS (SELECT w, pos, tok, step FROM s JOIN (SELECT w, max(step) AS step FROM s GROUP BY w) USING (w, step))
"""
#: Ids and decoded bytes of contracted pieces, in order.
DECODE = """
SELECT w, string_agg(tok::VARCHAR, ',' ORDER BY pos) AS ids, string_agg(v.hex, '' ORDER BY pos) AS hex
FROM {source} JOIN vocabulary v ON v.id = tok GROUP BY w
"""


@lru_cache(maxsize=2)
class Coder:
    """The merge table of one rank file in a DuckDB of this worker, and what it has encoded so far."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex

        with open(ranks_path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pieces_of = regex.compile(pattern).findall
        self.size = {n: len(t) for t, n in self.ranks.items()}
        self.bytes_to_id = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        #: Ids, each followed by a comma, and decoded bytes, by generation; entries of plain strings cost the collector nothing.
        self.chunks: list[tuple[dict[str, str], dict[str, bytes]]] = [({}, {}), ({}, {})]
        self.pieces: list[tuple[dict[bytes, str], dict[bytes, bytes]]] = [({}, {}), ({}, {})]
        self.long: list[str | bytes] = []
        splits = [(self.ranks[t[:i]], self.ranks[t[i:]], n) for t, n in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        self.splits = pa.table(dict(zip(("a", "b", "merged"), (pa.array(x, pa.int32()) for x in zip(*splits, strict=True)), strict=True)))
        self.vocabulary = pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "hex": [t.hex() for t in self.ranks]})

    @cached_property
    def db(self):
        """A connection with the merge table and the vocabulary."""
        import duckdb

        db = duckdb.connect()
        db.execute("SET threads = 1; SET memory_limit = '300MB'; SET temp_directory = ''; SET preserve_insertion_order = true")
        db.register("splits", self.splits)
        db.register("tokens", self.vocabulary)
        db.execute("CREATE TABLE merges AS FROM splits; CREATE TABLE vocabulary AS FROM tokens")
        return db

    def rest(self) -> None:
        """Gives back the memory of queries and columns when a task ends: a worker may wait long for its next one. What is remembered stays."""
        if "db" in vars(self):
            self.db.close()
            del self.db
        pa.default_memory_pool().release_unused()

    # ------------------------------------------------------------------------------------------- contraction
    def _base(self, pieces: list[bytes]) -> pa.Table:
        """Rows of the pieces in order: their bytes, or the one token that a piece is."""
        whole = [self.ranks.get(p, -1) for p in pieces]
        lengths = np.array([1 if n >= 0 else len(p) for p, n in zip(pieces, whole, strict=True)], np.int64)
        w = np.repeat(np.arange(len(pieces), dtype=np.int32), lengths)
        starts = np.cumsum(lengths) - lengths
        pos = (np.arange(len(w)) - np.repeat(starts, lengths)).astype(np.int32)
        tok = self.bytes_to_id[np.frombuffer(b"".join([p if n < 0 else b"\0" for p, n in zip(pieces, whole, strict=True)]), np.uint8)]
        single = np.array(whole, np.int64) >= 0
        tok[starts[single]] = np.array(whole, np.int32)[single]
        return pa.table({"w": w, "pos": pos, "tok": tok})

    def _query(self, base: pa.Table, sql: str) -> pa.Table:
        self.db.register("base", base)
        out = self.db.sql(sql).to_arrow_table()
        self.db.unregister("base")
        return out

    def _short(self, pieces: list[bytes]) -> None:
        """Encodes and decodes pieces of fewer than LONG bytes in one query."""
        out = self._query(self._base(pieces), CONTRACT.format(positions=LONG, kind="INTEGER", rounds=LONG) + DECODE.format(source="done"))
        found = [pieces[i] for i in _values(out["w"])]
        ids, raw = self.pieces[0]
        ids.update(zip(found, _values(pc.binary_join_element_wise(out["ids"], "", ",")), strict=True))
        raw.update(zip(found, [p if p == x else x for p, x in zip(found, map(bytes.fromhex, _values(out["hex"])), strict=True)], strict=True))  # equal bytes are held once

    def _tokens(self, raw: bytes) -> list[int]:
        """The ids of one window."""
        if len(raw) < LONG:
            known = self.pieces[0][0]
            if raw not in known:
                self._short([raw])
            return list(map(int, known[raw][:-1].split(",")))
        positions = 1 << len(raw).bit_length()
        rounds = max(1, QUERY_ROWS // len(raw))
        base, step = self._base([raw]), rounds
        sql = CONTRACT.format(positions=positions, kind="BIGINT", rounds=rounds) + "SELECT * FROM done ORDER BY pos"
        while step == rounds:  # what rounds leave goes on in the next query
            out = self._query(base, sql)
            step = out["step"][0].as_py()
            base = out.select(["w", "pos", "tok"])
        return base["tok"].to_pylist()

    def _joined(self, raw: bytes) -> list[int]:
        """The ids of a long piece, joined from those of its windows."""
        width = LONG - 1
        ids = self._tokens(raw[:width])
        ends = list(accumulate(self.size[t] for t in ids))
        start = 0
        while ends[-1] < len(raw):
            start += STRIDE
            new = self._tokens(raw[start : start + width])
            new_ends = list(accumulate((self.size[t] for t in new), initial=start))
            i = bisect_left(ends, start)  # tokens from i + 1 on begin at ends[i], in the overlap
            held = {(ends[k], ids[k + 1]): k + 1 for k in range(i, len(ids) - 1)}
            k, j = next(((held[key], j) for j, key in enumerate(zip(new_ends, new, strict=False)) if key in held), (0, -1))
            back = STRIDE
            while j < 0:  # a window from the start of an accepted token, further back each time
                k = bisect_left(ends, ends[-1] - back) + 1 if back < ends[-1] else 0
                at = ends[k - 1] if k else 0
                new = self._tokens(raw[at : ends[-1] + STRIDE - 1])
                new_ends = list(accumulate((self.size[t] for t in new), initial=at))
                j = 0 if k == 0 or new[0] == ids[k] else -1
                back *= 2
            ids[k:], ends[k:] = new[j:], new_ends[j + 1 :]
            start = max(start, (ends[-1] - width) // STRIDE * STRIDE)
        return ids

    def _contract(self, pieces: list[bytes]) -> None:
        """Encodes and decodes pieces not met before, in queries of bounded size."""
        long = [p for p in pieces if len(p) >= LONG and p not in self.ranks]
        windows = {p[i : i + LONG - 1] for p in long for i in range(0, len(p), STRIDE)}
        fresh = [p for p in pieces if len(p) < LONG or p in self.ranks]
        todo, rows = [], 0
        for p in [*fresh, *windows.difference(fresh, self.pieces[0][0])]:
            cost = 1 if p in self.ranks else len(p) * len(p) // 2
            if todo and rows + cost > QUERY_ROWS:
                self._short(todo)
                todo, rows = [], 0
            todo.append(p)
            rows += cost
        if todo:
            self._short(todo)
        for p in long:
            ids = pa.array(self._joined(p), pa.int32())
            base = pa.table({"w": pa.array(np.zeros(len(ids), np.int32)), "pos": pa.array(np.arange(len(ids), dtype=np.int32)), "tok": ids})
            out = self._query(base, DECODE.format(source="base"))
            self.pieces[0][0][p], self.pieces[0][1][p] = f"{out["ids"][0]},", bytes.fromhex(out["hex"][0].as_py())

    def _turn(self) -> None:
        """Forgets long entries and starts a new generation of a cache that is full."""
        for caches, most in ((self.chunks, CHUNKS), (self.pieces, PIECES)):
            for long in self.long:
                for cache in caches[0]:
                    cache.pop(long, None)
            if len(caches[0][0]) > most:
                caches[:] = [({}, {}), caches[0]]
        self.long.clear()

    def _recall(self, chunks: list[str]) -> tuple[dict[str, str], dict[str, bytes]]:
        """Ids, each followed by a comma, and decoded bytes of different chunks."""
        self._turn()
        (ids, raw), (old_ids, old_raw) = self.chunks
        (have_ids, have_raw), (had_ids, had_raw) = self.pieces
        missing = [c for c in chunks if c not in ids]
        found = list(map(old_ids.get, missing))
        new = [c for c, x in zip(missing, found, strict=True) if x is None]
        again = [c for c, x in zip(missing, found, strict=True) if x is not None]
        ids.update(zip(again, [x for x in found if x is not None], strict=True))
        raw.update(zip(again, map(old_raw.__getitem__, again)))
        split = [[p.encode() for p in pieces] for pieces in map(self.pieces_of, new)]
        missing = set(chain.from_iterable(split)).difference(have_ids)
        fresh = missing.difference(had_ids)
        again = missing - fresh
        have_ids.update(zip(again, map(had_ids.__getitem__, again)))
        have_raw.update(zip(again, map(had_raw.__getitem__, again)))
        self._contract(list(fresh))
        ids.update(zip(new, ["".join(map(have_ids.__getitem__, x)) if len(x) > 1 else have_ids[x[0]] for x in split], strict=True))
        raw.update(zip(new, [b"".join(map(have_raw.__getitem__, x)) if len(x) > 1 else have_raw[x[0]] for x in split], strict=True))
        self.long += [x for some in (new, fresh) for x in some if len(x) > CACHED_CHARS]
        return ids, raw

    def cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Chunks that join to the texts and split into pieces independently of each other, and the place of each text's first."""
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        first, last = int(bounds[0]), int(bounds[-1])
        if first == last:
            return pa.array([], pa.large_string()), np.zeros(len(texts) + 1, np.int64)
        octets = np.frombuffer(texts.buffers()[2], np.uint8)[first:last]
        line = octets == 10
        starts = line | (octets == 32)
        starts[1:] |= line[:-1]
        for i in np.flatnonzero(pc.match_substring_regex(texts, WHOLE)):
            starts[bounds[i] - first : bounds[i + 1] - first] = False
        starts[bounds[:-1][np.diff(bounds) > 0] - first] = True
        offsets = np.append(np.flatnonzero(starts) + first, last)
        return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets), texts.buffers()[2]]), np.searchsorted(offsets, bounds)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, list[memoryview], list[memoryview]]:
        """Number of ids, ids joined by commas and decoded bytes of each text (``large_string`` without nulls)."""
        cut, bounds = self.cut(texts)
        cut = cut.dictionary_encode()
        chunks = _values(cut.dictionary)
        collects = gc.isenabled()
        gc.disable()  # nothing here refers to itself, and passes over so many short-lived lists are dear
        try:
            known = self._recall(chunks)
        finally:
            if collects:
                gc.enable()
        ids, raw = (pa.array(map(cache.__getitem__, chunks), kind, size=len(chunks)) for cache, kind in zip(known, (pa.large_string(), pa.large_binary()), strict=True))
        count = np.append(0, np.cumsum(pc.count_substring(ids, ",").to_numpy()[cut.indices.to_numpy()]))[bounds]
        return np.diff(count), _joined(ids.take(cut.indices), bounds, 1), _joined(raw.take(cut.indices), bounds, 0)

    def code(self, texts: list[str]) -> list[tuple[int, str, bytes]]:
        """(number of ids, ids joined by commas, decoded bytes) of each text."""
        return [(int(n), str(ids, "ascii"), bytes(raw)) for n, ids, raw in zip(*self.encode(pa.array(texts, pa.large_string())), strict=True)]


def _values(column: pa.Array | pa.ChunkedArray) -> list:
    """Python values, without a scalar for each on the way."""
    return column.to_numpy(zero_copy_only=False).tolist()


def _joined(values: pa.Array, bounds: np.ndarray, without: int) -> list[memoryview]:
    """The bytes of neighbouring values between bounds, without some at the end."""
    if not len(values):
        return [memoryview(b"")] * (len(bounds) - 1)
    _, offsets, data = values.buffers()
    data = memoryview(data)
    at = np.frombuffer(offsets, np.int64)[bounds].tolist()
    return [data[a : max(a, b - without)] for a, b in pairwise(at)]


def _groups(texts: pa.Array, chars: int) -> Iterator[pa.Array]:
    """Slices of at most ``chars`` characters, or one text."""
    ends = np.append(0, np.cumsum(pc.utf8_length(texts).to_numpy(), dtype=np.int64))
    start = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(ends, ends[start] + chars, "right")) - 1)
        yield texts.slice(start, end - start)
        start = end


_OUT = {"n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, keep: list[str] | None = None, with_ids: bool = False) -> DataFrame:
    """``row`` (kept columns as a struct), n_tokens, digests of the ids and of the bytes they decode to.

    ``with_ids`` adds ``ids`` (array of int) and ``decoded`` (string, invalid sequences replaced).
    """
    rows = docs.select(F.struct(*(["doc_id"] if keep is None else keep)).alias("row"), F.col("text").cast("string").alias("text"))
    out = _OUT | ({"ids": T.ArrayType(T.IntegerType()), "decoded": T.StringType()} if with_ids else {})

    def coded(coder: Coder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            for texts in _groups(batch.column(1).fill_null("").cast(pa.large_string()), GROUP_CHARS):
                count, ids, raw = coder.encode(texts)
                columns = [
                    batch.column(0).slice(start, len(texts)),
                    pa.array(count, pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(x).hexdigest() for x in raw]),
                ]
                if with_ids:
                    columns += [pa.array([[int(n) for n in bytes(x).split(b",")] if x else [] for x in ids], pa.list_(pa.int32())), pa.array([str(x, errors="replace") for x in raw])]
                yield pa.RecordBatch.from_arrays(columns, names=["row", *out])
                start += len(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(ranks_path, pattern)
        try:
            yield from coded(coder, batches)
        finally:
            coder.rest()

    return rows.mapInArrow(run, T.StructType([rows.schema["row"], *(T.StructField(n, t) for n, t in out.items())]))


def op6_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Contract query: ids of every document and the round trip back to its bytes."""
    import public_tokenizers

    coded = encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("row.*", *_OUT)

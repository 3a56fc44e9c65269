"""Operator 8, token counts by prefix dynamic programming.

The prefix table of a text holds, for each of its prefixes (by code points, the empty one first), the exact
number of tokens that the prefix has when encoded alone. Counts, truncation points and budget questions are
read from the table; nothing is encoded again.

Inside a piece one pass fills the table: a prefix that ends at i is reached from the one place j whose last
token may stand before the token from j to i. Whether two tokens may stand together is told by walking their
merges backwards: they may when at no time the parts at the joint would have merged first. The word-end mark
is tried at every place, as each prefix ends a word. Piece tables are joined to the table of a text by running
sums. Places are those of the text as given: where normalising changes lengths (composed accents, letters
whose lower case is two) the places inside the cluster get the count of the prefix as it would be normalised.
Special strings of the file found in a text are one token at their last character, as is the library's
default; before it their characters count as the ordinary text that such a prefix is.

Counts equal those of the public library for the same file without added begin or end tokens. Defined results:
null counts as the empty text with no tokens; repeated rows count alike; other columns are ignored by the query
and kept by the operator in a struct. Time and memory are linear in the length of a text, with or without
spaces.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table, text_groups

LIMIT = 2048
#: Chunks, pieces and token pairs that a worker remembers (the first two in the younger of two generations), and
#: the length from which they are forgotten after use.
CHUNKS, PIECES, PAIRS, CACHED_CHARS = 200_000, 200_000, 1_000_000, 200
#: Characters of the texts whose tables are made together.
GROUP_CHARS = 4_000_000
END = "</w>"
#: White space of the vocabulary's pattern, by Unicode; every character of it stands for a space.
SPACE = re.compile("[\t\x0b\x0c\r\x85\xa0  -     　]")
_ZERO = np.zeros(1, np.int32).tobytes()


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


@lru_cache(maxsize=1)
def joining_letters() -> frozenset[str]:
    """Characters that may compose with the one before: marks, second parts of compositions, Hangul vowels and finals."""
    pairs = (unicodedata.decomposition(chr(c)).split() for c in range(0x110000))
    seconds = {chr(int(p[1], 16)) for p in pairs if len(p) == 2 and not p[0].startswith("<")}
    return frozenset(seconds | {chr(c) for c in range(0x1160, 0x1200)})


class _Growing:
    """The table inside one piece, symbol by symbol; symbols can be taken back."""

    def __init__(self, counter: PrefixCounter, symbols: str = ""):
        self.counter, self.count, self.last, self.ends, self.state = counter, [0], [-1], [0], [0]
        self.push(symbols)

    def push(self, symbols: str) -> None:
        self.counter.extend(symbols, self.count, self.last, self.ends, self.state)

    def end(self) -> int:
        """Tokens of the piece if it ends here."""
        return self.ends[-1]

    def pop(self, n: int) -> None:
        if n:
            for held in (self.count, self.last, self.ends, self.state):
                del held[-n:]


@lru_cache(maxsize=2)
class PrefixCounter:
    """Prefix tables for one vocabulary file of the word-ending kind."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary = spec["model"]["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.token = {i: t for t, i in vocabulary.items()}
        self.width = max(vocabulary.values()) + 2
        self.rank = {p: i for i, p in enumerate(pairs)}
        self.merge = {vocabulary[a] * self.width + vocabulary[b]: i for i, (a, b) in enumerate(pairs)}
        #: When a token is formed (-1: a single symbol) and from which two.
        self.formed = [-1] * self.width
        self.parts: dict[int, tuple[int, int]] = {}
        for i, (a, b) in enumerate(pairs):
            t = vocabulary[a + b]
            self.formed[t], self.parts[t] = i, (vocabulary[a], vocabulary[b])
        #: Text without the mark -> (id inside a word or -1, id at its end or -1)
        self.ids: dict[str, tuple[int, int]] = {}
        for t, i in vocabulary.items():
            plain = t.removesuffix(END)
            inner, end = self.ids.get(plain, (-1, -1))
            self.ids[plain] = (inner, i) if plain != t else (i, end)
        #: Beginnings of tokens by number, the tokens that end where each is the longest one, and the next by symbol.
        self.beginnings = {t[:n] for t in self.ids for n in range(len(t) + 1)}
        self.state_no, self.state_text, self.ending = {"": 0}, [""], [()]
        self.next_state: dict[int, int] = {}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces_of = regex.compile(split["pattern"]["Regex"]).findall
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)")
        self.alphabet = byte_alphabet()
        self.may_stand: dict[int, bool] = {}
        self.pieces: list[dict[str, bytes]] = [{}, {}]
        self.chunks: list[dict[str, bytes]] = [{"": _ZERO}, {}]

    # ---------------------------------------------------------------------------------- tokens side by side
    def merged(self, symbols: list[str]) -> list[str]:
        """Tokens by plain contraction; tells whether a token is what its own text is encoded to."""
        parts = list(symbols)
        while len(parts) > 1:
            r, i = min((self.rank.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:], strict=False)))
            if r == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def apart(self, a: int, b: int) -> bool:
        """Whether two tokens stay as they are when their texts stand together."""
        limit = len(self.rank)
        while True:
            if self.merge.get(a * self.width + b, limit) < limit:
                return False
            if self.formed[a] > self.formed[b]:
                limit, a = self.formed[a], self.parts[a][1]
            elif self.formed[b] >= 0:  # of equal pairs the left one merges first
                limit, b = self.formed[b] + 1, self.parts[b][0]
            else:
                return True

    def fits(self, before: int, token: int) -> bool:
        """Whether ``token`` may follow ``before`` (-1 at the start of a word)."""
        key = (before + 1) * self.width + token
        if (known := self.may_stand.get(key)) is None:
            if before < 0:
                text = self.token[token]
                plain = text.removesuffix(END)
                known = self.merged([*plain[:-1], plain[-1] + text[len(plain) :]]) == [text]
            else:
                known = self.fits(-1, token) and self.apart(before, token)
            self.may_stand[key] = known
        return known

    def _advance(self, state: int, symbol: str) -> int:
        """The longest beginning of a token that the symbol after this one leaves."""
        text = self.state_text[state] + symbol
        while text not in self.beginnings:
            text = text[1:]
        if (found := self.state_no.get(text)) is None:
            found = self.state_no[text] = len(self.state_text)
            self.state_text.append(text)
            self.ending.append(tuple((len(text) - j, *self.ids[text[j:]]) for j in range(len(text)) if text[j:] in self.ids))
        if len(self.next_state) > PAIRS:
            self.next_state.clear()
        self.next_state[state << 9 | ord(symbol)] = found
        return found

    def extend(self, symbols: str, count: list[int], last: list[int], ends: list[int], states: list[int]) -> None:
        """Adds places to the table of a piece: tokens and last token if it goes on, tokens if it ends there."""
        may, width, following, ending = self.may_stand, self.width, self.next_state, self.ending
        state, i = states[-1], len(count)
        for c in symbols:
            to = following.get(state << 9 | ord(c))
            state = self._advance(state, c) if to is None else to
            end, inner, token = 0, 0, -1
            for n, x, y in ending[state]:
                before = (last[i - n] + 1) * width
                if y >= 0 and not end:
                    ok = may.get(before + y)
                    if self.fits(last[i - n], y) if ok is None else ok:
                        end = count[i - n] + 1
                        if inner:
                            break
                if x >= 0 and not inner:
                    ok = may.get(before + x)
                    if self.fits(last[i - n], x) if ok is None else ok:
                        inner, token = count[i - n] + 1, x
                        if end:
                            break
            if not (end and inner):
                raise ValueError("the vocabulary lacks a byte")
            count.append(inner)
            last.append(token)
            ends.append(end)
            states.append(state)
            i += 1

    # -------------------------------------------------------------------------------------------- pieces
    def symbols(self, text: str) -> str:
        return "".join([self.alphabet[b] for b in text.encode()])

    def learn(self, pieces: set[str]) -> None:
        """Fills the tables of pieces. In sorted order each goes on from the prefix it shares with the one before."""
        before, count, last, ends, states = "", [0], [-1], [0], [0]
        known = self.pieces[0]
        for s, piece in sorted((self.symbols(p), p) for p in pieces):
            n = 0
            for x, y in zip(s, before, strict=False):
                if x != y:
                    break
                n += 1
            for held in (count, last, ends, states):
                del held[n + 1 :]
            before = s
            self.extend(s[n:], count, last, ends, states)
            if len(s) == len(piece):
                counts = ends[1:]
            else:
                counts = [ends[i] for i in accumulate(len(c.encode()) for c in piece)]
            if piece in ("'re", "'ve", "'ll"):  # the pattern takes these whole or not at all
                counts[1] = counts[0] + self.total(piece[1])
            known[piece] = np.diff(np.array(counts, np.int32), prepend=np.int32(0)).tobytes() if len(counts) > 64 else array("i", [y - x for x, y in zip([0, *counts], counts, strict=False)]).tobytes()

    def steps_of(self, piece: str) -> bytes:
        """Steps of the token counts of the prefixes of a normalised piece, each encoded alone, by code points."""
        young, old = self.pieces
        known = young.get(piece) or old.get(piece)
        if known is None:
            self.learn({piece})
            known = young.pop(piece) if len(piece) > CACHED_CHARS else young[piece]
        else:
            young[piece] = known
        return known

    def prefix_counts(self, piece: str) -> list[int]:
        return np.cumsum(np.frombuffer(self.steps_of(piece), np.int32)).tolist()

    def total(self, piece: str) -> int:
        return int(np.frombuffer(self.steps_of(piece), np.int32).sum())

    def normal(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no final form: letters are lowered one by one
        return text.lower()

    # -------------------------------------------------------------------------------------------- chunks
    def pieces_in(self, chunk: str) -> list[str] | None:
        """The normalised pieces of a chunk; None where normalising moves places."""
        normal = self.normal(chunk)
        if len(normal) != len(chunk) or not (normal.isascii() or unicodedata.is_normalized("NFC", chunk)):
            return None
        return self.pieces_of(normal)

    def chunk_steps(self, chunk: str) -> bytes:
        """Steps of the token counts of a text without white space and special strings, by code points."""
        pieces = self.pieces_in(chunk)
        if pieces is None:
            return np.diff(np.array(self._uneven_counts(chunk), np.int32), prepend=np.int32(0)).tobytes()
        return b"".join([self.steps_of(p) for p in pieces])

    def chunk_counts(self, chunk: str) -> list[int]:
        return np.cumsum(np.frombuffer(self.chunk_steps(chunk), np.int32)).tolist()

    def _uneven_counts(self, chunk: str) -> list[int]:
        """The same where normalising moves places. Clusters that normalise by themselves are added one by one;
        inside a cluster each part is normalised, counted behind what stands before, and taken back."""
        joins = joining_letters()
        starts = [i for i, c in enumerate(chunk) if i == 0 or not (unicodedata.combining(c) or c in joins)]
        out: list[int] = []
        total, tail = 0, ""  # tokens of finished pieces, and the piece that may go on
        grown = _Growing(self)

        def split(more: str) -> tuple[str, list[str]]:
            """What goes to the tail, and the pieces after it. A tail beyond contractions is known by its kind."""
            stand_in = "x" if tail[0].isalpha() else "!"
            first, *rest = self.pieces_of(stand_in + more)
            return first[1:], rest

        for s, e in zip(starts, [*starts[1:], len(chunk)], strict=True):
            for stop in range(s + 1, e + 1):
                more = self.normal(chunk[s:stop])
                if len(tail) > 3 and not tail[0].isnumeric():
                    own, rest = split(more)
                    own = self.symbols(own)
                    grown.push(own)
                    out.append(total + grown.end() + sum(map(self.total, rest)))
                    grown.pop(len(own))
                else:
                    out.append(total + sum(map(self.total, self.pieces_of(tail + more))))
            if len(tail) > 3 and not tail[0].isnumeric():
                own, rest = split(more)
                grown.push(self.symbols(own))
                tail += own
                total += grown.end() if rest else 0
            else:
                rest = self.pieces_of(tail + more)
            if rest[-2:] in (["'", "r"], ["'", "v"], ["'", "l"]):  # may become a contraction: both stay open
                rest[-2:] = ["'" + rest[-1]]
            if rest:
                total += sum(map(self.total, rest[:-1]))
                tail = rest[-1]
                grown = _Growing(self, self.symbols(tail))
        return out

    def _turn(self) -> None:
        """Starts a new generation of a cache that is full; what is used again comes over from the old one."""
        for caches, most in ((self.chunks, CHUNKS), (self.pieces, PIECES)):
            if len(caches[0]) > most:
                caches[:] = [{}, caches[0]]
        if len(self.may_stand) > PAIRS:
            self.may_stand.clear()

    # --------------------------------------------------------------------------------------------- texts
    def _chunks(self, text: str) -> list[str]:
        low = self.normal(text)
        if len(low) == len(text) and (text.isascii() or unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", low)):
            text = low  # fewer different chunks
        text = text.replace("\n", " ")
        return (SPACE.sub(" ", text) if SPACE.search(text) else text).split(" ")

    def _recall(self, chunks: set[str]) -> dict[str, bytes]:
        """Steps of chunks, with none for the white space before each."""
        self._turn()
        young, old = self.chunks
        fresh = {}
        for c in chunks - young.keys():
            if (known := old.get(c)) is None:
                fresh[c] = self.pieces_in(c)
            else:
                young[c] = known
        have, had = self.pieces
        pieces = set().union(*(p for p in fresh.values() if p)) - have.keys()
        self.learn({p for p in pieces if p not in had})
        for c, p in fresh.items():
            young[c] = _ZERO + (self.chunk_steps(c) if p is None else b"".join([have.get(x) or self.steps_of(x) for x in p]))
        return young

    def tables(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Tokens of every prefix of each text, the empty one first: one more entry than code points."""
        found = [list(self.special.finditer(t)) if "<" in t else [] for t in texts]
        cuts = []  # the stretches of each text between special strings, as chunks
        for text, marks in zip(texts, found, strict=True):
            edges = [0, *[e for m in marks for e in m.span()], len(text)]
            cuts.append([self._chunks(text[a:b]) for a, b in zip(edges[::2], edges[1::2], strict=True)])
        known = self._recall({c for cut in cuts for chunks in cut for c in chunks})
        for marks, cut in zip(found, cuts, strict=True):
            steps = [np.frombuffer(b"".join([known[c] for c in chunks]), np.int32) for chunks in cut]
            parts = steps[:1]
            for m, chunks, after in zip(marks, cut[:-1], steps[1:], strict=True):  # a prefix that ends inside goes on with the text before
                tail = chunks[-1]
                inside = [0, *self.chunk_counts(tail + m[0][:-1])][len(tail) :]
                parts += [np.diff(np.array([*inside, (self.chunk_counts(tail)[-1] if tail else 0) + 1], np.int32)), after[1:]]
            yield np.cumsum(np.concatenate(parts) if marks else parts[0])
        for cache in (self.chunks[0], self.pieces[0]):
            for long in [c for c in cache if len(c) > CACHED_CHARS]:
                del cache[long]

    def table(self, text: str) -> np.ndarray:
        return next(iter(list(self.tables([text]))))

    def count(self, text: str) -> int:
        return int(self.table(text)[-1])


_OUT = {"n_bytes": T.LongType(), "n_tokens": T.LongType(), "over_limit": T.BooleanType(), "fit_chars": T.LongType()}


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, keep: list[str] | None = None, with_prefixes: bool = False) -> DataFrame:
    """``row`` (kept columns as a struct), n_bytes, n_tokens, over_limit, and fit_chars: the code points of the
    longest prefix of at most ``limit`` tokens. All come from the prefix table of the text.

    ``with_prefixes`` adds the table as ``prefix_tokens``; ``fit_to_budget`` answers other budgets from it.
    """
    rows = docs.select(F.struct(*(["doc_id"] if keep is None else keep)).alias("row"), F.col("text").cast("string").alias("text"))
    out = _OUT | ({"prefix_tokens": T.ArrayType(T.IntegerType())} if with_prefixes else {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter(path)
        for batch in batches:
            totals, fits, tables = [], [], []
            for texts in text_groups(batch.column(1), GROUP_CHARS):
                for counts in counter.tables(texts):
                    totals.append(int(counts[-1]))
                    fits.append(len(counts) - 1 if totals[-1] <= limit else int(np.flatnonzero(counts <= limit)[-1]))
                    if with_prefixes:
                        tables.append(counts.astype(np.int32))
            n_bytes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
            columns = [batch.column(0), n_bytes, pa.array(totals, pa.int64()), pa.array([n > limit for n in totals], pa.bool_()), pa.array(fits, pa.int64())]
            if with_prefixes:
                columns.append(pa.array(tables, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=["row", *out])

    return rows.mapInArrow(run, T.StructType([rows.schema["row"], *(T.StructField(n, t) for n, t in out.items())]))


def fit_to_budget(counted: DataFrame, budget: int) -> DataFrame:
    """Adds ``fit_end``: the code points of the longest prefix of at most ``budget`` tokens, from ``prefix_tokens``."""
    longest = F.expr(f"array_max(filter(sequence(0, size(prefix_tokens) - 1), i -> prefix_tokens[i] <= {int(budget)}))")
    return counted.withColumn("fit_end", longest)


def op8_prefix_counts(spark, sf_dir: str) -> DataFrame:
    """Contract query: bytes and tokens of every document, from its prefix table."""
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).select("row.*", *_OUT)

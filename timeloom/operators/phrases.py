"""Phrases of a dimension table found in texts: places, flags, institutions, signs by their names.

Where the dimension is counted to be small it is broadcast as a trie over tokens and each text is walked once; a
larger one meets the texts' token sequences in a join by phrase. Both give the matches of which the same rule takes
the longest first, then the earliest, none of which overlap.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters of all phrases together up to which the dimension is broadcast.
TRIE_CHARS = 4_000_000

_MATCH = T.ArrayType(T.StructType([T.StructField("at", T.IntegerType()), T.StructField("n", T.IntegerType()), T.StructField("phrase", T.StringType()), T.StructField("label", T.StringType())]))


def trie_of(phrases: list[tuple[str, str]]) -> dict:
    """Nested dicts by token; the phrase and its label stand under the empty token."""
    root: dict = {}
    for phrase, label in phrases:
        node = root
        for token in phrase.split(" "):
            node = node.setdefault(token, {})
        node[""] = (phrase, label)
    return root


def walk(trie: dict, tokens: list[str]) -> Iterator[tuple[int, int, str, str]]:
    """(at, n, phrase, label) of every phrase in the tokens."""
    for i, first in enumerate(tokens):
        node, n = trie.get(first), 1
        while node is not None:
            if "" in node:
                yield (i, n, *node[""])
            node = node.get(tokens[i + n]) if i + n < len(tokens) and tokens[i + n] else None
            n += 1


def longest_first(found: list[tuple[int, int, str, str]], size: int) -> list[tuple[int, int, str, str]]:
    """Matches without overlaps, longer ones first, then earlier ones; a map of taken tokens tells overlaps."""
    taken, out = bytearray(size), []
    for m in sorted(found, key=lambda m: (-m[1], m[0], m[2])):
        if taken.find(1, m[0], m[0] + m[1]) < 0:
            taken[m[0] : m[0] + m[1]] = b"\1" * m[1]
            out.append(m)
    return out


def _as_lists(found: list[list[tuple]]) -> pa.Array:
    return pa.array([[dict(zip(("at", "n", "phrase", "label"), m, strict=True)) for m in x] for x in found], pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32()), ("phrase", pa.string()), ("label", pa.string())])))


def phrase_matches(texts: DataFrame, ids: list[str], tokens: str, phrases: DataFrame, longest: int | None = None) -> DataFrame:
    """(ids, at, n, phrase, label): phrases found in an array of tokens, longer ones first, then the earlier; a match
    that overlaps one taken before it is left out.

    ``phrases`` has phrase (canonical words joined by spaces) and label, the smallest of which counts; ``longest`` is
    the number of words of the longest one, counted if not given. Null and empty phrases match nothing.
    """
    known = phrases.filter("phrase <> ''").groupBy("phrase").agg(F.min("label").alias("label"))
    chars, words = known.agg(F.sum(F.length("phrase")), F.max(F.size(F.split("phrase", " ")))).first()
    rows = texts.select(*ids, F.coalesce(F.col(tokens).cast("array<string>"), F.array().cast("array<string>")).alias("_t"))
    if (chars or 0) <= TRIE_CHARS:
        trie = trie_of([tuple(r) for r in known.collect()])  # counted above

        @F.arrow_udf(_MATCH)
        def matches(column: pa.Array) -> pa.Array:
            return _as_lists([longest_first(list(walk(trie, t)), len(t)) for t in column.to_pylist()])

        kept = rows.select(*ids, F.explode(matches("_t")).alias("m"))
    else:
        def grams(n: int) -> Column:
            starts = F.when(F.size("_t") >= n, F.sequence(F.lit(0), F.size("_t") - n)).otherwise(F.array().cast("array<int>"))
            return F.transform(starts, lambda i: F.struct(i.alias("at"), F.lit(n).alias("n"), F.array_join(F.slice("_t", i + 1, n), " ").alias("phrase")))

        spread = rows.select(*ids, F.explode(F.concat(*[grams(n) for n in range(1, (longest or words) + 1)])).alias("g")).select(*ids, "g.*")
        found = spread.join(known, "phrase").groupBy(*ids).agg(F.collect_list(F.struct("at", "n", "phrase", "label")).alias("_m"))

        @F.arrow_udf(_MATCH)
        def apart(column: pa.Array) -> pa.Array:
            lists = [[(m["at"], m["n"], m["phrase"], m["label"]) for m in ms] for ms in column.to_pylist()]
            return _as_lists([longest_first(ms, max(m[0] + m[1] for m in ms)) for ms in lists])

        kept = found.select(*ids, F.explode(apart("_m")).alias("m"))
    return kept.select(*ids, "m.at", "m.n", "m.phrase", "m.label")


def relabelled(matches: DataFrame, overrides: DataFrame, language: str, home: DataFrame) -> DataFrame:
    """Labels overridden by (language, phrase), and phrases of a language's home (language, phrase) left out."""
    out = matches.join(home.select(language, "phrase").distinct(), [language, "phrase"], "left_anti")
    other = overrides.select(language, "phrase", F.col("label").alias("_label"))
    return out.join(other, [language, "phrase"], "left").withColumn("label", F.coalesce("_label", "label")).drop("_label")

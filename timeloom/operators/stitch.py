"""Stitching of partial takes: sentences that the kept rows don't cover get fragments of dropped ones.

Sentences of a session are taken in order, and what one picks counts as kept for those behind it. Only rows that
share tokens with a sentence are looked at: they are found by a join on tokens, and stream through one pass per
session in the order of sentences and times, with the picked rows as its state.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.functions.text import tokenize

from .layout import fold

#: Shares of a sentence that are enough and that a stitch must reach, new tokens that a fragment adds at
#: least, seconds from a cluster's first fragment to an earlier one, and the share of a sentence that a kept row holds
#: to count for it (three tokens at least).
ENOUGH, NEEDED, NEW_TOKENS, CLUSTER_GAP, HELD = 0.85, 0.70, 2, 10.0, 0.3


def picked_for(size: int, rows: list[dict], kept: set[int]) -> list[int]:
    """Row numbers picked for a sentence of ``size`` tokens from rows (row_no, keep, start, shared, n_tokens) in time
    order; ``kept`` holds what earlier sentences picked."""
    is_kept = lambda r: r["keep"] or r["row_no"] in kept
    holding = [r for r in rows if is_kept(r) and len(r["shared"]) >= max(3, int(size * HELD))]
    covered = set().union(*(r["shared"] for r in holding))
    if len(covered) >= ENOUGH * size:
        return []
    anchor = min((r["start"] for r in holding), default=None)
    out = []
    for r in reversed(rows):
        shared = set(r["shared"])
        if is_kept(r) or len(shared) < NEW_TOKENS or r["n_tokens"] - len(shared) > 2 * len(shared) + 1:
            continue
        new = shared - covered
        if len(new) < NEW_TOKENS:
            continue
        if anchor is not None and anchor - r["start"] > CLUSTER_GAP and len(covered) >= NEEDED * size:
            break
        out.append(r["row_no"])
        covered |= new
        anchor = r["start"] if anchor is None else min(anchor, r["start"])
        if len(covered) >= ENOUGH * size:
            break
    return out[::-1] if len(covered) >= NEEDED * size else []


def stitched(rows: DataFrame, sentences: DataFrame, key: str) -> DataFrame:
    """(key, row_no, sentence_no) of the rows that are picked, each by the first sentence that takes it.

    ``rows``: key, row_no, text, start (seconds), keep (boolean); ``sentences``: key, sentence_no, text. Texts without
    tokens are passed over; null keep is false.
    """
    said = rows.select(key, "row_no", "start", F.coalesce("keep", F.lit(False)).alias("keep"), F.array_distinct(tokenize(F.col("text"))).alias("_t"))
    asked = sentences.select(key, "sentence_no", F.array_distinct(tokenize(F.col("text"))).alias("_t"))
    a = asked.select(key, "sentence_no", F.size("_t").alias("size"), F.explode("_t").alias("_w"))
    b = said.select(key, "row_no", F.explode("_t").alias("_w"))
    shared = a.join(b, [key, "_w"]).groupBy(key, "sentence_no", "row_no").agg(F.first("size").alias("size"), F.sort_array(F.collect_list("_w")).alias("shared")).filter(F.size("shared") >= NEW_TOKENS)
    pairs = shared.join(said.select(key, "row_no", "start", "keep", F.size("_t").alias("n_tokens")), [key, "row_no"])

    def step(found: Iterator[dict]) -> Iterator[dict]:
        kept: set[int] = set()
        for no, group in groupby(found, key=lambda r: r["sentence_no"]):
            near = list(group)
            for row_no in picked_for(near[0]["size"], near, kept):
                kept.add(row_no)
                yield {key: near[0][key], "row_no": row_no, "sentence_no": no}

    kinds = {f.name: f.dataType.simpleString() for f in pairs.schema}
    return fold(pairs, [key], ["sentence_no", "start", "row_no"], f"{key} {kinds[key]}, row_no {kinds['row_no']}, sentence_no {kinds['sentence_no']}", step)

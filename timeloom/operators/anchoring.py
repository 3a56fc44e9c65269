"""Anchoring of titles and links to spoken rows.

A page's blocks are found in the token stream of the rows that read it, by joins on stretches of GRAM tokens. What
isn't spoken itself takes its anchor from the nearest blocks around it that are: windows carry them in both
directions. Weak labels ("link", short words) are replaced by the text of the block they stand in.
Joins merge sorted sides, as two dozen sides of some MB each would fill the driver where Spark broadcasts them.

``stream`` is (keys, pos, row_no, token, start, end), the spoken tokens in order; ``blocks`` is (keys, block_no, text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from timeloom.functions.text import normalize, tokenize

GRAM = 4
#: Labels that say nothing about their target.
WEAK_LABELS = ("extrait", "video", "vidéo", "lien", "link", "source", "voir", "watch", "play")


def weak_label(label: Column) -> Column:
    """Whether a label is blank, says nothing, or has at most two words and 16 characters."""
    short = F.trim(F.coalesce(label, F.lit("")))
    return (short == "") | F.lower(short).isin(*WEAK_LABELS) | ((F.size(tokenize(short)) <= 2) & (F.length(short) <= 16))


def spoken_runs(texts: DataFrame, stream: DataFrame, keys: list[str], item: str, text: str) -> DataFrame:
    """(keys, item, a, b): every run of the stream's tokens that is a text's, from pos a to b.

    A text is cut into stretches of GRAM tokens, the last one at its end; each votes for the place at which the text
    would begin. A run has the votes of all, so all of its tokens agree. Shorter texts are one stretch.
    """
    order = Window.partitionBy(*keys).orderBy("pos")
    ahead = [F.lead("token", i).over(order) for i in range(GRAM)]
    sized = lambda tokens: F.xxhash64(F.lit(len(tokens)), *tokens)
    held = stream.select(*keys, "pos", *[c.alias(f"_t{i}") for i, c in enumerate(ahead)])
    grams = held.select(*keys, "pos", F.explode(F.array(*[F.when(F.col(f"_t{n - 1}").isNotNull(), sized([F.col(f"_t{i}") for i in range(n)])) for n in range(1, GRAM + 1)])).alias("_gram")).filter("_gram IS NOT NULL")
    cut = texts.select(*keys, item, tokenize(F.col(text)).alias("_t")).withColumn("_n", F.size("_t")).filter("_n > 0")
    last = F.greatest(F.col("_n") - GRAM, F.lit(0))
    cut = cut.select(*keys, item, "_t", "_n", F.array_distinct(F.concat(F.sequence(F.lit(0), last, F.lit(GRAM)), F.array(last))).alias("_at")).select(*keys, item, "_t", "_n", F.size("_at").alias("_all"), F.explode("_at").alias("_off"))
    part = [F.get("_t", F.col("_off") + i) for i in range(GRAM)]
    gram = F.when(F.col("_n") >= GRAM, sized(part))
    for n in range(1, GRAM):
        gram = F.when(F.col("_n") == n, sized(part[:n])).otherwise(gram)
    votes = cut.select(*keys, item, "_n", "_all", "_off", gram.alias("_gram")).join(grams.hint("merge"), [*keys, "_gram"]).groupBy(*keys, item, (F.col("pos") - F.col("_off")).alias("a")).agg(F.count("*").alias("_votes"), F.first("_all").alias("_all"), F.first("_n").alias("_n"))
    return votes.filter("_votes = _all").select(*keys, item, "a", (F.col("a") + F.col("_n") - 1).alias("b"))


def timed_runs(runs: DataFrame, stream: DataFrame, keys: list[str], item: str) -> DataFrame:
    """Adds the row and start of a run's first token and the end of its last one."""
    first = stream.select(*keys, F.col("pos").alias("a"), "row_no", "start")
    last = stream.select(*keys, F.col("pos").alias("b"), "end")
    return runs.join(first.hint("merge"), [*keys, "a"]).join(last.hint("merge"), [*keys, "b"]).select(*keys, item, "a", "b", "row_no", "start", "end")


def with_neighbours(blocks: DataFrame, keys: list[str], usable: Column) -> DataFrame:
    """Adds ``previous`` and ``following``: the nearest usable blocks of another text, as (block_no, row_no, start, end).

    Of usable blocks with equal texts side by side, the one before or after them all is remembered, so a block whose
    neighbour repeats its text looks past it; no pairs of blocks are made.
    """
    order = Window.partitionBy(*keys).orderBy("block_no")
    own = F.struct("block_no", "row_no", "start", "end", F.col("_key").alias("key"))
    named = blocks.withColumn("_key", normalize(F.col("text"))).withColumn("_ok", F.coalesce(usable, F.lit(False)))
    changed = F.col("_ok") & (F.coalesce(F.last(F.when(F.col("_ok"), F.col("_key")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit("\n")) != F.col("_key"))
    named = named.withColumn("_run", F.sum(changed.cast("int")).over(order))
    ends = named.filter("_ok").groupBy(*keys, "_run").agg(F.min_by(own, "block_no").alias("_head"), F.max_by(own, "block_no").alias("_tail"))
    runs = Window.partitionBy(*keys).orderBy("_run")
    ends = ends.select(*keys, "_run", F.lag("_tail").over(runs).alias("_before"), F.lead("_head").over(runs).alias("_behind"))
    kept = named.join(ends.hint("merge"), [*keys, "_run"], "left")
    near = F.when(F.col("_ok"), F.struct(own.alias("own"), F.col("_before").alias("before"), F.col("_behind").alias("behind")))
    kept = kept.withColumns({"_p": F.last(near, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)), "_f": F.first(near, ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing))})
    other = lambda c, past: F.when(F.col(f"{c}.own.key") == F.col("_key"), F.col(f"{c}.{past}")).otherwise(F.col(f"{c}.own"))
    return kept.withColumns({"previous": other("_p", "before"), "following": other("_f", "behind")}).drop("_key", "_ok", "_run", "_before", "_behind", "_p", "_f")


def resolved_blocks(blocks: DataFrame, stream: DataFrame, keys: list[str]) -> DataFrame:
    """Blocks with row_no, start and end of their first run in the stream; null where they aren't spoken."""
    runs = spoken_runs(blocks, stream, keys, "block_no", "text").groupBy(*keys, "block_no").agg(F.min(F.struct("a", "b")).alias("_r")).select(*keys, "block_no", "_r.a", "_r.b")
    return blocks.join(timed_runs(runs, stream, keys, "block_no").drop("a", "b").hint("merge"), [*keys, "block_no"], "left")


def anchor_titles(blocks: DataFrame, stream: DataFrame, keys: list[str], is_title: Column) -> DataFrame:
    """(keys, block_no, locator, row_no, start, end) of every title that can be placed.

    spoken: the title's words stand in the row of the block before it, else of the one behind. gap: from the end of
    the block before to the start of the block behind. Without a block before, the row before the one behind takes
    its place; without one behind, the gap is empty.
    """
    near = with_neighbours(resolved_blocks(blocks, stream, keys), keys, F.col("row_no").isNotNull()).filter(is_title).select(*keys, "block_no", "text", "previous", "following")
    rows = stream.groupBy(*keys, "row_no").agg(F.min("start").alias("_row_start"), F.max("end").alias("_row_end"))
    before = rows.select(*keys, (F.col("row_no") + 1).alias("_next"), F.struct(F.lit(None).cast("int").alias("block_no"), "row_no", F.col("_row_start").alias("start"), F.col("_row_end").alias("end"), F.lit(None).cast("string").alias("key")).alias("_instead"))
    near = near.withColumn("_next", F.col("following.row_no")).join(before.hint("merge"), [*keys, "_next"], "left").withColumn("previous", F.coalesce("previous", "_instead")).drop("_next", "_instead")
    runs = timed_runs(spoken_runs(near, stream, keys, "block_no", "text"), stream, keys, "block_no")
    heard = near.select(*keys, "block_no", "previous", "following").join(runs.hint("merge"), [*keys, "block_no"]).filter((F.col("row_no") == F.col("previous.row_no")) | (F.col("row_no") == F.col("following.row_no")))
    rank = F.struct((~F.coalesce(F.col("row_no") == F.col("previous.row_no"), F.lit(False))).alias("late"), "a", "row_no", "start", "end")
    said = heard.groupBy(*keys, "block_no").agg(F.min(rank).alias("_s"))
    start = F.col("previous.end")
    placed = near.join(said.hint("merge"), [*keys, "block_no"], "left").filter("previous IS NOT NULL OR _s IS NOT NULL")
    spoken = F.col("_s").isNotNull()
    return placed.select(
        *keys, "block_no", F.when(spoken, "spoken").otherwise("gap").alias("locator"), F.coalesce("_s.row_no", "previous.row_no").alias("row_no"),
        F.when(spoken, F.col("_s.start")).otherwise(start).alias("start"), F.when(spoken, F.col("_s.end")).otherwise(F.greatest(start, F.coalesce("following.start", start))).alias("end"),
    )


def anchor_links(links: DataFrame, blocks: DataFrame, stream: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, link_no, locator, row_no, start, end) of every link that can be placed.

    ``links`` is (keys, link_no, block_no, text). label: a strong label's words inside the run of its own block;
    block: the run of its block (weak labels, and strong ones said otherwise); previous, following: the nearest
    spoken block that isn't itself a weak label.
    """
    found = with_neighbours(resolved_blocks(blocks, stream, keys), keys, F.col("row_no").isNotNull() & ~weak_label(F.col("text")))
    own = links.select(*keys, "link_no", "block_no", F.col("text").alias("label")).join(found.withColumnRenamed("text", "_block").hint("merge"), [*keys, "block_no"])
    strong = own.filter(F.col("row_no").isNotNull() & ~weak_label(F.col("label"))).select(*keys, "link_no", F.col("label").alias("text"), F.col("start").alias("_from"), F.col("end").alias("_to"))
    runs = timed_runs(spoken_runs(strong, stream, keys, "link_no", "text"), stream, keys, "link_no")
    inside = strong.select(*keys, "link_no", "_from", "_to").join(runs.hint("merge"), [*keys, "link_no"]).filter("start >= _from AND end <= _to").groupBy(*keys, "link_no").agg(F.min(F.struct("a", "row_no", "start", "end")).alias("_s"))
    # a block that is nothing but a weak label doesn't tell where its link belongs
    usable = F.col("row_no").isNotNull() & ~weak_label(F.col("_block"))
    choice = (
        F.when(F.col("_s").isNotNull(), F.struct(F.lit("label").alias("locator"), "_s.row_no", "_s.start", "_s.end"))
        .when(usable, F.struct(F.lit("block").alias("locator"), "row_no", "start", "end"))
        .when(F.col("previous").isNotNull(), F.struct(F.lit("previous").alias("locator"), "previous.row_no", F.col("previous.end").alias("start"), F.col("previous.end").alias("end")))
        .when(F.col("following").isNotNull(), F.struct(F.lit("following").alias("locator"), "following.row_no", F.col("following.start").alias("start"), F.col("following.start").alias("end")))
    )
    return own.join(inside.hint("merge"), [*keys, "link_no"], "left").select(*keys, "link_no", choice.alias("_c")).filter("_c IS NOT NULL").select(*keys, "link_no", "_c.*")

"""Localisation of values in aligned rows: a positional token index and a ladder of six tiers.

A row has a written (reference) and a spoken (transcript) text and a timeline, whose steps carry the token numbers
of both sides and times. A value is looked up, in this order, as a phrase of the reference, as a phrase of the
transcript, as characters of either beside their nearest token, word by word on the timeline, and at last as the
whole row. Lookups are equality joins on (row, side, token) and (row, side, place). They merge
sorted sides, as a dozen sides of some MB each would fill the driver where Spark broadcasts them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from timeloom.functions.text import ACCENTED, normalize, tokenize

#: A run of letters and digits of the raw text that is one canonical token.
TOKEN = rf"[0-9A-Za-z{ACCENTED}][0-9A-Za-z{ACCENTED}\p{{Mn}}]*"
TIERS = ("reference_span", "transcript_span", "reference_symbol", "transcript_symbol", "token_match", "row")


def token_places(df: DataFrame, keys: list[str], sides: dict[str, str]) -> DataFrame:
    """(keys, side, place, token, first, past): every token of the texts named by side, with its offsets."""
    both = df.select(*keys, F.explode(F.array(*[F.struct(F.lit(side).alias("side"), F.coalesce(c, F.lit("")).alias("text")) for side, c in sides.items()])).alias("_s")).select(*keys, "_s.*")
    found = both.select(*keys, "side", F.posexplode(F.arrays_zip(F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0)).alias("word"), F.slice(F.split("text", TOKEN), 1, 1 << 30).alias("gap"))).alias("place", "_t")).filter("_t.word IS NOT NULL")
    upto = Window.partitionBy(*keys, "side").orderBy("place")
    past = F.sum(F.length("_t.gap") + F.length("_t.word")).over(upto)
    return found.select(*keys, "side", "place", normalize(F.col("_t.word")).alias("token"), (past - F.length("_t.word")).alias("first"), past.alias("past"))


def phrase_places(values: DataFrame, index: DataFrame, keys: list[str], value_id: str, value: str) -> DataFrame:
    """(keys, value_id, side, a, b): the first run of tokens that is the value's, by side.

    Each token of a value votes for the place at which the value would begin; a run has all votes.
    """
    wanted = values.select(*keys, value_id, tokenize(F.col(value)).alias("_t")).select(*keys, value_id, F.size("_t").alias("_n"), F.posexplode("_t").alias("_i", "token"))
    votes = wanted.join(index.hint("merge"), [*keys, "token"]).groupBy(*keys, value_id, "side", (F.col("place") - F.col("_i")).alias("_at")).agg(F.count("*").alias("_votes"), F.first("_n").alias("_n"))
    runs = votes.filter("_votes = _n").groupBy(*keys, value_id, "side").agg(F.min("_at").alias("a"), F.first("_n").alias("_n"))
    return runs.select(*keys, value_id, "side", "a", (F.col("a") + F.col("_n") - 1).alias("b"))


def found_at(text: Column, part: Column) -> Column:
    """Offset of the part in the text, else of it in lower case; three dots also as one character; null if nowhere."""
    out = F.lit(None).cast("int")
    for p in (F.when(part == "...", F.lit("…")), part):
        for t, x in ((F.lower(text), F.lower(p)), (text, p)):
            at = F.position(x, t)
            out = F.when((x != "") & (at > 0), at - 1).otherwise(out)
    return out


def symbol_places(values: DataFrame, rows: DataFrame, index: DataFrame, keys: list[str], value_id: str, value: str, sides: dict[str, str]) -> DataFrame:
    """(keys, value_id, side, a, b): the token before the characters of a value in the raw text, else the one after."""
    texts = rows.select(*keys, F.explode(F.array(*[F.struct(F.lit(side).alias("side"), F.coalesce(c, F.lit("")).alias("_text")) for side, c in sides.items()])).alias("_s")).select(*keys, "_s.*")
    hits = values.select(*keys, value_id, value).join(texts.hint("merge"), keys).withColumn("_at", found_at(F.col("_text"), F.col(value))).filter("_at IS NOT NULL").select(*keys, value_id, "side", "_at")
    near = hits.join(index.select(*keys, "side", "place", "past").hint("merge"), [*keys, "side"]).groupBy(*keys, value_id, "side").agg(
        F.coalesce(F.max(F.when(F.col("past") <= F.col("_at"), F.col("place"))), F.min("place")).alias("a"))
    return near.withColumn("b", F.col("a"))


def localize(values: DataFrame, rows: DataFrame, timeline: DataFrame, keys: list[str], value_id: str, value: str, reference: str = "reference", transcript: str = "transcript") -> DataFrame:
    """(keys, value_id, locator, start, end, exact) of every value.

    ``rows`` has the two texts and start and end; ``timeline`` step_no, right_no and left_no (token numbers of
    reference and transcript, null where a side is missing), start, end and exact. A tier counts only where the
    tokens it finds have steps on the timeline.
    """
    sides = {"reference": F.col(reference), "transcript": F.col(transcript)}
    index = token_places(rows, keys, sides)
    ids = [*keys, value_id]
    steps = timeline.select(*keys, "start", "end", "exact", F.explode(F.array(F.struct(F.lit("reference").alias("side"), F.col("right_no").alias("place")), F.struct(F.lit("transcript").alias("side"), F.col("left_no").alias("place")))).alias("_p")).select(*keys, "_p.*", "start", "end", "exact").filter("place IS NOT NULL")

    def timed(places: DataFrame, tier: int) -> DataFrame:
        each = places.select(*ids, "side", F.explode(F.sequence("a", "b")).alias("place")).join(steps.hint("merge"), [*keys, "side", "place"])
        ranked = (F.col("side") != "reference").cast("int") + tier
        return each.groupBy(*ids, ranked.alias("tier")).agg(F.min("start").alias("start"), F.max("end").alias("end"), F.bool_and("exact").alias("exact"))

    phrases = timed(phrase_places(values, index, keys, value_id, value), 0)
    rest = values.join(phrases.select(*ids).distinct().hint("merge"), ids, "left_anti")
    symbols = timed(symbol_places(rest, rows, index, keys, value_id, value, sides), 2)
    # word by word: the first word of the value that stands on the timeline, at its first step
    words = rest.select(*ids, F.posexplode(tokenize(F.col(value))).alias("_i", "token"))
    numbered = timeline.select(*keys, "step_no", F.col("right_no"), F.col("left_no"), "start", "end", "exact")
    side_token = index.select(*keys, "side", "place", "token")
    stood = [numbered.join(side_token.filter(F.col("side") == side).select(*keys, F.col("place").alias(no), "token").hint("merge"), [*keys, no]).select(*keys, "token", "step_no", "start", "end", "exact") for side, no in (("reference", "right_no"), ("transcript", "left_no"))]
    single = words.join(stood[0].union(stood[1]).hint("merge"), [*keys, "token"]).groupBy(*ids).agg(F.min(F.struct("_i", "step_no", "start", "end", "exact")).alias("_m")).select(*ids, F.lit(4).alias("tier"), "_m.start", "_m.end", "_m.exact")
    whole = values.select(*ids).join(rows.select(*keys, "start", "end").hint("merge"), keys).select(*ids, F.lit(5).alias("tier"), "start", "end", F.lit(False).alias("exact"))
    tried = phrases.unionByName(symbols).unionByName(single).unionByName(whole)
    best = tried.groupBy(*ids).agg(F.min(F.struct("tier", "start", "end", "exact")).alias("_b"))
    return best.select(*ids, F.element_at(F.array(*map(F.lit, TIERS)), F.col("_b.tier") + 1).alias("locator"), "_b.start", "_b.end", "_b.exact")

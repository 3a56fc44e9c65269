"""Queries of the localisation and anchoring operators."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from timeloom.functions import text
from timeloom.operators import anchoring, localize
from timeloom.operators.durable import durable
from timeloom.sources import html

from .registry import query, read

STEP, SAID = 0.4, 0.35
_TOKENS = f"regexp_extract_all({{0}}, '[0-9A-Za-z{text.ACCENTED}][0-9A-Za-z{text.ACCENTED}\\p{{{{Mn}}}}]*')"
_WORDS = "[lower(strip_accents(x)) FOR x IN {0}]"


def _spoken_turns(spark, sf_dir):
    """Turns spoken at an even pace, each with the turn before it as its script; every seventh script token is lost."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("transcript"), F.coalesce(F.lag("text").over(w), F.lit("")).alias("reference"))
    rows = rows.withColumns({"_l": text.tokenize(F.col("transcript")), "_r": text.tokenize(F.col("reference"))}).withColumn("n", F.greatest(F.size("_l"), F.size("_r")))
    rows = rows.withColumns({"start": F.lit(0.0), "end": F.col("n") * STEP})
    steps = rows.filter("n > 0").select("conv_id", "turn", F.size("_l").alias("nl"), F.size("_r").alias("nr"), F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("step_no"))
    no = F.col("step_no")
    steps = steps.select("conv_id", "turn", "step_no", F.when(no < F.col("nl"), no).alias("left_no"), F.when((no < F.col("nr")) & (no % 7 != 3), no).alias("right_no"), (no * STEP).alias("start"), (no * STEP + SAID).alias("end"), (no % 2 == 0).alias("exact"))
    return rows, steps


@query(f"""WITH t AS (SELECT conv_id, turn, coalesce(text, '') AS l, coalesce(lag(text) OVER (PARTITION BY conv_id ORDER BY turn), '') AS r FROM conversations),
k AS (SELECT *, {_TOKENS.format('l')} AS lw, {_TOKENS.format('r')} AS rw, regexp_split_to_array(l, '[0-9A-Za-z{text.ACCENTED}][0-9A-Za-z{text.ACCENTED}\\p{{Mn}}]*') AS lg, regexp_split_to_array(r, '[0-9A-Za-z{text.ACCENTED}][0-9A-Za-z{text.ACCENTED}\\p{{Mn}}]*') AS rg FROM t),
m AS (SELECT *, {_WORDS.format('lw')} AS lt, {_WORDS.format('rw')} AS rt, [list_sum([length(lg[j]) + length(lw[j]) FOR j IN range(1, i + 1)]) FOR i IN range(1, len(lw) + 1)] AS lp, [list_sum([length(rg[j]) + length(rw[j]) FOR j IN range(1, i + 1)]) FOR i IN range(1, len(rw) + 1)] AS rp FROM k),
v AS (SELECT *, unnest([0, 1, 2, 3, 4, 5]) AS value_no, unnest([array_to_string(rt[3:5], ' '), array_to_string(lt[2:4], ' '), '.', chr(10), 'qqq ' || coalesce(lt[-1], ''), 'qqq zzz']) AS val FROM m),
w AS (SELECT *, {_WORDS.format(_TOKENS.format('val'))} AS vt FROM v),
p AS (SELECT *, CASE WHEN len(vt) > 0 THEN list_min([i FOR i IN range(1, len(rt) + 1) IF rt[i:i + len(vt) - 1] = vt]) - 1 END AS ra, CASE WHEN len(vt) > 0 THEN list_min([i FOR i IN range(1, len(lt) + 1) IF lt[i:i + len(vt) - 1] = vt]) - 1 END AS la,
  CASE WHEN val <> '' AND strpos(r, val) > 0 AND len(rt) > 0 THEN greatest(0, len([x FOR x IN rp IF x <= strpos(r, val) - 1]) - 1) WHEN val <> '' AND strpos(lower(r), lower(val)) > 0 AND len(rt) > 0 THEN greatest(0, len([x FOR x IN rp IF x <= strpos(lower(r), lower(val)) - 1]) - 1) END AS rs,
  CASE WHEN val <> '' AND strpos(l, val) > 0 AND len(lt) > 0 THEN greatest(0, len([x FOR x IN lp IF x <= strpos(l, val) - 1]) - 1) WHEN val <> '' AND strpos(lower(l), lower(val)) > 0 AND len(lt) > 0 THEN greatest(0, len([x FOR x IN lp IF x <= strpos(lower(l), lower(val)) - 1]) - 1) END AS ls FROM w),
s AS (SELECT *, [x FOR x IN range(ra, ra + len(vt)) IF x % 7 <> 3] AS t0, [x FOR x IN range(la, la + len(vt))] AS t1, [x FOR x IN [rs] IF x % 7 <> 3] AS t2, [x FOR x IN [ls] IF x IS NOT NULL] AS t3,
  [y FOR y IN [list_min([i - 1 FOR i IN range(1, greatest(len(lt), len(rt)) + 1) IF lt[i] = x OR (rt[i] = x AND (i - 1) % 7 <> 3)]) FOR x IN vt] IF y IS NOT NULL][1:1] AS t4 FROM p),
b AS (SELECT *, CASE WHEN len(t0) > 0 THEN t0 WHEN len(t1) > 0 THEN t1 WHEN len(t2) > 0 THEN t2 WHEN len(t3) > 0 THEN t3 WHEN len(t4) > 0 THEN t4 END AS hit,
  CASE WHEN len(t0) > 0 THEN 'reference_span' WHEN len(t1) > 0 THEN 'transcript_span' WHEN len(t2) > 0 THEN 'reference_symbol' WHEN len(t3) > 0 THEN 'transcript_symbol' WHEN len(t4) > 0 THEN 'token_match' ELSE 'row' END AS locator FROM s)
SELECT conv_id, turn, value_no, locator, CASE WHEN hit IS NULL THEN 0.0::DOUBLE ELSE list_min(hit) * 0.4::DOUBLE END AS start, CASE WHEN hit IS NULL THEN greatest(len(lt), len(rt)) * 0.4::DOUBLE ELSE list_max(hit) * 0.4::DOUBLE + 0.35::DOUBLE END AS "end",
 hit IS NOT NULL AND len([x FOR x IN hit IF x % 2 <> 0]) = 0 AS exact FROM b""")
def value_locations(spark, sf_dir):
    """Where six kinds of values of each turn are said: phrases of either side, signs, half known and unknown ones."""
    rows, steps = _spoken_turns(spark, sf_dir)
    join = lambda c, a, n: F.array_join(F.slice(c, a, n), " ")
    kinds = F.array(join("_r", 3, 3), join("_l", 2, 3), F.lit("."), F.lit("\n"), F.concat(F.lit("qqq "), F.coalesce(F.try_element_at("_l", F.lit(-1)), F.lit(""))), F.lit("qqq zzz"))
    values = rows.select("conv_id", "turn", F.posexplode(kinds).alias("value_no", "value"))
    return localize.localize(values, rows.select("conv_id", "turn", "reference", "transcript", "start", "end"), steps, ["conv_id", "turn"], "value_no", "value")


def _read_pages(spark, sf_dir):
    """Blocks and links of the pages, and the tokens of a reading of them: two blocks to a row, every fifth one left
    out, and every second heading."""
    pages = read(spark, sf_dir, "pages")
    blocks = durable(html.html_blocks(pages, ["page_id"]).select("page_id", "block_no", "tag", "text"))
    heading = F.col("tag").rlike("^h[1-6]$")
    said = blocks.filter(F.when(heading, F.col("page_id") % 2 == 0).otherwise(F.col("block_no") % 5 != 2))
    place = F.row_number().over(Window.partitionBy("page_id").orderBy("block_no")) - 1
    tokens = said.select("page_id", F.floor(place / 2).cast("int").alias("row_no"), "block_no", F.posexplode(text.tokenize(F.col("text"))).alias("i", "token"))
    pos = (F.row_number().over(Window.partitionBy("page_id").orderBy("block_no", "i")) - 1).cast("int")
    return blocks, durable(html.html_links(pages, ["page_id"])), durable(tokens.select("page_id", pos.alias("pos"), "row_no", "token", (pos * STEP).alias("start"), (pos * STEP + SAID).alias("end")))


@query()
def title_anchors(spark, sf_dir):
    """Where the headings of the pages belong in a reading that leaves some of them out."""
    blocks, _, stream = _read_pages(spark, sf_dir)
    return anchoring.anchor_titles(blocks, stream, ["page_id"], F.col("tag").rlike("^h[1-6]$"))


@query()
def link_anchors(spark, sf_dir):
    """Where the links of the pages belong in the same reading."""
    blocks, links, stream = _read_pages(spark, sf_dir)
    return anchoring.anchor_links(links, blocks.drop("tag"), stream, ["page_id"])

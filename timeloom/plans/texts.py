"""Queries of the text, extraction, URL, HTML and alignment operators."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from timeloom.functions import extract, text, urls
from timeloom.operators import align, regions
from timeloom.operators.dealing import dealt
from timeloom.operators.durable import durable
from timeloom.sources import articles, html

from .registry import query, read

_TURN = """t AS (SELECT conv_id, turn, text, regexp_extract_all(trim(regexp_replace(lower(strip_accents(coalesce(text, ''))), '[^a-z0-9]+', ' ', 'g')), '[a-z0-9]+') AS tok FROM conversations),
p AS (SELECT *, lag(turn) OVER w AS prev_turn, lag(tok) OVER w AS prev_tok FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn))"""


def _turns(spark, sf_dir):
    w = Window.partitionBy("conv_id").orderBy("turn")
    t = read(spark, sf_dir, "conversations").select("conv_id", "turn", "text").withColumn("tok", text.tokenize(F.col("text")))
    return t.withColumns({"prev_turn": F.lag("turn").over(w), "prev_tok": F.lag("tok").over(w), "prev_text": F.lag("text").over(w)})


@query(f"""WITH {_TURN} SELECT conv_id, turn, len(tok)::BIGINT AS n_tokens, len(list_distinct(tok))::BIGINT AS n_distinct, tok[1] AS first_token FROM t""")
def tokenize(spark, sf_dir):
    """Tokens of each turn."""
    return _turns(spark, sf_dir).select("conv_id", "turn", F.size("tok").cast("long").alias("n_tokens"), F.size(F.array_distinct("tok")).cast("long").alias("n_distinct"), F.get("tok", F.lit(0)).alias("first_token"))


@query(f"""WITH {_TURN}, d AS (SELECT *, list_distinct(tok) AS a, list_distinct(prev_tok) AS b FROM p WHERE prev_turn IS NOT NULL)
SELECT conv_id, turn, CASE WHEN least(len(a), len(b)) > 0 THEN round(len(list_intersect(a, b)) / least(len(a), len(b)), 9) ELSE 0.0 END::DOUBLE AS set_overlap,
 CASE WHEN least(len(tok), len(prev_tok)) > 0 THEN round(least(len(tok), len(prev_tok)) / greatest(len(tok), len(prev_tok)), 9) ELSE 0.0 END::DOUBLE AS length_ratio FROM d""")
def token_overlap(spark, sf_dir):
    """Set overlap and length ratio of consecutive turns."""
    t = _turns(spark, sf_dir).filter("prev_turn IS NOT NULL")
    return t.select("conv_id", "turn", F.round(text.set_overlap(F.col("tok"), F.col("prev_tok")), 9).alias("set_overlap"), F.round(text.length_ratio(F.col("tok"), F.col("prev_tok")), 9).alias("length_ratio"))


@query(f"""WITH {_TURN}, a AS (SELECT conv_id, turn, w, count(*) AS n FROM (SELECT conv_id, turn, unnest(tok) AS w FROM p WHERE prev_turn IS NOT NULL) GROUP BY ALL),
b AS (SELECT conv_id, turn, w, count(*) AS n FROM (SELECT conv_id, turn, unnest(prev_tok) AS w FROM p WHERE prev_turn IS NOT NULL) GROUP BY ALL)
SELECT p.conv_id, p.turn, coalesce(sum(CASE WHEN b.n IS NOT NULL THEN least(a.n, b.n) END), 0)::BIGINT AS common FROM p LEFT JOIN a USING (conv_id, turn) LEFT JOIN b ON b.conv_id = a.conv_id AND b.turn = a.turn AND b.w = a.w WHERE prev_turn IS NOT NULL GROUP BY ALL""")
def token_overlap_stats(spark, sf_dir):
    """Common tokens of consecutive turns, repeats counted."""
    t = _turns(spark, sf_dir).filter("prev_turn IS NOT NULL")
    return t.select("conv_id", "turn", text.multiset_overlap(F.col("tok"), F.col("prev_tok")).cast("long").alias("common"))


@query(f"""WITH {_TURN} SELECT a.conv_id, a.turn, b.turn AS other, len(list_intersect(list_distinct(a.tok), list_distinct(b.tok)))::BIGINT AS common FROM t a JOIN t b ON a.conv_id = b.conv_id AND b.turn BETWEEN a.turn - 8 AND a.turn - 1
WHERE len(list_intersect(list_distinct(a.tok), list_distinct(b.tok))) >= 4""")
def repetition_lookback(spark, sf_dir):
    """Turns that share four or more tokens with one of the eight before."""
    t = _turns(spark, sf_dir).select("conv_id", "turn", "tok").withColumn("own", F.col("turn"))
    pairs = align.lookback_pairs(t, ["conv_id"], "turn", 8, ["own", "tok"])
    return pairs.select("conv_id", "turn", F.col("prev_own").alias("other"), text.overlap(F.col("tok"), F.col("prev_tok")).cast("long").alias("common")).filter("common >= 4")


@query("""WITH t AS (SELECT conv_id, turn, regexp_extract_all(trim(regexp_replace(lower(strip_accents(coalesce(text, ''))), '[^a-z0-9]+', ' ', 'g')), '[a-z0-9]+') AS tok, len([x FOR x IN string_split(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), ' ') IF x <> '']) AS size FROM conversations),
u AS (SELECT conv_id, turn, size, tok, unnest(tok) AS w, unnest(range(1, len(tok) + 1)) AS i FROM t),
m AS (SELECT a.conv_id, a.turn AS left_no, b.turn AS right_no, a.tok, least(a.size, b.size) AS shorter, a.i, a.i - b.i AS d FROM u a JOIN u b ON a.conv_id = b.conv_id AND a.w = b.w AND b.turn - a.turn BETWEEN 1 AND 8),
g AS (SELECT *, i - row_number() OVER (PARTITION BY conv_id, left_no, right_no, d ORDER BY i) AS g FROM m),
r AS (SELECT conv_id, left_no, right_no, any_value(tok) AS tok, any_value(shorter) AS shorter, count(*) AS n, min(i) AS s FROM g GROUP BY conv_id, left_no, right_no, d, g),
b AS (SELECT *, row_number() OVER (PARTITION BY conv_id, left_no, right_no ORDER BY n DESC, s) AS k FROM r)
SELECT conv_id, left_no, right_no, n::INT AS run, array_to_string(tok[s:s + n - 1], ' ') AS phrase, n / greatest(shorter, 1)::DOUBLE AS coverage FROM b WHERE k = 1
 AND (n >= 4 OR (shorter BETWEEN 1 AND 3 AND n = shorter) OR (shorter < 4 AND n >= 2 AND n / greatest(shorter, 1) >= 0.4))""")
def repetition_links(spark, sf_dir):
    """Turns that repeat a long run of an earlier one."""
    return align.repetition_links(read(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), ["conv_id"], "turn", "text")


@query()
def weighted_score(spark, sf_dir):
    """Weighted match score of consecutive turns and its parts."""
    t = _turns(spark, sf_dir).filter("prev_turn IS NOT NULL")
    return t.select("conv_id", "turn", align.score_pairs("text", "prev_text").alias("s")).select("conv_id", "turn", "s.*")


@query()
def token_align(spark, sf_dir):
    """Token alignment of consecutive turns, one row per step."""
    t = dealt(_turns(spark, sf_dir).filter("prev_turn IS NOT NULL").select("conv_id", "turn", "text", "prev_text"), "conv_id", "turn").select("conv_id", "turn", align.token_steps("text", "prev_text").alias("s"))
    return t.select("conv_id", "turn", F.posexplode("s").alias("step_no", "s")).select("conv_id", "turn", "step_no", "s.*")


@query()
def align_rows(spark, sf_dir):
    """User turns of each conversation aligned to the sentences of its assistant turns."""
    c = read(spark, sf_dir, "conversations")
    rows = regions.numbered(c.filter("role = 'user'").select("conv_id", "turn", "text"), "conv_id", "turn", "row_no").drop("turn")
    refs = c.filter("role <> 'user'").select("conv_id", F.posexplode(F.split("text", r"(?<=[.?!])\s+")).alias("part", "text"), "turn").select("conv_id", (F.col("turn") * 1000 + F.col("part")).alias("ref_no"), "text")
    refs = regions.numbered(refs, "conv_id", "ref_no", "ref_pos").drop("ref_no")
    found = durable(regions.align_regions(rows, refs, "conv_id"))
    again = regions.recovered(found.join(rows, ["conv_id", "row_no"]), refs, "conv_id", F.lit(True))
    return again.select("conv_id", "row_no", "ref_start", "ref_end", "score", "status")


@query("""SELECT doc_id, len(regexp_extract_all(text, '[0-9]+(?:[.,][0-9]+)*'))::BIGINT AS n_numbers, len(regexp_extract_all(text, '[$€£] ?[0-9]+(?:[.,][0-9]+)*'))::BIGINT AS n_money FROM documents""")
def extract_numbers(spark, sf_dir):
    """Numbers and amounts of money in each document."""
    count = lambda p: F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(p), F.lit(0))).cast("long")
    return read(spark, sf_dir, "documents").select("doc_id", count(extract.PATTERNS["number"]).alias("n_numbers"), count(r"[$€£] ?[0-9]+(?:[.,][0-9]+)*").alias("n_money"))


_MENTIONS = {k: extract.PATTERNS[k].replace("(?U)", "") for k in ("percent", "money", "duration", "ranking", "iso_date", "year", "timecode", "hashtag", "url", "speed", "weight", "temperature", "surface", "volume", "decibel", "social", "slash_date", "spoken_url", "bullet")}


def _mention_sql() -> str:
    """All matches of each kind, spaces collapsed, the first of those that are equal ignoring case."""
    found = " UNION ALL ".join(
        f"SELECT doc_id, '{k}' AS kind, list_transform(regexp_extract_all(text, '{p.replace(chr(39), chr(39) * 2)}'), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))) AS vs FROM documents WHERE text IS NOT NULL" for k, p in _MENTIONS.items())
    return f"""WITH f AS ({found}), d AS (SELECT doc_id, kind, list_filter(vs, lambda x, i: list_position(list_transform(vs, lambda y: lower(y)), lower(x)) = i) AS vs FROM f)
SELECT doc_id, kind, unnest(range(len(vs)))::INT AS value_no, unnest(vs) AS value FROM d"""


@query(_mention_sql())
def extract_mentions(spark, sf_dir):
    """All kinds of mentions of each document, one row per value; no text is filtered out beforehand."""
    found = F.array(*[F.struct(F.lit(k).alias("kind"), extract.find_all(F.col("text"), p).alias("v")) for k, p in _MENTIONS.items()])
    return read(spark, sf_dir, "documents").select("doc_id", F.explode(found).alias("f")).select("doc_id", "f.kind", F.posexplode("f.v").alias("value_no", "value"))


@query(r"""WITH c AS (SELECT doc_id, len(regexp_replace(coalesce(text, ''), '[^A-Za-zÀ-ɏ]', '', 'g')) AS latin, len(regexp_replace(coalesce(text, ''), '[^Ѐ-ӿ]', '', 'g')) AS cyrillic, len(regexp_replace(coalesce(text, ''), '[^Ͱ-Ͽ]', '', 'g')) AS greek,
 len(regexp_replace(coalesce(text, ''), '[^֐-׿]', '', 'g')) AS hebrew, len(regexp_replace(coalesce(text, ''), '[^؀-ۿ]', '', 'g')) AS arabic FROM documents)
SELECT doc_id, CASE WHEN latin + cyrillic + greek + hebrew + arabic > 0 THEN round(latin / (latin + cyrillic + greek + hebrew + arabic), 9) ELSE 0.0 END::DOUBLE AS latin, latin::BIGINT AS n_latin FROM c""")
def script_ratio(spark, sf_dir):
    """Share of Latin letters."""
    return read(spark, sf_dir, "documents").select("doc_id", F.round(text.script_ratio(F.col("text"), "latin"), 9).alias("latin"), text.script_count(F.col("text"), "latin").cast("long").alias("n_latin"))


def _language_sql() -> str:
    score = lambda words, letters: " + ".join([f"(length(t) - length(replace(t, '{w}', ''))) // {len(w)}" for w in words] + ([f"1.5 * length(regexp_replace(t, '[^{letters}]', '', 'g'))"] if letters else []))
    fr, en = (score(*text.LANGUAGES[x]) for x in ("fr", "en"))
    return f"WITH d AS (SELECT doc_id, lang, lower(coalesce(text, '')) AS t FROM documents) SELECT doc_id, lang, CASE WHEN {fr} >= {en} THEN 'fr' ELSE 'en' END AS guess FROM d"


@query(_language_sql())
def language_guess(spark, sf_dir):
    """Language by marker words and letters beside the stated one."""
    return read(spark, sf_dir, "documents").select("doc_id", "lang", text.guess_language(F.col("text")).alias("guess"))


@query(r"""WITH h AS (SELECT page_id, url, regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)), '^(www|m)\.', '') AS host, regexp_extract(url, '^[a-zA-Z]+://[^/?#]+([^?#]*)', 1) AS path FROM pages)
SELECT page_id, host, host || regexp_replace(path, '/+$', '') AS canonical, CASE WHEN regexp_matches(path, '/[0-9]{4}/|/[^/]*-[^/]*-[^/]+|/[0-9]+/?$') THEN 'article' WHEN regexp_matches(path, '^/?$') THEN 'site' ELSE 'page' END AS category FROM h""")
def url_canonical(spark, sf_dir):
    """Host, canonical form and class of page addresses."""
    u = F.col("url")
    return read(spark, sf_dir, "pages").select("page_id", urls.host(u).alias("host"), urls.canonical(u).alias("canonical"), urls.category(u).alias("category"))


@query("""SELECT page_id, len(regexp_extract_all(html, '<a [^>]*href="[^"]+"'))::BIGINT AS n_links, regexp_extract(html, '<title[^>]*>([^<]*)</title>', 1) AS title FROM pages""")
def html_anchors(spark, sf_dir):
    """Anchors and title of a page by patterns."""
    return read(spark, sf_dir, "pages").select("page_id", F.size(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit('<a [^>]*href="[^"]+"'), F.lit(0))).cast("long").alias("n_links"), F.regexp_extract("html", "<title[^>]*>([^<]*)</title>", 1).alias("title"))


@query()
def html_blocks(spark, sf_dir):
    """Text blocks of pages with their styled parts."""
    return html.html_blocks(read(spark, sf_dir, "pages"), ["page_id"])


@query()
def html_links(spark, sf_dir):
    """Anchors of pages with text and place."""
    return html.html_links(read(spark, sf_dir, "pages"), ["page_id"])


@query()
def links_in_context(spark, sf_dir):
    """Anchors of the pages with the text around them, and addresses in the text."""
    return html.links_in_context(read(spark, sf_dir, "pages"), ["page_id"])


@query(r"""WITH l AS (SELECT doc_id, i::INT AS line_no, trim(regexp_replace(string_split(text, chr(10))[i + 1], '\s+', ' ', 'g')) AS t FROM documents, range(0, 100000) r(i) WHERE i < len(string_split(text, chr(10))))
SELECT doc_id, line_no, CASE WHEN regexp_matches(upper(t), '^(?:EXTRAIT|INSERT)') THEN '' ELSE trim(regexp_replace(regexp_replace(t, '(?i)https?://\S+|www\.\S+', ' ', 'g'), '\s+', ' ', 'g')) END AS line FROM l""")
def script_paragraphs(spark, sf_dir):
    """Every line of the documents as a paragraph of a script."""
    d = read(spark, sf_dir, "documents").filter("text IS NOT NULL")
    return d.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "t")).select("doc_id", "line_no", text.script_paragraph(F.col("t")).alias("line"))


@query()
def html_titles(spark, sf_dir):
    """Headings of pages, the first of equal ones."""
    return html.html_titles(read(spark, sf_dir, "pages"), ["page_id"])


@query()
def html_article(spark, sf_dir):
    """Title, author and date of pages."""
    return html.html_article(read(spark, sf_dir, "pages"), ["page_id"])


@query()
def article_metadata(spark, sf_dir):
    """Best title, authors and date of pages from all sources of a page and its address."""
    return articles.article_metadata(read(spark, sf_dir, "pages"), ["page_id"])


@query(f"""WITH RECURSIVE t AS (SELECT conv_id, turn, role, list_distinct(regexp_extract_all(trim(regexp_replace(lower(strip_accents(coalesce(text, ''))), '[^a-z0-9]+', ' ', 'g')), '[a-z0-9]+')) AS tok FROM conversations),
c AS (SELECT a.conv_id, a.turn, a.tok, b.turn AS other, list_intersect(b.tok, a.tok) AS hit, row_number() OVER (PARTITION BY a.conv_id, a.turn ORDER BY b.turn DESC) AS n FROM t a JOIN t b ON a.conv_id = b.conv_id AND b.role = 'user' AND b.turn < a.turn WHERE a.role <> 'user'),
r AS (SELECT conv_id, turn, tok, 0::BIGINT AS n, []::VARCHAR[] AS have, []::BIGINT[] AS picked, false AS done FROM t WHERE role <> 'user'
 UNION ALL SELECT r.conv_id, r.turn, r.tok, c.n, CASE WHEN len(new) > 0 THEN list_concat(have, new) ELSE have END, CASE WHEN len(new) > 0 THEN list_prepend(c.other, picked) ELSE picked END, len(r.tok) > 0 AND len(have) + len(new) >= 0.9 * len(r.tok)
 FROM (SELECT r.*, list_filter(c.hit, lambda x: NOT list_contains(r.have, x)) AS new, c.n AS m FROM r JOIN c ON c.conv_id = r.conv_id AND c.turn = r.turn AND c.n = r.n + 1 WHERE NOT r.done) r JOIN c ON c.conv_id = r.conv_id AND c.turn = r.turn AND c.n = r.m)
SELECT conv_id, turn, max_by(picked, n) AS picked, CASE WHEN len(any_value(tok)) > 0 THEN max_by(len(have), n) / len(any_value(tok)) ELSE 0.0 END::DOUBLE AS covered FROM r GROUP BY conv_id, turn""")
def set_cover_stitch(spark, sf_dir):
    """For each assistant turn the user turns before it that cover its tokens, picked from the last backwards."""
    c = read(spark, sf_dir, "conversations")
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.collect_list(F.when(F.col("role") == "user", F.struct("turn", "text"))).over(w)
    t = c.select("conv_id", "turn", "role", "text", earlier.alias("earlier")).filter("role <> 'user'")
    return t.select("conv_id", "turn", align.cover("text", "earlier").alias("c")).select("conv_id", "turn", "c.picked", "c.covered")

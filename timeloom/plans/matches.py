"""Queries of matching by tolerance, names in texts, spanned extraction, snippets and stitching."""

from __future__ import annotations

from pyspark.sql import functions as F

from timeloom.functions.display import MONTHS
from timeloom.functions.text import tokenize
from timeloom.operators import extraction, nearest, phrases, snippets, stitch

from .registry import query, read


@query("""WITH RECURSIVE e AS (SELECT user_id, event_id, event_type, epoch_us(ts) // 1000000 AS pos FROM events WHERE event_type IN ('view', 'click', 'purchase', 'error')),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id, side ORDER BY pos, event_id) AS i FROM (SELECT *, event_type IN ('view', 'click') AS side FROM e)),
u AS (SELECT user_id, count(*) FILTER (side) AS nl, count(*) FILTER (NOT side) AS nr FROM n GROUP BY user_id),
s AS (SELECT user_id, nl, nr, 1::BIGINT AS i, 1::BIGINT AS j, NULL::BIGINT AS left_id, NULL::BIGINT AS right_id, NULL::BIGINT AS pos, false AS made FROM u
 UNION ALL SELECT s.user_id, nl, nr, CASE WHEN takes_left THEN s.i + 1 ELSE s.i END, CASE WHEN takes_right THEN s.j + 1 ELSE s.j END, CASE WHEN takes_left THEN lid END, CASE WHEN takes_right THEN rid END,
  CASE WHEN takes_left AND takes_right THEN least(la, ra) WHEN takes_left THEN la ELSE ra END, true
 FROM (SELECT s.*, l.event_id AS lid, l.pos AS la, r.event_id AS rid, r.pos AS ra, r.pos IS NULL OR (l.pos IS NOT NULL AND (abs(l.pos - r.pos) <= 7200 OR l.pos < r.pos)) AS takes_left, l.pos IS NULL OR (r.pos IS NOT NULL AND (abs(l.pos - r.pos) <= 7200 OR r.pos < l.pos)) AS takes_right
  FROM s LEFT JOIN n l ON l.user_id = s.user_id AND l.side AND l.i = s.i LEFT JOIN n r ON r.user_id = s.user_id AND NOT r.side AND r.i = s.j WHERE s.i <= nl OR s.j <= nr) s)
SELECT user_id, left_id, right_id, pos AS "at" FROM s WHERE made""")
def tolerance_merge(spark, sf_dir):
    """Views and clicks of a user paired with purchases and errors within two hours, each used once."""
    e = read(spark, sf_dir, "events").select("user_id", "event_id", "event_type", F.unix_seconds(F.col("ts").cast("timestamp")).alias("at"))
    left = e.filter(F.col("event_type").isin("view", "click")).select("user_id", F.col("event_id").alias("left_id"), "at")
    right = e.filter(F.col("event_type").isin("purchase", "error")).select("user_id", F.col("event_id").alias("right_id"), "at")
    return nearest.merge_tolerance(left, right, ["user_id"], "at", "left_id", "right_id", 7200)


_NAMES = """b AS (SELECT regexp_extract_all(lower(strip_accents(text)), '[a-z0-9]+') AS t FROM benchmark WHERE text IS NOT NULL),
ph AS (SELECT phrase, min(label) AS label FROM (SELECT array_to_string(t[1:4], ' ') AS phrase, 'opening' AS label FROM b WHERE len(t) >= 4 UNION ALL SELECT array_to_string(t[3:5], ' '), 'middle' FROM b WHERE len(t) >= 5 UNION ALL SELECT array_to_string(t[4:5], ' '), 'pair' FROM b WHERE len(t) >= 5) GROUP BY phrase),
d AS (SELECT doc_id, regexp_extract_all(trim(regexp_replace(lower(strip_accents(coalesce(text, ''))), '[^a-z0-9]+', ' ', 'g')), '[a-z0-9]+') AS t FROM documents),
g AS (SELECT doc_id, n, i, array_to_string(t[i + 1:i + n], ' ') AS phrase FROM (SELECT doc_id, t, n, unnest(range(0, len(t) - n + 1)) AS i FROM (SELECT *, unnest([2, 3, 4]) AS n FROM d))),
m AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY -n, i, phrase) AS r, n, i, phrase, label FROM g JOIN ph USING (phrase))"""


@query(f"""WITH RECURSIVE {_NAMES},
k AS (SELECT doc_id, 0::BIGINT AS r, NULL::BIGINT AS n, NULL::BIGINT AS i, NULL::VARCHAR AS phrase, NULL::VARCHAR AS label, []::BIGINT[] AS used, false AS kept FROM m GROUP BY doc_id
 UNION ALL SELECT m.doc_id, m.r, m.n, m.i, m.phrase, m.label, CASE WHEN len(list_intersect(used, range(m.i, m.i + m.n))) = 0 THEN list_concat(used, range(m.i, m.i + m.n)) ELSE used END, len(list_intersect(used, range(m.i, m.i + m.n))) = 0 FROM k JOIN m ON m.doc_id = k.doc_id AND m.r = k.r + 1)
SELECT doc_id, i::INT AS at_token, n::INT AS n, phrase, label FROM k WHERE kept""")
def named_spans(spark, sf_dir):
    """Passages of the benchmark's openings found in all documents, longest first, without overlaps."""
    b = read(spark, sf_dir, "benchmark").filter("text IS NOT NULL").select(tokenize(F.col("text")).alias("t"))
    part = lambda a, n, label: b.filter(F.size("t") >= a + n - 1).select(F.array_join(F.slice("t", a, n), " ").alias("phrase"), F.lit(label).alias("label"))
    names = part(1, 4, "opening").unionByName(part(3, 3, "middle")).unionByName(part(4, 2, "pair"))
    docs = read(spark, sf_dir, "documents").select("doc_id", tokenize(F.col("text")).alias("t"))
    return phrases.phrase_matches(docs, ["doc_id"], "t", names).select("doc_id", F.col("at").alias("at_token"), "n", "phrase", "label")


_STYLES = [("\"", "\""), ("'", "'"), ("“", "”"), ("„", "“"), ("«", "»"), ("‹", "›"), ("‚", "‘"), ("‘", "’"), ("<<", ">>")]
_SQL_STYLES = "[" + ", ".join("['{}', '{}']".format(a.replace("'", "''"), b.replace("'", "''")) for a, b in _STYLES) + "]"
_FR = "['janvier', 'février', 'mars', 'avril', 'mai', 'juin', 'juillet', 'août', 'septembre', 'octobre', 'novembre', 'décembre']"


@query(f"""WITH o AS (SELECT o_orderkey, o_orderkey % 5 AS k, o_orderkey % 3 AS n, {_SQL_STYLES}[o_orderkey % 9 + 1] AS q, o_orderdate::DATE AS d, year(o_orderdate)::VARCHAR AS y, {_FR}[month(o_orderdate)] AS m FROM orders),
p AS (SELECT *, CASE k WHEN 0 THEN day(d) || ' ' || m || ' ' || y WHEN 1 THEN strftime(d, '%d/%m/%Y') WHEN 2 THEN strftime(d, '%Y-%m-%d') WHEN 3 THEN m || ' ' || y ELSE y END AS dt, CASE n WHEN 0 THEN '12,5 %' WHEN 1 THEN '270 000 dollars' ELSE '45' END AS nu, q[1] || 'words of the clerk' || q[2] AS qu FROM o),
x AS (SELECT *, 3 AS a, 3 + length(dt) + 11 AS b, 3 + length(dt) + 11 + length(nu) + 5 AS c FROM p),
s AS (SELECT o_orderkey, 'date' AS kind, a AS st, dt AS value FROM x
 UNION ALL SELECT o_orderkey, 'date', a + length(dt) - length(m) - 5, m || ' ' || y FROM x WHERE k = 0
 UNION ALL SELECT o_orderkey, 'date', CASE WHEN k = 2 THEN a ELSE a + length(dt) - 4 END, y FROM x WHERE k < 4
 UNION ALL SELECT o_orderkey, 'number', b, nu FROM x UNION ALL SELECT o_orderkey, 'number', b, '270' FROM x WHERE n = 1 UNION ALL SELECT o_orderkey, 'number', b + 4, '000 dollars' FROM x WHERE n = 1
 UNION ALL SELECT o_orderkey, 'quote', c, qu FROM x)
SELECT o_orderkey, kind, st::INT AS start, (st + length(value))::INT AS "end", value FROM s""")
def spanned_values(spark, sf_dir):
    """Places of dates, numbers and quotes in sentences made of the orders, in five, three and nine forms."""
    k, d = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    month, year = F.element_at(F.array(*map(F.lit, MONTHS["fr"])), F.month(d)), F.year(d).cast("string")
    date = F.when(k % 5 == 0, F.concat_ws(" ", F.dayofmonth(d).cast("string"), month, year)).when(k % 5 == 1, F.date_format(d, "dd/MM/yyyy")).when(k % 5 == 2, F.date_format(d, "yyyy-MM-dd")).when(k % 5 == 3, F.concat_ws(" ", month, year)).otherwise(year)
    number = F.when(k % 3 == 0, "12,5 %").when(k % 3 == 1, "270 000 dollars").otherwise("45")
    style = F.element_at(F.array(*[F.array(F.lit(a), F.lit(b)) for a, b in _STYLES]), (k % 9 + 1).cast("int"))
    sentence = F.concat(F.lit("On "), date, F.lit(" they paid "), number, F.lit(" for "), style[0], F.lit("words of the clerk"), style[1], F.lit("."))
    texts = read(spark, sf_dir, "orders").select("o_orderkey", sentence.alias("text"))
    return extraction.text_spans(texts, ["o_orderkey"], "text")


@query()
def snippet_places(spark, sf_dir):
    """Where the middle of a turn, with every third word misspelt, stands in the turn."""
    c = read(spark, sf_dir, "conversations").filter("text IS NOT NULL").select("conv_id", "turn", "text", F.split("text", r"\s+").alias("w"))
    wrong = F.transform(F.slice("w", F.floor(F.size("w") / 3).cast("int") + 1, F.greatest(F.floor(F.size("w") / 3), F.lit(1)).cast("int")), lambda x, i: F.when(i % 3 == 2, F.reverse(x)).otherwise(x))
    return c.select("conv_id", "turn", snippets.snippet_place(F.array_join(wrong, " "), F.col("text")).alias("p")).select("conv_id", "turn", "p.*")


def _takes(spark, sf_dir):
    """Turns of a conversation cut into sentences as a script, and read in pieces of five words, every third one kept."""
    c = read(spark, sf_dir, "conversations").filter("text IS NOT NULL")
    sentences = c.select("conv_id", "turn", F.posexplode(F.split("text", r"(?<=[.?!])\s+")).alias("part", "text")).select("conv_id", (F.col("turn") * 1000 + F.col("part")).alias("sentence_no"), "text")
    pieces = c.select("conv_id", "turn", F.split("text", r"\s+").alias("w")).select("conv_id", "turn", F.explode(F.sequence(F.lit(0), F.floor((F.size("w") - 1) / 5))).alias("i"), "w")
    no = F.col("turn") * 1000 + F.col("i")
    rows = pieces.select("conv_id", no.alias("row_no"), F.array_join(F.slice("w", (F.col("i") * 5 + 1).cast("int"), 5), " ").alias("text"), (no * 2.0).alias("start"), (F.col("i") % 3 == 0).alias("keep"))
    return rows, sentences


_TOKENS = "list_distinct(regexp_extract_all(trim(regexp_replace(lower(strip_accents({0})), '[^a-z0-9]+', ' ', 'g')), '[a-z0-9]+'))"


@query(f"""WITH RECURSIVE c AS (SELECT conv_id, turn, string_split(regexp_replace(text, '([.?!])\\s+', '\\1' || chr(1), 'g'), chr(1)) AS ss, regexp_split_to_array(text, '\\s+') AS w FROM conversations WHERE text IS NOT NULL),
s AS (SELECT conv_id, turn * 1000 + p AS sentence_no, {_TOKENS.format('ss[p + 1]')} AS t FROM (SELECT *, unnest(range(0, len(ss))) AS p FROM c)),
r AS (SELECT conv_id, turn * 1000 + i AS row_no, i % 3 = 0 AS keep, {_TOKENS.format("array_to_string(w[i * 5 + 1:i * 5 + 5], ' ')")} AS t FROM (SELECT *, unnest(range(0, (len(w) - 1) // 5 + 1)) AS i FROM c)),
p AS (SELECT s.conv_id, sentence_no, row_no, keep, len(s.t) AS size, len(r.t) AS n, list_intersect(r.t, s.t) AS shared FROM s JOIN r ON r.conv_id = s.conv_id WHERE len(list_intersect(r.t, s.t)) >= 2),
b AS (SELECT conv_id, sentence_no, any_value(size) AS size, list({{'row_no': row_no, 'keep': keep, 'shared': shared}}) AS near FROM p GROUP BY conv_id, sentence_no),
e AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY sentence_no, first DESC, row_no DESC) AS k FROM (SELECT conv_id, sentence_no, size, true AS first, NULL AS row_no, NULL AS keep, 0 AS n, NULL AS shared, near FROM b
  UNION ALL SELECT conv_id, sentence_no, size, false, row_no, keep, n, shared, NULL FROM p UNION ALL SELECT conv_id, 1000000000, 1, true, NULL, NULL, 0, NULL, [] FROM b GROUP BY conv_id)),
f AS (SELECT conv_id, 0::BIGINT AS k, 1::BIGINT AS size, NULL::BIGINT AS sentence_no, []::BIGINT[] AS kept, []::VARCHAR[] AS covered, NULL::BIGINT AS anchor, []::BIGINT[] AS picked, true AS done, []::BIGINT[] AS gained, NULL::BIGINT AS gained_by FROM b GROUP BY conv_id
 UNION ALL SELECT conv_id, k, size, sentence_no, kept, CASE WHEN first THEN held ELSE CASE WHEN takes THEN list_distinct(list_concat(covered, shared)) ELSE covered END END,
  CASE WHEN first THEN held_from WHEN takes THEN least(coalesce(anchor, row_no), row_no) ELSE anchor END, CASE WHEN first THEN [] WHEN takes THEN list_append(picked, row_no) ELSE picked END,
  CASE WHEN first THEN len(held) >= 0.85 * size ELSE done OR stops OR (takes AND len(list_distinct(list_concat(covered, shared))) >= 0.85 * size) END, gained, gained_by
 FROM (SELECT *, NOT first AND usable AND NOT stops AS takes FROM (SELECT *, usable AND anchor IS NOT NULL AND (anchor - row_no) * 2.0 > 10 AND len(covered) >= 0.7 * size AS stops FROM (
  SELECT h.*, list_distinct(flatten([x.shared FOR x IN near IF (x.keep OR list_contains(kept, x.row_no)) AND len(x.shared) >= greatest(3, floor(0.3::DOUBLE * size))])) AS held, list_min([x.row_no FOR x IN near IF (x.keep OR list_contains(kept, x.row_no)) AND len(x.shared) >= greatest(3, floor(0.3::DOUBLE * size))]) AS held_from,
   NOT first AND NOT done AND NOT keep AND NOT list_contains(kept, row_no) AND n - len(shared) <= 2 * len(shared) + 1 AND len([x FOR x IN shared IF NOT list_contains(covered, x)]) >= 2 AS usable
  FROM (SELECT e.conv_id, e.k, e.size, e.sentence_no, e.first, e.row_no, e.keep, e.n, e.shared, e.near, f.covered, f.anchor, f.picked, f.done,
    CASE WHEN e.first AND len(f.covered) >= 0.7 * f.size THEN list_concat(f.kept, f.picked) ELSE f.kept END AS kept, CASE WHEN e.first AND len(f.covered) >= 0.7 * f.size THEN f.picked ELSE [] END AS gained, f.sentence_no AS gained_by
   FROM f JOIN e ON e.conv_id = f.conv_id AND e.k = f.k + 1) h))))
SELECT conv_id, unnest(gained) AS row_no, gained_by AS sentence_no FROM f""")
def stitched_takes(spark, sf_dir):
    """Dropped pieces of the turns that are taken back to cover sentences, in the order of the script."""
    rows, sentences = _takes(spark, sf_dir)
    return stitch.stitched(rows, sentences, "conv_id")

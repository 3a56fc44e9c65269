"""Operator 9, line dedup by a log-template tree.

Every line is parsed down a tree of fixed depth: by its number of tokens, then by its leading tokens, tokens
that hold a digit being a variable field. Below a leaf the remaining places are generalised: a token that two
or more documents hold at this place of this leaf is a constant, any other one fills a variable field. The
template of a line is its way down the tree with its constants. It stands for the line when constants and
leading tokens are SIMILAR of all tokens or more; else, and for short lines, the line's exact tokens do.

An online tree fits each line to the templates met so far, so it depends on their order and on one process.
This form counts instead and gives the same answer in any order: leaves and exact lines are counted by
64-bit hashes; only lines in leaves that different lines of different documents share are looked at token by
token, one of each; constants are counted per place, and the template's hash is combined from its constants, so no leaf,
place or template is ever gathered.

A template, exact or generalised, recurs when it is found in two or more documents. Its lines stay in the
document with the smallest doc_id and are dropped from all others, so groups of copies keep one whole text.

Defined results: null and empty texts come back as they are; lines of fewer than ``min_tokens`` tokens and
fewer than ``min_chars`` characters are never dropped, being common by chance; a line of fewer than
``general`` tokens has its exact template only; a null doc_id sorts last and all null ids count as one
document; repeated rows with one doc_id are one document, changed alike; other columns are kept. An empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, row_identity, small_join, space_words, table

#: A line takes part from so many tokens or characters on, and can be generalised from GENERAL tokens on; DEPTH
#: leading tokens are levels of the tree; a template needs this part of a line's tokens.
MIN_TOKENS, MIN_CHARS, GENERAL, DEPTH, SIMILAR = 5, 15, 8, 3, 0.6


def _tokens(line: Column) -> Column:
    """The words of a line, those with a digit marked as variable fields."""
    masked = F.regexp_replace(line, r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*", "<*>")
    return space_words(F.when(line.rlike("[0-9]"), masked).otherwise(line))


def parsed_lines(docs: DataFrame, min_tokens: int = MIN_TOKENS, min_chars: int = MIN_CHARS, general: int = GENERAL, depth: int = DEPTH) -> DataFrame:
    """(row_a, row_b, did, line_no, exact, leaf): did is the document's order; leaf is null for lines that aren't
    generalised."""
    lines = docs.select(
        *row_identity("doc_id", "text"), F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("did"), F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    )
    t, n = F.col("t"), F.size("t")
    parsed = lines.select("row_a", "row_b", "did", "line_no", F.length("line").alias("chars"), _tokens(F.col("line")).alias("t"))
    parsed = parsed.filter((n > 0) & ((n >= min_tokens) | (F.col("chars") >= min_chars)))
    leaf = F.when(n >= general, F.xxhash64(n, F.slice(t, 1, depth)))
    return parsed.select("row_a", "row_b", "did", "line_no", F.xxhash64(t).alias("exact"), leaf.alias("leaf"))


def generalised(docs: DataFrame, lines: DataFrame, depth: int = DEPTH, similar: float = SIMILAR) -> DataFrame:
    """(exact, lo, hi, template) of the lines that have a generalised template; lo and hi are the first and the
    last document of the exact line.

    Of equal lines one is read again, in a document that holds it.
    """
    place = F.struct("row_a", "row_b", "line_no")
    different = lines.filter("leaf IS NOT NULL").groupBy("leaf", "exact").agg(F.min("did").alias("lo"), F.max("did").alias("hi"), F.min(place).alias("at"))
    different = durable(different)
    leaves = different.groupBy("leaf").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count("*").alias("n")).filter("lo < hi AND n > 1").select("leaf")
    wanted = different.join(leaves, "leaf").select("at.*", F.struct("at.line_no", "exact", "leaf", "lo", "hi").alias("l"))
    wanted = durable(wanted.groupBy("row_a", "row_b").agg(F.collect_list("l").alias("ls")))  # lines of one document
    named = docs.select(*row_identity("doc_id", "text"), "text")
    read = small_join(named, wanted, ["row_a", "row_b"]).select(F.split("text", "\n").alias("_all"), F.explode("ls").alias("l"))
    shared = durable(read.select("l.exact", "l.leaf", "l.lo", "l.hi", _tokens(F.get("_all", F.col("l.line_no"))).alias("t")).dropDuplicates(["exact"]))
    tail = F.posexplode(F.slice("t", depth + 1, F.greatest(F.size("t") - depth, F.lit(0)))).alias("place", "token")
    tokens = shared.select("exact", "leaf", "lo", "hi", tail).select("exact", "lo", "hi", F.xxhash64("leaf", "place", "token").alias("key"))
    constants = tokens.groupBy("key").agg(F.min("lo").alias("first"), F.max("hi").alias("last")).filter("first < last").select("key")
    held = tokens.select("exact", "key").join(constants, "key").groupBy("exact").agg(F.count("*").alias("k"), F.bit_xor("key").alias("x"), F.bit_xor(F.xxhash64("key")).alias("y"))
    found = shared.select("exact", "leaf", "lo", "hi", F.size("t").alias("n")).join(held, "exact")
    return found.filter(F.col("k") + depth >= similar * F.col("n")).select("exact", "lo", "hi", F.xxhash64("leaf", "k", "x", "y").alias("template"))


def drop_recurring_lines(docs: DataFrame, min_tokens: int = MIN_TOKENS, min_chars: int = MIN_CHARS, general: int = GENERAL, depth: int = DEPTH, similar: float = SIMILAR, report: bool = False) -> DataFrame:
    """The documents with lines of recurring templates removed; ``report`` adds n_lines and n_dropped."""
    lines = durable(parsed_lines(docs, min_tokens, min_chars, general, depth))
    member = durable(generalised(docs, lines, depth, similar))
    wide = member.groupBy("template").agg(F.min("lo").alias("first"), F.max("hi").alias("last")).filter("first < last")
    by_template = member.join(wide, "template").select("exact", F.col("first").alias("lo"), F.col("last").alias("hi"))
    by_exact = lines.groupBy("exact").agg(F.min("did").alias("lo"), F.max("did").alias("hi")).filter("lo < hi")
    recurring = durable(by_exact.unionByName(by_template).groupBy("exact").agg(F.min("lo").alias("first")))
    gone = small_join(lines, recurring, "exact").filter("did > first").groupBy("row_a", "row_b").agg(F.collect_set("line_no").alias("gone"))
    named = docs.select(F.struct(*docs.columns).alias("row"), *row_identity("doc_id", "text"))
    joined = named.join(gone.hint("shuffle_hash"), ["row_a", "row_b"], "left")
    kept = F.expr("""IF(gone IS NULL, row.text, transform(array(split(row.text, '\\n')), l ->
        array_join(transform(array_except(sequence(0, size(l) - 1), gone), i -> l[i]), '\\n'))[0])""")
    out = [kept.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns]
    if report:
        out += [F.coalesce(F.size(F.split("row.text", "\n")), F.lit(0)).cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped")]
    return joined.select(*out)


def op9_line_templates(spark, sf_dir: str) -> DataFrame:
    """Every document with the number of its lines, the number dropped, and its remaining text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_recurring_lines(docs, report=True)


OP9_SQL = """
WITH l AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no
  FROM documents WHERE text IS NOT NULL),
s AS (
  SELECT doc_id, text, line_no, length(line) AS chars, list_filter(string_split_regex(regexp_replace(line, '[^ \\t\\n\\x0b\\x0c\\r]*[0-9][^ \\t\\n\\x0b\\x0c\\r]*', '<*>', 'g'), '[ \\t\\n\\x0b\\x0c\\r]+'), lambda x: x <> '') AS t FROM l),
p AS (SELECT *, len(t) AS n FROM s WHERE len(t) > 0 AND (len(t) >= 5 OR chars >= 15)),
u AS (SELECT t, n, t[1:3] AS lead, min(doc_id) AS lo, max(doc_id) AS hi FROM p GROUP BY t, n),
k AS (SELECT t, n, lead, lo, hi, unnest(range(4, n + 1)) AS place, unnest(t[4:]) AS token FROM u WHERE n >= 8),
c AS (SELECT n, lead, place, token FROM k GROUP BY ALL HAVING min(lo) < max(hi)),
h AS (
  SELECT t, n, lead, any_value(lo) AS lo, any_value(hi) AS hi, list((place, token) ORDER BY place) AS constants
  FROM k JOIN c USING (n, lead, place, token) GROUP BY t, n, lead HAVING count(*) + 3 >= 0.6 * n),
w AS (SELECT n, lead, constants, min(lo) AS lo FROM h GROUP BY n, lead, constants HAVING min(lo) < max(hi)),
r AS (
  SELECT t, min(lo) AS lo FROM (SELECT t, lo FROM u WHERE lo < hi UNION ALL SELECT h.t, w.lo FROM h JOIN w USING (n, lead, constants)) GROUP BY t),
g AS (SELECT p.doc_id, p.text, list_distinct(list(line_no)) AS gone FROM p JOIN r USING (t) WHERE p.doc_id > r.lo GROUP BY p.doc_id, p.text)
SELECT d.doc_id,
  CASE WHEN g.gone IS NULL THEN d.text ELSE array_to_string(list_transform(list_filter(range(len(string_split(d.text, chr(10)))), lambda i: NOT list_contains(g.gone, i)), lambda i: string_split(d.text, chr(10))[i + 1]), chr(10)) END AS text,
  coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines, coalesce(len(g.gone), 0)::BIGINT AS n_dropped
FROM documents d LEFT JOIN g ON g.doc_id = d.doc_id AND g.text = d.text
"""

"""Queries of the refinement operators."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from timeloom.functions import spans, text
from timeloom.operators import align, refine
from timeloom.operators.components import connected_components

from .registry import query, read


def _sentences(spark, sf_dir):
    """The sentences of each assistant turn in an array."""
    c = read(spark, sf_dir, "conversations").filter("role <> 'user' AND text IS NOT NULL")
    return c.select("conv_id", "turn", F.filter(F.split("text", r"(?<=[.?!])\s+"), lambda x: F.trim(x) != "").alias("spans"))


@query()
def usable_spans(spark, sf_dir):
    """The run of sentences that the middle of a turn stands for."""
    s = _sentences(spark, sf_dir).withColumn("row", F.array_join(F.slice("spans", 2, 2), " "))
    return s.select("conv_id", "turn", refine.usable_spans_of("row", "spans").alias("s")).select("conv_id", "turn", "s.*")


@query()
def usable_words(spark, sf_dir):
    """The words of every sentence between words that aren't in the script."""
    s = _sentences(spark, sf_dir).select("conv_id", "turn", F.posexplode("spans").alias("part", "ref"))
    noise = F.array(*[F.lit(w) for w in ("zzz", "qqq", "xxx")])
    tokens = F.concat(noise, F.split("ref", r"\s+"), noise)
    return s.select("conv_id", "turn", "part", refine.usable_words_of(tokens, "ref").alias("s")).select("conv_id", "turn", "part", "s.*")


@query()
def validated_takes(spark, sf_dir):
    """Roles of the repeated turns of conversations, judged by their assistant turns' sentences."""
    c = read(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"))
    rank = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "text")).cast("long")
    rows = c.select("conv_id", rank.alias("rank"), "text")
    twice = rows.select("conv_id", (F.col("rank") * 2).alias("rank"), "text").unionByName(rows.filter("rank % 2 = 1").select("conv_id", (F.col("rank") * 2 + 1).alias("rank"), "text"))
    links = align.repetition_links(twice, ["conv_id"], "rank", "text")
    node = lambda x: F.concat_ws(":", F.col("conv_id").cast("string"), F.col(x).cast("string"))
    groups = connected_components(links.select(F.xxhash64(node("left_no")).alias("a"), F.xxhash64(node("right_no")).alias("b")), "a", "b")
    takes = twice.withColumn("node", F.xxhash64(node("rank"))).join(groups, "node").select("conv_id", F.col("component").alias("repeat"), "rank", "text", text.normalize(F.col("text")).alias("phrase"))
    refs = _sentences(spark, sf_dir).select("conv_id", F.posexplode("spans").alias("part", "text"), "turn").select("conv_id", (F.col("turn") * 1000 + F.col("part")).alias("ref_no"), "text")
    return refine.validated_takes(takes, refs, ["conv_id"], "repeat", "rank", "text", "phrase").drop("repeat")


_NORM = "trim(regexp_replace(lower(strip_accents(coalesce({0}, ''))), '[^a-z0-9]+', ' ', 'g'))"
_TURN = f"""c AS (SELECT conv_id, turn, [x FOR x IN string_split({_NORM.format('text')}, ' ') IF x <> ''] AS t FROM conversations WHERE role <> 'user' AND text IS NOT NULL)"""


@query(f"""WITH RECURSIVE {_TURN}, g AS (SELECT conv_id, turn, t, [t[k] FOR k IN range(1, len(t) + 1, 3)] AS target FROM c),
m AS (SELECT conv_id, turn, t, target, 0 AS i, 0 AS used, []::INT[] AS hits FROM g UNION ALL SELECT conv_id, turn, t, target, i + 1, CASE WHEN t[i + 1] = target[used + 1] THEN used + 1 ELSE used END, CASE WHEN t[i + 1] = target[used + 1] THEN list_append(hits, i) ELSE hits END FROM m WHERE i < len(t))
SELECT conv_id, turn, CASE WHEN used = len(target) AND used > 0 THEN hits ELSE [] END AS "at" FROM m WHERE i = len(t)""")
def ordered_matches(spark, sf_dir):
    """Words of a turn that use up every third of its words in order."""
    c = read(spark, sf_dir, "conversations").filter("role <> 'user' AND text IS NOT NULL")
    s = c.select("conv_id", "turn", text.tokenize(F.col("text")).alias("t"))
    s = s.select("conv_id", "turn", F.transform("t", lambda x: F.array(x)).alias("groups"), F.filter("t", lambda x, i: i % 3 == 0).alias("target"))
    return s.select("conv_id", "turn", refine.ordered_matches("groups", "target").alias("at"))


@query()
def quote_groups(spark, sf_dir):
    """Groups of like sentences in a turn."""
    return _sentences(spark, sf_dir).select("conv_id", "turn", refine.quote_groups_of("spans").alias("heads"))


_D = """d AS (SELECT doc_id, source, coalesce(text, '') AS t, lang, CASE WHEN doc_id % 3 = 0 THEN row_number() OVER (PARTITION BY source ORDER BY doc_id) * 2 END AS ref_first FROM documents),
r AS (SELECT *, ref_first + doc_id % 2 AS ref_last, length(regexp_replace(t, '[^A-Za-zÀ-ɏ]', '', 'g')) AS latin, length(regexp_replace(t, '[^0-9A-Za-zÀ-ɏ]', '', 'g')) AS letters FROM d)"""


@query(f"""WITH {_D}, b AS (SELECT *, coalesce(last_value(ref_last IGNORE NULLS) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1, 0) AS low,
 coalesce(first_value(ref_first IGNORE NULLS) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) - 1, 39) AS high FROM r),
u AS (SELECT DISTINCT source, unnest(range(ref_first, ref_last + 1)) AS ref FROM r WHERE ref_first IS NOT NULL),
w AS (SELECT doc_id, source, unnest(range(low, high + 1)) AS ref FROM b WHERE ref_first IS NULL), f AS (SELECT DISTINCT doc_id FROM w WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.source = w.source AND u.ref = w.ref))
SELECT doc_id, CASE WHEN ref_first IS NOT NULL THEN NULL WHEN letters >= 1 AND latin < 0.45 * letters THEN 'OFF_SCRIPT' WHEN lang <> 'en' AND doc_id % 4 = 1 AND letters >= 4 THEN 'OFF_LANGUAGE' WHEN doc_id NOT IN (SELECT doc_id FROM f) THEN 'NO_REFERENCE_COVERED' END AS reason FROM b""")
def row_cleanup(spark, sf_dir):
    """Reasons to drop unmatched documents of a source, some of which are given spans."""
    d = read(spark, sf_dir, "documents")
    no = F.row_number().over(Window.partitionBy("source").orderBy("doc_id")) * 2
    t = F.coalesce("text", F.lit(""))
    size = lambda p: F.length(F.regexp_replace(t, p, ""))
    d = d.withColumn("ref_first", F.when(F.col("doc_id") % 3 == 0, no).cast("long")).withColumn("ref_last", F.col("ref_first") + F.col("doc_id") % 2)
    latin, letters = size("[^A-Za-zÀ-ɏ]"), size("[^0-9A-Za-zÀ-ɏ]")
    shared = F.when(F.col("doc_id") % 4 == 1, 0).otherwise(1)
    out = refine.cleaned(d, ["source"], "doc_id", F.lit(40).cast("long"), F.when(letters > 0, latin / letters), letters, F.col("lang"), F.lit("en"), shared)
    return out.select("doc_id", "reason")


@query("""WITH r AS (SELECT o_custkey, o_custkey % 2 AS grp, o_orderkey, o_orderkey % 3 AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n, count(*) OVER (PARTITION BY o_custkey) AS m FROM orders),
x AS (SELECT *, CASE WHEN n <> 1 + o_custkey % 4 THEN n END AS ref FROM r), b AS (SELECT o_custkey, grp, count(*) FILTER (ref IS NULL) AS bare, max(o_orderkey) FILTER (ref IS NULL) AS o_orderkey, max(m) AS last FROM x GROUP BY o_custkey, grp),
w AS (SELECT b.o_custkey, grp, o_orderkey, unnest(range(1, last + 2)) AS ref FROM b WHERE bare = 1), l AS (SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.o_custkey = w.o_custkey AND x.ref = w.ref)),
f AS (SELECT o_custkey, o_orderkey, min(ref) AS a, max(ref) AS b FROM l GROUP BY o_custkey, o_orderkey HAVING max(ref) - min(ref) + 1 = count(*))
SELECT x.o_orderkey, f.a AS fill_first, f.b AS fill_last FROM x LEFT JOIN f ON f.o_custkey = x.o_custkey AND f.o_orderkey = x.o_orderkey""")
def suffix_backfill(spark, sf_dir):
    """Orders of a customer as a suffix that stands for one span more than they have."""
    w = Window.partitionBy("o_custkey")
    n = F.row_number().over(w.orderBy("o_orderkey")).cast("long")
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", (F.col("o_custkey") % 2).alias("grp"), n.alias("n"), F.lit(1).cast("long").alias("span_first"), (F.count("*").over(w) + 1).alias("span_last"))
    rows = o.withColumn("ref_first", F.when(F.col("n") != 1 + F.col("o_custkey") % 4, F.col("n"))).withColumn("ref_last", F.col("ref_first"))
    return refine.backfilled(rows, ["o_custkey"], "grp", "o_orderkey").select("o_orderkey", "fill_first", "fill_last")


@query()
def script_spans(spark, sf_dir):
    """Spans of the assistant turns' lines with their places."""
    c = read(spark, sf_dir, "conversations").filter("role <> 'user' AND text IS NOT NULL")
    lines = c.select("conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.select("conv_id", "turn", "line_no", F.posexplode(spans.script_spans("line")).alias("span_no", "s")).select("conv_id", "turn", "line_no", "span_no", "s.*")


@query("SELECT event_id, CASE WHEN event_id % 6 < 5 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k, CASE WHEN event_id % 6 = 3 THEN 'a' || chr(10) || 'b' END AS note FROM events")
def repaired_json(spark, sf_dir):
    """A field read from JSON cells damaged in six ways, the last beyond repair."""
    p, k = F.col("props"), F.col("event_id") % 6
    body = F.expr("substring(props, 1, length(props) - 1)")
    raw = (
        F.when(k == 0, p).when(k == 1, F.concat(F.lit("```json\nHere: "), p, F.lit(" done\n```"))).when(k == 2, F.concat(body, F.lit(",\n}")))
        .when(k == 3, F.concat(body, F.lit(', "note": "a\nb"}'))).when(k == 4, F.concat(body, F.lit(', "l": [{"x": 1}'))).otherwise("{k: 1")
    )
    fixed = F.from_json(spans.repair_json(raw), "k bigint, note string")
    return read(spark, sf_dir, "events").select("event_id", fixed.alias("j")).select("event_id", "j.*")

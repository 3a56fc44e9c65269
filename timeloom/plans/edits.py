"""Queries of the row rules and of joins by time, text, sets and signatures."""

from __future__ import annotations

from pyspark.sql import functions as F

from timeloom.functions import text
from timeloom.operators import joins, layout, rules, sessions
from timeloom.operators.lookup import first_by

from .registry import query, read
from .timeline import _E, _L, HOUR, events, shipments

_O = "o AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE '' END AS ref, CASE WHEN o_totalprice > 100000 THEN o_orderstatus ELSE ' ' END AS txt, CASE WHEN o_orderkey % 7 = 0 THEN 'x' ELSE '' END AS eliminated, CASE WHEN o_orderkey % 5 = 0 THEN 'Unmatched row' ELSE 'MATCH' END AS status, o_orderdate FROM orders)"
_KEPT = "(ref <> '' AND trim(txt) <> '' AND eliminated = '' AND status NOT LIKE 'Unmatched%')"


def _rows(spark, sf_dir):
    """Orders as rows: a reference where filled, a text where large, some eliminated, some unmatched."""
    k = F.col("o_orderkey")
    return read(spark, sf_dir, "orders").select(
        k, "o_custkey", F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).otherwise("").alias("ref"), F.when(F.col("o_totalprice") > 100000, F.col("o_orderstatus")).otherwise(" ").alias("txt"),
        F.when(k % 7 == 0, "x").otherwise("").alias("eliminated"), F.when(k % 5 == 0, "Unmatched row").otherwise("MATCH").alias("status"), "o_orderdate",
    )


def _kept():
    return rules.kept_row(F.col("ref"), F.col("txt"), F.col("eliminated"), F.col("status"))


@query(f"WITH {_O} SELECT o_orderkey, CASE WHEN ref <> '' AND trim(txt) <> '' THEN 'x' ELSE '' END AS ready, CASE WHEN ref = '' THEN 'x' ELSE '' END AS missing, {_KEPT} AS kept FROM o")
def keep_marks(spark, sf_dir):
    """Keep marks of both polarities and the predicate of kept rows."""
    r, t = F.col("ref"), F.col("txt")
    return _rows(spark, sf_dir).select("o_orderkey", rules.keep_mark(r, t, "keep").alias("ready"), rules.keep_mark(r, t, "missing").alias("missing"), _kept().alias("kept"))


@query(f"WITH {_O} SELECT o_orderkey, CASE WHEN {_KEPT} THEN ref ELSE '' END AS ref, CASE WHEN {_KEPT} THEN status ELSE '' END AS status, '' AS txt, '' AS zoom FROM o")
def blank_and_reset(spark, sf_dir):
    """Tags emptied on rows that aren't kept; a column reset and one added."""
    return rules.reset_columns(rules.blank_unkept(_rows(spark, sf_dir), ["ref", "status"], _kept()), ["txt", "zoom"]).select("o_orderkey", "ref", "status", "txt", "zoom")


@query(f"WITH {_O}, g AS (SELECT count(*) > 0 AS a, count(*) FILTER ({_KEPT}) > 10 AS b, count(*) FILTER (ref = '') = 0 AS c FROM o) SELECT unnest(['rows', 'kept', 'complete']) AS gate, unnest([a, b, c]) AS passed FROM g")
def validation_gates(spark, sf_dir):
    """Which gates a stage's rows pass."""
    return rules.gates(_rows(spark, sf_dir), {"rows": F.count("*") > 0, "kept": F.count_if(_kept()) > 10, "complete": F.count_if(F.col("ref") == "") == 0})


@query(f"WITH {_O} SELECT o_custkey, coalesce(min(o_orderkey) FILTER ({_KEPT}), 0) AS first_kept FROM o GROUP BY o_custkey")
def first_kept_row(spark, sf_dir):
    """The first kept order of each customer, 0 where none is."""
    return rules.first_kept(_rows(spark, sf_dir), ["o_custkey"], "o_orderkey", _kept())


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS LAST, o_orderkey) AS r FROM orders) WHERE r <= 3")
def capped_rows(spark, sf_dir):
    """The first three orders of each customer, undated ones last."""
    return rules.capped(read(spark, sf_dir, "orders"), ["o_custkey"], [F.asc_nulls_last("o_orderdate"), "o_orderkey"], 3).select("o_custkey", "o_orderkey")


@query(f"""WITH {_E}, c AS (
 SELECT user_id, us AS "at", 0 AS tag_no, 'label' AS tag, event_type || ' x' AS cell FROM e WHERE event_type <> 'view'
 UNION ALL SELECT user_id, us + cents, 1, 'amount', cents::VARCHAR FROM e WHERE event_type = 'purchase'
 UNION ALL SELECT user_id, us, 2, 'intro', 'intro ' || event_type FROM e),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id, tag ORDER BY "at", cell) AS nth FROM c),
u AS (SELECT user_id, us AS "at", 2 AS used FROM e WHERE event_type = 'error')
SELECT n.user_id, n."at", tag, split_part(cell, ' ', 1) AS value, (row_number() OVER (PARTITION BY n.user_id, n."at" ORDER BY tag_no, cell) + coalesce(used, 0))::INT AS order_no
FROM n LEFT JOIN (SELECT DISTINCT * FROM u) u ON u.user_id = n.user_id AND u."at" = n."at" WHERE tag <> 'intro' OR nth = 1""")
def tag_events(spark, sf_dir):
    """Filled tag cells of events as events of their own, numbered behind what is there already."""
    e = events(spark, sf_dir)
    t = F.col("event_type")
    cells = e.select("user_id", F.col("us").alias("start"), (F.col("us") + F.col("cents")).alias("end"), F.when(t != "view", F.concat(t, F.lit(" x"))).alias("label"), F.when(t == "purchase", F.col("cents")).alias("amount"), F.concat(F.lit("intro "), t).alias("intro"))
    used = e.filter(t == "error").select("user_id", F.col("us").alias("at"), F.lit(2).alias("order_no"))
    return rules.tag_events(cells, ["user_id"], "start", "end", {"label": "start", "amount": "end", "intro": "start"}, ("intro",), used)


@query("""WITH m AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, min(l_linenumber) FILTER (l_returnflag = 'R') OVER w AS lo, max(l_linenumber) FILTER (l_returnflag = 'R') OVER w AS hi FROM lineitem WINDOW w AS (PARTITION BY l_orderkey))
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM m WHERE l_linenumber BETWEEN lo AND hi""")
def supported_window(spark, sf_dir):
    """Lines of an order between its first and last returned one."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag")
    return rules.supported_window(li, ["l_orderkey"], "l_linenumber", F.col("l_returnflag") == "R").drop("l_returnflag")


@query("""WITH w AS (SELECT DISTINCT p_partkey, word FROM (SELECT p_partkey, unnest(string_split(p_name || ' ' || p_type, ' ')) AS word FROM part))
SELECT lower(word) AS key, min_by(word, (p_partkey, word)) AS first_text, list(DISTINCT p_partkey ORDER BY p_partkey) AS "rows", count(DISTINCT p_partkey)::INT AS n_rows FROM w GROUP BY lower(word)""")
def occurrence_rollup(spark, sf_dir):
    """Words of part names with the parts that hold them."""
    p = read(spark, sf_dir, "part")
    words = p.select("p_partkey", F.explode(F.split(F.concat_ws(" ", "p_name", "p_type"), " ")).alias("word")).withColumn("key", F.lower("word"))
    return rules.occurrences(words, ["key"], "word", "p_partkey")


@query("""WITH v AS (SELECT o_orderkey, unnest([o_orderpriority, lower(o_orderpriority), o_orderstatus]) AS v, unnest([0, 1, 2]) AS no FROM orders),
k AS (SELECT *, lower(v) AS key, row_number() OVER (PARTITION BY o_orderkey, lower(v) ORDER BY no) AS r, row_number() OVER (PARTITION BY lower(v) ORDER BY o_orderkey, no) AS g FROM v)
SELECT o_orderkey, v AS value, g = 1 AS first_of_all FROM k WHERE r = 1""")
def distinct_entries(spark, sf_dir):
    """Values of a row once each ignoring case, and whether a value is the first of all rows."""
    v = read(spark, sf_dir, "orders").select("o_orderkey", F.posexplode(F.array("o_orderpriority", F.lower("o_orderpriority"), "o_orderstatus")).alias("no", "value")).withColumn("key", F.lower("value"))
    w = sessions._ordered(["key"], ["o_orderkey", "no"])
    return first_by(v.withColumn("first_of_all", F.row_number().over(w) == 1), ["o_orderkey", "key"], ["no"]).select("o_orderkey", "value", "first_of_all")


_CODE = "CASE event_type WHEN 'click' THEN 'Z1' WHEN 'view' THEN 'z2' WHEN 'purchase' THEN 'Z3' WHEN 'signup' THEN 'z' ELSE 'other' END"


@query(f"""WITH {_E}, c AS (SELECT user_id, event_id, lower({_CODE}) AS c, us FROM e),
n AS (SELECT *, lag(c) OVER w AS p1, lead(c) OVER w AS n1, lead(c, 2) OVER w AS n2 FROM c WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id))
SELECT event_id, CASE WHEN c = 'z1' AND n1 = 'z2' AND coalesce(n2, '') <> 'z3' THEN 1.15 WHEN c = 'z1' THEN 1.11 WHEN c = 'z2' AND p1 = 'z1' AND coalesce(n1, '') <> 'z3' THEN 1.30 WHEN c = 'z2' THEN 1.26 WHEN c = 'z3' THEN 1.38 ELSE 1.25 END::DOUBLE AS scale FROM n""")
def zoom_scales(spark, sf_dir):
    """Scales of zoom codes by the sequence they stand in."""
    t = F.col("event_type")
    code = F.when(t == "click", "Z1").when(t == "view", "z2").when(t == "purchase", "Z3").when(t == "signup", "z").otherwise("other")
    return rules.scale_of_sequence(events(spark, sf_dir).withColumn("code", code), ["user_id"], ["us", "event_id"], "code").select("event_id", "scale")


@query(f"""WITH {_E}, o AS (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) <= {12 * HOUR} THEN 0 ELSE 1 END AS o FROM e),
k AS (SELECT *, sum(o) OVER (PARTITION BY user_id ORDER BY us, event_id) AS cl FROM o)
SELECT event_id, CASE WHEN count(*) OVER (PARTITION BY user_id, cl) = 1 THEN 'Z' ELSE 'Z' || least(row_number() OVER (PARTITION BY user_id, cl ORDER BY us, event_id), 3) END AS level FROM k""")
def chain_levels(spark, sf_dir):
    """Levels by rank in chains of events twelve hours apart at most."""
    keys, order = ["user_id"], ["us", "event_id"]
    near = F.col("us") - sessions.previous("us", keys, order) <= 12 * HOUR
    return rules.cluster_ranks(sessions.chain_clusters(events(spark, sf_dir), keys, near, order), keys, "cluster", order).select("event_id", "level")


@query(f"""WITH {_E}, n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) AS pos FROM e),
c AS (SELECT *, CASE WHEN pos - lag(pos) OVER w <= 2 OR us - lag(us) OVER w <= {6 * HOUR} THEN 0 ELSE 1 END AS o FROM n WHERE event_type IN ('purchase', 'signup') WINDOW w AS (PARTITION BY user_id ORDER BY pos)),
k AS (SELECT *, sum(o) OVER (PARTITION BY user_id ORDER BY pos) AS cl FROM c)
SELECT user_id, event_id, cents FROM (SELECT *, row_number() OVER (PARTITION BY user_id, cl ORDER BY cents DESC, pos) AS r FROM k) WHERE r = 1""")
def row_or_time_chains(spark, sf_dir):
    """The best goal of each chain of goals that are two rows or six hours apart at most."""
    keys = ["user_id"]
    pos = F.row_number().over(sessions._ordered(keys, ["us", "event_id"]))
    goals = events(spark, sf_dir).withColumn("pos", pos).filter("event_type IN ('purchase', 'signup')")
    near = (F.col("pos") - sessions.previous("pos", keys, ["pos"]) <= 2) | (F.col("us") - sessions.previous("us", keys, ["pos"]) <= 6 * HOUR)
    chained = sessions.chain_clusters(goals, keys, near, ["pos"])
    return first_by(chained, [*keys, "cluster"], [F.desc("cents"), "pos"]).select("user_id", "event_id", "cents")


# ------------------------------------------------------------------------------------------------- joins
@query(f"""WITH {_L}, a AS (SELECT * FROM l WHERE l_returnflag = 'R'), b AS (SELECT l_orderkey, l_linenumber, l_partkey, s, s + (e - s) % 3 AS e FROM l WHERE l_returnflag <> 'R')
SELECT a.l_orderkey AS l_order, a.l_linenumber AS l_line, b.l_orderkey AS r_order, b.l_linenumber AS r_line FROM a JOIN b USING (l_partkey)
WHERE greatest(a.s, b.s) < least(a.e, b.e) OR (b.s + b.e) / 2.0 BETWEEN a.s AND a.e""")
def overlap_or_midpoint(spark, sf_dir):
    """Returned shipments of a part with the short others that overlap them or have their middle in them."""
    s = shipments(spark, sf_dir)
    a = s.filter("l_returnflag = 'R'").select("l_partkey", F.col("l_orderkey").alias("l_order"), F.col("l_linenumber").alias("l_line"), F.col("start").alias("l_start"), F.col("end").alias("l_end"))
    b = s.filter("l_returnflag <> 'R'").select("l_partkey", F.col("l_orderkey").alias("r_order"), F.col("l_linenumber").alias("r_line"), F.col("start").alias("r_start"), (F.col("start") + (F.col("end") - F.col("start")) % 3).alias("r_end"))
    return joins.overlap_or_midpoint(a, b, ["l_partkey"], 30).select("l_order", "l_line", "r_order", "r_line")


_NORM = "trim(regexp_replace(lower(strip_accents(coalesce({0}, ''))), '[^a-z0-9]+', ' ', 'g'))"


@query(f"""WITH t AS (SELECT conv_id, turn, role, {_NORM.format("text")} AS n FROM conversations),
p AS (SELECT a.conv_id, a.turn, b.turn AS other, a.n AS x, b.n AS y, list_distinct(string_split(a.n, ' ')) AS wa, list_distinct(string_split(b.n, ' ')) AS wb FROM t a JOIN t b ON a.conv_id = b.conv_id AND a.role = 'user' AND b.role <> 'user' WHERE a.n <> '' AND b.n <> '')
SELECT conv_id, turn, other FROM p WHERE contains(x, y) OR contains(y, x) OR len(list_intersect(wa, wb)) >= greatest(3, least(len(wa), len(wb)) // 2)""")
def substring_pairs(spark, sf_dir):
    """User turns with the assistant turns that hold them, lie in them or share words with them."""
    c = read(spark, sf_dir, "conversations").withColumn("n", text.normalize(F.col("text")))
    a = c.filter("role = 'user'").select("conv_id", "turn", F.col("n").alias("x"))
    b = c.filter("role <> 'user'").select("conv_id", F.col("turn").alias("other"), F.col("n").alias("y"))
    return joins.substring_pairs(a, b, ["conv_id"], "x", "y").select("conv_id", "turn", "other")


_SPANS = """c AS (SELECT conv_id, turn, text, coalesce(sum(length(text) + 1) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s FROM conversations WHERE text <> ''),
sp AS (SELECT conv_id, turn, text, s, s + length(text) AS e FROM c)"""


def _located(spark, sf_dir):
    """Turns found one after the other in the text of their conversation."""
    from timeloom.operators import align

    c = first_by(read(spark, sf_dir, "conversations").filter("text <> ''"), ["conv_id", "turn"], ["text"])
    whole = c.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), "\n").alias("whole"))
    return align.locate_in_order(c.select("conv_id", "turn", "text"), whole, ["conv_id"], "turn", "text", "whole")


@query(f'WITH {_SPANS} SELECT conv_id, turn, s::INT AS "at" FROM sp')
def locate_turns(spark, sf_dir):
    """Where each turn stands in the text of its conversation."""
    return _located(spark, sf_dir).select("conv_id", "turn", "at")


@query(f"""WITH {_SPANS}, f AS (SELECT conv_id, unnest(range(0, max(e) + 200, 97)) AS off FROM sp GROUP BY conv_id)
SELECT f.conv_id, off, coalesce((SELECT turn FROM sp WHERE sp.conv_id = f.conv_id AND s <= off AND off < e), (SELECT min_by(turn, s) FROM sp WHERE sp.conv_id = f.conv_id AND s >= off), (SELECT max_by(turn, e) FROM sp WHERE sp.conv_id = f.conv_id AND e <= off)) AS turn FROM f""")
def features_to_rows(spark, sf_dir):
    """Offsets in a conversation's text mapped to their turn, else the next one, else the one before."""
    sp = _located(spark, sf_dir).select("conv_id", "turn", F.col("at").cast("long").alias("s"), (F.col("at") + F.length("text")).cast("long").alias("e"))
    f = sp.groupBy("conv_id").agg(F.max("e").alias("m")).select("conv_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") + 199, F.lit(97).cast("long"))).alias("off"))
    return joins.rows_of_offsets(f, sp, ["conv_id"], "off", "s", "e", "turn")


@query(f"""WITH {_L.replace('l_returnflag, datediff', 'l_returnflag, l_linestatus, datediff', 1)}
SELECT l_orderkey, l_linenumber FROM l a WHERE NOT (l_linestatus = 'O' AND EXISTS (SELECT 1 FROM l b WHERE b.l_linestatus = 'F' AND b.l_partkey % 20 = a.l_partkey % 20 AND b.s % 50 = a.s % 50 AND b.e - b.s = a.e - a.s))""")
def companion_suppression(spark, sf_dir):
    """Open lines without a finished twin of the same group, place and length."""
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date"))
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus", (F.col("l_partkey") % 20).alias("grp"), (day % 50).cast("double").alias("start"), F.floor("l_quantity").cast("double").alias("length"))
    return joins.without_companions(li, ["grp"], F.col("l_linestatus") == "O", F.col("l_linestatus") == "F", "start", "length").select("l_orderkey", "l_linenumber")


@query("""WITH g AS (SELECT s_nationkey AS grp, s_suppkey FROM supplier WHERE s_suppkey % 2 = 0)
SELECT o_orderkey, (SELECT min(grp) FROM lineitem JOIN g ON l_suppkey = s_suppkey WHERE l_orderkey = o_orderkey) AS grp FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""")
def first_overlapping_group(spark, sf_dir):
    """The first nation of even suppliers that delivers to an order."""
    rows = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_set("l_suppkey").alias("members"))
    groups = read(spark, sf_dir, "supplier").filter("s_suppkey % 2 = 0").groupBy(F.col("s_nationkey").alias("grp")).agg(F.collect_set("s_suppkey").alias("members"))
    rows = rows.join(read(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", "left_semi")
    return joins.first_overlapping_group(rows, groups, "o_orderkey", "grp", "members").select("o_orderkey", "grp")


@query("""WITH c AS (SELECT c_custkey, unnest(range(0, 7)) AS pos FROM customer), h AS (SELECT c_custkey, min_by(o_custkey, pos) AS o_custkey FROM c JOIN orders ON o_orderkey = c_custkey * 3 + pos WHERE o_totalprice > 200000 GROUP BY c_custkey)
SELECT customer.c_custkey, o_custkey AS found FROM customer LEFT JOIN h ON h.c_custkey = customer.c_custkey""")
def first_valid_listed(spark, sf_dir):
    """The first of seven listed orders of a customer that is large, by its buyer."""
    c = read(spark, sf_dir, "customer").select("c_custkey", F.sequence(F.col("c_custkey") * 3, F.col("c_custkey") * 3 + 6).alias("listed"))
    o = read(spark, sf_dir, "orders").filter("o_totalprice > 200000").select(F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("found"))
    return joins.first_valid(c, "c_custkey", "listed", o, "key", "found").select("c_custkey", "found")


@query(f"""WITH {_E} SELECT event_id FROM e a WHERE event_type = 'error' AND NOT EXISTS (SELECT 1 FROM e b WHERE b.event_type = 'purchase' AND b.user_id = a.user_id AND b.us // {HOUR} = a.us // {HOUR})""")
def new_by_signature(spark, sf_dir):
    """Errors in hours in which their user bought nothing."""
    e = events(spark, sf_dir)
    signature = {"s_user": F.col("user_id"), "s_hour": F.floor(F.col("us") / HOUR)}
    return joins.new_by_signature(e.filter("event_type = 'error'"), e.filter("event_type = 'purchase'"), signature).select("event_id")


_DAY = 24 * HOUR
_TAKES = f"""{_E}, z AS (SELECT user_id, min(us) AS t0, max(us) - min(us) + {_DAY} AS len FROM e GROUP BY user_id),
m AS (SELECT user_id, event_type, us - t0 AS s, us - t0 + cents * 10000 AS t, len FROM e JOIN z USING (user_id) WHERE event_type IN ('purchase', 'error')),
b AS (SELECT *, coalesce(lag(least(t + {HOUR}, len)) OVER (PARTITION BY user_id ORDER BY s, t), 0) AS c FROM m),
sg AS (SELECT user_id, c AS s, greatest(c, s) AS e, event_type = 'purchase' AS keep, event_type AS marker FROM b
 UNION ALL SELECT user_id, max_by(least(t + {HOUR}, len), (s, t)), max(len), true, 'tail' FROM m GROUP BY user_id),
sk AS (SELECT * FROM sg WHERE e - s >= {2 * HOUR})"""


def _takes(spark, sf_dir):
    """(events on their user's own clock, take segments between purchases and errors)."""
    e = layout.shift_to_zero(events(spark, sf_dir), ["user_id"], "us").withColumn("start", F.col("zeroed").cast("long"))
    e = e.withColumns({"end": F.col("start") + F.col("cents") * 10_000, "len": F.max("start").over(sessions.Window.partitionBy("user_id")) + _DAY})
    markers = e.filter("event_type IN ('purchase', 'error')")
    return e, joins.take_segments(markers, ["user_id"], "start", "end", "event_type", F.col("len"), "purchase", HOUR, 2 * HOUR)


@query(f"""WITH {_TAKES} SELECT user_id, s::BIGINT AS start, e::BIGINT AS "end", keep, marker FROM sk""")
def take_segments(spark, sf_dir):
    """Pieces of a user's time between purchases and errors; those before a purchase and the tail are kept."""
    return _takes(spark, sf_dir)[1].select("user_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "keep", "marker")


@query(f"""WITH {_TAKES}, p AS (SELECT event_id, user_id, us - t0 AS s, us - t0 + cents * 10000 AS t FROM e JOIN z USING (user_id)),
d AS (SELECT p.*, (SELECT min_by({{'s': sk.s, 'e': sk.e, 'k': sk.keep}}, sk.e) FROM sk WHERE sk.user_id = p.user_id AND sk.e > p.s) AS g, EXISTS (SELECT 1 FROM sk WHERE sk.user_id = p.user_id) AS has FROM p)
SELECT event_id FROM d WHERE NOT has OR (g.k AND t > g.s AND s < g.e)""")
def kept_takes(spark, sf_dir):
    """Events in kept takes."""
    e, segments = _takes(spark, sf_dir)
    return joins.in_kept_segments(e.select("event_id", "user_id", "start", "end"), segments, ["user_id"], "start", "end").select("event_id")


@query(f"""WITH {_TAKES}, g AS (SELECT user_id, s AS tl_start, e AS tl_end, s * 2 + 5 AS src FROM sk WHERE keep),
f AS (SELECT user_id, min_by(src, tl_start) AS src0, max_by(tl_start, tl_start) AS ls, max_by(tl_end, tl_start) AS le, max_by(src, tl_start) AS lsrc FROM g GROUP BY user_id),
p AS (SELECT event_id, user_id, us - t0 AS t FROM e JOIN z USING (user_id))
SELECT event_id, coalesce((SELECT min_by(src + t - tl_start, tl_start) FROM g WHERE g.user_id = p.user_id AND t BETWEEN tl_start AND tl_end), CASE WHEN t > le THEN lsrc + t - ls END, src0, t)::BIGINT AS source FROM p LEFT JOIN f USING (user_id)""")
def timeline_to_source(spark, sf_dir):
    """Times of events on a source clock, by the kept takes."""
    e, segments = _takes(spark, sf_dir)
    g = segments.filter("keep").select("user_id", F.col("start").alias("tl_start"), F.col("end").alias("tl_end"), (F.col("start") * 2 + 5).alias("src_start"))
    return joins.source_of(e.select("event_id", "user_id", "start"), g, ["user_id"], "start").select("event_id", F.col("source").cast("long").alias("source"))


@query(f"""WITH {_E}, b AS (SELECT DISTINCT user_id, us FROM e WHERE event_type = 'purchase')
SELECT event_id, coalesce((SELECT max(us) FROM b WHERE b.user_id = e.user_id AND b.us <= e.us), (SELECT min(us) FROM b WHERE b.user_id = e.user_id), e.us) AS snap_before,
 coalesce((SELECT min(us) FROM b WHERE b.user_id = e.user_id AND b.us >= e.us), (SELECT max(us) FROM b WHERE b.user_id = e.user_id), e.us) AS snap_after,
 coalesce((SELECT min_by(us, (abs(us - e.us), us)) FROM b WHERE b.user_id = e.user_id), e.us) AS snap_nearest FROM e""")
def boundary_snap(spark, sf_dir):
    """Times of events snapped to their user's purchases."""
    e = events(spark, sf_dir)
    b = e.filter("event_type = 'purchase'").select("user_id", F.col("us").alias("b"))
    return joins.snapped(e.select("event_id", "user_id", "us"), b, ["user_id"], "us", "b").select("event_id", "snap_before", "snap_after", "snap_nearest")


@query(f"""WITH {_E}, c AS (SELECT user_id AS clip, min(us) // 1000000 AS s, max(us) // 1000000 AS t FROM e WHERE user_id % 10 < 4 GROUP BY user_id),
own AS (SELECT user_id AS clip, 'own ' || event_id AS word, us // 1000000 AS a, us // 1000000 + 5 AS b FROM e WHERE event_type = 'click' AND user_id % 10 IN (1, 2)),
sh AS (SELECT 'shared ' || event_id AS word, us // 1000000 AS a, us // 1000000 + cents % 3 AS b FROM e WHERE event_type = 'signup' AND event_id % 20 = 0)
SELECT clip, word, a AS start, b AS "end", 'local' AS resolution FROM own JOIN c USING (clip)
UNION ALL SELECT clip, word, greatest(a, s), greatest(greatest(a, s), b), 'shared_words' FROM c, sh WHERE clip NOT IN (SELECT clip FROM own) AND (greatest(a, s) < least(b, t) OR (a + b) / 2.0 BETWEEN s AND t)""")
def stitched_words(spark, sf_dir):
    """Clicks of users as words of their clips; clips without any take the signups in them."""
    e = events(spark, sf_dir).withColumn("sec", F.floor(F.col("us") / 1_000_000))
    clips = e.filter("user_id % 10 < 4").groupBy(F.col("user_id").alias("clip")).agg(F.min("sec").alias("start"), F.max("sec").alias("end"))
    words = e.filter("event_type = 'click' AND user_id % 10 IN (1, 2)").select(F.col("user_id").alias("clip"), F.concat(F.lit("own "), F.col("event_id").cast("string")).alias("word"), "sec").join(clips, "clip")
    local = words.select("clip", "word", (F.col("sec") - F.col("start")).alias("start"), (F.col("sec") - F.col("start") + 5).alias("end"))
    shared = e.filter("event_type = 'signup' AND event_id % 20 = 0").select(F.concat(F.lit("shared "), F.col("event_id").cast("string")).alias("word"), F.col("sec").alias("start"), (F.col("sec") + F.col("cents") % 3).alias("end"))
    return joins.stitched(clips, local, shared, "clip", 86_400)

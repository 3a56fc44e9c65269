"""Queries of the lookup, aggregation and row-rule operators."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from timeloom.functions import cells, timecode
from timeloom.operators import lookup, sessions

from .registry import query, read
from .timeline import _E, HOUR, events


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def semi_keep(spark, sf_dir):
    """Orders of the customers of one segment."""
    c = read(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(c, "o_custkey", "left_semi").select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey, c_name, n_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey")
def left_lookup(spark, sf_dir):
    """Orders with their customer and nation."""
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", F.col("c_nationkey").alias("n_nationkey"))
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(c, "o_custkey", "left").join(n, "n_nationkey", "left").select("o_orderkey", "c_name", "n_name")


@query("""WITH c AS (SELECT c_nationkey AS k, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS pos FROM customer),
s AS (SELECT s_nationkey AS k, s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS pos FROM supplier)
SELECT k AS nation, pos, c_custkey, s_suppkey FROM c JOIN s USING (k, pos)""")
def positional_join(spark, sf_dir):
    """The n-th customer of a nation beside its n-th supplier."""
    place = lambda df, key, col: df.select(F.col(key).alias("nation"), F.col(col), F.row_number().over(Window.partitionBy(key).orderBy(col)).alias("pos"))
    c = place(read(spark, sf_dir, "customer"), "c_nationkey", "c_custkey")
    s = place(read(spark, sf_dir, "supplier"), "s_nationkey", "s_suppkey")
    return c.join(s, ["nation", "pos"]).select("nation", "pos", "c_custkey", "s_suppkey")


@query("""SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, 'base' AS origin FROM orders WHERE o_orderpriority <> '1-URGENT'
UNION ALL SELECT o_orderkey, CAST(round(o_totalprice * 200) AS BIGINT), 'override' FROM orders WHERE o_orderpriority = '1-URGENT'""")
def anti_override_union(spark, sf_dir):
    """Orders, the urgent ones replaced by their override rows."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    base = o.select("o_orderkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"), F.lit("base").alias("origin"))
    newer = o.filter("o_orderpriority = '1-URGENT'").select("o_orderkey", F.round(F.col("o_totalprice") * 200).cast("long").alias("cents"), F.lit("override").alias("origin"))
    return lookup.override(base, newer, "o_orderkey")


@query(f"""WITH {_E}, t AS (SELECT *, last_value(CASE WHEN event_type NOT IN ('click', 'error') THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS target FROM e),
g AS (SELECT event_id FROM t WHERE event_type = 'error' UNION SELECT target FROM t WHERE event_type = 'error' AND target IS NOT NULL)
SELECT event_id, event_type FROM e WHERE event_id NOT IN (SELECT event_id FROM g)""")
def zap_previous(spark, sf_dir):
    """An error drops itself and the user's previous event that isn't a click."""
    is_ = lambda t: F.col("event_type") == t
    return lookup.drop_with_previous(events(spark, sf_dir), ["user_id"], is_("error"), is_("click"), ["us", "event_id"], "event_id").select("event_id", "event_type")


@query("""WITH t AS (SELECT event_id, 1 AS tier, 'order:' || o_orderpriority AS source FROM events JOIN orders ON o_orderkey = event_id AND event_type = 'purchase'
 UNION ALL SELECT event_id, 2, 'customer:' || c_mktsegment FROM events JOIN customer ON c_custkey = user_id),
b AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY tier, source) AS r FROM t)
SELECT events.event_id, tier, source FROM events LEFT JOIN b ON b.event_id = events.event_id AND r = 1""")
def priority_cascade(spark, sf_dir):
    """The first source that knows an event: its order, else its customer."""
    e = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("event_id"), F.lit("purchase").alias("event_type"), F.concat(F.lit("order:"), "o_orderpriority").alias("source"))
    customers = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.concat(F.lit("customer:"), "c_mktsegment").alias("source"))
    return lookup.cascade(e, "event_id", [(orders, ["event_id", "event_type"]), (customers, ["user_id"])], "source", [F.col("source").alias("rank")]).select("event_id", "tier", "source")


@query("""SELECT o_orderkey, o_custkey, NULL AS issue FROM orders JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0
UNION ALL SELECT o_orderkey, o_custkey, 'missing_customer' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def join_with_issues(spark, sf_dir):
    """Orders joined with solvent customers; orders without one become issues."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = read(spark, sf_dir, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), F.lit(True).alias("present"))
    found, missed = lookup.with_issues(o, c, ["o_custkey"], "present", "missing_customer")
    return found.select("o_orderkey", "o_custkey", F.lit(None).cast("string").alias("issue")).unionByName(missed.select("o_orderkey", "o_custkey", "issue"))


@query(f"WITH {_E}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY us, event_id) AS r FROM e) SELECT user_id, event_type, event_id FROM r WHERE r = 1")
def dedupe_first(spark, sf_dir):
    """The first event of each user and type."""
    return lookup.first_by(events(spark, sf_dir), ["user_id", "event_type"], ["us", "event_id"]).select("user_id", "event_type", "event_id")


@query(f"""WITH {_E}, c AS (SELECT *, CASE WHEN us - lag(us) OVER w <= {30 * HOUR} THEN 0 ELSE 1 END AS o FROM e WINDOW w AS (PARTITION BY user_id, event_type ORDER BY us, event_id)),
k AS (SELECT *, sum(o) OVER (PARTITION BY user_id, event_type ORDER BY us, event_id) AS cl FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, cl ORDER BY cents DESC, us, event_id) AS r FROM k)
SELECT user_id, event_type, event_id, cents FROM r WHERE r = 1""")
def cluster_keep_best(spark, sf_dir):
    """The best event of each chain with steps of thirty hours at most."""
    keys, order = ["user_id", "event_type"], ["us", "event_id"]
    near = F.col("us") - sessions.previous("us", keys, order) <= 30 * HOUR
    chained = sessions.chain_clusters(events(spark, sf_dir), keys, near, order)
    return lookup.first_by(chained, [*keys, "cluster"], [F.desc("cents"), "us", "event_id"]).select("user_id", "event_type", "event_id", "cents")


@query(f"""WITH {_E}, s AS (SELECT *, max(us) OVER (PARTITION BY user_id) AS last, min(us) OVER (PARTITION BY user_id) AS first FROM e)
SELECT event_id, CASE WHEN us > last - {24 * HOUR} THEN 'none' WHEN us > last - {72 * HOUR} THEN 'down' WHEN (us - first) * 100 BETWEEN 35 * (last - first) AND 70 * (last - first) THEN 'up' ELSE 'same' END AS bias FROM s""")
def zoom_bias_case(spark, sf_dir):
    """Bias of an event's level by its place in the user's time: near the end none or down, in the middle up."""
    w = Window.partitionBy("user_id")
    e = events(spark, sf_dir).withColumns({"last": F.max("us").over(w), "first": F.min("us").over(w)})
    part = (F.col("us") - F.col("first")) * 100
    whole = F.col("last") - F.col("first")
    bias = F.when(F.col("us") > F.col("last") - 24 * HOUR, "none").when(F.col("us") > F.col("last") - 72 * HOUR, "down").when(part.between(35 * whole, 70 * whole), "up").otherwise("same")
    return e.select("event_id", bias.alias("bias"))


@query(f"""WITH {_E} SELECT event_id, CASE WHEN event_type = 'error' AND cents > 10000 THEN 'severe' WHEN event_type = 'error' THEN 'mild' WHEN event_type IN ('purchase', 'signup') THEN 'goal' ELSE 'other' END AS class FROM e""")
def classify_priority(spark, sf_dir):
    """Ordered rules, the first that holds."""
    t = F.col("event_type")
    c = F.when((t == "error") & (F.col("cents") > 10000), "severe").when(t == "error", "mild").when(t.isin("purchase", "signup"), "goal").otherwise("other")
    return events(spark, sf_dir).select("event_id", c.alias("class"))


@query("""WITH c AS (SELECT o_orderkey, 0 AS column_no, 'status' AS "column", o_orderstatus || ' | ' || o_orderpriority AS cell FROM orders
 UNION ALL SELECT o_orderkey, 1, 'customer', o_custkey || '|' || (o_custkey % 7) || '| ' FROM orders),
v AS (SELECT o_orderkey, column_no, "column", list_filter(list_transform(string_split(cell, '|'), lambda x: trim(x)), lambda x: x <> '') AS vs FROM c)
SELECT o_orderkey, column_no, "column", unnest(range(len(vs)))::INT AS value_no, unnest(vs) AS value FROM v""")
def unpivot_annotations(spark, sf_dir):
    """Multi-value cells of two columns as rows."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.concat_ws(" | ", "o_orderstatus", "o_orderpriority").alias("status"), F.concat(F.col("o_custkey").cast("string"), F.lit("|"), (F.col("o_custkey") % 7).cast("string"), F.lit("| ")).alias("customer"))
    return lookup.unpivot_cells(o, ["o_orderkey"], ["status", "customer"])


@query("SELECT o_orderkey, o_orderstatus || ' | ' || o_orderpriority AS status, o_custkey || ' | ' || (o_custkey % 7) AS customer FROM orders")
def repivot_annotations(spark, sf_dir):
    """The cells joined again from their values."""
    return lookup.repivot_cells(unpivot_annotations(spark, sf_dir), ["o_orderkey"], ["status", "customer"])


@query(f"WITH {_E} SELECT count(*) AS n, count(*) FILTER (event_type = 'error') AS n_error, count(*) FILTER (event_type = 'purchase' AND cents > 5000) AS n_large, count(DISTINCT user_id) AS n_users, max(us) - min(us) AS span FROM e")
def stage_summary(spark, sf_dir):
    """Conditional counts of a stage."""
    e = events(spark, sf_dir)
    return e.agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("n_error"), F.count_if((F.col("event_type") == "purchase") & (F.col("cents") > 5000)).alias("n_large"), F.countDistinct("user_id").alias("n_users"), (F.max("us") - F.min("us")).alias("span"))


@query(f"WITH {_E} SELECT event_type, count(*) AS n, sum(cents)::BIGINT AS total, bool_and(cents > 0) AS all_positive, bool_or(cents > 50000) AS any_large FROM e GROUP BY event_type")
def count_by_type(spark, sf_dir):
    """Counts, totals and all/any flags per type."""
    return events(spark, sf_dir).groupBy("event_type").agg(F.count("*").alias("n"), F.sum("cents").alias("total"), F.bool_and(F.col("cents") > 0).alias("all_positive"), F.bool_or(F.col("cents") > 50000).alias("any_large"))


@query("SELECT l_returnflag, round(quantile_cont(l_quantity, 0.2), 6) AS low, round(quantile_cont(l_quantity, 0.98), 6) AS high FROM lineitem GROUP BY l_returnflag")
def percentile_threshold(spark, sf_dir):
    """Percentiles by linear interpolation."""
    p = lambda q: F.round(F.percentile("l_quantity", q), 6)
    return read(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(p(0.2).alias("low"), p(0.98).alias("high"))


@query("""WITH m AS (SELECT l_returnflag, median(l_quantity) AS med FROM lineitem GROUP BY l_returnflag)
SELECT l_returnflag, any_value(med) AS med, median(abs(l_quantity - med)) AS mad, count(*) FILTER (l_quantity > med + 20) AS n_above FROM lineitem JOIN m USING (l_returnflag) GROUP BY l_returnflag""")
def mad_threshold(spark, sf_dir):
    """Median, median absolute deviation and rows far above."""
    li = read(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity")
    m = li.groupBy("l_returnflag").agg(F.median("l_quantity").alias("med"))
    return li.join(m, "l_returnflag").groupBy("l_returnflag").agg(F.first("med").alias("med"), F.median(F.abs(F.col("l_quantity") - F.col("med"))).alias("mad"), F.count_if(F.col("l_quantity") > F.col("med") + 20).alias("n_above"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, sf_dir):
    """A field of the JSON cell."""
    return read(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("""SELECT event_id, 'type=' || event_type || ' | user=' || user_id AS notes, 'user=' || user_id AS without FROM events""")
def notes_map_roundtrip(spark, sf_dir):
    """A notes cell parsed, changed and written again."""
    e = read(spark, sf_dir, "events")
    cell = F.concat(F.lit(" user = 0 | type="), F.col("event_type"), F.lit("|junk | user="), F.col("user_id").cast("string"))
    return e.select("event_id", cells.render_notes(cells.parse_notes(cell)).alias("notes"), cells.set_note(cell, "type", F.lit("")).alias("without"))


_TC = "lpad(({0})::VARCHAR, 2, '0')"


@query(f"""WITH f AS (SELECT event_id, CAST(round_even(value * 30, 0) AS BIGINT) AS f FROM events)
SELECT event_id, {_TC.format('f // 108000')} || ':' || {_TC.format('f // 1800 % 60')} || ':' || {_TC.format('f // 30 % 60')} || ':' || {_TC.format('f % 30')} AS tc, f AS frames FROM f""")
def timecode_roundtrip(spark, sf_dir):
    """Seconds as timecode and back to frames."""
    e = read(spark, sf_dir, "events").select("event_id", timecode.seconds_to_timecode(F.col("value"), 30).alias("tc"))
    return e.withColumn("frames", timecode.timecode_frames(F.col("tc"), 30.0))


@query("""SELECT DISTINCT ON (l_orderkey, l_linenumber) l_orderkey, l_linenumber, l_returnflag FROM lineitem ORDER BY l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_returnflag""")
def top_by_order(spark, sf_dir):
    """The earliest shipment of each order line, by a total order."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate", "l_partkey", "l_suppkey")
    return lookup.first_by(li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_returnflag"]).select("l_orderkey", "l_linenumber", "l_returnflag")


@query("""SELECT o_custkey AS key FROM orders UNION SELECT c_custkey FROM customer EXCEPT SELECT s_suppkey FROM supplier""")
def set_operations(spark, sf_dir):
    """Distinct union less another set."""
    k = lambda t, c: read(spark, sf_dir, t).select(F.col(c).alias("key"))
    return k("orders", "o_custkey").union(k("customer", "c_custkey")).distinct().subtract(k("supplier", "s_suppkey"))


@query("""SELECT l_orderkey, list_first(list(l_linenumber ORDER BY l_shipdate, l_linenumber, l_partkey)) AS first_line, count(*) AS n, string_agg(DISTINCT l_returnflag, '' ORDER BY l_returnflag) AS flags FROM lineitem GROUP BY l_orderkey""")
def grouped_lists(spark, sf_dir):
    """Rows of an order gathered in time order."""
    li = read(spark, sf_dir, "lineitem")
    ordered = F.sort_array(F.collect_list(F.struct("l_shipdate", "l_linenumber", "l_partkey")))
    return li.groupBy("l_orderkey").agg(F.get(ordered, F.lit(0))["l_linenumber"].alias("first_line"), F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set("l_returnflag")), "").alias("flags"))

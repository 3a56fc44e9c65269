"""Queries of the session, interval, nearest and layout operators over events and lineitem."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from timeloom.operators import intervals, layout, nearest, sessions
from timeloom.operators.components import connected_components

from .registry import query, read

HOUR = 3_600_000_000


def events(spark, sf_dir: str) -> DataFrame:
    """Events with the time in microseconds and the value in cents."""
    return read(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), F.round(F.col("value") * 100).cast("long").alias("cents")
    )


def shipments(spark, sf_dir: str) -> DataFrame:
    """Line items as day intervals [start, end) by quantity."""
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", day.alias("start"), (day + F.col("l_quantity").cast("long")).alias("end"))


_E = "e AS (SELECT event_id, user_id, event_type, epoch_us(ts) AS us, CAST(round(value * 100) AS BIGINT) AS cents FROM events)"
_L = "l AS (SELECT l_orderkey, l_partkey, l_linenumber, l_returnflag, datediff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS s, datediff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) + CAST(l_quantity AS BIGINT) AS e FROM lineitem)"
_S = f"""WITH {_E},
p AS (SELECT *, us - lag(us) OVER w AS pause, lag(event_type) OVER w AS pt FROM e WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)),
n AS (SELECT *, sum(CASE WHEN pause IS NULL OR pause >= {8 * HOUR} OR (pt = 'error' AND pause >= {4 * HOUR}) THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY us, event_id) AS session FROM p),
g AS (SELECT user_id, session, min(us) AS s, max(us) AS t, count(*) AS n FROM n GROUP BY ALL),
q AS (SELECT user_id, session, lag(t) OVER (PARTITION BY user_id ORDER BY session) AS a, s AS b FROM g)"""


def _sessions(ev: DataFrame) -> DataFrame:
    return sessions.sessionize(ev, ["user_id"], "us", "us", 8 * HOUR, ["us", "event_id"], F.col("event_type") == "error", 4 * HOUR)


@query(_S + f""", b AS (SELECT user_id, session, 'speech' AS kind, s, t, n FROM g UNION ALL SELECT user_id, session, 'silence', a, b, 0 FROM q WHERE b - a >= {8 * HOUR})
SELECT user_id, kind, s AS start, t AS "end", n, row_number() OVER (PARTITION BY user_id ORDER BY session, kind)::INT AS row_no FROM b""")
def sessionize_gap_rows(spark, sf_dir):
    """Sessions by pauses, with the pauses as rows of their own."""
    return sessions.session_rows(_sessions(events(spark, sf_dir)), ["user_id"], "us", "us", 8 * HOUR).select("user_id", "kind", "start", "end", "n", "row_no")


@query(_S + f""", r AS (SELECT user_id, sum(b - a) AS removed_us, count(*) AS n_gaps FROM q WHERE b - a >= {8 * HOUR} GROUP BY user_id)
SELECT g.user_id, count(*) AS n_sessions, coalesce(any_value(n_gaps), 0) AS n_gaps, sum(t - s)::BIGINT AS busy_us, coalesce(any_value(removed_us), 0)::BIGINT AS removed_us,
  (max(t) - coalesce(any_value(removed_us), 0))::BIGINT AS compact_end FROM g LEFT JOIN r USING (user_id) GROUP BY g.user_id""")
def kept_time(spark, sf_dir):
    """Sessions, pauses and the end of each user's timeline once the pauses are taken out."""
    spans = sessions.session_spans(_sessions(events(spark, sf_dir)), ["user_id"], "us", "us")
    removed = F.when(F.col("pause") >= 8 * HOUR, F.col("pause"))
    sums = spans.groupBy("user_id").agg(
        F.count("*").alias("n_sessions"), F.count(removed).alias("n_gaps"), F.sum(F.col("end") - F.col("start")).alias("busy_us"), F.coalesce(F.sum(removed), F.lit(0)).alias("removed_us"), F.max("end").alias("_last"),
    )
    # all pauses lie before the last end, so the clock without them ends at the difference
    return sums.select("user_id", "n_sessions", "n_gaps", "busy_us", "removed_us", F.greatest(F.col("_last") - F.col("removed_us"), F.lit(0)).alias("compact_end"))


def _merged_sql(key: str, tolerance: int) -> str:
    return f"""WITH {_L}, m AS (SELECT {key}, s, e, max(e) OVER (PARTITION BY {key} ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM l WHERE e > s),
    g AS (SELECT *, sum(CASE WHEN top IS NULL OR s > top + {tolerance} THEN 1 ELSE 0 END) OVER (PARTITION BY {key} ORDER BY s, e) AS g FROM m)
    SELECT {key}, min(s) AS start, max(e) AS "end" FROM g GROUP BY {key}, g"""


@query(_merged_sql("l_orderkey", 0))
def interval_merge(spark, sf_dir):
    """Union of each order's shipment intervals; touching ones merge."""
    return intervals.merge_intervals(shipments(spark, sf_dir), ["l_orderkey"], "start", "end")


@query(_merged_sql("l_partkey", 2))
def interval_merge_tol(spark, sf_dir):
    """Union of each part's shipment intervals, pauses of two days bridged."""
    return intervals.merge_intervals(shipments(spark, sf_dir), ["l_partkey"], "start", "end", 2)


_CUTS = f"""WITH {_E}, c0 AS (SELECT user_id, us AS s, us + {2 * HOUR} AS t FROM e WHERE event_type = 'error'),
c1 AS (SELECT *, max(t) OVER (PARTITION BY user_id ORDER BY s, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM c0),
c2 AS (SELECT *, sum(CASE WHEN top IS NULL OR s > top THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY s, t) AS g FROM c1),
c AS (SELECT user_id, min(s) AS cs, max(t) AS ct FROM c2 GROUP BY user_id, g),
v AS (SELECT user_id, event_id, us AS s, us + cents * 1000000 AS t FROM e WHERE event_type <> 'error' AND cents > 0)"""


def _cuts(ev: DataFrame) -> DataFrame:
    return ev.filter("event_type = 'error'").select("user_id", F.col("us").alias("start"), (F.col("us") + 2 * HOUR).alias("end"))


def _spans(ev: DataFrame) -> DataFrame:
    return ev.filter("event_type <> 'error' AND cents > 0").select("user_id", "event_id", F.col("us").alias("start"), (F.col("us") + F.col("cents") * 1_000_000).alias("end"))


@query(_CUTS + """, p AS (SELECT user_id, event_id, s AS a, t, NULL AS cs FROM v UNION ALL SELECT v.user_id, event_id, ct, t, cs FROM v JOIN c ON c.user_id = v.user_id AND cs < t AND ct > s),
n AS (SELECT *, least(coalesce(lead(cs) OVER (PARTITION BY user_id, event_id ORDER BY cs NULLS FIRST), t), t) AS b FROM p)
SELECT user_id, event_id, a AS start, b AS "end" FROM n WHERE b > a""")
def interval_subtract(spark, sf_dir):
    """Spans of events less the two hours after each error."""
    ev = events(spark, sf_dir)
    return intervals.subtract(_spans(ev), _cuts(ev), ["user_id"], "event_id", "start", "end", bucket=24 * HOUR)


@query(f"""WITH {_E}, v AS (SELECT *, us + cents * 1000000 AS t, min(us) OVER (PARTITION BY user_id) + {48 * HOUR} AS lo, min(us) OVER (PARTITION BY user_id) + {240 * HOUR} AS hi FROM e)
SELECT event_id, greatest(us, lo) AS start, least(t, hi) AS "end", greatest(us, lo) - us AS in_point FROM v WHERE least(t, hi) > greatest(us, lo)""")
def interval_clip(spark, sf_dir):
    """Event spans cut to days two to ten of each user, with the in-point moved along."""
    first = F.min("us").over(sessions._ordered(["user_id"], ["user_id"]))
    ev = events(spark, sf_dir).select("event_id", F.col("us").alias("start"), (F.col("us") + F.col("cents") * 1_000_000).alias("end"), F.lit(0).cast("long").alias("in_point"), first.alias("first"))
    return intervals.clip(ev, "start", "end", F.col("first") + 48 * HOUR, F.col("first") + 240 * HOUR, "in_point").drop("first")


@query(_CUTS + """SELECT v.event_id, (any_value(s) - coalesce(sum(least(s, ct) - cs), 0))::BIGINT AS collapsed FROM v LEFT JOIN c ON c.user_id = v.user_id AND cs < s GROUP BY v.event_id""")
def interval_collapse(spark, sf_dir):
    """Events on the clock without the hours after errors."""
    ev = events(spark, sf_dir)
    return intervals.collapse_points(_spans(ev).select("user_id", "event_id", F.col("start").alias("at")), _cuts(ev), ["user_id"], "at", "start", "end").select("event_id", "collapsed")


@query(f"""WITH {_L} SELECT a.l_orderkey, a.l_linenumber AS l_line, b.l_linenumber AS r_line, greatest(a.s, b.s) AS ov_start, least(a.e, b.e) AS ov_end
FROM l a JOIN l b ON a.l_orderkey = b.l_orderkey AND a.s < b.e AND a.e > b.s WHERE a.l_returnflag = 'R' AND b.l_returnflag = 'N' AND a.e > a.s AND b.e > b.s""")
def interval_overlap_join(spark, sf_dir):
    """Returned and new line items of one order whose intervals overlap."""
    s = shipments(spark, sf_dir)
    left = s.filter("l_returnflag = 'R'").select("l_orderkey", F.col("l_linenumber").alias("l_line"), F.col("start").alias("l_start"), F.col("end").alias("l_end"))
    right = s.filter("l_returnflag = 'N'").select("l_orderkey", F.col("l_linenumber").alias("r_line"), F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    pairs = intervals.overlap_join(left, right, ["l_orderkey"], 30)
    return pairs.select("l_orderkey", "l_line", "r_line", F.greatest("l_start", "r_start").alias("ov_start"), F.least("l_end", "r_end").alias("ov_end"))


@query(f"""WITH {_L}, t AS (SELECT *, coalesce(sum(e - s) OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY s, e, l_linenumber, l_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS tl FROM l)
SELECT a.l_orderkey, a.l_linenumber AS l_line, b.l_linenumber AS r_line, (a.tl + greatest(a.s, b.s) - a.s)::BIGINT AS tl_start, (a.tl + least(a.e, b.e) - a.s)::BIGINT AS tl_end
FROM t a JOIN l b ON a.l_orderkey = b.l_orderkey AND a.s < b.e AND a.e > b.s WHERE a.l_returnflag = 'R' AND b.l_returnflag = 'A' AND a.e > a.s AND b.e > b.s""")
def interval_intersect_remap(spark, sf_dir):
    """Overlaps moved to the clock on which the returned items of an order follow each other."""
    s = shipments(spark, sf_dir).withColumn("length", F.col("end") - F.col("start"))
    laid = layout.prefix_layout(s, ["l_orderkey", "l_returnflag"], "length", ["start", "end", "l_linenumber", "l_partkey"])
    left = laid.filter("l_returnflag = 'R'").select("l_orderkey", F.col("l_linenumber").alias("l_line"), F.col("start").alias("l_start"), F.col("end").alias("l_end"), F.col("at").alias("l_timeline"))
    right = s.filter("l_returnflag = 'A'").select("l_orderkey", F.col("l_linenumber").alias("r_line"), F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    return intervals.remap(intervals.overlap_join(left, right, ["l_orderkey"], 30)).select("l_orderkey", "l_line", "r_line", "tl_start", "tl_end")


@query(_CUTS + "SELECT v.event_id, c.cs AS inside FROM v LEFT JOIN c ON c.user_id = v.user_id AND v.s >= cs AND v.s < ct")
def point_in_interval(spark, sf_dir):
    """Events with the error window that holds them."""
    ev = events(spark, sf_dir)
    windows = intervals.merge_intervals(_cuts(ev), ["user_id"], "start", "end").withColumn("opened", F.col("start"))
    points = _spans(ev).select("user_id", "event_id", F.col("start").alias("at"))
    return nearest.containing(points, windows, ["user_id"], "at", "start", "end", "opened").select("event_id", "inside")


@query(f"""WITH {_E}, m AS (SELECT user_id, us, min(event_id) AS v FROM e WHERE event_type = 'purchase' GROUP BY ALL),
j AS (SELECT e.event_id, max(CASE WHEN m.us <= e.us THEN m.us END) AS b, min(CASE WHEN m.us >= e.us THEN m.us END) AS a, any_value(e.us) AS us, any_value(e.user_id) AS user_id
 FROM e LEFT JOIN m ON m.user_id = e.user_id WHERE e.event_type = 'click' GROUP BY e.event_id),
k AS (SELECT *, CASE WHEN a IS NULL OR us - b <= a - us THEN b ELSE a END AS n FROM j)
SELECT event_id, b AS before_at, a AS after_at, n AS nearest_at, m.v AS nearest_value FROM k LEFT JOIN m ON m.user_id = k.user_id AND m.us = k.n""")
def nearest_neighbour(spark, sf_dir):
    """The purchase before, after and nearest to each click of a user."""
    ev = events(spark, sf_dir)
    found = nearest.neighbours(ev.filter("event_type = 'click'"), ev.filter("event_type = 'purchase'").select("user_id", F.col("us").alias("mark"), F.col("event_id").alias("mark_id")), ["user_id"], "us", "mark", "mark_id")
    return found.select("event_id", "before_at", "after_at", "nearest_at", "nearest_value")


@query("""WITH c AS (SELECT c_custkey, c_nationkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) AS known FROM customer),
n AS (SELECT *, last_value(CASE WHEN known THEN c_custkey END IGNORE NULLS) OVER (PARTITION BY c_nationkey ORDER BY c_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_known,
 first_value(CASE WHEN known THEN c_custkey END IGNORE NULLS) OVER (PARTITION BY c_nationkey ORDER BY c_custkey ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_known FROM c)
SELECT c_custkey, prev_known, next_known FROM n WHERE NOT known""")
def leftovers_prev_next(spark, sf_dir):
    """Customers without a large order, with the neighbours of their nation that have one."""
    buyers = read(spark, sf_dir, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("known", F.lit(True))
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(buyers, "c_custkey", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    return nearest.with_neighbours(c, ["c_nationkey"], ["c_custkey"], "known", "c_custkey").filter("NOT known").select("c_custkey", "prev_known", "next_known")


@query(f"WITH {_E} SELECT event_id, coalesce(lag(us + cents * 10000000) OVER (PARTITION BY user_id ORDER BY us, event_id) > us, false) AS overlaps FROM e")
def overlap_previous_flag(spark, sf_dir):
    """Whether the previous event's span reaches into this one."""
    ev = events(spark, sf_dir).withColumn("till", F.col("us") + F.col("cents") * 10_000_000)
    return layout.overlaps_previous(ev, ["user_id"], "us", "till", ["us", "event_id"]).select("event_id", "overlaps")


@query(f"""WITH {_E} SELECT event_id, least(coalesce(min(us) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) - us, {6 * HOUR}), {6 * HOUR}) AS duration FROM e""")
def lead_bounded_duration(spark, sf_dir):
    """Time to the user's next strictly later event, six hours at most."""
    return layout.lead_bounded(events(spark, sf_dir), ["user_id"], "us", 6 * HOUR).select("event_id", "duration")


@query(f"""WITH {_E} SELECT event_id, coalesce(sum(cents) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS at FROM e""")
def prefix_layout(spark, sf_dir):
    """Events laid end to end by value."""
    return layout.prefix_layout(events(spark, sf_dir), ["user_id"], "cents", ["us", "event_id"]).select("event_id", "at")


@query(f"""WITH {_E} SELECT event_id, (us + coalesce(sum(CASE WHEN event_type = 'error' THEN cents END) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS shifted FROM e""")
def running_offset(spark, sf_dir):
    """Times shifted by the values of earlier errors."""
    return layout.running_offset(events(spark, sf_dir), ["user_id"], F.col("event_type") == "error", "cents", "us", ["us", "event_id"]).select("event_id", "shifted")


@query(f"""WITH {_E} SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN cents END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM e""")
def fill_forward(spark, sf_dir):
    """The value of the user's last signup so far."""
    ev = events(spark, sf_dir).withColumn("known", F.when(F.col("event_type") == "signup", F.col("cents")))
    return layout.fill_forward(ev, ["user_id"], "known", ["us", "event_id"]).select("event_id", "filled")


@query(f"WITH {_E} SELECT event_id, us - min(us) OVER (PARTITION BY user_id) AS zeroed FROM e")
def shift_to_zero(spark, sf_dir):
    """Times counted from the user's first event."""
    return layout.shift_to_zero(events(spark, sf_dir), ["user_id"], "us").select("event_id", "zeroed")


@query(f"""WITH {_E}, k AS (SELECT *, event_id % 7 NOT IN (2, 3, 4) AS known, min(us) OVER (PARTITION BY user_id) AS lo, max(us) OVER (PARTITION BY user_id) AS hi FROM e),
r AS (SELECT *, sum(known::INT) OVER w AS run, coalesce(last_value(CASE WHEN known THEN us END IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), lo) AS b,
 coalesce(first_value(CASE WHEN known THEN us END IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), hi) AS a FROM k WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
i AS (SELECT *, row_number() OVER (PARTITION BY user_id, run, known ORDER BY event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id, run, known) AS n FROM r)
SELECT event_id, CASE WHEN known THEN us ELSE floor(b + (greatest(a - b, 0) / n) * i)::BIGINT END AS start_filled FROM i""")
def gap_interpolate(spark, sf_dir):
    """Times of three in seven events taken away and filled evenly between the neighbours."""
    w = sessions._ordered(["user_id"], ["user_id"])
    ev = events(spark, sf_dir).withColumns({"lo": F.min("us").over(w), "hi": F.max("us").over(w)}).withColumn("known", F.when(~(F.col("event_id") % 7).isin(2, 3, 4), F.col("us")))
    out = layout.fill_gaps(ev, ["user_id"], "known", "known", ["event_id"], F.col("lo"), F.col("hi"))
    return out.select("event_id", F.floor("start_filled").cast("long").alias("start_filled"))


@query(f"""WITH {_E}, c AS (SELECT *, CASE WHEN lag(event_type) OVER w = event_type THEN 0 ELSE 1 END AS o FROM e WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)),
i AS (SELECT *, sum(o) OVER (PARTITION BY user_id ORDER BY us, event_id) AS island FROM c)
SELECT user_id, island::BIGINT AS island, event_type, count(*) AS n, min(us) AS start, max(us) AS "end" FROM i GROUP BY ALL HAVING count(*) >= 2""")
def islands_problem_blocks(spark, sf_dir):
    """Runs of two or more events of one type."""
    i = sessions.islands(events(spark, sf_dir), ["user_id"], "event_type", ["us", "event_id"])
    return i.groupBy("user_id", "island", "event_type").agg(F.count("*").alias("n"), F.min("us").alias("start"), F.max("us").alias("end")).filter("n >= 2")


@query(f"""WITH {_E}, p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) AS pos FROM e)
SELECT user_id, event_type, max(pos) - min(pos) + 1 = count(*) AS contiguous, count(*) AS n FROM p GROUP BY ALL""")
def contiguous_groups(spark, sf_dir):
    """Whether a user's events of one type follow each other without others between."""
    pos = F.row_number().over(sessions._ordered(["user_id"], ["us", "event_id"]))
    return sessions.contiguous_members(events(spark, sf_dir).withColumn("pos", pos), ["user_id", "event_type"], "pos")


@query(f"WITH {_E}, f AS (SELECT *, unnest(range(greatest((us - {12 * HOUR}) // {6 * HOUR} + 1, 0), us // {6 * HOUR} + 1)) AS frame FROM e) SELECT event_type, frame, count(*) AS n, sum(cents)::BIGINT AS total FROM f GROUP BY ALL")
def sliding_frames(spark, sf_dir):
    """Events and values in frames of twelve hours that start every six."""
    return sessions.sliding_frames(events(spark, sf_dir), ["event_type"], "us", "cents", 12 * HOUR, 6 * HOUR).select("event_type", "frame", "n", "total")


@query("SELECT event_id // 60 AS batch, count(*) AS n, min(event_id) AS first_id FROM events GROUP BY ALL")
def bucket_batches(spark, sf_dir):
    """Events in consecutive batches of sixty."""
    return sessions.batches(events(spark, sf_dir), 60, "event_id").groupBy("batch").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query(f"""WITH RECURSIVE {_E}, g AS (SELECT user_id, event_type, us, min(event_id) AS event_id FROM e GROUP BY ALL),
k AS (SELECT user_id, event_type, min(us) AS us FROM g GROUP BY ALL UNION ALL
 SELECT k.user_id, k.event_type, min(g.us) FROM k JOIN g ON g.user_id = k.user_id AND g.event_type = k.event_type AND g.us >= k.us + {40 * HOUR} GROUP BY k.user_id, k.event_type, k.us)
SELECT user_id, event_type, event_id, us FROM k JOIN g USING (user_id, event_type, us)""")
def throttle_last_emit(spark, sf_dir):
    """Events of a user and type at least forty hours after the last one kept."""
    ev = events(spark, sf_dir).select("user_id", "event_type", "event_id", "us")
    return layout.throttle(ev, ["user_id", "event_type"], "us", ["us", "event_id"], 40 * HOUR, "user_id bigint, event_type string, event_id bigint, us bigint")


@query(f"""WITH RECURSIVE {_E}, n AS (SELECT user_id, event_type, event_id, us, us + cents * 1000000 AS till, cents, row_number() OVER (PARTITION BY user_id, event_type ORDER BY us, event_id) AS n FROM e),
r AS (SELECT user_id, event_type, n, event_id, us, till, cents, 1 AS win FROM n WHERE n = 1
 UNION ALL SELECT n.user_id, n.event_type, n.n, CASE WHEN o OR better THEN n.event_id ELSE r.event_id END, CASE WHEN o OR better THEN n.us ELSE r.us END, CASE WHEN o OR better THEN n.till ELSE r.till END, CASE WHEN o OR better THEN n.cents ELSE r.cents END, r.win + o::INT
 FROM (SELECT r.*, n.event_id AS e2, n.us > r.till + {6 * HOUR} AS o, n.cents > r.cents AS better, n.n AS n2 FROM r JOIN n ON n.user_id = r.user_id AND n.event_type = r.event_type AND n.n = r.n + 1) r JOIN n ON n.user_id = r.user_id AND n.event_type = r.event_type AND n.n = r.n2)
SELECT user_id, event_type, event_id, us, till, cents FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, win ORDER BY n DESC) AS last FROM r) WHERE last = 1""")
def metric_window_dedupe(spark, sf_dir):
    """The best event of each window that ends six hours after the kept one."""
    ev = events(spark, sf_dir).select("user_id", "event_type", "event_id", "us", (F.col("us") + F.col("cents") * 1_000_000).alias("till"), "cents")
    return layout.window_best(ev, ["user_id", "event_type"], "us", "till", "cents", ["us", "event_id"], 6 * HOUR, "user_id bigint, event_type string, event_id bigint, us bigint, till bigint, cents bigint")


@query("""WITH RECURSIVE o AS (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders),
r AS (SELECT o_custkey, 0::BIGINT AS o_orderkey, 0::BIGINT AS n, 0::DOUBLE AS held, 0 AS target FROM orders GROUP BY o_custkey UNION ALL
 SELECT x.o_custkey, x.o_orderkey, x.n, x.h - x.t, x.t FROM (SELECT y.*, CASE WHEN h >= 0.999 THEN greatest(1, least(3, floor(h)::INT)) ELSE 0 END AS t
  FROM (SELECT o.o_custkey, o.o_orderkey, o.n, r.held + o.o_totalprice * 0.000004 AS h FROM r JOIN o ON o.o_custkey = r.o_custkey AND o.n = r.n + 1) y) x)
SELECT o_orderkey, target::BIGINT AS target FROM r WHERE n > 0""")
def news_accumulator(spark, sf_dir):
    """Whole units paid out as the running sum of order prices passes them, three at most."""
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    out = layout.accumulate_targets(o.withColumn("o_orderdate", F.col("o_orderdate").cast("date")), ["o_custkey"], "o_totalprice", 0.000004, ["o_orderdate", "o_orderkey"], "o_custkey bigint, o_orderkey bigint, o_orderdate date, o_totalprice double, target bigint")
    return out.select("o_orderkey", "target")


_TRACKS = "l_orderkey bigint, l_linenumber int, start bigint, end bigint"


_N = "n AS (SELECT l_orderkey, l_linenumber, l_returnflag, s, e, row_number() OVER (PARTITION BY l_orderkey ORDER BY s, e, l_linenumber) AS n FROM l)"


@query(f"""WITH RECURSIVE {_L}, {_N}, r AS (SELECT l_orderkey, l_linenumber, s, e, n, 0::BIGINT AS track, [e] AS ends FROM n WHERE n = 1
 UNION ALL SELECT l_orderkey, l_linenumber, s, e, n, (p - 1)::BIGINT, CASE WHEN p > len(ends) THEN list_append(ends, e) ELSE list_transform(ends, lambda x, i: CASE WHEN i = p THEN e ELSE x END) END
 FROM (SELECT n.*, r.ends, coalesce(nullif(list_position(list_transform(r.ends, lambda x: x <= n.s), true), 0), len(r.ends) + 1) AS p FROM r JOIN n ON n.l_orderkey = r.l_orderkey AND n.n = r.n + 1))
SELECT l_orderkey, l_linenumber, s AS start, e AS "end", track FROM r""")
def track_packing(spark, sf_dir):
    """Shipments of an order on as few tracks as needed."""
    s = shipments(spark, sf_dir).select("l_orderkey", "l_linenumber", "start", "end")
    return layout.pack_tracks(s, ["l_orderkey"], "start", "end", ["start", "end", "l_linenumber"], _TRACKS + ", track bigint")


@query(f"""WITH RECURSIVE {_L}, {_N}, r AS (SELECT l_orderkey, n, l_linenumber, s, e, 0::BIGINT AS held, e AS cursor, true AS taken FROM n WHERE n = 1
 UNION ALL SELECT n.l_orderkey, n.n, n.l_linenumber, n.s, n.e, r.cursor, CASE WHEN n.s >= r.cursor THEN n.e ELSE r.cursor END, n.s >= r.cursor FROM r JOIN n ON n.l_orderkey = r.l_orderkey AND n.n = r.n + 1)
SELECT l_orderkey, l_linenumber, s AS start, e AS "end", 'clip' AS kind FROM r WHERE taken UNION ALL SELECT l_orderkey, l_linenumber, held, s, 'gap' FROM r WHERE taken AND s > held""")
def gap_rows_on_track(spark, sf_dir):
    """Shipments of an order on one track with gap rows, overlapping ones skipped."""
    s = shipments(spark, sf_dir).select("l_orderkey", "l_linenumber", "start", "end")
    return layout.track_with_gaps(s, ["l_orderkey"], "start", "end", ["start", "end", "l_linenumber"], _TRACKS + ", kind string")


@query(f"""WITH {_L}, g AS (SELECT *, max(CASE WHEN l_returnflag = 'R' THEN e END) OVER (PARTITION BY l_orderkey ORDER BY s, e, l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS g FROM l),
m AS (SELECT *, CASE WHEN l_returnflag <> 'R' AND s < g THEN g - s ELSE 0 END AS d FROM g) SELECT l_orderkey, l_linenumber, s + d AS start, e + d AS "end", l_returnflag = 'R' AS blocks FROM m""")
def guard_delay(spark, sf_dir):
    """Shipments pushed behind the end of a returned one."""
    s = shipments(spark, sf_dir).select("l_orderkey", "l_linenumber", "start", "end", (F.col("l_returnflag") == "R").alias("blocks"))
    return layout.hold_until_free(s, ["l_orderkey"], "start", "end", "blocks", ["start", "end", "l_linenumber"])


@query(f"""WITH RECURSIVE {_L}, z AS (SELECT l_partkey, (s - min(s) OVER (PARTITION BY l_partkey))::DOUBLE AS s, (e - min(s) OVER (PARTITION BY l_partkey))::DOUBLE AS e FROM l),
k AS (SELECT l_partkey, list_sort(list(s)) AS ss, list_sort(list(e)) AS es, list_sort(list_distinct(list_concat(list_concat(list(s), list(e)), [0.0::DOUBLE]))) AS ps, max(e) AS stop FROM z GROUP BY l_partkey),
c AS (SELECT l_partkey, ss, es, ps, stop, -1::BIGINT AS chunk, ps[1] AS a, ps[1] AS b FROM k
 UNION ALL SELECT l_partkey, ss, es, ps, stop, chunk + 1, b, CASE WHEN over IS NULL THEN close ELSE coalesce(list_max([q FOR q IN ps IF q > b AND q < over]), over) END
 FROM (SELECT *, list_min([p FOR p IN ps IF p > b AND p <= close AND len([x FOR x IN ss IF x < p]) - len([x FOR x IN es IF x <= b]) > 12]) AS over FROM (SELECT *, least(stop, b + 45) AS close FROM c WHERE b < stop)))
SELECT l_partkey, chunk, a AS start, b AS "end", (len([x FOR x IN ss IF x < b]) - len([x FOR x IN es IF x <= a]))::BIGINT AS n FROM c WHERE chunk >= 0""")
def chunk_plan(spark, sf_dir):
    """Render chunks of each part's shipments: at most twelve at once, 45 days long."""
    s = shipments(spark, sf_dir)
    zeroed = layout.shift_to_zero(s.withColumn("length", F.col("end") - F.col("start")), ["l_partkey"], "start").select("l_partkey", F.col("zeroed").alias("start"), (F.col("zeroed") + F.col("length")).alias("end"))
    return layout.plan_chunks(zeroed, ["l_partkey"], "start", "end", ["start", "end"], "l_partkey bigint, chunk bigint, start double, end double, n bigint")


@query(f"""WITH {_E}, v AS (SELECT *, us + cents * 4000000 AS t FROM e) SELECT a.event_id, a.us AS start, a.t AS "end", a.cents FROM v a
WHERE NOT EXISTS (SELECT 1 FROM v b WHERE b.user_id = a.user_id AND b.us <= a.us AND a.t <= b.t AND b.t - b.us > a.t - a.us AND b.cents >= a.cents)""")
def subset_dedupe(spark, sf_dir):
    """Event spans not strictly inside a better one of the user."""
    ev = events(spark, sf_dir).select("event_id", "user_id", F.col("us").alias("start"), (F.col("us") + F.col("cents") * 4_000_000).alias("end"), "cents")
    return intervals.dominated(ev, ["user_id"], "event_id", "start", "end", "cents", 24 * HOUR).select("event_id", "start", "end", "cents")


@query(f"""WITH {_E}, m AS (SELECT user_id, us, event_id % 5 AS strength, us + {HOUR} AS t, coalesce(lag(us + {HOUR}) OVER w, 0) AS f, lead(us) OVER w AS nx, max(us) OVER (PARTITION BY user_id) + {10 * HOUR} AS total FROM (SELECT user_id, us, min(event_id) AS event_id FROM e WHERE event_type = 'click' AND us % 3 = 0 GROUP BY ALL) WINDOW w AS (PARTITION BY user_id ORDER BY us))
SELECT user_id, f AS start, us AS "end" FROM m WHERE strength >= 3 AND us > f UNION ALL SELECT user_id, t, total FROM m WHERE nx IS NULL AND total > t""")
def marked_takes(spark, sf_dir):
    """Times of users before strong marks, and what follows the last one."""
    e = events(spark, sf_dir).filter("event_type = 'click' AND us % 3 = 0").groupBy("user_id", "us").agg(F.min("event_id").alias("event_id"))
    total = F.max("start").over(Window.partitionBy("user_id")) + 10 * HOUR
    marks = e.select("user_id", F.col("us").alias("start"), (F.col("us") + HOUR).alias("end"), (F.col("event_id") % 5).alias("strength"))
    return intervals.kept_takes(marks, ["user_id"], "start", "end", "strength", total)


@query(f"""WITH {_L}, v AS (SELECT l_partkey, l_orderkey, l_linenumber, s // 40 AS span, (l_orderkey % 7)::DOUBLE AS score, l_returnflag = 'R' AS fixed FROM l)
SELECT l_partkey, l_orderkey, l_linenumber FROM v a WHERE NOT EXISTS (SELECT 1 FROM v b WHERE b.l_partkey = a.l_partkey AND b.span = a.span AND b.l_orderkey * 10 + b.l_linenumber > a.l_orderkey * 10 + a.l_linenumber
 AND (b.score > a.score + 0.5 OR (abs(b.score - a.score) <= 0.5 AND NOT a.fixed AND b.fixed)))""")
def equal_span_dedupe(spark, sf_dir):
    """Shipments of a part in the same span of days, less those that a later one outdoes."""
    s = shipments(spark, sf_dir).select("l_partkey", "l_orderkey", "l_linenumber", F.floor(F.col("start") / 40).alias("span"), (F.col("l_orderkey") % 7).cast("double").alias("score"), (F.col("l_returnflag") == "R").alias("fixed"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("no"))
    return intervals.superseded(s.withColumn("span_end", F.col("span")), ["l_partkey"], "span", "span_end", "no", "score", F.col("fixed")).select("l_partkey", "l_orderkey", "l_linenumber")


@query(f"""WITH {_L} SELECT l_orderkey, l_linenumber, p.part, p.s AS start, p.e AS "end" FROM (SELECT *, unnest(CASE WHEN s < 9000 AND 9000 < e THEN [{{'part': 0, 's': s, 'e': 9000}}, {{'part': 1, 's': 9010, 'e': e + 10}}]
 ELSE [{{'part': 0, 's': s + CASE WHEN s >= 9000 THEN 10 ELSE 0 END, 'e': e + CASE WHEN s >= 9000 THEN 10 ELSE 0 END}}] END) AS p FROM l)""")
def split_at_boundary(spark, sf_dir):
    """Shipments split at one day, everything from it on moved by ten days."""
    s = shipments(spark, sf_dir).select("l_orderkey", "l_linenumber", "start", "end")
    return intervals.split_and_shift(s, ["l_orderkey"], "start", "end", F.lit(9000).cast("long"), F.lit(10).cast("long"))


@query(f"""WITH RECURSIVE {_E}, p AS (SELECT user_id, lag(user_id) OVER w AS other, us - lag(us) OVER w AS d, event_type, lag(event_type) OVER w AS pt FROM e WINDOW w AS (PARTITION BY us // {24 * HOUR} ORDER BY us, event_id)),
k AS (SELECT DISTINCT user_id AS a, other AS b FROM p WHERE event_type = 'error' AND pt = 'error' AND d <= {HOUR // 2} AND user_id <> other),
s AS (SELECT a, b FROM k UNION SELECT b, a FROM k),
r AS (SELECT a, a AS m FROM s UNION SELECT s.a, r.m FROM r JOIN s ON s.b = r.a)
SELECT a AS node, min(m) AS component FROM r GROUP BY a""")
def linked_users(spark, sf_dir):
    """Components of users whose errors followed each other within half an hour of one day."""
    w = sessions._ordered(["day"], ["us", "event_id"])
    ev = events(spark, sf_dir).withColumn("day", F.floor(F.col("us") / (24 * HOUR)))
    p = ev.select("user_id", F.lag("user_id").over(w).alias("other"), (F.col("us") - F.lag("us").over(w)).alias("d"), "event_type", F.lag("event_type").over(w).alias("pt"))
    links = p.filter(f"event_type = 'error' AND pt = 'error' AND d <= {HOUR // 2} AND user_id <> other")
    return connected_components(links, "user_id", "other")

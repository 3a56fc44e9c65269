"""Queries against DuckDB on the smallest tables, and the pure functions against their rules."""

import os
import random

import duckdb
import pytest

from timeloom.operators import align, intervals, layout, nearest
from timeloom.plans import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations".split()
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(DATA):
        pytest.skip("no test tables here")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return tuple(map(_plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    df = catalog.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    rel = duck.sql(SQL[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    got = sorted((tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=str)
    want = sorted((tuple(_plain(r[i]) for i in at) for r in rel.fetchall()), key=str)
    assert got == want


# --------------------------------------------------------------------------------------------- intervals
def test_interval_algebra(spark):
    df = spark.createDataFrame([(1, 0, 5), (1, 5, 7), (1, 9, 10), (1, 1, 2), (1, 10, 12), (1, 20, 20), (2, 3, 4)], "k int, s int, e int")
    assert sorted(map(tuple, intervals.merge_intervals(df, ["k"], "s", "e").collect())) == [(1, 0, 7), (1, 9, 12), (2, 3, 4)]
    assert sorted(map(tuple, intervals.gaps_between(df, ["k"], "s", "e").collect())) == [(1, 7, 9)]
    points = spark.createDataFrame([(1, i, i) for i in range(15)], "k int, id int, at int")
    got = {r["id"]: r["collapsed"] for r in intervals.collapse_points(points, df, ["k"], "at", "s", "e").collect()}
    covered = set(range(0, 7)) | set(range(9, 12))
    assert got == {i: i - len([x for x in covered if x < i]) for i in range(15)}
    rows = spark.createDataFrame([(1, 0, 0, 15), (1, 1, 6, 10), (1, 2, 1, 3)], "k int, id int, s int, e int")
    assert sorted(map(tuple, intervals.subtract(rows, df, ["k"], "id", "s", "e").collect())) == [(1, 0, 7, 9), (1, 0, 12, 15), (1, 1, 7, 9)]


def test_neighbours_ties(spark):
    points = spark.createDataFrame([(1, 0), (1, 5), (1, 7), (1, 20)], "k int, at int")
    marks = spark.createDataFrame([(1, 3, "a"), (1, 7, "b"), (1, 7, "c")], "k int, m int, v string")
    got = {r["at"]: (r["before_value"], r["after_value"], r["nearest_value"]) for r in nearest.neighbours(points, marks, ["k"], "at", "m", "v").collect()}
    assert got == {0: (None, "a", "a"), 5: ("a", "b", "a"), 7: ("b", "b", "b"), 20: ("b", None, "b")}


def test_folds(spark):
    df = spark.createDataFrame([(1, i, s, e) for i, (s, e) in enumerate([(0, 4), (2, 6), (4, 8), (5, 9), (20, 21)])], "k int, id int, s int, e int")
    packed = {r["id"]: r["track"] for r in layout.pack_tracks(df, ["k"], "s", "e", ["s", "id"], "k int, id int, s int, e int, track int").collect()}
    assert packed == {0: 0, 1: 1, 2: 0, 3: 2, 4: 0}
    track = [(r["kind"], r["s"], r["e"]) for r in layout.track_with_gaps(df, ["k"], "s", "e", ["s", "id"], "k int, id int, s int, e int, kind string").orderBy("s").collect()]
    assert track == [("clip", 0, 4), ("clip", 4, 8), ("gap", 8, 20), ("clip", 20, 21)]
    kept = [r["id"] for r in layout.throttle(df, ["k"], "s", ["s", "id"], 4, "k int, id int, s int, e int").orderBy("id").collect()]
    assert kept == [0, 2, 4]
    assert layout.throttle(df.limit(0), ["k"], "s", ["s", "id"], 4, "k int, id int, s int, e int").count() == 0


# --------------------------------------------------------------------------------------------- alignment
def test_token_alignment_consumes_each_token_once():
    r = random.Random(1)
    for _ in range(200):
        a, b = ([r.choice(["aa", "bb", "cc", "long", "longs"]) for _ in range(r.randrange(0, 9))] for _ in range(2))
        steps = align.align_tokens(a, b)
        assert [i for _, i, _ in sorted(steps, key=lambda x: -1 if x[1] is None else x[1]) if i is not None] == list(range(len(a)))
        assert sorted(j for _, _, j in steps if j is not None) == list(range(len(b)))
    assert [k for k, _, _ in align.align_tokens("the big red dog".split(), "the red big dog".split())] == ["MATCH", "TRANSPOSED", "TRANSPOSED", "MATCH"]
    assert [k for k, _, _ in align.align_tokens(["house", "houses"], ["houses", "house"])] == ["TRANSPOSED"] * 2  # 3.0 either way: the swap is offered first
    assert [k for k, _, _ in align.align_tokens(["a", "a"], ["a", "a"])] == ["MATCH"] * 2


def test_scores_and_plans():
    assert align.match_score("Été à Paris", "ete a paris")[0] == pytest.approx(1.0)
    assert align.match_score("", "x") == (0.0,) * 5
    assert align.longest_run("a b c d".split(), "x b c y b c d".split()) == (3, 1)
    refs = ["the first sentence of the script is here", "a second one follows it now", "and the third ends everything we say"]
    rows = ["the first sentence of the script is here", "hmm well", "a second one follows it now and the third ends everything we say"]
    assert align.gap_plan(["a second one follows"], refs[1:2])[0][:3] == (0, 0, 1)
    assert align.cover_sentence("one two three", [(1, "one"), (2, "two three"), (3, "four")]) == ([1, 2], 1.0)
    where, ratio = align.locate_snippet("second one", "The first, then the SECOND one!")
    assert ratio == 1.0 and "the first then the second one"[where:].startswith("second one")


# --------------------------------------------------------------------------------------- column functions
def test_timecodes(spark):
    from pyspark.sql import functions as F

    from timeloom.functions import timecode as tc

    df = spark.createDataFrame([("01:02:03:15",), ("",), ("bad",), (None,)], "t string")
    assert [r[0] for r in df.select(tc.parse_timecode(F.col("t"))).collect()] == [3723.5, 0.0, 0.0, 0.0]
    assert [r[0] for r in df.select(tc.parse_timecode(F.col("t"), 30, None)).collect()] == [3723.5, None, None, None]
    n = spark.createDataFrame([(59.999,), (3723.5,), (0.0,)], "s double")
    assert [tuple(r) for r in n.select(tc.format_timecode(F.col("s")), tc.format_clock(F.col("s"))).collect()] == [("00:01:00:00", "00:00:59.999"), ("01:02:03:15", "01:02:03.500"), ("00:00:00:00", "00:00:00.000")]
    names = spark.createDataFrame([("00h01m02s167ms_3_x.mov",), ("3m07 y",), ("z",)], "n string")
    assert [r[0] for r in names.select(tc.parse_name_stamp(F.col("n"))).collect()] == [62.167, 187.0, None]
    prose = spark.createDataFrame([("from 1:02 to 1:05:10",), ("1h2m3s",), ("2min",), ("none",)], "p string")
    assert [(r[0]["start"], r[0]["end"]) for r in prose.select(tc.loose_range(F.col("p"))).collect()] == [(62.0, 3910.0), (3723.0, None), (120.0, None), (None, None)]


def test_cells_and_text(spark):
    from pyspark.sql import functions as F

    from timeloom.functions import cells, extract, text, urls

    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(cells.merge_values(F.lit("a | B|a"), F.lit(" b | c"))) == "a | B | c"
    assert one(cells.render_notes(cells.parse_notes(F.lit("z=1 | a=2 | z=3 | junk | q=")))) == "a=2 | z=3"
    assert tuple(one(cells.note_range(F.lit("span=3-7"), "span"))) == (3, 7)
    assert one(cells.percent(F.lit("95,3%"))) == pytest.approx(0.953) and one(cells.percent(F.lit("x"))) == 0.0
    assert one(text.normalize(F.lit("  Élan—vital, N°5! "))) == "elan vital n 5"
    assert one(text.phrase_count(F.lit("the cat and the cat the cats"), F.lit("The cat"))) == 2
    assert one(text.dominant_script(F.lit("abc где это же"))) == "cyrillic"
    assert one(extract.extract(F.lit("up 5% then 7 percent, 5%"), "percent")) == ["5%", "7 percent"]
    assert one(extract.pure_distances(F.lit("ran 5 km at 12 km/h"))) == ["5 km"]
    assert one(extract.plain_numbers(F.lit("2001-02-03 gave 42"))) == ["42"]
    assert one(urls.category(F.lit("https://www.youtube.com/watch?v=1"))) == "video"
    assert one(urls.unwrap(F.lit("https://www.g.com/url?q=https%3A%2F%2Fx.org%2Fa&z=1"))) == "https://x.org/a"


def test_html_and_files(spark, tmp_path):
    from timeloom.sources import delimited, documents, html

    page = '<head><title>T</title></head><body><h1>One</h1><p>a <b>bold</b> <a href="/x">link</a></p><ul><li>item</li></ul><h2>one</h2><script>no</script></body>'
    pages = spark.createDataFrame([(1, page), (2, None)], "page_id int, html string")
    blocks = html.html_blocks(pages, ["page_id"]).orderBy("block_no").collect()
    assert [(b["tag"], b["text"], b["list_type"], b["bold"]) for b in blocks] == [("h1", "One", None, []), ("p", "a bold link", None, ["bold"]), ("li", "item", "ul", []), ("h2", "one", None, [])]
    assert [(r["href"], r["text"]) for r in html.html_links(pages, ["page_id"]).collect()] == [("/x", "link")]
    assert [(r["level"], r["text"]) for r in html.html_titles(pages, ["page_id"]).collect()] == [(1, "One")]
    (tmp_path / "a.csv").write_text("﻿Speaker Name; Start Time;End Time;Text\nA;00:00:00:00;00:00:01:00;hello\nB;x;y;\n", encoding="utf-8")
    assert [tuple(r) for r in delimited.read_segments(spark, str(tmp_path / "a.csv")).collect()] == [("A", "00:00:00:00", "00:00:01:00", "hello")]
    assert [delimited.choose_delimiter(x) for x in ("a;b,c", "a,b", "a\tb", "ab")] == [";", ",", "\t", ";"]
    (tmp_path / "t.json").write_text('{"segments": [{"start": 1, "end": 0.5, "text": " hi ", "words": [{"word": "hi", "start": 1, "end": 2}, {"word": " "}]}]}')
    files = documents.read_transcription(spark, str(tmp_path / "t.json"))
    assert [(r["word"], r["start"], r["end"]) for r in documents.transcription_words(files).collect()] == [("hi", 1.0, 2.0)]
    assert [(r["text"], r["end"]) for r in documents.transcription_segments(files).collect()] == [("hi", 1.0)]
    delimited.write_delimited(pages.select("page_id"), str(tmp_path / "out"), ["page_id"])
    assert delimited.read_delimited(spark, str(tmp_path / "out")).count() == 2
    assert documents.latest_file(spark, str(tmp_path), "*.csv").endswith("a.csv")


def test_entry_has_the_queries():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_edit_timeline_of_a_recording(spark):
    from timeloom.plans import alignment as plan

    said = ["welcome to this short film about the old town.", "we will walk along the river and", "we will walk along the river and see the bridge today.", "hmm right", "thank you all for watching it."]
    words, at = [], 0.0
    for line in said:
        at += 0.6
        for w in line.split():
            words.append((1, len(words), w, round(at, 3), round(at + 0.3, 3)))
            at += 0.32
    words = spark.createDataFrame(words, "session bigint, word_no int, word string, start double, end double")
    script = ["Welcome to this short film about the old town.", "We will walk along the river and see the bridge today.", "Never said at all anywhere.", "Thank you all for watching it."]
    refs = spark.createDataFrame([(1, i, x) for i, x in enumerate(script)], "session bigint, ref_no bigint, text string")
    rows = plan.matched_rows(plan.repeated_takes(plan.working_rows(words), refs), refs)
    got = [(r["kind"], r["take"], r["ref_start"], r["ref_end"]) for r in rows.orderBy("row_no").collect()]
    pause = ("silence", None, None, None)
    assert got == [("speech", None, 0, 0), pause, ("speech", "PRE_REPEAT_ELIMINATED", None, None), pause, ("speech", "LAST_TAKE_KEEP", 1, 1), pause, ("speech", None, None, None), pause, ("speech", None, 3, 3)]
    edit = plan.edit_timeline(plan.word_timeline(rows, words, refs), rows).orderBy("row_no", "step_no").collect()
    assert len(edit) == 9 + 11 + 6 and all(e["kind"] == "MATCH" for e in edit)
    assert all(a["edit_end"] <= b["edit_start"] + 1e-6 for a, b in zip(edit, edit[1:], strict=False))
    assert abs(edit[-1]["edit_end"] - 0.6 - sum(n * 0.32 - 0.02 for n in (9, 11, 6))) < 1e-6  # no pause row before the first word: the lead-in stays
    assert [r["text"] for r in plan.leftovers(rows, refs).collect()] == [script[2]]

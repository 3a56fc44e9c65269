"""Rows and amounts of work that findings of round 4 named."""

from __future__ import annotations


def _rows_of_both(spark, folder, name):
    """Rows of a query and of its SQL over the tables in a folder, in one order."""
    import duckdb

    import __spark_entry__ as entry

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in folder.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}/*.parquet'")
    got = entry.queries()[name](spark, str(folder))
    key = lambda r: [str(x) for x in r]
    return sorted((tuple(r) for r in got.collect()), key=key), sorted(con.execute(f"SELECT {', '.join(got.columns)} FROM ({entry.oracle_sql()[name]})".replace(" end,", ' "end",')).fetchall(), key=key)


def test_lines_that_bear_a_mark_of_their_own_are_no_marked_lines(spark, tmp_path):
    rows = [(1, 1, "user", "one\ntwo\nthree\nA. four\nfive"), (2, 4, "user", "- six\n\nseven"), (3, None, "user", "x"), (4, 0, "user", None)]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got, wanted = _rows_of_both(spark, tmp_path, "list_lines")
    assert got == wanted and len(got) == 5


def test_a_currency_text_is_read_once(spark):
    from pyspark.sql import functions as F

    from timeloom.functions import display

    texts = ["12 Euros et dollars", "C$ 5 dollars", "7 francs", "£3", "9", None, "won a buck", "10 kr", "chf"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(display.currency_symbol(F.col("t")).alias("s"))
    assert [r["s"] for r in df.collect()] == ["€", "C$", "CHF", "£", None, None, "₩", "kr", "CHF"]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("translate(") == 1


def test_hits_that_step_back_find_their_spans(spark):
    """Rows that each begin a span before the last hit need spans further back than the first row does."""
    from pyspark.sql import functions as F

    from timeloom.operators import regions

    script = ["zero zebra zinc zone", "one onion otter oval", "two tulip tiger twig", "three thyme thrush thorn", "four fern finch flint", "five fig falcon fog", "six sage swan sand"]
    refs = spark.createDataFrame([(1, i, x) for i, x in enumerate(script)], "s bigint, ref_pos int, text string")
    said = [(1, 0, script[4], 4, 4, 1.0, "MATCH"), (1, 1, script[3], None, None, 0.0, "UNMATCHED"), (1, 2, script[2], None, None, 0.0, "UNMATCHED"), (1, 3, script[1], None, None, 0.0, "UNMATCHED")]
    rows = spark.createDataFrame(said, "s bigint, row_no int, text string, ref_start int, ref_end int, score double, status string")
    got = regions.recovered(rows, refs, "s", F.lit(True)).orderBy("row_no").collect()
    assert [(r["ref_start"], r["ref_end"]) for r in got] == [(4, 4), (3, 3), (2, 2), (1, 1)]


def test_characters_are_matched_only_where_they_can_decide(monkeypatch):
    import random

    from timeloom.config import DEFAULTS as t
    from timeloom.operators import align

    r = random.Random(3)
    words = "the old town lies by a wide river and its bridge was built of stone long ago when few people lived here".split()
    lines = [" ".join(r.choice(words) for _ in range(r.randrange(1, 25))) for _ in range(60)] + ["", "--", "Été à Paris", "ete a paris"]
    pairs = [(a, b) for a in lines for b in lines]
    for least, common, floor in ((t.match_score, t.transposed_set, float("-inf")), (t.relaxed_score, t.relaxed_set, 0.6)):
        for a, b in pairs:
            plain = align.match_score(a, b)
            wanted = plain if a and b and plain[0] > floor and (plain[0] >= least or plain[2] >= common) and plain[4] else None
            assert align.score_above(align.Said.of(a), align.Said.of(b), least, common, floor) == wanted
    lines = [" ".join(f"w{int(r.random() ** 3 * 400)}" for _ in range(r.randrange(8, 25))) for _ in range(60)]
    ratios = []
    kept = align.difflib.SequenceMatcher.ratio
    monkeypatch.setattr(align.difflib.SequenceMatcher, "ratio", lambda m: ratios.append(1) or kept(m))
    align.gap_program(lines[:20], lines[20:60])
    assert len(ratios) < 20 * 40 * 5 / 4


def test_links_call_python_once_and_in_all_tasks(spark):
    from timeloom.operators import align

    rows = [(1, i, x) for i, x in enumerate(["we walk along the river today", "hmm", "so we walk along the river", "yes", "yes we can", "a b", "é à"])]
    links = align.repetition_links(spark.createDataFrame(rows, "s bigint, i bigint, t string"), ["s"], "i", "t")
    assert sorted((r["left_no"], r["right_no"], r["run"], r["phrase"]) for r in links.collect()) == [(0, 2, 5, "we walk along the river"), (3, 4, 1, "yes")]
    assert links._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("ArrowEvalPython") == 1
    assert links.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_suffixes_by_bounds_and_by_all_windows(monkeypatch):
    import random

    from timeloom.operators import align, refine

    r = random.Random(6)
    line = lambda: " ".join(f"w{int(r.random() ** 2 * 90)}" for _ in range(r.randrange(2, 16)))
    matched = []
    kept = align.difflib.SequenceMatcher.find_longest_match
    monkeypatch.setattr(align.difflib.SequenceMatcher, "find_longest_match", lambda m, *x: matched.append(isinstance(m.a, str)) or kept(m, *x))
    used = 0
    for _ in range(25):
        refs = [line() for _ in range(30)]
        takes = [(i, t) for i, t in enumerate([line(), " ".join(refs[3:5]), " ".join(refs[3:5])][r.randrange(0, 3) :])]
        matched.clear()
        got = refine.best_suffix(takes, refs)
        used += sum(matched)
        best = None
        for start in range(len(takes) - 1, -1, -1):
            said = " ".join(t for _, t in takes[start:])
            found = max((s, n, c, -u, -abs(len(said.split()) - len(text.split())), takes[start][0], j - i, -i) for i in range(30) for j in range(i, min(30, i + 5)) for text in [" ".join(refs[i : j + 1])] for s, n, _, c, u in [refine.support_rank(said, text)] if n)
            if best is None or found[:7] > best[0]:
                best = (found[:7], len(takes) - start, -found[7], found[6] - found[7])
        assert got == best[1:]
    assert used < 700, used


def _frames_that_end_with_the_key(df):
    return df._jdf.queryExecution().optimizedPlan().toString().lower().count("unboundedfollowing")


def test_clean_up_reads_no_frame_anew(spark):
    from pyspark.sql import functions as F

    from timeloom.operators import refine

    rows = spark.createDataFrame([(1, i, a, a) for i, a in enumerate([None, 1, None, 2, None, 5, None, None])], "k int, i int, ref_first bigint, ref_last bigint")
    out = refine.cleaned(rows, ["k"], "i", F.lit(6).cast("long"), F.lit(1.0), F.lit(9), F.lit("en"), F.lit("en"), F.lit(1))
    assert [r["reason"] for r in out.orderBy("i").collect()] == [None, None, "NO_REFERENCE_COVERED", None, None, None, "NO_REFERENCE_COVERED", "NO_REFERENCE_COVERED"]
    assert not _frames_that_end_with_the_key(out)


def test_known_neighbours_read_no_frame_anew(spark):
    from timeloom.operators import nearest

    rows = spark.createDataFrame([(1, i, known) for i, known in enumerate([False, True, False, False, True, True, False])], "k int, i int, known boolean")
    out = nearest.with_neighbours(rows, ["k"], ["i"], "known", "i")
    assert [(r["prev_known"], r["next_known"]) for r in out.orderBy("i").collect()] == [(None, 1), (None, 4), (1, 4), (1, 4), (1, 5), (4, None), (5, None)]
    assert not _frames_that_end_with_the_key(out)


def test_tokens_are_compared_once_and_few_by_their_ratios(monkeypatch):
    import random

    from timeloom.operators import align

    r = random.Random(2)
    left, right = ([f"{r.choice(['river', 'stone', 'bridge', 'town', 'walker', 'walkers'])}{r.randrange(4)}" for _ in range(60)] for _ in range(2))
    compared, ratios = [], []
    alike, kept = align.alike, align.difflib.SequenceMatcher.ratio
    monkeypatch.setattr(align, "alike", lambda a, b: compared.append((a, b)) or alike(a, b))
    monkeypatch.setattr(align.difflib.SequenceMatcher, "ratio", lambda m: ratios.append(1) or kept(m))
    steps = align.align_tokens(left, right)
    assert [i for _, i, _ in sorted(steps, key=lambda s: -1 if s[1] is None else s[1]) if i is not None] == list(range(60))
    assert compared and len(compared) == len(set(compared)) and len(ratios) <= len(compared) / 2


def _broadcasts(spark, name):
    import __spark_entry__ as entry

    return entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString().count("Broadcast")


def test_values_are_located_without_broadcasts(spark):
    assert _broadcasts(spark, "value_locations") == 0


def test_titles_and_links_are_placed_without_broadcasts(spark):
    assert [_broadcasts(spark, name) for name in ("title_anchors", "link_anchors")] == [0, 0]

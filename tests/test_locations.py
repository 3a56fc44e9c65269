"""Localisation of values and anchoring of titles and links against plain scans."""

import random

import pytest
from pyspark.sql import functions as F

from timeloom.operators import anchoring, localize
from timeloom.operators.align import canonical

WORDS = "stone bridge river town wide old long short walk water light house".split()


def test_tiers_of_a_row(spark):
    rows = spark.createDataFrame([(1, "L'été à Paris... le Pont, le soir!", "On dit: L'ete a Paris ce soir; fin", 10.0, 20.0), (2, None, "", 0.0, 1.0), (3, "x", None, 3.0, 4.0)], "row int, reference string, transcript string, start double, end double")
    # reference: l ete a paris le pont le soir; transcript: on dit l ete a paris ce soir fin. "pont" has no step: its characters stand behind "le"
    pairs = [(0, 2), (1, 3), (2, 4), (3, 5), (4, 6), (6, None), (7, 7), (None, 0), (None, 1), (None, 8)]
    steps = spark.createDataFrame([(1, i, r, t, float(i), i + 0.5, i != 2) for i, (r, t) in enumerate(pairs)], "row int, step_no int, right_no int, left_no int, start double, end double, exact boolean")
    wanted = {
        "ÉTÉ à paris": ("reference_span", 1.0, 3.5, False), "paris": ("reference_span", 3.0, 3.5, True), "ce soir": ("transcript_span", 4.0, 6.5, True),
        "...": ("reference_symbol", 3.0, 3.5, True), "!": ("reference_symbol", 6.0, 6.5, True), ";": ("transcript_symbol", 6.0, 6.5, True), ":": ("transcript_symbol", 8.0, 8.5, True),
        "nobody said fin": ("token_match", 9.0, 9.5, True), "le": ("reference_span", 4.0, 4.5, True), "Pont": ("reference_symbol", 4.0, 4.5, True), "nothing": ("row", 10.0, 20.0, False), "": ("row", 10.0, 20.0, False), None: ("row", 10.0, 20.0, False),
    }
    values = spark.createDataFrame([(1, i, v) for i, v in enumerate(wanted)] + [(2, 0, "x"), (3, 0, "x")], "row int, value_no int, value string")
    got = {(r["row"], r["value_no"]): tuple(r)[2:] for r in localize.localize(values, rows, steps, ["row"], "value_no", "value").collect()}
    assert got == {(1, i): x for i, x in enumerate(wanted.values())} | {(2, 0): ("row", 0.0, 1.0, False), (3, 0): ("row", 3.0, 4.0, False)}


def test_token_places(spark):
    texts = ["L'été à Paris...", "", " a  b", "Straße", "naïve cóté 3x"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    for r in localize.token_places(df, ["k"], {"s": F.col("t")}).collect():
        assert canonical(texts[r["k"]][r["first"] : r["past"]]) == r["token"] == canonical(texts[r["k"]]).split()[r["place"]]


# ------------------------------------------------------------------------------------------------- anchoring
def page(r):
    """Blocks, and the rows of a reading that leaves some of them out; short vocabulary, so texts recur."""
    blocks = [(" ".join(r.choice(WORDS) for _ in range(r.choice([1, 2, 3, 4, 5, 9, 14]))), r.random() < 0.3) for _ in range(r.randrange(1, 14))]
    blocks += [blocks[0]] * r.randrange(3)
    r.shuffle(blocks)
    stream = []
    for i, (text, _) in enumerate(blocks):
        if r.random() < 0.6:
            stream += [(w, i // 3) for w in text.split()]
    links = []
    for i, (text, _) in enumerate(blocks):
        if r.random() < 0.6:
            w = text.split()
            a = r.randrange(len(w))
            links.append((i, r.choice([" ".join(w[a : a + 4]), "link", "Video", "", "no such label at all here", text])))
    return blocks, stream, links


def runs_of(text, stream):
    t = text.split()
    return [(a, a + len(t) - 1) for a in range(len(stream) - len(t) + 1) if t and [w for w, _ in stream[a : a + len(t)]] == t]


def weak(label):
    return not label.strip() or label.strip().lower() in anchoring.WEAK_LABELS or len(label.split()) <= 2 and len(label.strip()) <= 16


def at(p):
    return p * 0.5


def near(blocks, stream, i, usable):
    """The first block from i towards either end that is spoken, usable and has another text, as (row, start, end)."""
    out = []
    for way in (range(i - 1, -1, -1), range(i + 1, len(blocks))):
        found = None
        for j in way:
            text = blocks[j][0]
            runs = runs_of(text, stream)
            if text != blocks[i][0] and runs and usable(text):
                found = (stream[runs[0][0]][1], at(runs[0][0]), at(runs[0][1]) + 0.4)
                break
        out.append(found)
    return out


def plain_titles(blocks, stream):
    for i, (text, title) in enumerate(blocks):
        if not title:
            continue
        before, behind = near(blocks, stream, i, lambda t: True)
        if before is None and behind is not None:
            own = [p for p, (_, row) in enumerate(stream) if row == behind[0] - 1]
            before = (behind[0] - 1, at(own[0]), at(own[-1]) + 0.4) if own else None
        heard = [(row is not before, a, stream[a][1], at(a), at(b) + 0.4) for row in (before, behind) if row for a, b in runs_of(text, stream) if stream[a][1] == row[0]]
        if heard:
            best = min((stream[h[1]][1] != before[0] if before else True, *h[1:]) for h in heard)
            yield i, "spoken", best[2], best[3], best[4]
        elif before:
            yield i, "gap", before[0], before[2], max(before[2], behind[1] if behind else before[2])


def plain_links(blocks, stream, links):
    for no, (i, label) in enumerate(links):
        text = blocks[i][0]
        own = runs_of(text, stream)
        inside = [(a, b) for a, b in runs_of(label, stream) if own and own[0][0] <= a and b <= own[0][1]] if not weak(label) else []
        before, behind = near(blocks, stream, i, lambda t: not weak(t))
        if inside:
            yield no, "label", stream[inside[0][0]][1], at(inside[0][0]), at(inside[0][1]) + 0.4
        elif own and not weak(text):
            yield no, "block", stream[own[0][0]][1], at(own[0][0]), at(own[0][1]) + 0.4
        elif before:
            yield no, "previous", before[0], before[2], before[2]
        elif behind:
            yield no, "following", behind[0], behind[1], behind[1]


@pytest.fixture(scope="module")
def pages(spark):
    r = random.Random(12)
    made = [page(r) for _ in range(120)]
    blocks = spark.createDataFrame([(k, i, t, h) for k, (b, _, _) in enumerate(made) for i, (t, h) in enumerate(b)], "page int, block_no int, text string, title boolean").cache()
    stream = spark.createDataFrame([(k, p, row, w, at(p), at(p) + 0.4) for k, (_, s, _) in enumerate(made) for p, (w, row) in enumerate(s)], "page int, pos int, row_no int, token string, start double, end double").cache()
    links = spark.createDataFrame([(k, no, i, t) for k, (_, _, x) in enumerate(made) for no, (i, t) in enumerate(x)], "page int, link_no int, block_no int, text string").cache()
    return made, blocks, stream, links


def test_spoken_runs(pages):
    made, blocks, stream, _ = pages
    got = {tuple(r) for r in anchoring.spoken_runs(blocks, stream, ["page"], "block_no", "text").collect()}
    assert got == {(k, i, a, b) for k, (bs, s, _) in enumerate(made) for i, (t, _) in enumerate(bs) for a, b in runs_of(t, s)}


def test_title_anchors(pages):
    made, blocks, stream, _ = pages
    got = sorted(map(tuple, anchoring.anchor_titles(blocks, stream, ["page"], F.col("title")).collect()))
    assert got == sorted((k, *x) for k, (b, s, _) in enumerate(made) for x in plain_titles(b, s)) and {g[2] for g in got} == {"spoken", "gap"}


def test_link_anchors(pages):
    made, blocks, stream, links = pages
    got = sorted(map(tuple, anchoring.anchor_links(links, blocks, stream, ["page"]).collect()))
    assert got == sorted((k, *x) for k, (b, s, n) in enumerate(made) for x in plain_links(b, s, n)) and {g[2] for g in got} == {"label", "block", "previous", "following"}

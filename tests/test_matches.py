"""Tolerance merge, names, spanned extraction, snippets and stitching against plain code."""

import random
import re
from difflib import SequenceMatcher

import pytest

from timeloom.functions.display import MONTHS
from timeloom.operators import extraction, intervals, layout, nearest, phrases, snippets, stitch
from timeloom.operators.align import canonical


def test_tolerance_merge(spark):
    r = random.Random(3)
    sides = {k: [sorted(r.choice([r.randrange(0, 60), r.randrange(0, 600)]) for _ in range(r.randrange(0, 40))) for _ in range(2)] for k in range(12)}
    sides[99] = [[0, 10, 20, 31], [4, 16, 23, 36]]
    tables = [spark.createDataFrame([(k, i, at) for k, s in sides.items() for i, at in enumerate(s[side])] + ([(0, 777, None)] if side else []), f"k int, {name} int, at int") for side, name in enumerate(("l", "r"))]
    got = sorted(map(tuple, nearest.merge_tolerance(*tables, ["k"], "at", "l", "r", 5).collect()), key=repr)
    want = [(0, None, 777, None)]
    for k, (left, right) in sides.items():
        i = j = 0
        while i < len(left) or j < len(right):
            if i < len(left) and j < len(right) and abs(left[i] - right[j]) <= 5:
                want.append((k, i, j, min(left[i], right[j])))
                i, j = i + 1, j + 1
            elif j == len(right) or i < len(left) and left[i] < right[j]:
                want.append((k, i, None, left[i]))
                i += 1
            else:
                want.append((k, None, j, right[j]))
                j += 1
    assert got == sorted(want, key=repr)


def test_chunks_of_a_timeline(spark):
    """Chunks found by bisection against counting all clips at every point."""
    r = random.Random(13)
    clips = {k: [(float(a := r.randrange(0, 200)), float(a + r.randrange(0, 60))) for _ in range(r.randrange(1, 60))] for k in range(25)}
    want = []
    for k, own in clips.items():
        stop, points = max(e for _, e in own), sorted({0.0, *(x for c in own for x in c)})
        begin, no = points[0], 0
        while begin < stop:
            close = min(stop, begin + 45.0)
            for p in points:
                if begin < p <= close and sum(s < p and e > begin for s, e in own) > 4:
                    earlier = [q for q in points if begin < q < p]
                    close = earlier[-1] if earlier else p
                    break
            want.append((k, no, begin, close, sum(s < close and e > begin for s, e in own)))
            begin, no = close, no + 1
    df = spark.createDataFrame([(k, *c) for k, own in clips.items() for c in own], "k int, start double, end double")
    got = layout.plan_chunks(df, ["k"], "start", "end", ["start", "end"], "k int, chunk bigint, start double, end double, n bigint", most=4)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_subtract_by_buckets(spark):
    r = random.Random(14)
    make = lambda n: spark.createDataFrame([(r.randrange(3), i, a := r.randrange(-50, 300), a + r.randrange(0, 90)) for i in range(n)], "k int, id int, s int, e int").cache()
    rows, cuts = make(60), make(40)
    whole = sorted(map(tuple, intervals.subtract(rows, cuts, ["k"], "id", "s", "e").collect()))
    assert all(sorted(map(tuple, intervals.subtract(rows, cuts, ["k"], "id", "s", "e", bucket=b).collect())) == whole for b in (1, 17, 1000)) and len(whole) > 20


@pytest.mark.parametrize("chars", [4_000_000, 0])
def test_phrases_by_trie_and_by_join(spark, monkeypatch, chars):
    monkeypatch.setattr(phrases, "TRIE_CHARS", chars)
    r = random.Random(5)
    known = {" ".join(r.choice("abc") for _ in range(n)): f"l{n}" for n in (1, 2, 2, 3, 3, 4, 5) for _ in range(2)}
    known = {p: x for p, x in known.items() if p != "a"}
    texts = {i: [r.choice("abcd") for _ in range(r.randrange(0, 40))] for i in range(40)} | {40: None}
    want = set()
    for i, t in texts.items():
        found = sorted((-n, at, " ".join(t[at : at + n])) for n in range(1, 6) for at in range(len(t) - n + 1) if " ".join(t[at : at + n]) in known) if t else []
        used: set[int] = set()
        for less, at, phrase in found:
            if not used & set(range(at, at - less)):
                used |= set(range(at, at - less))
                want.add((i, at, -less, phrase, known[phrase]))
    dim = spark.createDataFrame([*known.items(), ("", "none"), (None, "none"), *[(p, "zz") for p in known]], "phrase string, label string")
    rows = spark.createDataFrame(list(texts.items()), "i int, t array<string>")
    assert {tuple(x) for x in phrases.phrase_matches(rows, ["i"], "t", dim).collect()} == want
    assert phrases.phrase_matches(rows, ["i"], "t", dim.limit(0)).collect() == []


# ------------------------------------------------------------------------------------------------ extraction
def plain_spans(text):
    unit = r"(?:\s?(?:%|€|euros?|dollars?|millions?|milliards?|milliers?))?"
    names = "|".join(sorted((re.escape(n) for m in MONTHS.values() for n in m), key=len, reverse=True))
    out, dates, seen = [], [], set()

    def record(kind, s, e):
        value = text[s:e]
        s, e = s + len(value) - len(value.lstrip()), e - len(value) + len(value.rstrip())
        if e > s and (kind, s, text[s:e].lower()) not in seen:
            seen.add((kind, s, text[s:e].lower()))
            out.append((kind, s, e, text[s:e]))

    for p in (rf"\b\d{{1,2}}(?:er|e)?\s+(?:{names})(?:\s+\d{{2,4}})?", rf"\b(?:{names})\s+\d{{4}}\b", r"\b\d{1,2}/\d{1,2}(?:/\d{2,4})?\b", r"\b\d{4}-\d{2}-\d{2}\b", r"\b(?:1[5-9]\d{2}|20\d{2})\b"):
        for m in re.finditer(p, text, re.IGNORECASE):
            record("date", *m.span())
            dates.append(m.span())
    for p in (r"\b\d{1,3}(?:[  ]\d{3})+(?:[.,]\d+)?" + unit, r"\b\d+(?:[.,]\d+)?" + unit):
        for m in re.finditer(p, text, re.IGNORECASE):
            if not any(m.start() < e and m.end() > s for s, e in dates):
                record("number", *m.span())
    for a, b in (('"', '"'), ("“", "”"), ("„", "“"), ("«", "»"), ("‹", "›"), ("‚", "‘"), ("‘", "’")):
        for m in re.finditer(f"{a}([^{b}]+){b}", text):
            if len(m[1].strip()) >= 8 and len(re.findall(r"\w+", m[1])) >= 3:
                record("quote", *m.span())
    for p in (r"(?<!\w)'([^']+)'(?!\w)", r"<<([^>]+)>>"):
        for m in re.finditer(p, text):
            if len(m[1].strip()) >= 8 and len(re.findall(r"\w+", m[1])) >= 3:
                record("quote", *m.span())
    return out


def test_text_spans(spark):
    r = random.Random(8)
    parts = ["5 mars 2021", "1er août", "March 1999", "12/05", "3/4/99", "2020-01-31", "1815", "270 000 dollars", "12,5 %", "3 000,5", "45", "n°7", "été", " ", ", ", "'", '"', "“", "”", "„", "«", "»", "‹", "›", "‚", "‘", "’", "<<", ">>", "one two three", "mai", "Décembre 20", "\n", "𝄞", "don't", "2021é", "x1900"]
    texts = ["".join(r.choice(parts) + r.choice(["", " "]) for _ in range(r.randrange(0, 30))) for _ in range(400)]
    texts += ["« he said it all »", "'it is so big'", "'a b c'", "5 mars 2021", ""]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(len(texts), None)], "i int, t string")
    got = {tuple(x) for x in extraction.text_spans(rows, ["i"], "t").collect()}
    want = {(i, *s) for i, t in enumerate(texts) for s in plain_spans(t)}
    assert got == want and {w[1] for w in want} == {"date", "number", "quote"}


def test_money_words(spark):
    values = ["3 €", "12 Euros", "5 real", "realm", "₫40", None, "won", "wonder"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert [x[0] for x in df.select(extraction.is_money(df.v)).collect()] == [True, True, True, False, True, False, True, False]


# -------------------------------------------------------------------------------------------------- snippets
def plain_place(snippet, text):
    """Every proposed start in order, each scored in full."""
    s, (t, places) = snippets.mapped(snippet)[0], snippets.mapped(text)
    if not s or len(s) > len(t):
        return None
    starts = sorted({at - m.start() for m in re.finditer(r"\d{2,}|[a-z0-9]{4,}", s) for at in range(len(t)) if t.startswith(m[0], at) and at >= m.start()})
    if not starts:
        found = SequenceMatcher(None, t, s).find_longest_match(0, len(t), 0, len(s))
        starts = [max(0, found.a - found.b)] if found.size else list(range(0, len(t) - len(s) + 1, max(1, len(s) // 6)))
    best = (-1.0, 0)
    for at in starts:
        at = min(at, len(t) - len(s))
        ratio = SequenceMatcher(None, s, t[at : at + len(s)]).ratio()
        if ratio > best[0]:
            best = (ratio, at)
    return places[best[1]], places[best[1] + len(s) - 1] + 1, best[0]


def test_snippets(spark):
    r = random.Random(6)
    words = "stone bridge river town wide old Été naïve co-op 1999 it a walks".split()
    pairs = [("xyz", "abcdefghi"), ("", "abc"), (None, "abc"), ("abc", None), ("longer than it", "short"), ("éa", "x Éa!"), ("...", "abc")]
    for _ in range(200):
        text = r.choice(["", "... "]).join(r.choice(words) + r.choice([" ", ", ", "\n"]) for _ in range(r.randrange(1, 60)))
        at = r.randrange(len(text))
        cut = list(text[at : at + r.randrange(1, 60)])
        for _ in range(len(cut) // 8):
            cut[r.randrange(len(cut))] = r.choice("abcxyz ")
        pairs.append(("".join(cut), text))
    got = [tuple(x) for x in spark.createDataFrame(list(enumerate(pairs)), "i int, p struct<s:string,t:string>").orderBy("i").select(snippets.snippet_place("p.s", "p.t").alias("x")).select("x.*").collect()]
    assert got == [plain_place(s or "", t or "") or (None, None, None) for s, t in pairs]
    assert snippets.place("seconde one", "The first — then the SECOND\tone!")[:2] == (20, 31)


# ------------------------------------------------------------------------------------------------- stitching
def plain_stitching(rows, sentences):
    """Sentence by sentence over all rows of a session, which are marked as they are picked."""
    keep, out = [bool(r[2]) for r in rows], []
    tokens = [set(canonical(r[0] or "").split()) for r in rows]
    for no, text in sentences:
        want = set(canonical(text or "").split())
        if not want:
            continue
        holding = [i for i, k in enumerate(keep) if k and len(tokens[i] & want) >= max(3, int(len(want) * 0.3))]
        covered = set().union(*(tokens[i] & want for i in holding))
        if len(covered) >= 0.85 * len(want):
            continue
        anchor, picked = min((rows[i][1] for i in holding), default=None), []
        for i in sorted(range(len(rows)), key=lambda i: (rows[i][1], i), reverse=True):
            joint = tokens[i] & want
            if keep[i] or len(joint) < 2 or len(tokens[i] - want) > 2 * len(joint) + 1 or len(joint - covered) < 2:
                continue
            if anchor is not None and anchor - rows[i][1] > 10 and len(covered) >= 0.7 * len(want):
                break
            picked.append(i)
            covered |= joint
            anchor = rows[i][1] if anchor is None else min(anchor, rows[i][1])
            if len(covered) >= 0.85 * len(want):
                break
        if len(covered) >= 0.7 * len(want):
            for i in picked:
                keep[i] = True
                out.append((i, no))
    return out


def test_stitching(spark):
    r = random.Random(7)
    words = [f"w{i}" for i in range(14)]
    sessions = []
    for _ in range(60):
        sentences = [(no, " ".join(r.sample(words, r.randrange(0, 12)))) for no in range(r.randrange(1, 7))] + [(90, None)]
        said = " ".join(t or "" for _, t in sentences).split()
        rows = [(" ".join(said[i : i + r.randrange(1, 6)]) if r.random() < 0.8 else r.choice([None, "", "w1 x y z q"]), r.choice([1.0, 2.5, 6.0]) * i, r.choice([True, False, False, None])) for i in range(0, len(said) + 4, 2)]
        sessions.append((rows, sentences))
    rows = spark.createDataFrame([(k, i, *x) for k, (rs, _) in enumerate(sessions) for i, x in enumerate(rs)], "s int, row_no int, text string, start double, keep boolean")
    sentences = spark.createDataFrame([(k, *x) for k, (_, ss) in enumerate(sessions) for x in ss], "s int, sentence_no int, text string")
    got = {tuple(x) for x in stitch.stitched(rows, sentences, "s").collect()}
    want = {(k, *x) for k, (rs, ss) in enumerate(sessions) for x in plain_stitching(rs, ss)}
    assert got == want and len(want) > 60

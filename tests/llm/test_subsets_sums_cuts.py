"""Operators 11 to 13 against plain code: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import itertools
import random
import re

import pytest
import regex

from timeloom.llm import interactions, middle, multiset

from .test_operators import SCHEMA, bag, docs, empty, prose, rows, words  # noqa: F401  fixtures


def write(spark, folder, **tables):
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory, rows, docs):  # noqa: F811
    labels = [(r[0], r[0] % 2 if r[0] % 5 else None, int(r[0] % 3 == 0), "x") for r in rows if r[0] is not None and r[0] % 4]
    labels += [(1, 0, 0, "x"), (1, 1, 1, "x"), (None, 1, 1, "x"), (10**6, 1, 1, "x")]
    return write(spark, tmp_path_factory.mktemp("tables"), documents=docs, labels=spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int, part string"))


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory, empty):  # noqa: F811
    return write(spark, tmp_path_factory.mktemp("none"), documents=empty, labels=spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))


# --------------------------------------------------------------------------------------------------- subsets
def plain_audit(rows, labels):  # noqa: F811
    marks = {}
    for doc_id, quality, toxic in labels:
        good, bad = marks.get(doc_id, (False, False))
        marks[doc_id] = (good or quality == 1, bad or toxic == 1)
    found = []
    for r in rows:
        text, w = r[1] or "", words(r[1])
        smaller = any(o[0] is not None and r[0] is not None and o[0] < r[0] and (o[1] or "") == text for o in rows)
        flags = (len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), bool(re.search("[#$%&*|]", text)), smaller)
        found.append((r[3] or "", dict(zip("ABCDE", flags, strict=True)), *(marks.get(r[0], (False, False)) if r[0] is not None else (False, False))))
    out = {}
    for part in {f[0] for f in found}:
        own = [f for f in found if f[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [f for f in left if f[1][letter]]
                left = [f for f in left if not f[1][letter]]
                failing = sum(f[1][letter] for f in own)
                alone = sum(f[1][letter] and sum(f[1].values()) == 1 for f in own)
                out[part, order, step] = [len(left), len(gone), failing - len(gone), alone, sum(f[2] for f in gone), sum(f[3] for f in gone)]
    shapley = {}
    for (part, order, step), x in out.items():
        shapley[part, order[step - 1]] = shapley.get((part, order[step - 1]), 0) + x[1]
    return bag((*k, *x, shapley[k[0], k[1][k[2] - 1]]) for k, x in out.items())


def test_filter_orders(spark, sf_dir, rows):  # noqa: F811
    got = interactions.op11_filter_cube(spark, sf_dir)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    labels = [tuple(r)[:3] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()]
    assert bag(map(tuple, got.collect())) == plain_audit(rows, labels)


def test_filter_orders_beyond_broadcasts(spark, sf_dir, rows, monkeypatch):  # noqa: F811
    monkeypatch.setattr("timeloom.llm.common.BROADCAST_ROWS", 0)
    labels = [tuple(r)[:3] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()]
    assert bag(map(tuple, interactions.op11_filter_cube(spark, sf_dir).collect())) == plain_audit(rows, labels)


def test_filters_of_any_number(spark):
    flagged = spark.createDataFrame([("p", True, False), ("p", True, True), ("q", False, False)], "part string, x boolean, y boolean")
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.shapley) for r in interactions.filter_orders(flagged, ["x", "y"], "part").collect()}
    assert got == {
        ("p", "xy", 1): (0, 2, 0, 1, 3), ("p", "xy", 2): (0, 0, 1, 0, 1), ("p", "yx", 1): (1, 1, 0, 0, 1), ("p", "yx", 2): (0, 1, 1, 1, 3),
        ("q", "xy", 1): (1, 0, 0, 0, 0), ("q", "xy", 2): (1, 0, 0, 0, 0), ("q", "yx", 1): (1, 0, 0, 0, 0), ("q", "yx", 2): (1, 0, 0, 0, 0),
    }
    with pytest.raises(ValueError):
        interactions.subset_survivors(flagged, ["x"] * 7, "part")


def test_no_documents(spark, empty_dir):
    for query in (interactions.op11_filter_cube, multiset.op12_multiset_hash, middle.op13_checkpoint_middle):
        assert query(spark, empty_dir).collect() == []


# ------------------------------------------------------------------------------------------------------ sums
def plain_vector(text):
    exact, lanes = [0] * multiset.EXACT, [0] * multiset.LANES
    for p in text.split("\n"):
        digest = hashlib.blake2b(p.encode()).digest()
        for i in range(multiset.EXACT):
            exact[i] = (exact[i] + int.from_bytes(digest[8 * i : 8 * i + 8], "little")) % (1 << 64)
        g = multiset.GRAM if len(p) >= 2 * multiset.GRAM else multiset.GRAM // 2
        for s in [p[i : i + g] for i in range(len(p) - g + 1)] if len(p) >= g else [p] * bool(p):
            h = 0
            for i in range(g):
                h = (h * 0x9E3779B97F4A7C15 + (ord(s[i]) + 1 if i < len(s) else 0)) % (1 << 64)
            h = (h ^ h >> 32) * 0xD6E8FEB86659FD93 % (1 << 64) >> 54
            lanes[h % multiset.LANES] += 1 if h < multiset.LANES else -1
    return "".join(f"{x:016x}" for x in exact) + "".join(f"{x % 65536:04x}" for x in lanes)


TEXTS = ["", "\n", "\n\n", "a", "short\n\nlines\n", prose(120, 5), "日本語のとても長い段落です\nÜnï", "x" * 300, "seven77", "eight888\neight888"]


@pytest.mark.parametrize("chunk", [1 << 20, 7])
def test_vectors(monkeypatch, chunk):
    monkeypatch.setattr(multiset, "CHUNK", chunk)
    for t in TEXTS:
        mark = multiset.Fingerprint.of(t)
        assert str(mark) == plain_vector(t) and multiset.Fingerprint.read(str(mark)) == mark


def test_sums():
    of, r = multiset.Fingerprint.of, random.Random(2)
    for t in TEXTS:
        parts = t.split("\n")
        assert of("\n".join(r.sample(parts, len(parts)))) == of(t)
        assert of(t) + of("more") - of("gone") + of("gone") == of(t + "\nmore")
        for keep in range(len(t) + 1):
            assert of(t).edited(t, keep, "new\nend") == of(t[:keep] + "new\nend")
    assert of("a\na\nb") != of("a\nb\nb") and of("a\nb") != of("a\n\nb") and of("a b") != of("b a")
    wide = of("y" * 70_000)  # its lane wraps
    assert wide + of("z") - of("y" * 70_000) == of("z")


def test_likeness():
    of = multiset.Fingerprint.of
    r = random.Random(9)
    for n in (60, 400, 4000):
        for _ in range(5):
            a, b = prose(n, r.random()), prose(n, r.random())
            for share in (0.25, 0.5, 0.75):
                cut = int(len(a) * share)
                assert abs(of(a).likeness(of(a[:cut] + b[cut:])) - share) < 0.2
            assert of(a).likeness(of(b)) < 0.25 and of(a).likeness(of(a)) == 1
    assert of("").likeness(of("\n")) == 0 and of("").likeness(of("")) == 1


def plain_neighbours(rows):  # noqa: F811
    """Expected rows; those of equal id and different text may come in either order, so ids here are distinct."""
    ordered = sorted(((r[0] is not None, r[0] or 0), r[1] or "") for r in rows)
    out = []
    for (key, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, other, following = (multiset.Fingerprint.of(x) for x in (text, edited, after))
        out.append((key[1] if key[0] else None, len(text), hashlib.sha256(edited.encode()).hexdigest(), plain_vector(text), str(other), own.likeness(other), own.likeness(following)))
    return bag(out)


@pytest.mark.parametrize("block", [4 << 20, 2000, 1])
def test_neighbours(spark, sf_dir, rows, block, monkeypatch):  # noqa: F811
    monkeypatch.setattr(multiset, "BLOCK_BYTES", block)
    monkeypatch.setattr(multiset, "OUTPUT_ROWS", 3)
    got = multiset.op12_multiset_hash(spark, sf_dir)
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert bag(map(tuple, got.collect())) == plain_neighbours(rows)


def test_neighbour_alone(spark):
    one = spark.createDataFrame([(5, "abcdef")], "doc_id bigint, text string")
    (row,) = multiset.edited_by_next(one).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and row.near_next == 1


def test_updates(spark, docs, rows):  # noqa: F811
    marks = multiset.fingerprint_documents(docs.dropDuplicates(["doc_id"])).select("row.doc_id", "fingerprint")
    changes = [(1, "one more", 1), (1, "and again", 3), (1, "and again", -1), (2, rows[2][1].split("\n")[0], -1), (999, "new", 1), (3, "back", 1), (3, "back", -1), (4, None, 1)]
    got = {r.doc_id: r.fingerprint for r in multiset.update_fingerprints(marks, spark.createDataFrame(changes, "doc_id bigint, paragraph string, times int")).collect()}
    want = {r[0]: plain_vector(r[1] or "") for r in rows}
    want |= {1: plain_vector(rows[1][1] + "\none more\nand again\nand again"), 2: plain_vector(rows[2][1].split("\n", 1)[1]), 999: plain_vector("new"), 4: plain_vector(rows[4][1] + "\n")}
    assert got == want


# ------------------------------------------------------------------------------------------------------ cuts
UNITS = [None, r"\S+\s*", r"(?s)..?", r"\d+"]


@pytest.mark.parametrize("unit", UNITS)
@pytest.mark.parametrize("every", [1, 3, 1024])
def test_cuts(every, unit):
    for text in ["", "a", "é日本 x𝄞", "some words  and 12 numbers 3", "ab" * 40 + "日本" * 9, "\n\x00 \r\n"]:
        index = middle.Checkpoints(text, every, unit)
        starts = [m.start() for m in regex.finditer(unit, text)] if unit else list(range(len(text)))
        assert index.n == len(starts)
        for i, start in enumerate([*starts, len(text)]):
            assert index.cut(i) == (len(text[:start].encode()), start)
        for char in range(len(text) + 1):
            assert index.unit_at(char, "char") == sum(s < char for s in starts)
            assert index.unit_at(len(text[:char].encode())) == sum(s < char for s in starts)
        with pytest.raises(IndexError):
            index.cut(index.n + 1)


def test_long_text_and_blocks(monkeypatch):
    monkeypatch.setattr(middle, "BLOCK", 5)  # blocks end inside characters
    text = "aé日𝄞" * 2000
    index = middle.Checkpoints(text, 64)
    assert len(index.bytes_at) == 125 and all(index.cut(i) == (len(text[:i].encode()), i) for i in range(0, 8001, 37))


def plain_middle(key, text):
    n, digits = len(text), hashlib.sha256(f"1:{key}".encode()).hexdigest()
    h = [int(digits[8 * i : 8 * i + 8], 16) for i in range(4)]
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, mid, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, sha(f"<S>{suffix}<P>{prefix}<M>{mid}"), sha(text)
    return n, "psm", a, b - a, sha(f"<P>{prefix}<S>{suffix}<M>{mid}"), sha(text)


def test_middle(spark, tmp_path, rows):  # noqa: F811
    odd = ["<P>", "a<S>b", "<<M>>", "<P", "S>", "<", "<S<P<M>", "<P <S <M " * 5, "日" * 3000, "\r\n\x0b" * 9, "<S" * 30]
    table = [*rows, *[(1000 + i, t, None, None, None, None, None, None, None, None) for i, t in enumerate(odd * 12)]]
    folder = write(spark, tmp_path, documents=spark.createDataFrame(table, SCHEMA))
    got = middle.op13_checkpoint_middle(spark, folder)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    want = bag((r[0], *plain_middle("" if r[0] is None else r[0], r[1] or "")) for r in table)
    assert bag(map(tuple, got.collect())) == want
    assert {r.form for r in got.collect()} == {"plain", "psm", "spm"}


def test_middle_of_words(spark, docs, rows):  # noqa: F811
    out = middle.fill_in_middle(docs, keep=["doc_id", "text", "row"], unit=r"\S+\s*", every=5, rate=100, suffix_first=50)
    for r in out.select("row.*", "n", "form", "prefix_chars", "middle_chars", "output", middle.restored(out.output, out.form).alias("rebuilt")).collect():
        text = r.text or ""
        assert r.rebuilt == text and r.n == len(regex.findall(r"\S+\s*", text))
        if r.form != "plain":
            starts = {m.start() for m in regex.finditer(r"\S+\s*", text)} | {len(text)}
            assert {r.prefix_chars, r.prefix_chars + r.middle_chars} <= starts

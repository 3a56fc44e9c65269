"""Operator 5, SimHash near-duplicates: a binary trie self-join over 64-bit fingerprints.

Fingerprints are made once per document in Arrow batches. Distinct fingerprints are dealt to subtrees of a
binary trie by their leading bits; each pair of subtrees whose leading bits differ by no more than the error
budget is one unit of work. In a unit, node pairs descend together, adding the differing bits, and a pair is
dropped as soon as it exceeds the budget; small node pairs compare their leaves. A unit returns a spanning
forest of the links it found, not all pairs, so a dense group of copies stays linear, and components join the
forests. Bits are ordered by balance first (a trie over any fixed order of bits finds the same links), which
keeps the subtrees even.

Defined results: null and word-less texts have fingerprint zero and are linked like any other; a null doc_id
is linked but never names a component (null where no other id is in it); repeated rows stay; an empty table
gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timeloom.operators.components import connected_components

from .common import BROADCAST_ROWS, durable, row_identity, small_join, table
from .winnow import gram_hashes, grouped_texts, word_hashes

#: Distinct fingerprints that one subtree of the frontier should hold about.
SUBTREE = 1 << 15
#: Bits of the subtrees' prefixes at most; a fingerprint is copied to the prefixes within the budget of its own.
MOST_DEPTH = 28
#: Node pairs handled at once in a task, leaf pairs compared at once, and the product of node sizes at which
#: leaves are compared.
CHUNK, COMPARED, LEAVES = 1 << 17, 1 << 21, 64


# -------------------------------------------------------------------------------------------- fingerprints
def shingle_hashes(text: bytes, k: int) -> np.ndarray:
    """XXH64 (seed 42) of the k-word shingles, repeats included; fewer words give the whole sequence."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(len(words) - k + 1, 1)
    spans = zip(starts[:n].tolist(), ends[min(k, len(words)) - 1 :].tolist(), strict=True)
    return np.fromiter((xxh64_intdigest(joined[s:e], 42) for s, e in spans), np.uint64, n)


def fingerprint(text: bytes | None, k: int = 4) -> int:
    """64 bits, each set when set in over half of the shingle hashes; zero without words."""
    h = shingle_hashes(text or b"", k)
    if not len(h):
        return 0
    counts = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(h), bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, k: int = 4, keep: list[str] | None = None) -> DataFrame:
    """``row``, the kept columns (doc_id unless named) as a struct, and ``fp``, the fingerprint as a signed long."""
    rows = docs.select(F.struct(*(["doc_id"] if keep is None else keep)).alias("row"), F.col("text").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), k) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["row", "fp"])

    return rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("fp", T.LongType())]))


# --------------------------------------------------------------------------------------------- trie join
def _roots(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    while True:
        up = parent[x]
        if (up == x).all():
            return x
        x = parent[up]


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of the pairs; pairs that already share a root cost two look-ups."""
    a, b = _roots(parent, a), _roots(parent, b)
    live = a != b
    for x, y in zip(a[live].tolist(), b[live].tolist(), strict=True):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        while parent[y] != y:
            parent[y] = parent[parent[y]]
            y = parent[y]
        if x != y:
            parent[max(x, y)] = min(x, y)


def trie_pairs(values: np.ndarray, starts: list[tuple[int, int, int, int, int, int]], budget: int, bits: int = 64, leaves: int = LEAVES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Batches of index pairs (i, j) of ``values`` that differ in 1 to ``budget`` bits.

    ``values`` has ``bits`` bits and is sorted and distinct in each range; ``starts`` lists node pairs (lo, hi,
    lo, hi, depth, differing bits) over it. Memory is bounded by CHUNK times the depth of the trie.
    """
    zeros: dict[int, np.ndarray] = {}

    def middle(lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
        if depth not in zeros:
            bit = (values >> np.uint64(bits - 1 - depth)) & np.uint64(1)
            zeros[depth] = np.concatenate(([0], np.cumsum(bit == 0)))
        z = zeros[depth]
        return lo + z[hi] - z[lo]

    stack = [(d, *(np.array([x], np.int64) for x in (a, b, c, e, diff))) for a, b, c, e, d, diff in starts]
    while stack:
        depth, al, ah, bl, bh, diff = stack.pop()
        if len(al) > CHUNK:
            half = len(al) // 2
            stack += [(depth, al[s], ah[s], bl[s], bh[s], diff[s]) for s in (slice(half), slice(half, None))]
            continue
        small = ((ah - al) * (bh - bl) <= leaves) | (depth >= bits)
        if small.any():
            lo_a, lo_b, sizes_b = al[small], bl[small], (bh - bl)[small]
            sizes = (ah - al)[small] * sizes_b
            cut = np.flatnonzero(np.diff(np.cumsum(sizes) // COMPARED)) + 1
            for part in np.split(np.arange(len(sizes)), cut):
                pair = np.repeat(part, sizes[part])
                k = np.arange(len(pair)) - np.repeat(np.cumsum(sizes[part]) - sizes[part], sizes[part])
                i, j = lo_a[pair] + k // sizes_b[pair], lo_b[pair] + k % sizes_b[pair]
                near = ((lo_a != lo_b)[pair] | (i < j)) & (np.bitwise_count(values[i] ^ values[j]) <= budget)
                yield i[near], j[near]
            al, ah, bl, bh, diff = (x[~small] for x in (al, ah, bl, bh, diff))
        if not len(al):
            continue
        am, bm = middle(al, ah, depth), middle(bl, bh, depth)
        own = (al == bl) & (ah == bh)  # a node with itself: its mirrored child pair is left out
        nexts = [(al, am, bl, bm, diff, True), (am, ah, bm, bh, diff, True), (al, am, bm, bh, diff + 1, True), (am, ah, bl, bm, diff + 1, ~own)]
        kept = []
        for a, b, c, e, d, extra in nexts:
            ok = (b > a) & (e > c) & (d <= budget) & extra
            kept.append([x[ok] for x in (a, b, c, e, d)])
        merged = [np.concatenate(x) for x in zip(*kept, strict=True)]
        if len(merged[0]):
            stack.append((depth + 1, *merged))


def trie_links(values: np.ndarray, starts: list[tuple[int, int, int, int, int, int]], budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the pairs within ``budget`` bits, as (member, root) values."""
    parent = np.arange(len(values))
    for i, j in trie_pairs(values, starts, budget):
        _unite(parent, i, j)
    root = _roots(parent, np.arange(len(values)))
    member = root != np.arange(len(values))
    return values[member], values[root[member]]


def fingerprint_components(fps: DataFrame, budget: int = 4, subtree: int = SUBTREE) -> DataFrame:
    """(fp, component): fingerprints linked to others within ``budget`` bits, directly or through others.

    ``fps`` has distinct longs in ``fp``. Fingerprints without any link are absent.
    """
    total = fps.agg(F.count("*").alias("n"), *[F.sum(F.shiftrightunsigned("fp", b).bitwiseAND(F.lit(1))).alias(f"b{b}") for b in range(64)]).first()
    n = total["n"]
    order = sorted(range(64), key=lambda b: (abs((total[f"b{b}"] or 0) / max(n, 1) - 0.5), b))  # most even bit first
    depth = max(0, min(MOST_DEPTH, int(np.ceil(np.log2(max(n / subtree, 1))))))
    masks = [sum(1 << b for b in bits) for k in range(min(budget, depth) + 1) for bits in combinations(range(depth), k)]
    prefix = F.lit(0).cast("long")
    for i, b in enumerate(order[:depth]):
        prefix = prefix.bitwiseOR(F.shiftleft(F.shiftrightunsigned("fp", b).bitwiseAND(F.lit(1)), depth - 1 - i))
    dealt = (
        fps.select("fp", prefix.alias("p"))
        .withColumn("q", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])))
        .select("fp", "p", F.least("p", F.col("p").bitwiseXOR(F.col("q"))).alias("low"), F.greatest("p", F.col("p").bitwiseXOR(F.col("q"))).alias("high"))
    )

    def permuted(x: np.ndarray) -> np.ndarray:
        out = np.zeros_like(x)
        for i, b in enumerate(order):
            out |= ((x >> np.uint64(b)) & np.uint64(1)) << np.uint64(63 - i)
        return out

    def restored(x: np.ndarray) -> np.ndarray:
        out = np.zeros_like(x)
        for i, b in enumerate(order):
            out |= ((x >> np.uint64(63 - i)) & np.uint64(1)) << np.uint64(b)
        return out.view(np.int64)

    def unit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        low, high = int(key[0]), int(key[1])
        values = np.sort(permuted(pdf["fp"].to_numpy(np.int64).view(np.uint64)))
        cut = len(values) if low == high else int((pdf["p"] == low).sum())
        start = (0, cut, 0, cut, depth, 0) if low == high else (0, cut, cut, len(values), depth, bin(low ^ high).count("1"))
        a, b = trie_links(values, [start] if cut and (low == high or cut < len(values)) else [], budget)
        return pd.DataFrame({"a": restored(a), "b": restored(b)})

    links = durable(dealt.groupBy("low", "high").applyInPandas(unit, "a bigint, b bigint"))
    return connected_components(links, "a", "b").select(F.col("node").alias("fp"), "component")


def simhash_components(rows: DataFrame, budget: int = 4) -> DataFrame:
    """Rows with ``doc_id`` and ``fp`` plus ``component_id``, the smallest doc_id within reach."""
    by_fp = durable(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")))
    linked = fingerprint_components(by_fp.select("fp"), budget)
    whole = by_fp.join(linked, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = whole.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = durable(whole.join(least, "component").select("fp", "component_id", "n"))
    total, n_fps = named.agg(F.sum("n"), F.count("*")).first()
    if n_fps <= BROADCAST_ROWS:
        return rows.join(F.broadcast(named.drop("n")), "fp")
    # fingerprints with a thousandth of the rows each, so a thousand at most, come by a broadcast; the rest is even
    often = named.filter(F.col("n") > total / 1000).drop("n").withColumn("_often", F.lit(True))
    marked = rows.join(F.broadcast(often), "fp", "left")
    rest = marked.filter("_often IS NULL").drop("component_id").join(named.filter(F.col("n") <= total / 1000).drop("n"), "fp")
    return marked.filter("_often").unionByName(rest).drop("_often")


# ------------------------------------------------------------------- near duplicates by word-shingle similarity
#: Words of a shingle, and the similarity of shingle sets (a fraction) from which two texts are near copies.
SHINGLE, SIMILAR = 5, (4, 5)
#: The prefixes of two texts must share JOINT shingles and one more for each JOINT_STEP of the smaller set before
#: the texts are compared, or all that similar sets of their sizes are sure to share where these are fewer.
JOINT, JOINT_STEP = 3, 32
#: Common shingles: one in SAMPLE rows is counted, shingles of HOT rows of it or more stand last in the order
#: of prefixes. Any order gives the same links; this one keeps common passages out of the prefixes.
SAMPLE, HOT = 16, 8

_TOKEN = np.ones(256, bool)
_TOKEN[[32, 9, 10, 11, 12, 13]] = False


def _shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Sorted 64-bit hashes of the distinct shingles of each text; fewer words give the whole sequence."""
    for _, data, offsets in grouped_texts(column):
        h, firsts = word_hashes(data, offsets, _TOKEN)
        for i in range(len(offsets) - 1):
            words = h[firsts[i] : firsts[i + 1]]
            grams = np.sort(gram_hashes(words, min(SHINGLE, len(words)))) if len(words) else words
            yield grams[np.concatenate(([True], grams[1:] != grams[:-1]))] if len(grams) else grams


def _longs(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.empty(0, np.uint64), *arrays]).view(np.int64)))


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for s in _shingle_sets(batch.column(0)):
            yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64))], names=["token"])


def _joint(n):
    return JOINT + n // JOINT_STEP


def _prefixes(hot: np.ndarray):
    """Rows with the hash and size of their shingle set, the fingerprint of the text and the set's prefix: sets
    that share the part SIMILAR of their union share members of both prefixes, as many as the smaller set's
    _joint, or all that they share, in any fixed order of shingles. ``hot`` is sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in batches:
            fids, sizes, fps, firsts = [], [], [], []
            for s, text in zip(_shingle_sets(batch.column(3)), batch.column(3), strict=True):
                common = hot[np.minimum(np.searchsorted(hot, s), len(hot) - 1)] == s if len(hot) else np.zeros(len(s), bool)
                fids.append(xxh64_intdigest(s.tobytes(), 5))
                sizes.append(len(s))
                fps.append(fingerprint(text.as_py()))
                firsts.append(np.concatenate((s[~common], s[common]))[: len(s) + _joint(len(s)) + -len(s) * SIMILAR[0] // SIMILAR[1]])
            columns = [pa.array(np.array(fids, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), pa.array(np.array(fps, np.uint64).view(np.int64)), _longs(firsts)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], names=["row_a", "row_b", "did", "fid", "n", "fp", "prefix"])

    return run


def _by_token(work):
    """Calls ``work`` with the columns of whole groups of a partition sorted by token, its first column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy() for c in batch.columns]
            held = columns if held is None else [np.concatenate(x) for x in zip(held, columns, strict=True)]
            cut = int(np.argmax(held[0] == held[0][-1]))
            if cut:
                yield from work(*[c[:cut] for c in held])
                held = [c[cut:] for c in held]
        if held is not None:
            yield from work(*held)

    return run


def _groups(token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
    return first, np.diff(np.append(first, len(token)))


def _shared(token, fid, n, pos) -> Iterator[pa.RecordBatch]:
    """Only tokens of two or more members; rows with equal sets are one member."""
    new = np.concatenate(([True], (token[1:] != token[:-1]) | (fid[1:] != fid[:-1])))
    token, fid, n, pos = (c[new] for c in (token, fid, n, pos))
    sizes = _groups(token)[1]
    take = np.repeat(sizes, sizes) > 1
    yield pa.RecordBatch.from_arrays([pa.array(c[take]) for c in (token, fid, n, pos)], names=["token", "fid", "n", "pos"])


def _proposed(fid: np.ndarray, n: np.ndarray, pos: np.ndarray, component: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    """Pairs that aren't connected and can be similar with this as one of the joint shingles that they need: how
    many they share here, and how many they need."""
    least = -(-(n[i].astype(np.int64) + n[j]) * SIMILAR[0] // (SIMILAR[0] + SIMILAR[1]))
    need = np.minimum(least, _joint(np.minimum(n[i], n[j])))
    ok = (component[i] != component[j]) & (np.minimum(n[i] - pos[i], n[j] - pos[j]) + need - 1 >= least)
    a, b, need = fid[i[ok]], fid[j[ok]], need[ok]
    out, first, joint = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b))), axis=1, return_index=True, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (out[0], out[1], joint, need[first])], names=["a", "b", "joint", "need"])


def _star_pairs(token, fid, n, pos, component) -> Iterator[pa.RecordBatch]:
    """The first member of each token with the others."""
    first, sizes = _groups(token)
    hub, other = np.repeat(first, sizes), np.arange(len(token))
    yield _proposed(fid, n, pos, component, hub, other)


def _cross_pairs(token, fid, n, pos, component) -> Iterator[pa.RecordBatch]:
    """All pairs of members of a token."""
    first, sizes = _groups(token)
    mixed = np.minimum.reduceat(component, first) != np.maximum.reduceat(component, first)
    token, fid, n, pos, component = (c[np.repeat(mixed, sizes)] for c in (token, fid, n, pos, component))
    left, right, held, step = [], [], 0, 1
    i = np.arange(len(token))
    while True:  # each member with the one that stands so many places behind it
        i = i[i < len(token) - step]
        i = i[token[i] == token[i + step]]
        if held and (held > COMPARED or not len(i)):
            yield _proposed(fid, n, pos, component, np.concatenate(left), np.concatenate(right))
            left, right, held = [], [], 0
        if not len(i):
            return
        left.append(i)
        right.append(i + step)
        held += len(i)
        step += 1


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (a, fid, text) sorted by a, the text of a itself first, the pairs whose similarity, counted shingle by
    shingle, reaches SIMILAR."""
    hub = None
    for batch in batches:
        found = []
        for a, b, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _shingle_sets(batch.column(2)), strict=True):
            if a == b:
                hub = x
            else:
                joint = len(np.intersect1d(hub, x, assume_unique=True))
                if joint * SIMILAR[1] >= (len(hub) + len(x) - joint) * SIMILAR[0]:
                    found.append((a, b))
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])


def similar_links(named: DataFrame, rows: DataFrame) -> DataFrame:
    """(a, b): pairs of ``fid`` of similar shingle sets, enough of them to connect all that are connected.

    ``rows`` are the prefix rows of ``named``. The trie join of the fingerprints proposes the near copies, the
    smallest member of each of its components with the others. Similar texts whose fingerprints are further apart
    share shingles of both prefixes: first every shingle proposes its smallest member with the others, then all
    pairs of members, each time of those that are still apart. So no similar pair is missed; each is verified.
    """
    postings = rows.select("fid", "n", F.posexplode("prefix").alias("pos", "token")).select("token", "fid", "n", "pos")
    dealt = lambda df: df.repartition("token").sortWithinPartitions("token", "fid")
    members = durable(rows.groupBy("fid").agg(F.min(F.struct("row_a", "row_b")).alias("place"), F.min("fp").alias("fp")))

    def verified(pairs: DataFrame) -> DataFrame:
        meet = pairs.select("a", F.explode(F.array("a", "b")).alias("fid")).groupBy("fid").agg(F.collect_set("a").alias("at"))
        meet = durable(meet.join(members, "fid").select("place.row_a", "place.row_b", "fid", "at"))
        texts = named.select("row_a", "row_b", F.col("text").cast("binary").alias("text"))
        met = texts.join(F.broadcast(meet) if meet.count() <= BROADCAST_ROWS else meet.hint("shuffle_hash"), ["row_a", "row_b"])
        met = met.select(F.explode("at").alias("a"), "fid", "text").repartition("a").sortWithinPartitions("a", F.col("fid") != F.col("a"))
        return durable(met.mapInArrow(_similar, "a bigint, b bigint"))

    near = small_join(members, fingerprint_components(members.select("fp").distinct()), ["fp"], "left").select("fid", F.coalesce("component", "fp").alias("component"))
    hubs = durable(near.groupBy("component").agg(F.min("fid").alias("a"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    tried = durable(small_join(near, hubs, ["component"]).filter("fid > a").select("a", F.col("fid").alias("b")))
    links = verified(tried)
    shared = durable(dealt(postings).mapInArrow(_by_token(_shared), "token bigint, fid bigint, n int, pos int"))
    for propose in (_star_pairs, _cross_pairs):
        known = durable(connected_components(links, "a", "b").withColumnRenamed("node", "fid"))
        apart = small_join(shared, known, ["fid"], "left").select("token", "fid", "n", "pos", F.coalesce("component", "fid").alias("component"))
        pairs = dealt(apart).mapInArrow(_by_token(propose), "a bigint, b bigint, joint bigint, need bigint").groupBy("a", "b")
        pairs = pairs.agg(F.sum("joint").alias("joint"), F.max("need").alias("need")).filter("joint >= need").select("a", "b")
        pairs = durable(pairs.join(tried, ["a", "b"], "left_anti"))
        links, tried = links.unionByName(verified(pairs)), tried.unionByName(pairs)
    return links


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id; all columns unchanged.

    Near copies share five-word shingles with similarity 0.8 or more, counted exactly (shingles are compared by
    64-bit hashes); groups are connected through such links, found by the trie join of the fingerprints and, beyond
    its four bits, by shingles. Equal shingle sets are one member, texts without
    words too.
    """
    named = docs.withColumns(dict(zip(("row_a", "row_b"), row_identity("doc_id", "text", "lang", "source"), strict=True)))
    sample = named.filter(F.pmod("row_b", F.lit(SAMPLE)) == 0).select(F.col("text").cast("binary").alias("text")).mapInArrow(_sampled, "token bigint")
    hot = sample.groupBy("token").agg(F.count("*").alias("n")).filter(F.col("n") >= HOT).orderBy(F.desc("n"), "token").limit(BROADCAST_ROWS)
    hot = np.sort(np.array([r[0] for r in hot.select("token").collect()], np.int64).view(np.uint64))
    last = F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("did")
    rows = durable(
        named.select("row_a", "row_b", last, F.col("text").cast("binary").alias("text"))
        .mapInArrow(_prefixes(hot), "row_a bigint, row_b bigint, did bigint, fid bigint, n int, fp bigint, prefix array<bigint>")
    )
    groups = connected_components(similar_links(named, rows), "a", "b")
    grouped = small_join(rows, durable(groups.withColumnRenamed("node", "fid")), ["fid"], "left").select("row_a", "row_b", "did", F.coalesce("component", "fid").alias("component"))
    by_row = grouped.groupBy("component", "row_a", "row_b").agg(F.min("did").alias("did"), F.count("*").alias("n"))
    best = by_row.groupBy("component").agg(F.min(F.struct("did", "row_a", "row_b")).alias("best"))
    stays = best.select("best.row_a", "best.row_b", F.lit(True).alias("stays"))
    judged = durable(by_row.join(stays, ["row_a", "row_b"], "left").select("row_a", "row_b", F.coalesce("stays", F.lit(False)).alias("stays"), "n"))
    lost = judged.filter(~F.col("stays")).select("row_a", "row_b")
    n_lost, most = judged.agg(F.count_if(~F.col("stays")), F.max(F.when(F.col("stays"), F.col("n")))).first()
    kept = named.join(F.broadcast(lost) if n_lost <= BROADCAST_ROWS else lost.hint("shuffle_hash"), ["row_a", "row_b"], "left_anti")
    if (most or 0) > 1:  # wholly equal rows
        kept = kept.dropDuplicates(["row_a", "row_b"])
    return kept.select(*docs.columns)


def op5_simhash_trie(spark, sf_dir: str) -> DataFrame:
    """Contract query: fingerprint and component of every document."""
    rows = durable(with_fingerprints(table(spark, sf_dir, "documents")).select("row.doc_id", "fp"))
    return simhash_components(rows).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

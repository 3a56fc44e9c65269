"""The pipeline against its stages in plain code, on a table small enough that no estimate is made."""

import hashlib
import random

import pytest

from . import test_operators as plain

P = pytest.importorskip("public_tokenizers")


def _documents():
    r = random.Random(23)
    base = [plain.prose(r.randrange(40, 120), 300 + i) for i in range(30)]
    texts = [*base, base[0], base[1].replace(".", "!"), "short text", None, base[2] + "\nShared closing line with enough words to count", base[3] + "\nShared closing line with enough words to count"]
    texts += [" ".join(base[4].split()[:-3]), base[5].split("\n")[0] + "\n" + plain.prose(60, 900), " ".join(plain.prose(80, 901).split()[:30] + plain.prose(30, 902).split()), ""]
    return [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]


def _expected(rows, items):
    import tiktoken

    rows = [r for r in rows if not plain.plain_statistics(r[1])[5]]
    kept = [(d, t) for (d, t) in plain.plain_line_dedup([(r[0], r[1]) for r in rows])]
    ids = set(plain.plain_survivors([(d, t or "") for d, t in kept]))
    kept = [(d, t) for d, t in kept if d in ids]
    clean = {x[0] for x in plain.plain_contamination(kept, items) if not x[5]}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=plain.bpe.Coder(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).ranks, special_tokens={})
    out = []
    for d, t in kept:
        if d in clean:
            tokens = enc.encode_ordinary(t)
            out.append((d, len(tokens), hashlib.sha256(",".join(map(str, tokens)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    return out


def test_pipeline_against_plain_code(spark, tmp_path):
    import corpus_pipeline

    rows = _documents()
    items = [(1, " ".join(plain.prose(30, 902).split()[2:25])), (2, "nothing of this is in the documents at all today")]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    want = _expected(rows, items)
    assert plain.bag(map(tuple, got)) == plain.bag(want)
    assert 20 < len(want) < len(rows) - 5


def test_each_stage_keeps_the_columns(spark, tmp_path):
    import corpus_pipeline

    docs = spark.createDataFrame(_documents(), "doc_id bigint, text string, lang string, source string, n_chars bigint")
    spark.createDataFrame([(1, "x")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0

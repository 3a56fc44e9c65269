"""Corpus preparation in five stages; each takes (spark, docs, sf_dir) and works on all rows it is given.

The first four return the columns of ``documents``; the last returns the encoded form of every document left.
"""

from __future__ import annotations

from timeloom.llm import bpe, quality, simhash, templates, winnow
from timeloom.llm.common import table


def quality_rules(spark, docs, sf_dir):
    """Documents that fail the base rules or lie outside their language and source go."""
    return quality.quality_filter(docs)


def line_dedup(spark, docs, sf_dir):
    """Lines of recurring templates go from all documents but the first."""
    return templates.drop_recurring_lines(docs)


def near_dedup(spark, docs, sf_dir):
    """One document of each group of near copies stays."""
    return simhash.drop_near_duplicates(docs)


def decontamination(spark, docs, sf_dir):
    """Documents that hold a window of the benchmark go."""
    return winnow.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark, docs, sf_dir):
    """Byte-level BPE ids of every document and the round trip to its bytes."""
    import public_tokenizers

    coded = bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", encoding),
]

#: SQL can't express the estimates, the trie join and the encoding; tests hold the stages against plain code.
ORACLE_SQL = None


def run(spark, sf_dir: str):
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs

"""Queries of the corpus operators and, where SQL can express one, the SQL of the same rows."""

from __future__ import annotations

from collections.abc import Callable

from . import bpe, counts, fixity, interactions, middle, multiset, pseudonyms, quality, secrets, shards, simhash, templates, winnow


def queries() -> dict[str, Callable]:
    return {
        "op1_mcd_quality": quality.op1_mcd_quality,
        "op2_merkle_fixity": fixity.op2_merkle_fixity,
        "op3_winnowing": winnow.op3_winnowing,
        "op4_sampled_splitters": shards.op4_sampled_splitters,
        "op5_simhash_trie": simhash.op5_simhash_trie,
        "op6_byte_bpe": bpe.op6_byte_bpe,
        "op7_secret_novelty": secrets.op7_secret_novelty,
        "op8_prefix_counts": counts.op8_prefix_counts,
        "op9_line_templates": templates.op9_line_templates,
        "op10_feistel_pseudonyms": pseudonyms.op10_feistel_pseudonyms,
        "op11_filter_cube": interactions.op11_filter_cube,
        "op12_multiset_hash": multiset.op12_multiset_hash,
        "op13_checkpoint_middle": middle.op13_checkpoint_middle,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_merkle_fixity": fixity.OP2_SQL,
        "op3_winnowing": winnow.OP3_SQL,
        "op9_line_templates": templates.OP9_SQL,
        "op11_filter_cube": interactions.OP11_SQL,
        "op13_checkpoint_middle": middle.OP13_SQL,
    }

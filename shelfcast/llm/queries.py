"""Registered queries of the training-data operators, and DuckDB SQL where it can express them."""

from __future__ import annotations

from . import bpe, collocations, fingerprints, hard_negatives, mixing, neardup, pii, quality, secret_scan, sharding, suffix_dedup, toxicity, warc

QUERIES = {
    "op1_bpe": bpe.op1,
    "op2_sharding": sharding.op2,
    "op3_simhash_near_dedup": neardup.op3,
    "op4_warc": warc.op4,
    "op5_secret_scan": secret_scan.op5,
    "op6_quality_rules": quality.op6,
    "op7_mixing": mixing.op7,
    "op8_fingerprints": fingerprints.op8,
    "op9_pii": pii.op9,
    "op10_toxicity": toxicity.op10,
    "op11_collocations": collocations.op11,
    "op12_hard_negatives": hard_negatives.op12,
    "op13_suffix_dedup": suffix_dedup.op13,
}

#: the other operators are tested against brute force, round trips or held-out accuracy in tests/llm
ORACLE = {
    "op4_warc": warc.ORACLE,
    "op6_quality_rules": quality.ORACLE,
    "op7_mixing": mixing.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
    "op13_suffix_dedup": suffix_dedup.ORACLE,
}

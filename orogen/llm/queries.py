"""The registered queries of the training-data operators."""

from __future__ import annotations

from . import embedding_lsh, hilbert, mixing, packing, quality_crf, simhash, suffix_dedup, toxicity, url_filter, winnow

QUERIES = {
    "op1_hilbert": hilbert.op1_hilbert,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_winnowing": winnow.op3_winnowing,
    "op4_packing": packing.op4_packing,
    "op5_simhash": simhash.op5_simhash,
    "op6_suffix_dedup": suffix_dedup.op6_suffix_dedup,
    "op7_quality_crf": quality_crf.op7_quality_crf,
    "op8_url_filter": url_filter.op8_url_filter,
    "op9_mixing": mixing.op9_mixing,
    "op10_embedding_lsh": embedding_lsh.op10_embedding_lsh,
}

#: Queries without an entry have no SQL form (hash bits, iteration, models); tests/llm holds them against brute force.
ORACLES: dict[str, str] = {"op8_url_filter": url_filter.ORACLE}

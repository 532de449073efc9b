"""The registered opN queries and their SQL oracles."""

from __future__ import annotations

from earshot.llm import decontaminate, exact_dedup, html_extract, lexical, line_dedup, merkle, ngram_join, pii, quality_gam, sentencepiece_codec, sharding, token_counts, warc

QUERIES = {
    "op1_decontamination": decontaminate.op1_decontamination,
    "op2_html_extraction": html_extract.op2_html_extraction,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_warc": warc.op4_warc,
    "op5_line_dedup": line_dedup.op5_line_dedup,
    "op6_sentencepiece": sentencepiece_codec.op6_sentencepiece,
    "op7_sharding": sharding.op7_sharding,
    "op8_ngram_join": ngram_join.op8_ngram_join,
    "op9_token_counts": token_counts.op9_token_counts,
    "op10_quality": quality_gam.op10_quality,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_pii": pii.op12_pii,
    "op13_ranked_search": lexical.op13_ranked_search,
}
ORACLES = {
    "op1_decontamination": decontaminate.ORACLE,
    "op3_exact_dedup": exact_dedup.ORACLE,
    "op4_warc": warc.ORACLE,
    "op5_line_dedup": line_dedup.ORACLE,
    "op7_sharding": sharding.ORACLE,
    "op8_ngram_join": ngram_join.ORACLE,
    "op11_merkle_manifest": merkle.ORACLE,
    "op12_pii": pii.ORACLE,
    "op13_ranked_search": lexical.ORACLE,
}

"""Registered queries of the corpus operators (see ``__spark_entry__.py``)."""

from __future__ import annotations

import corpus_pipeline
from lodestar.llm import (op1_toxicity, op2_license, op3_token_ids, op4_pii, op5_decontaminate, op6_exact,
                          op7_neardup, op8_substring, op9_sentencepiece, op10_language, op11_align, op12_collocations,
                          op13_simhash)

QUERIES = {
    "op1_toxicity": op1_toxicity.query,
    "op2_license": op2_license.query,
    "op3_token_ids": op3_token_ids.query,
    "op4_pii": op4_pii.query,
    "op5_decontaminate": op5_decontaminate.query,
    "op6_exact_dedup": op6_exact.query,
    "op7_minhash_neardup": op7_neardup.query,
    "op8_substring_dedup": op8_substring.query,
    "op9_sentencepiece": op9_sentencepiece.query,
    "op10_language": op10_language.query,
    "op11_align": op11_align.query,
    "op12_collocations": op12_collocations.query,
    "op13_simhash": op13_simhash.query,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op6_exact_dedup": op6_exact.ORACLE,
    "op7_minhash_neardup": op7_neardup.ORACLE,
    "op8_substring_dedup": op8_substring.ORACLE,
    "op12_collocations": op12_collocations.ORACLE,
}

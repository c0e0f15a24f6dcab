"""The registered queries of this package and their SQL, for ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from layerkit.llm import chat_parts, lexical_search, license_rules, near_dedup, secret_ledger
from layerkit.llm.bpe_automaton import op7_bpe_automaton
from layerkit.llm.chunk_bpe import op13_chunk_bpe
from layerkit.llm.cotraining import op8_cotraining
from layerkit.llm.cross_polytope import op2_cross_polytope
from layerkit.llm.decision_list import op4_decision_list
from layerkit.llm.mixing import op3_pfair_mix
from layerkit.llm.subword_toxicity import op10_subword_toxicity
from layerkit.llm.whitening import op11_whitening


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_minhash": near_dedup.op1_minhash,
        "op2_cross_polytope": op2_cross_polytope,
        "op3_pfair_mix": op3_pfair_mix,
        "op4_decision_list": op4_decision_list,
        "op5_license_rules": license_rules.op5_license_rules,
        "op6_secret_ledger": secret_ledger.op6_secret_ledger,
        "op7_bpe_automaton": op7_bpe_automaton,
        "op8_cotraining": op8_cotraining,
        "op9_chat_parts": chat_parts.op9_chat_parts,
        "op10_subword_toxicity": op10_subword_toxicity,
        "op11_whitening": op11_whitening,
        "op12_lexical_search": lexical_search.op12_lexical_search,
        "op13_chunk_bpe": op13_chunk_bpe,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_minhash": near_dedup.ORACLE,
        "op5_license_rules": license_rules.ORACLE,
        "op6_secret_ledger": secret_ledger.ORACLE,
        "op9_chat_parts": chat_parts.ORACLE,
        "op12_lexical_search": lexical_search.ORACLE,
    }

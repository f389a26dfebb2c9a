"""The queries of this subpackage by name, and their SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

#: Module, query. Each module has a function of the query's name and may have ORACLE_SQL.
_OPERATORS = [
    ("quality", "op1_hashed_ngram_llr"),
    ("fst", "op2_transducer_token_counts"),
    ("chat", "op3_prefix_target_chat"),
    ("langid", "op5_ecoc_language_id"),
    ("neardup", "op6_fast_sketch_near_duplicates"),
    ("wavelet", "op4_wavelet_matrix_shards"),
    ("decontaminate", "op7_winnowing_decontamination"),
    ("repeats", "op8_common_prefix_interval_repeats"),
    ("mixing", "op9_systematic_mixing"),
    ("pii", "op10_pii_spans"),
    ("repair", "op11_conversation_viterbi_repair"),
    ("periodic", "op12_suffix_automaton_runs"),
    ("topk", "op13_norm_sorted_topk"),
]

#: Parts of an operator's result that SQL can say, each with the name of its SQL.
_PARTS = [("quality", "quality_base_counts", "BASE_SQL"), ("pii", "pii_base_spans", "BASE_SQL")]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: getattr(import_module(f"{__package__}.{module}"), name) for module, name, *_ in [*_OPERATORS, *_PARTS]}


def oracle_sql() -> dict[str, str]:
    named = [*((module, name, "ORACLE_SQL") for module, name in _OPERATORS), *_PARTS]
    found = {name: getattr(import_module(f"{__package__}.{module}"), sql, None) for module, name, sql in named}
    return {name: sql for name, sql in found.items() if sql}

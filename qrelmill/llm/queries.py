"""The dealt queries and their SQL; the bindings add them where this folder exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from qrelmill.llm import (
    context_mixing,
    decontamination,
    exact_dedup,
    filter_audit,
    hamming_search,
    jaccard_join,
    mixing,
    resampling,
    sentence_pieces,
    simplex_clustering,
    suffix_dedup,
    token_counts,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_importance_resampling": resampling.op1_importance_resampling,
    "op2_binary_fuse_dedup": exact_dedup.op2_binary_fuse_dedup,
    "op3_streaming_viterbi": sentence_pieces.op3_streaming_viterbi,
    "op4_transducer_token_counts": token_counts.op4_transducer_token_counts,
    "op5_bucket_pointer_dedup": suffix_dedup.op5_bucket_pointer_dedup,
    "op6_entropy_balancing": mixing.op6_entropy_balancing,
    "op7_divide_skip_jaccard": jaccard_join.op7_divide_skip_jaccard,
    "op8_multi_index_hashing": hamming_search.op8_multi_index_hashing,
    "op9_seekable_warc": warc.op9_seekable_warc,
    "op10_logistic_context_mixing": context_mixing.op10_logistic_context_mixing,
    "op11_simplex_centroids": simplex_clustering.op11_simplex_centroids,
    "op12_posting_list_audit": filter_audit.op12_posting_list_audit,
    "op13_benchmark_windows": decontamination.op13_benchmark_windows,
}
ORACLES: dict[str, str] = {
    "op2_binary_fuse_dedup": exact_dedup.ORACLE,
    "op7_divide_skip_jaccard": jaccard_join.ORACLE,
    "op8_multi_index_hashing": hamming_search.ORACLE,
    "op9_seekable_warc": warc.ORACLE,
    "op11_simplex_centroids": simplex_clustering.ORACLE,
    "op12_posting_list_audit": filter_audit.ORACLE,
    "op13_benchmark_windows": decontamination.ORACLE,
}

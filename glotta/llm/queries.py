"""The operators applied to their whole tables: ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

from glotta.llm import (byte_bpe, compact_windows, decontamination, html_density, line_dedup, merkle, outliers, packing,
                        pii, prefix_trie, simhash, suffix_dedup, warc)
from glotta.llm.oracles import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES = {
    "op1_warc_revisits": warc.op1_warc_revisits,
    "op2_boosted_pii": pii.op2_boosted_pii,
    "op3_robust_quality_outliers": outliers.op3_robust_quality_outliers,
    "op4_bm25_decontamination": decontamination.op4_bm25_decontamination,
    "op5_composite_text_density": html_density.op5_composite_text_density,
    "op6_compact_windows": compact_windows.op6_compact_windows,
    "op7_blockwise_suffix_dedup": suffix_dedup.op7_blockwise_suffix_dedup,
    "op8_reduced_best_fit_packing": packing.op8_reduced_best_fit_packing,
    "op10_segment_line_join": line_dedup.op10_segment_line_join,
    "op9_covering_simhash": simhash.op9_covering_simhash,
    "op11_splitter_skeleton_trie": prefix_trie.op11_splitter_skeleton_trie,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_segment_tree_bpe": byte_bpe.op13_segment_tree_bpe,
}

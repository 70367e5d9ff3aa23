"""Registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from remitflow.llm.alignment import op11_cross_tokenizer_alignment
from remitflow.llm.ann import op10_approximate_nearest_neighbours
from remitflow.llm.bpe import op6_byte_level_bpe
from remitflow.llm.clustering import OP13_SQL, op13_centroid_clustering
from remitflow.llm.embedding_dedup import op9_embedding_near_dedup
from remitflow.llm.language_id import op1_language_id
from remitflow.llm.line_dedup import OP4_SQL, op4_line_dedup
from remitflow.llm.packing import op8_best_fit_packing
from remitflow.llm.quality import op5_quality_classifier
from remitflow.llm.secrets import op7_secret_scans
from remitflow.llm.simhash import op2_simhash_near_dedup
from remitflow.llm.suffix_dedup import op3_suffix_array_dedup
from remitflow.llm.vector_packing import op12_instruction_packing

QUERIES = {f.__name__: f for f in (op1_language_id, op2_simhash_near_dedup, op3_suffix_array_dedup, op4_line_dedup, op5_quality_classifier, op6_byte_level_bpe, op7_secret_scans, op8_best_fit_packing,
                                   op9_embedding_near_dedup, op10_approximate_nearest_neighbours, op11_cross_tokenizer_alignment, op12_instruction_packing, op13_centroid_clustering)}

#: DuckDB SQL where it can express a query over whole tables; the others are tested in tests/llm.
ORACLE: dict[str, str] = {"op4_line_dedup": OP4_SQL, "op13_centroid_clustering": OP13_SQL}

"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (centroid_clustering, exact_dedup, language_id, mixing, near_dedup, packing, private_spans, projected_neighbours, sharding, substring_dedup,
               token_alignment, token_counts, warc_derivatives)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": token_counts.op1_token_counts,
    "op2_warc_derivatives": warc_derivatives.op2_warc_derivatives,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_sharding": sharding.op4_sharding,
    "op5_mixing": mixing.op5_mixing,
    "op6_packing": packing.op6_packing,
    "op7_projected_neighbours": projected_neighbours.op7_projected_neighbours,
    "op8_near_dedup": near_dedup.op8_near_dedup,
    "op9_substring_dedup": substring_dedup.op9_substring_dedup,
    "op10_language_id": language_id.op10_language_id,
    "op11_centroid_clustering": centroid_clustering.op11_centroid_clustering,
    "op12_private_spans": private_spans.op12_private_spans,
    "op13_token_alignment": token_alignment.op13_token_alignment,
}

ORACLE_SQL: dict[str, str] = {
    "op3_exact_dedup": exact_dedup.OP3_SQL,
    "op5_mixing": mixing.oracle_sql(),
    "op11_centroid_clustering": centroid_clustering.oracle_sql(),
}

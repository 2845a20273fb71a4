"""The corpus operators' registered queries and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomline.llm import alignment, ann, ctw, html_extract, lang_id, mixing, neardup, parity_join, pii, point_in_time, quality, sp_unigram, token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": sp_unigram.op1_sentencepiece,
    "op2_mixing": mixing.op2_mixing,
    "op3_language_id": lang_id.op3_language_id,
    "op4_ann": ann.op4_ann,
    "op5_quality": quality.op5_quality,
    "op8_near_dedup": neardup.op8_near_dedup,
    "op6_html": html_extract.op6_html,
    "op7_token_counts": token_counts.op7_token_counts,
    "op9_lm_scoring": ctw.op9_lm_scoring,
    "op10_pii": pii.op10_pii,
    "op11_alignment": alignment.op11_alignment,
    "op12_point_in_time": point_in_time.op12_point_in_time,
    "op13_ngram_join": parity_join.op13_ngram_join,
}
ORACLES: dict[str, str] = {
    "op2_mixing": mixing.ORACLE,
    "op12_point_in_time": point_in_time.ORACLE,
}

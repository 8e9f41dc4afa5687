"""Registered queries of the training-data operators."""

from __future__ import annotations

from patchloom.llm import decontaminate, extract, langid, linedup, lm, neardup, packing, pieces, quality, sql, toxicity


def queries() -> dict:
    return {
        "op1_near_dedup": neardup.op1_near_dedup,
        "op2_extract": extract.op2_extract,
        "op3_lm_score": lm.op3_lm_score,
        "op4_line_dedup": linedup.op4_line_dedup,
        "op5_decontaminate": decontaminate.op5_decontaminate,
        "op6_sentencepiece": pieces.op6_sentencepiece,
        "op7_quality_rules": quality.op7_quality_rules,
        "op8_token_shards": packing.op8_token_shards,
        "op9_language_id": langid.op9_language_id,
        "op10_toxicity": toxicity.op10_toxicity,
    }


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLES)

"""Registered queries of the training-data operators."""

from __future__ import annotations

from casekit.llm import decontaminate, hardneg, langid, lm, mixing, neardup, quality, runs, sharding, tokens, topk, vecdup, warc


def queries() -> dict:
    return {
        "op1_decontaminate": decontaminate.op1_decontaminate,
        "op2_near_duplicates": neardup.op2_near_duplicates,
        "op3_exact_topk": topk.op3_exact_topk,
        "op4_token_shards": tokens.op4_token_shards,
        "op5_lm_scores": lm.op5_lm_scores,
        "op6_quality": quality.op6_quality,
        "op7_mixing": mixing.op7_mixing,
        "op8_language_id": langid.op8_language_id,
        "op9_warc": warc.op9_warc,
        "op10_sharding": sharding.op10_sharding,
        "op11_hard_negatives": hardneg.op11_hard_negatives,
        "op12_periodic_runs": runs.op12_periodic_runs,
        "op13_vector_duplicates": vecdup.op13_vector_duplicates,
    }


def oracle_sql() -> dict[str, str]:
    """Operators SQL can express; the others have brute-force tests."""
    return {
        "op1_decontaminate": decontaminate.ORACLE,
        "op2_near_duplicates": neardup.ORACLE,
        "op3_exact_topk": topk.ORACLE,
        "op7_mixing": mixing.ORACLE,
        "op9_warc": warc.ORACLE,
        "op11_hard_negatives": hardneg.ORACLE,
        "op13_vector_duplicates": vecdup.ORACLE,
    }

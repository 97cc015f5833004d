"""Queries of the training-data operators, opN_<name>, and SQL for those that SQL can express."""

from __future__ import annotations

from . import audio, bpe, chunk_dedup, jaccard_join, packing, pii, qda, quality_rules, reply_trees, sharding


def queries() -> dict:
    return {
        "op1_telephony_audio": audio.op1_telephony_audio,
        "op2_extendible_sharding": sharding.op2_extendible_sharding,
        "op3_quality_qda": qda.op3_quality_qda,
        "op4_nnls_packing": packing.op4_nnls_packing,
        "op5_reply_trees": reply_trees.op5_reply_trees,
        "op6_jaccard_join": jaccard_join.op6_jaccard_join,
        "op7_chunk_dedup": chunk_dedup.op7_chunk_dedup,
        "op8_quality_rules": quality_rules.op8_quality_rules,
        "op9_pii": pii.op9_pii,
        "op10_byte_bpe": bpe.op10_byte_bpe,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_extendible_sharding": sharding.ORACLE, "op5_reply_trees": reply_trees.ORACLE, "op8_quality_rules": quality_rules.ORACLE}

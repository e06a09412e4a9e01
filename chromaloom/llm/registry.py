"""Queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from . import chat, decontaminate, filter_audit, importance, line_dedup, mixture, ngram_join, pseudonyms, quality, simhash, token_counts, toxicity, warc

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_mixing": mixture.op2_mixing,
    "op3_ngram_jaccard_join": ngram_join.op3_ngram_jaccard_join,
    "op4_chat_rotation": chat.op4_chat_rotation,
    "op5_quality_rules": quality.op5_quality_rules,
    "op6_warc_packages": warc.op6_warc_packages,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_pseudonyms": pseudonyms.op8_pseudonyms,
    "op9_decontamination": decontaminate.op9_decontamination,
    "op10_token_counts": token_counts.op10_token_counts,
    "op11_filter_audit": filter_audit.op11_filter_audit,
    "op12_importance_resampling": importance.op12_importance_resampling,
    "op13_simhash": simhash.op13_simhash,
}

ORACLES: dict[str, str] = {
    "op1_line_dedup": line_dedup.ORACLE,
    "op2_mixing": mixture.ORACLE,
    "op3_ngram_jaccard_join": ngram_join.ORACLE,
    "op4_chat_rotation": chat.ORACLE,
    "op5_quality_rules": quality.ORACLE,
    "op6_warc_packages": warc.ORACLE,
    "op11_filter_audit": filter_audit.ORACLE,
    "op12_importance_resampling": importance.ORACLE,
}

"""Registered queries of the package, and SQL for those that SQL can express."""

from __future__ import annotations

from lamina.llm import decontam, langid, mixing, order_minhash, phrases, pii, quality, rules, simhash, suffixes, tokens, vector_codes, windows

QUERIES = {
    "op1_tokens": tokens.op1_tokens,
    "op2_pii": pii.op2_pii,
    "op3_simhash": simhash.op3_simhash,
    "op4_decontam": decontam.op4_decontam,
    "op5_windows": windows.op5_windows,
    "op6_langid": langid.op6_langid,
    "op7_suffixes": suffixes.op7_suffixes,
    "op8_rules": rules.op8_rules,
    "op9_quality": quality.op9_quality,
    "op10_mixing": mixing.op10_mixing,
    "op11_phrases": phrases.op11_phrases,
    "op12_vector_codes": vector_codes.op12_vector_codes,
    "op13_order_minhash": order_minhash.op13_order_minhash,
}

ORACLES: dict[str, str] = {
    "op8_rules": rules.OP8_SQL,
    "op11_phrases": phrases.OP11_SQL,
    "op12_vector_codes": vector_codes.OP12_SQL,
}

"""The document operators as queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from . import bit_sliced, conversation_repair, decontaminate, host_rules, html_text, langid, line_chunks, mixing, near_dup, pii, quality_pu, sharding, token_align

QUERIES = {
    "op1_bigru": langid.op1_bigru,
    "op2_pu": quality_pu.op2_pu,
    "op3_boosted_spans": pii.op3_boosted_spans,
    "op4_virtual_slots": sharding.op4_virtual_slots,
    "op5_host_rules": host_rules.op5_host_rules,
    "op6_automaton": decontaminate.op6_automaton,
    "op7_line_chunks": line_chunks.op7_line_chunks,
    "op8_tag_paths": html_text.op8_tag_paths,
    "op9_mix": mixing.op9_mix,
    "op10_odd_sketch": near_dup.op10_odd_sketch,
    "op11_diagonal_runs": token_align.op11_diagonal_runs,
    "op12_iterative_deepening": conversation_repair.op12_iterative_deepening,
    "op13_bit_sliced": bit_sliced.op13_bit_sliced,
}

ORACLES = {
    "op5_host_rules": host_rules.OP5_SQL,
    "op6_automaton": decontaminate.OP6_SQL,
    "op7_line_chunks": line_chunks.OP7_SQL,
    "op9_mix": mixing.OP9_SQL,
    "op10_odd_sketch": near_dup.OP10_SQL,
    "op13_bit_sliced": bit_sliced.OP13_SQL,
}

"""The operators' queries, and the SQL of those that SQL can express."""

from __future__ import annotations

from alluvia.llm import alignment, chat, compression, decontamination, html, licenses, maxent, mixing, near_dedup, quality, tokens, toxicity, trie
from alluvia.llm.workers import reachable


_OPERATORS = {
    "op1_quality_rules": quality.op1_quality_rules,
    "op2_chat_format": chat.op2_chat_format,
    "op3_near_dedup": near_dedup.op3_near_dedup,
    "op4_token_counts": tokens.op4_token_counts,
    "op5_html_extraction": html.op5_html_extraction,
    "op6_source_mixing": mixing.op6_source_mixing,
    "op7_decontamination": decontamination.op7_decontamination,
    "op8_license_scan": licenses.op8_license_scan,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_lm_score": maxent.op10_lm_score,
    "op11_quality_classifier": compression.op11_quality_classifier,
    "op12_prefix_trie": trie.op12_prefix_trie,
    "op13_tokenizer_alignment": alignment.op13_tokenizer_alignment,
}

QUERIES = {name: (lambda spark, sf_dir, run=run: run(reachable(spark), sf_dir)) for name, run in _OPERATORS.items()}

ORACLES = {
    "op1_quality_rules": quality.OP1_SQL,
    "op2_chat_format": chat.OP2_SQL,
    "op6_source_mixing": mixing.OP6_SQL,
    "op12_prefix_trie": trie.OP12_SQL,
}

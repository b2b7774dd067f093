"""The queries of these operators, and SQL for those that SQL can express."""

from __future__ import annotations

from corpusmill.llm import chat, lines, merkle, ngramjoin, secrets, spelling
from corpusmill.llm.chat import op13_chat_formatting
from corpusmill.llm.decontaminate import op6_decontamination
from corpusmill.llm.lines import op2_line_dedup
from corpusmill.llm.lmscore import op10_lm_scoring
from corpusmill.llm.merkle import op11_merkle_manifest
from corpusmill.llm.ngramjoin import op9_ngram_join
from corpusmill.llm.packing import op3_packing
from corpusmill.llm.repeats import op8_substring_dedup
from corpusmill.llm.rules import op7_quality_rules
from corpusmill.llm.secrets import op1_secrets
from corpusmill.llm.spelling import op12_spelling_variants
from corpusmill.llm.tokencount import op4_token_counts
from corpusmill.llm.toxicity import op5_toxicity

QUERIES = {
    f.__name__: f
    for f in (
        op1_secrets,
        op2_line_dedup,
        op3_packing,
        op4_token_counts,
        op5_toxicity,
        op6_decontamination,
        op7_quality_rules,
        op8_substring_dedup,
        op9_ngram_join,
        op10_lm_scoring,
        op11_merkle_manifest,
        op12_spelling_variants,
        op13_chat_formatting,
    )
}

ORACLES = {
    "op1_secrets": secrets.SQL,
    "op2_line_dedup": lines.SQL,
    "op9_ngram_join": ngramjoin.SQL,
    "op11_merkle_manifest": merkle.SQL,
    "op12_spelling_variants": spelling.SQL,
    "op13_chat_formatting": chat.SQL,
}

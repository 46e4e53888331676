"""The queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from smudgelex.llm.attention_mil import op5_attention_mil
from smudgelex.llm.best_fit_packing import op6_best_fit_packing
from smudgelex.llm.byte_bpe import op7_byte_bpe
from smudgelex.llm.hnsw import op4_hnsw
from smudgelex.llm.language_codes import op13_language_codes
from smudgelex.llm.license_rules import op3_license_rules, op3_sql
from smudgelex.llm.mask_search import op12_mask_search, op12_sql
from smudgelex.llm.quality_mcd import op1_quality_mcd
from smudgelex.llm.spelling_variants import op11_spelling_variants, op11_sql
from smudgelex.llm.string_kernel import op9_string_kernel
from smudgelex.llm.suffix_dedup import op8_suffix_dedup
from smudgelex.llm.url_markov import op2_sql, op2_url_markov
from smudgelex.llm.weighted_minhash import op10_weighted_minhash

QUERIES = {
    q.__name__: q
    for q in (
        op1_quality_mcd,
        op2_url_markov,
        op3_license_rules,
        op4_hnsw,
        op5_attention_mil,
        op6_best_fit_packing,
        op7_byte_bpe,
        op8_suffix_dedup,
        op9_string_kernel,
        op10_weighted_minhash,
        op11_spelling_variants,
        op12_mask_search,
        op13_language_codes,
    )
}
ORACLE_SQL = {
    "op2_url_markov": op2_sql(),
    "op3_license_rules": op3_sql(),
    "op11_spelling_variants": op11_sql(),
    "op12_mask_search": op12_sql(),
}

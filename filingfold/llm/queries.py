"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from filingfold.llm.alignment import op13_galloping_alignment
from filingfold.llm.decontaminate import op2_template_decontamination
from filingfold.llm.exact_dedup import OP6_SQL, op6_exact_dedup
from filingfold.llm.language import op3_crf_language
from filingfold.llm.license_scan import OP9_SQL, op9_license_scan
from filingfold.llm.line_templates import op5_line_templates
from filingfold.llm.minhash import OP1_SQL, op1_minhash
from filingfold.llm.mixing import op10_source_mix
from filingfold.llm.periods import op11_dyadic_runs
from filingfold.llm.pii import op7_bilstm_pii
from filingfold.llm.quality import op8_attention_quality
from filingfold.llm.sharding import op4_jump_sharding
from filingfold.llm.token_machine import op12_machine_counts

LLM_QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_template_decontamination": op2_template_decontamination,
    "op3_crf_language": op3_crf_language,
    "op4_jump_sharding": op4_jump_sharding,
    "op5_line_templates": op5_line_templates,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_bilstm_pii": op7_bilstm_pii,
    "op8_attention_quality": op8_attention_quality,
    "op9_license_scan": op9_license_scan,
    "op10_source_mix": op10_source_mix,
    "op11_dyadic_runs": op11_dyadic_runs,
    "op12_machine_counts": op12_machine_counts,
    "op13_galloping_alignment": op13_galloping_alignment,
}

LLM_ORACLES = {"op1_minhash": OP1_SQL, "op6_exact_dedup": OP6_SQL, "op9_license_scan": OP9_SQL}

"""The registered queries of this package and their SQL."""

from __future__ import annotations

from touchline.llm.decontaminate import OP8_SQL, op8_benchmark_decontamination
from touchline.llm.line_dedup import op10_line_dedup
from touchline.llm.merkle import OP12_SQL, op12_merkle_manifest
from touchline.llm.minhash import op13_minmax_neardup
from touchline.llm.packing import op1_best_fit_packing
from touchline.llm.perplexity import op4_perplexity_rules
from touchline.llm.resampling import OP11_SQL, op11_importance_resampling
from touchline.llm.secrets import op7_crf_secrets
from touchline.llm.simhash import op3_simhash_pivots
from touchline.llm.token_files import op5_token_frames
from touchline.llm.toxicity import op2_counterfactual_toxicity
from touchline.llm.warc import OP9_SQL, op9_warc_revisits
from touchline.llm.weak_quality import op6_weak_label_quality

QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_counterfactual_toxicity": op2_counterfactual_toxicity,
    "op3_simhash_pivots": op3_simhash_pivots,
    "op4_perplexity_rules": op4_perplexity_rules,
    "op5_token_frames": op5_token_frames,
    "op6_weak_label_quality": op6_weak_label_quality,
    "op7_crf_secrets": op7_crf_secrets,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_warc_revisits": op9_warc_revisits,
    "op10_line_dedup": op10_line_dedup,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_minmax_neardup": op13_minmax_neardup,
}
ORACLE_SQL = {
    "op8_benchmark_decontamination": OP8_SQL,
    "op9_warc_revisits": OP9_SQL,
    "op11_importance_resampling": OP11_SQL,
    "op12_merkle_manifest": OP12_SQL,
}

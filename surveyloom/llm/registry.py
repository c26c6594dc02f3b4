"""The operators' queries and their SQL."""

from __future__ import annotations

import corpus_pipeline
from surveyloom.llm.chat import op9_budgeted_windows
from surveyloom.llm.fingerprint import op1_scaled_sketch
from surveyloom.llm.licenses import op10_license_templates
from surveyloom.llm.merges import op11_batched_merges
from surveyloom.llm.mixing import OP3_SQL, op3_source_mix
from surveyloom.llm.neardup import op6_dart_minhash
from surveyloom.llm.packing import op2_bin_completion
from surveyloom.llm.phrases import OP13_SQL, op13_toivonen_phrases
from surveyloom.llm.quality import OP7_SQL, op7_host_rules
from surveyloom.llm.revisits import OP5_SQL, op5_revisits
from surveyloom.llm.tokens import op4_whole_token_counts
from surveyloom.llm.toxicity import op8_toxicity
from surveyloom.llm.vectors import OP12_SQL, op12_equal_average_codes

QUERIES = {
    "op1_scaled_sketch": op1_scaled_sketch,
    "op2_bin_completion": op2_bin_completion,
    "op3_source_mix": op3_source_mix,
    "op4_whole_token_counts": op4_whole_token_counts,
    "op5_revisits": op5_revisits,
    "op6_dart_minhash": op6_dart_minhash,
    "op7_host_rules": op7_host_rules,
    "op8_toxicity": op8_toxicity,
    "op9_budgeted_windows": op9_budgeted_windows,
    "op10_license_templates": op10_license_templates,
    "op11_batched_merges": op11_batched_merges,
    "op12_equal_average_codes": op12_equal_average_codes,
    "op13_toivonen_phrases": op13_toivonen_phrases,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op3_source_mix": OP3_SQL,
    "op5_revisits": OP5_SQL,
    "op7_host_rules": OP7_SQL,
    "op12_equal_average_codes": OP12_SQL,
    "op13_toivonen_phrases": OP13_SQL,
}

if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL

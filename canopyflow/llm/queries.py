"""The queries of this subpackage, and the SQL for those that SQL can express on whole tables."""

from __future__ import annotations

from canopyflow.llm import ann_tree, chosen_path, collocations, language_id, mixing, packing, projection_dedup, secret_scan, substring_dedup, suffix_dedup, token_alignment, toxicity, warc

QUERIES = {
    "op1_substring_dedup": substring_dedup.op1_substring_dedup,
    "op2_mixing": mixing.op2_mixing,
    "op3_secret_scan": secret_scan.op3_secret_scan,
    "op4_jaccard_join": chosen_path.op4_jaccard_join,
    "op5_ann": ann_tree.op5_ann,
    "op6_warc": warc.op6_warc,
    "op7_suffix_dedup": suffix_dedup.op7_suffix_dedup,
    "op8_projection_dedup": projection_dedup.op8_projection_dedup,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_packing": packing.op10_packing,
    "op11_collocations": collocations.op11_collocations,
    "op12_language_id": language_id.op12_language_id,
    "op13_token_alignment": token_alignment.op13_token_alignment,
}

ORACLES = {
    "op1_substring_dedup": substring_dedup.OP1_SQL,
    "op4_jaccard_join": chosen_path.OP4_SQL,
    "op6_warc": warc.OP6_SQL,
    "op7_suffix_dedup": suffix_dedup.OP7_SQL,
    "op8_projection_dedup": projection_dedup.OP8_SQL,
    "op11_collocations": collocations.OP11_SQL,
}

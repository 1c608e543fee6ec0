"""Queries of the text operators with their SQL counterparts."""

from __future__ import annotations

from cellweave.llm import (
    collocations, decontaminate, jaccard_join, licenses, line_dedup, packing, periodic_runs, quality, secrets, substring_dedup,
    token_counts, toxicity, warc)

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_license_scan": licenses.op2_license_scan,
    "op3_substring_dedup": substring_dedup.op3_substring_dedup,
    "op4_benchmark_decontamination": decontaminate.op4_benchmark_decontamination,
    "op5_quality_rules": quality.op5_quality_rules,
    "op6_secret_scan": secrets.op6_secret_scan,
    "op7_ngram_jaccard_join": jaccard_join.op7_ngram_jaccard_join,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_best_fit_packing": packing.op9_best_fit_packing,
    "op10_warc": warc.op10_warc,
    "op11_periodic_runs": periodic_runs.op11_periodic_runs,
    "op12_token_counts": token_counts.op12_token_counts,
    "op13_phrase_collocations": collocations.op13_phrase_collocations,
}

ORACLES = {
    "op1_line_dedup": line_dedup.OP1_SQL,
    "op4_benchmark_decontamination": decontaminate.OP4_SQL,
    "op5_quality_rules": quality.OP5_SQL,
    "op6_secret_scan": secrets.OP6_SQL,
    "op10_warc": warc.OP10_SQL,
    "op13_phrase_collocations": collocations.OP13_SQL,
}

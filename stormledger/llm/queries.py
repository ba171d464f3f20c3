"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from stormledger.llm import audit_queries, contamination_queries, dedup_queries, language_queries, lattice_queries, license_queries, packing_queries, run_queries, secret_queries, simhash_queries, token_queries, toxicity_queries, warc_queries

QUERIES = {
    "op6_warc_revisits": warc_queries.op6_warc_revisits,
    "op7_toxicity": toxicity_queries.op7_toxicity,
    "op4_language_id": language_queries.op4_language_id,
    "op5_token_files": token_queries.op5_token_files,
    "op1_best_fit_packing": packing_queries.op1_best_fit_packing,
    "op8_secret_scan": secret_queries.op8_secret_scan,
    "op3_license_scan": license_queries.op3_license_scan,
    "op9_decontamination": contamination_queries.op9_decontamination,
    "op2_simhash_near_dedup": simhash_queries.op2_simhash_near_dedup,
    "op10_exact_dedup": dedup_queries.op10_exact_dedup,
    "op11_filter_audit": audit_queries.op11_filter_audit,
    "op12_periodic_runs": run_queries.op12_periodic_runs,
    "op13_lattice_scores": lattice_queries.op13_lattice_scores,
}
CHECKS = {
    "op6_warc_revisits": warc_queries.OP6_SQL,
    "op10_exact_dedup": dedup_queries.OP10_SQL,
    "op11_filter_audit": audit_queries.OP11_SQL,
    "op12_periodic_runs": run_queries.OP12_SQL,
}

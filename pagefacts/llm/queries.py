"""Queries of this subpackage, and the SQL they are checked against where SQL can express them."""

from __future__ import annotations

from . import fill_in_middle, filter_audit, hamming, interpolation, licenses, mixing, packing, pii, quality, superminhash, token_counts, toxicity, urls

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_url_filter": urls.op2_url_filter,
    "op3_packing": packing.op3_packing,
    "op4_interpolation": interpolation.op4_interpolation,
    "op5_hamming_top_k": hamming.op5_hamming_top_k,
    "op6_near_duplicates": superminhash.op6_near_duplicates,
    "op7_mixing": mixing.op7_mixing,
    "op8_quality": quality.op8_quality,
    "op9_token_counts": token_counts.op9_token_counts,
    "op10_pii": pii.op10_pii,
    "op11_fill_in_middle": fill_in_middle.op11_fill_in_middle,
    "op12_filter_audit": filter_audit.op12_filter_audit,
    "op13_licenses": licenses.op13_licenses,
}

SQL = {**hamming.SQL, **fill_in_middle.SQL, **filter_audit.SQL, **licenses.SQL}

"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import bpe, exact_dedup, html_text, minhash, packing, quality_rules, rule_ensemble, secret_scan, substring, warc

QUERIES = {
    "op1_minhash_dedup": minhash.op1_minhash_dedup,
    "op2_substring_dedup": substring.op2_substring_dedup,
    "op3_quality_classifier": rule_ensemble.op3_quality_classifier,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_secret_scan": secret_scan.op5_secret_scan,
    "op6_warc": warc.op6_warc,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op8_html_text": html_text.op8_html_text,
    "op9_byte_bpe": bpe.op9_byte_bpe,
    "op10_packing": packing.op10_packing,
}

ORACLE_SQL = {"op4_exact_dedup": exact_dedup.OP4_SQL, "op6_warc": warc.OP6_SQL}

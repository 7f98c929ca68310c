"""Registered queries of this subpackage."""

from tableforge.llm import (
    bpe,
    classifier,
    digests,
    katz,
    lexical,
    licenses,
    line_dedup,
    mixing,
    negatives,
    packing,
    quality_rules,
    simhash,
    warc,
)

QUERIES = {
    "op1_quality_rules": quality_rules.op1_quality_rules,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_simhash": simhash.op3_simhash,
    "op4_document_fingerprints": digests.op4_document_fingerprints,
    "op5_katz_scores": katz.op5_katz_scores,
    "op6_best_fit_packing": packing.op6_best_fit_packing,
    "op7_bpe": bpe.op7_bpe,
    "op8_quality_classifier": classifier.op8_quality_classifier,
    "op9_warc": warc.op9_warc,
    "op10_license_scan": licenses.op10_license_scan,
    "op11_source_mix": mixing.op11_source_mix,
    "op12_hard_negatives": negatives.op12_hard_negatives,
    "op13_lexical_search": lexical.op13_lexical_search,
}
ORACLES = {
    "op1_quality_rules": quality_rules.ORACLE,
    "op2_line_dedup": line_dedup.ORACLE,
    "op9_warc": warc.ORACLE,
    "op11_source_mix": mixing.ORACLE,
    "op12_hard_negatives": negatives.ORACLE,
    "op13_lexical_search": lexical.ORACLE,
}

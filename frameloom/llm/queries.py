"""The queries of the numbered operators, and SQL for those that SQL can express."""

from __future__ import annotations

from . import alignment, bpe, classifier, line_dedup, ngram_join, packing, pii, quality_rules, token_counts, topk, url_filter, warc, whitening

QUERIES = {
    "op1_quality_rules": quality_rules.query,
    "op2_url_filter": url_filter.query,
    "op3_pii": pii.query,
    "op4_ngram_join": ngram_join.query,
    "op5_warc": warc.query,
    "op6_packing": packing.query,
    "op7_bpe": bpe.query,
    "op8_classifier": classifier.query,
    "op9_line_dedup": line_dedup.query,
    "op10_topk": topk.query,
    "op11_token_counts": token_counts.query,
    "op12_alignment": alignment.query,
    "op13_whitening": whitening.query,
}
SQL = {"op3_pii": pii.oracle(), "op4_ngram_join": ngram_join.ORACLE, "op5_warc": warc.ORACLE, "op10_topk": topk.ORACLE}

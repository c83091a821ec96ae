"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline
from tidemark.llm import align, bpe, decontaminate, fill_middle, jaccard_join, licenses, minhash, nbsvm, pitman_yor, quality_rules, secrets, shards, warc

QUERIES = {
    "op1_license_digest": licenses.query,
    "op2_template_decontamination": decontaminate.query,
    "op3_pitman_yor_scores": pitman_yor.query,
    "op4_tensored_minhash": minhash.query,
    "op5_byte_bpe": bpe.query,
    "op6_hypergeometric_shards": shards.query,
    "op7_quality_rules": quality_rules.query,
    "op8_warc": warc.query,
    "op9_secret_scan": secrets.query,
    "op10_nb_svm": nbsvm.query,
    "op11_fill_in_middle": fill_middle.query,
    "op12_token_alignment": align.query,
    "op13_jaccard_join": jaccard_join.query,
    "pipeline": corpus_pipeline.run,
}
ORACLE = {
    "op1_license_digest": licenses.oracle(),
    "op4_tensored_minhash": minhash.ORACLE,
    "op7_quality_rules": quality_rules.ORACLE,
    "op8_warc": warc.ORACLE,
    "op11_fill_in_middle": fill_middle.ORACLE,
    "op13_jaccard_join": jaccard_join.ORACLE,
}

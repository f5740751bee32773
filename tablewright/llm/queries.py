"""Queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from . import bpe, decontaminate, divergence, licenses, line_dedup, merkle, minhash, quality, secrets, simhash, spots, substring, toxicity

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_quality": quality.op2_quality,
    "op3_licenses": licenses.op3_licenses,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_simhash": simhash.op5_simhash,
    "op6_secrets": secrets.op6_secrets,
    "op7_substring_dedup": substring.op7_substring_dedup,
    "op8_spots": spots.op8_spots,
    "op9_decontaminate": decontaminate.op9_decontaminate,
    "op10_bpe": bpe.op10_bpe,
    "op11_divergence": divergence.op11_divergence,
    "op12_minhash": minhash.op12_minhash,
    "op13_merkle": merkle.op13_merkle,
}

SQL = {
    "op1_line_dedup": line_dedup.OP1_SQL,
    "op3_licenses": licenses.OP3_SQL,
    "op11_divergence": divergence.OP11_SQL,
    "op12_minhash": minhash.OP12_SQL,
    "op13_merkle": merkle.OP13_SQL,
}

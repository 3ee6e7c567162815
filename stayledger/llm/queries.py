"""The registered queries of the corpus operators and their SQL twins."""

from __future__ import annotations

from . import chat, decontaminate, divergence, lines, mixing, near, negatives, quality, rules, secrets
from . import sharding, toxicity, warc

QUERIES = {
    "op1_sharding": sharding.op1_sharding,
    "op2_secrets": secrets.op2_secrets,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_chat": chat.op4_chat,
    "op5_rules": rules.op5_rules,
    "op6_near": near.op6_near,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_quality": quality.op8_quality,
    "op9_mixing": mixing.op9_mixing,
    "op10_warc": warc.op10_warc,
    "op11_lines": lines.op11_lines,
    "op12_divergence": divergence.op12_divergence,
    "op13_negatives": negatives.op13_negatives,
}

ORACLES = {
    "op1_sharding": sharding.oracle(),
    "op4_chat": chat.ORACLE,
    "op5_rules": rules.oracle(),
    "op7_decontaminate": decontaminate.ORACLE,
    "op9_mixing": mixing.oracle(),
    "op10_warc": warc.ORACLE,
    "op11_lines": lines.ORACLE,
    "op12_divergence": divergence.ORACLE,
    "op13_negatives": negatives.ORACLE,
}

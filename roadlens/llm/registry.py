"""The queries of this subpackage and their SQL equivalents."""

from __future__ import annotations

from roadlens.llm import (
    credentials, decontamination, hardneg, jaccard, katz, lines, mixing, periods, personal, quality, sharding, urls, wrappers,
)

QUERIES = {
    "op1_jaccard": jaccard.op1_jaccard,
    "op2_lines": lines.op2_lines,
    "op3_urls": urls.op3_urls,
    "op4_secrets": credentials.op4_secrets,
    "op5_mixing": mixing.op5_mixing,
    "op6_scoring": katz.op6_scoring,
    "op7_sharding": sharding.op7_sharding,
    "op8_decontamination": decontamination.op8_decontamination,
    "op9_extraction": wrappers.op9_extraction,
    "op10_quality": quality.op10_quality,
    "op11_periods": periods.op11_periods,
    "op12_personal": personal.op12_personal,
    "op13_hard_negatives": hardneg.op13_hard_negatives,
}
SQL = {
    "op2_lines": lines.OP2_SQL,
    "op5_mixing": mixing.OP5_SQL,
    "op8_decontamination": decontamination.OP8_SQL,
    "op13_hard_negatives": hardneg.OP13_SQL,
}

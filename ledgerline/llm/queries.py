"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from ledgerline.llm.decontamination import op8_decontamination
from ledgerline.llm.hard_negatives import OP13_SQL, op13_hard_negatives
from ledgerline.llm.language_id import op5_language_id
from ledgerline.llm.line_dedup import op2_line_dedup
from ledgerline.llm.lm_scoring import op6_lm_scoring
from ledgerline.llm.mixing import OP9_SQL, op9_mixing
from ledgerline.llm.quality_classifier import op1_quality_classifier
from ledgerline.llm.quality_rules import op7_quality_rules
from ledgerline.llm.simhash import op4_simhash
from ledgerline.llm.suffix_dedup import OP12_SQL, op12_suffix_dedup
from ledgerline.llm.toxicity import op3_toxicity
from ledgerline.llm.warc import OP10_SQL, op10_warc
from ledgerline.llm.whitening import op11_embedding_whitening

QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_line_dedup": op2_line_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_simhash": op4_simhash,
    "op5_language_id": op5_language_id,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_quality_rules": op7_quality_rules,
    "op8_decontamination": op8_decontamination,
    "op9_mixing": op9_mixing,
    "op10_warc": op10_warc,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_hard_negatives": op13_hard_negatives,
}

#: The other operators learn models or hash words in ways that SQL here does not have.
ORACLE_SQL = {"op9_mixing": OP9_SQL, "op10_warc": OP10_SQL, "op12_suffix_dedup": OP12_SQL, "op13_hard_negatives": OP13_SQL}

"""Queries of the text operators: name -> (spark, sf_dir) -> DataFrame, and SQL where it can express one."""

from __future__ import annotations

import corpus_pipeline

from .byte_bpe import op10_byte_bpe
from .chat_snapshots import OP4_SQL, op4_chat_snapshots
from .decontamination import op3_decontamination, op3_proximity
from .hard_negatives import OP13_SQL, op13_hard_negatives
from .lexical_search import OP11_SQL, op11_lexical_search
from .oracles import OP1_SQL, OP3_PROXIMITY_SQL, OP3_SQL, OP5_SQL
from .pii import op2_pii
from .quality_classifier import op7_quality_classifier
from .repetition import op5_repetition_rules
from .simhash_dedup import op8_simhash_near_dedup
from .substring_dedup import op1_substring_dedup
from .token_counts import op6_token_counts
from .toxicity import op9_toxicity
from .warc import OP12_SQL, op12_warc

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_pii": op2_pii,
    "op3_decontamination": op3_decontamination,
    "op3_proximity": op3_proximity,
    "op4_chat_snapshots": op4_chat_snapshots,
    "op5_repetition_rules": op5_repetition_rules,
    "op6_token_counts": op6_token_counts,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_lexical_search": op11_lexical_search,
    "op12_warc": op12_warc,
    "op13_hard_negatives": op13_hard_negatives,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": OP1_SQL,
    "op3_decontamination": OP3_SQL,
    "op3_proximity": OP3_PROXIMITY_SQL,
    "op4_chat_snapshots": OP4_SQL,
    "op5_repetition_rules": OP5_SQL,
    "op11_lexical_search": OP11_SQL,
    "op12_warc": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}

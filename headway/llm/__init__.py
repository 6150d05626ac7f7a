"""Operators for preparing training text, each with one registered query."""

from headway.llm.jaccard import op7_jaccard
from headway.llm.lattice import op2_segmentations
from headway.llm.nearest import op3_nearest
from headway.llm.merkle import OP13_SQL, op13_merkle_manifest
from headway.llm.negatives import OP12_SQL, op12_hard_negatives
from headway.llm.packing import op4_packing
from headway.llm.quality_classifier import op5_quality_classifier
from headway.llm.quality_rules import op8_quality_rules
from headway.llm.secrets import op6_secrets
from headway.llm.token_counts import op10_token_counts
from headway.llm.url_filter import op9_url_filter
from headway.llm.warc import op1_warc
from headway.llm.word_bpe import op11_word_bpe

QUERIES = {
    "op1_warc": op1_warc,
    "op2_segmentations": op2_segmentations,
    "op3_nearest": op3_nearest,
    "op4_packing": op4_packing,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_secrets": op6_secrets,
    "op7_jaccard": op7_jaccard,
    "op8_quality_rules": op8_quality_rules,
    "op9_url_filter": op9_url_filter,
    "op10_token_counts": op10_token_counts,
    "op11_word_bpe": op11_word_bpe,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_merkle_manifest": op13_merkle_manifest,
}
SQL: dict[str, str] = {"op12_hard_negatives": OP12_SQL, "op13_merkle_manifest": OP13_SQL}

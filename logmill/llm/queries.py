"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from .ann import op4_nearest_neighbours
from .conversations import op11_conversation_repair
from .hamming import OP6_SQL, op6_hamming_top_k
from .licenses import OP9_SQL, op9_license_scan
from .mix import OP1_SQL, op1_mix_sources
from .near_copies import op8_near_copies
from .periodic import op13_periodic_runs
from .pieces import op10_sentence_pieces
from .repeats import OP2_SQL, op2_repeated_passages
from .rules import op12_quality_rules
from .token_files import op5_token_files
from .toxicity import op3_toxicity
from .warc import OP7_SQL, op7_warc

QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_repeated_passages": op2_repeated_passages,
    "op3_toxicity": op3_toxicity,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_token_files": op5_token_files,
    "op6_hamming_top_k": op6_hamming_top_k,
    "op7_warc": op7_warc,
    "op8_near_copies": op8_near_copies,
    "op9_license_scan": op9_license_scan,
    "op10_sentence_pieces": op10_sentence_pieces,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_quality_rules": op12_quality_rules,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLES = {
    "op1_mix_sources": OP1_SQL,
    "op2_repeated_passages": OP2_SQL,
    "op6_hamming_top_k": OP6_SQL,
    "op7_warc": OP7_SQL,
    "op9_license_scan": OP9_SQL,
}

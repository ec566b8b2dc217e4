"""Registered queries of this subpackage and, where SQL can express them, their DuckDB oracles."""

from .collocations import OP13_SQL, op13_collocations
from .decontamination import op8_decontaminate
from .extraction import op6_extract_text
from .mixing import op9_mix_sources
from .negatives import OP12_SQL, op12_hard_negatives
from .oracles import OP2_SQL, OP3_SQL, OP5_SQL, OP7_SQL, OP8_SQL, OP9_SQL, OP10_SQL
from .quality import op11_quality_rules
from .secrets import op7_secret_scan
from .simhash import op10_simhash_neardup
from .substrings import op5_substring_dedup
from .tokencounts import op1_token_counts
from .toxicity import op4_toxicity
from .vectors import op2_embedding_neardup
from .warc import op3_warc_roundtrip

QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_embedding_neardup": op2_embedding_neardup,
    "op3_warc_roundtrip": op3_warc_roundtrip,
    "op4_toxicity": op4_toxicity,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_extract_text": op6_extract_text,
    "op7_secret_scan": op7_secret_scan,
    "op8_decontaminate": op8_decontaminate,
    "op9_mix_sources": op9_mix_sources,
    "op10_simhash_neardup": op10_simhash_neardup,
    "op11_quality_rules": op11_quality_rules,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_collocations": op13_collocations,
}
ORACLES: dict[str, str] = {
    "op2_embedding_neardup": OP2_SQL,
    "op3_warc_roundtrip": OP3_SQL,
    "op5_substring_dedup": OP5_SQL,
    "op7_secret_scan": OP7_SQL,
    "op8_decontaminate": OP8_SQL,
    "op9_mix_sources": OP9_SQL,
    "op10_simhash_neardup": OP10_SQL,
    "op12_hard_negatives": OP12_SQL,
    "op13_collocations": OP13_SQL,
}

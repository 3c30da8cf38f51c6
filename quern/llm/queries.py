"""The queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from quern.llm import centroid_clustering, code_compression, decontamination, near_duplicates, sharding
from quern.llm.byte_bpe import op7_byte_bpe
from quern.llm.centroid_clustering import op12_centroid_clusters
from quern.llm.chat_windows import op1_chat_windows
from quern.llm.code_compression import op13_vector_codes
from quern.llm.decontamination import op6_decontamination
from quern.llm.lm_scoring import op10_lm_scoring
from quern.llm.near_duplicates import op5_near_duplicates
from quern.llm.quality_classifier import op2_quality_classifier
from quern.llm.quality_rules import op9_quality_rules
from quern.llm.secrets import op4_secret_scans
from quern.llm.sharding import op11_shards
from quern.llm.token_records import op3_token_records
from quern.llm.toxicity import op8_toxicity

QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_windows, op2_quality_classifier, op3_token_records, op4_secret_scans, op5_near_duplicates,
        op6_decontamination, op7_byte_bpe, op8_toxicity, op9_quality_rules, op10_lm_scoring,
        op11_shards, op12_centroid_clusters, op13_vector_codes,
    )
}
ORACLE_SQL = {
    "op5_near_duplicates": near_duplicates.ORACLE_SQL,
    "op6_decontamination": decontamination.ORACLE_SQL,
    "op11_shards": sharding.ORACLE_SQL,
    "op12_centroid_clusters": centroid_clustering.ORACLE_SQL,
    "op13_vector_codes": code_compression.ORACLE_SQL,
}

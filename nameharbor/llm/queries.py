"""The numbered queries over whole tables, the pipeline, and the same in SQL where SQL can say it."""

from __future__ import annotations

from nameharbor.llm.embedding_neardup import op4_embedding_neardup
from nameharbor.llm.html_extraction import op11_html_extraction
from nameharbor.llm.language_id import op10_language_id
from nameharbor.llm.line_dedup import OP1_SQL, op1_line_dedup
from nameharbor.llm.merkle_manifest import OP12_SQL, op12_merkle_manifest
from nameharbor.llm.ngram_join import OP7_SQL, op7_ngram_join
from nameharbor.llm.packing import op2_packing
from nameharbor.llm.quality_rules import op9_quality_rules
from nameharbor.llm.sentencepiece_fst import op8_sentencepiece
from nameharbor.llm.sharding import OP6_SQL, op6_sharding
from nameharbor.llm.suffix_dedup import OP5_SQL, op5_suffix_dedup
from nameharbor.llm.toxicity import op3_toxicity
from nameharbor.llm.vector_codes import OP13_SQL, op13_vector_codes

QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_packing": op2_packing,
    "op3_toxicity": op3_toxicity,
    "op4_embedding_neardup": op4_embedding_neardup,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_sharding": op6_sharding,
    "op7_ngram_join": op7_ngram_join,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_quality_rules": op9_quality_rules,
    "op10_language_id": op10_language_id,
    "op11_html_extraction": op11_html_extraction,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_vector_codes": op13_vector_codes,
}
ORACLES = {"op1_line_dedup": OP1_SQL, "op5_suffix_dedup": OP5_SQL, "op6_sharding": OP6_SQL, "op7_ngram_join": OP7_SQL,
           "op12_merkle_manifest": OP12_SQL, "op13_vector_codes": OP13_SQL}

"""Registered queries of the training-text operators and their SQL."""

from __future__ import annotations

from folio.llm import embedding_dedup, vector_codes
from folio.llm.decontamination import op9_decontamination
from folio.llm.embedding_dedup import op12_embedding_dedup
from folio.llm.language import op5_language, page_language
from folio.llm.licenses import op6_licences
from folio.llm.lm import op10_lm
from folio.llm.packing import op4_packing
from folio.llm.pii import op3_pii
from folio.llm.quality import op8_quality
from folio.llm.runs import op11_periodic_runs
from folio.llm.secret_scan import op7_secrets
from folio.llm.sharding import op2_sharding
from folio.llm.simhash import op1_simhash
from folio.llm.vector_codes import op13_vector_codes

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_sharding": op2_sharding,
    "op3_pii": op3_pii,
    "op4_packing": op4_packing,
    "op5_language": op5_language,
    "op6_licences": op6_licences,
    "op7_secrets": op7_secrets,
    "op8_quality": op8_quality,
    "op9_decontamination": op9_decontamination,
    "op10_lm": op10_lm,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_embedding_dedup": op12_embedding_dedup,
    "op13_vector_codes": op13_vector_codes,
    "page_language": page_language,
}

SQL: dict[str, str] = {
    "op12_embedding_dedup": embedding_dedup.SQL,
    "op13_vector_codes": vector_codes.SQL,
}

"""Registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from hydromart.llm.bpe import op4_bpe_roundtrip
from hydromart.llm.chat import OP11_SQL, op11_chat_format
from hydromart.llm.collocations import OP13_SQL, op13_phrase_collocations
from hydromart.llm.decontaminate import op7_decontaminate
from hydromart.llm.embeddings import OP3_SQL, op3_embedding_dedup
from hydromart.llm.html import op5_html_extract
from hydromart.llm.lines import OP1_SQL, op1_line_dedup
from hydromart.llm.manifest import OP12_SQL, op12_merkle_manifest
from hydromart.llm.pii import op6_pii
from hydromart.llm.quality import op9_quality
from hydromart.llm.secrets import op8_secret_scan
from hydromart.llm.simhash import op10_simhash_dedup
from hydromart.llm.substrings import op2_substring_dedup

QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_substring_dedup, op3_embedding_dedup, op4_bpe_roundtrip, op5_html_extract, op6_pii,
    op7_decontaminate, op8_secret_scan, op9_quality, op10_simhash_dedup, op11_chat_format, op12_merkle_manifest,
    op13_phrase_collocations)}

ORACLES: dict[str, str] = {"op1_line_dedup": OP1_SQL, "op3_embedding_dedup": OP3_SQL,
                           "op11_chat_format": OP11_SQL, "op12_merkle_manifest": OP12_SQL,
                           "op13_phrase_collocations": OP13_SQL}

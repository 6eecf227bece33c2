"""Queries of the subpackage: name -> f(spark, sf_dir), and their DuckDB statements where SQL can express them."""

from __future__ import annotations

from touchline.llm import statements
from touchline.llm.alignment import op12_token_alignment
from touchline.llm.fmindex import op9_fm_decontamination
from touchline.llm.jaccard import op7_jaccard_join
from touchline.llm.licenses import op2_license_scan
from touchline.llm.mixing import op4_soft_mixing
from touchline.llm.negatives import op11_hard_negatives
from touchline.llm.quality import op10_rule_quality
from touchline.llm.search import op6_block_max_search
from touchline.llm.secrets import op8_secret_ledger
from touchline.llm.substrings import op5_substring_dedup
from touchline.llm.tokens import op3_wavelet_tokens
from touchline.llm.urls import op13_url_filter
from touchline.llm.warc import op1_warc_roundtrip

QUERIES = {
    "op1_warc_roundtrip": op1_warc_roundtrip,
    "op2_license_scan": op2_license_scan,
    "op3_wavelet_tokens": op3_wavelet_tokens,
    "op4_soft_mixing": op4_soft_mixing,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_block_max_search": op6_block_max_search,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_secret_ledger": op8_secret_ledger,
    "op9_fm_decontamination": op9_fm_decontamination,
    "op10_rule_quality": op10_rule_quality,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_token_alignment": op12_token_alignment,
    "op13_url_filter": op13_url_filter,
}
SQL = {
    "op5_substring_dedup": statements.SUBSTRINGS,
    "op7_jaccard_join": statements.JACCARD,
    "op9_fm_decontamination": statements.CONTAMINATION,
    "op13_url_filter": statements.URLS,
}

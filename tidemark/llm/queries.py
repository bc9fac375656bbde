"""The operators of this subpackage as named queries."""

from __future__ import annotations

from tidemark.llm import ann_search, bpe_codec, chat_format, decontaminate, language_id, license_scan, line_dedup, ngram_join, pii, url_filter

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_license_scan": license_scan.op2_license_scan,
    "op3_pii": pii.op3_pii,
    "op4_url_filter": url_filter.op4_url_filter,
    "op5_bpe_codec": bpe_codec.op5_bpe_codec,
    "op6_ngram_join": ngram_join.op6_ngram_join,
    "op7_language_id": language_id.op7_language_id,
    "op8_ann_search": ann_search.op8_ann_search,
    "op9_decontaminate": decontaminate.op9_decontaminate,
    "op10_chat_format": chat_format.op10_chat_format,
}

#: Where SQL cannot express an operator, tests hold it against a brute-force version.
ORACLE_SQL = {
    "op10_chat_format": chat_format.ORACLE_SQL,
}

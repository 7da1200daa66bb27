"""The queries of this subpackage and their SQL, for __spark_entry__.py."""

from __future__ import annotations

from . import decontaminate, exact_dedup, fill_middle, html_extract, jaccard_join, language_id, pii, quality_cnn, spm_codec, token_counts, url_filter, vector_codes, warc

QUERIES = {
    "op1_url_filters": url_filter.op1_url_filters,
    "op2_warc": warc.op2_warc,
    "op3_decontamination": decontaminate.op3_decontamination,
    "op4_quality": quality_cnn.op4_quality,
    "op5_pii": pii.op5_pii,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_language_id": language_id.op7_language_id,
    "op8_sentencepiece": spm_codec.op8_sentencepiece,
    "op9_html_extraction": html_extract.op9_html_extraction,
    "op10_jaccard_join": jaccard_join.op10_jaccard_join,
    "op11_token_counts": token_counts.op11_token_counts,
    "op12_fill_middle": fill_middle.op12_fill_middle,
    "op13_vector_codes": vector_codes.op13_vector_codes,
}

ORACLES = {
    "op2_warc": warc.ORACLE,
    "op3_decontamination": decontaminate.ORACLE,
    "op6_exact_dedup": exact_dedup.ORACLE,
    "op10_jaccard_join": jaccard_join.ORACLE,
    "op12_fill_middle": fill_middle.ORACLE,
    "op13_vector_codes": vector_codes.ORACLE,
}

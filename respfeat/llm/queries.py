"""The text operators as named queries over whole tables, with SQL where it can express them."""

from respfeat.llm import (
    collocations,
    conversation_repair,
    decontaminate,
    exact_dedup,
    html_extract,
    lm_scoring,
    near_dedup,
    pii,
    quality,
    sentencepiece_codec,
    substring_dedup,
    suffix_dedup,
    url_filters,
)

QUERIES = {
    "op1_url_filters": url_filters.query,
    "op2_near_dedup": near_dedup.query,
    "op3_exact_dedup": exact_dedup.query,
    "op4_substring_dedup": substring_dedup.query,
    "op5_decontaminate": decontaminate.query,
    "op6_pii": pii.query,
    "op7_lm_scoring": lm_scoring.query,
    "op8_suffix_dedup": suffix_dedup.query,
    "op9_sentencepiece": sentencepiece_codec.query,
    "op10_quality": quality.query,
    "op11_conversation_repair": conversation_repair.query,
    "op12_collocations": collocations.query,
    "op13_html_extract": html_extract.query,
}
ORACLES = {
    "op1_url_filters": url_filters.ORACLE,
    "op3_exact_dedup": exact_dedup.ORACLE,
    "op12_collocations": collocations.ORACLE,
}

"""The corpus queries and the SQL of those that SQL can express."""

from . import alignment, decontaminate, language, merkle, mixing, packing, quality, simhash, token_counts, token_store, topk, toxicity, url_filter

QUERIES = {
    "op1_decontamination": decontaminate.query,
    "op2_quality": quality.query,
    "op3_token_counts": token_counts.query,
    "op4_language": language.query,
    "op5_topk": topk.query,
    "op6_simhash": simhash.query,
    "op7_url_filter": url_filter.query,
    "op8_token_store": token_store.query,
    "op9_toxicity": toxicity.query,
    "op10_mixing": mixing.query,
    "op11_packing": packing.query,
    "op12_merkle": merkle.query,
    "op13_alignment": alignment.query,
}
ORACLES = {
    "op1_decontamination": decontaminate.ORACLE,
    "op5_topk": topk.ORACLE,
    "op7_url_filter": url_filter.ORACLE,
    "op10_mixing": mixing.ORACLE,
    "op12_merkle": merkle.ORACLE,
}

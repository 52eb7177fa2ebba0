"""The operators as queries over whole tables, and SQL that states their results."""

from __future__ import annotations

from . import (
    ann,
    bpe,
    clustering,
    divergence,
    exact_dedup,
    inner_product,
    langid,
    line_dedup,
    packing,
    secret_scan,
    setsketch,
    token_counts,
    warc,
)

QUERIES = {
    "op1_near_duplicates": setsketch.op1_near_duplicates,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_token_counts": token_counts.op4_token_counts,
    "op5_language": langid.op5_language,
    "op6_secrets": secret_scan.op6_secrets,
    "op7_nearest": ann.op7_nearest,
    "op8_packing": packing.op8_packing,
    "op9_warc": warc.op9_warc,
    "op10_byte_bpe": bpe.op10_byte_bpe,
    "op11_clusters": clustering.op11_clusters,
    "op12_source_divergence": divergence.op12_source_divergence,
    "op13_top_products": inner_product.op13_top_products,
}

ORACLES = {
    "op3_exact_dedup": exact_dedup.ORACLE,
    "op6_secrets": secret_scan.ORACLE,
    "op7_nearest": ann.ORACLE,
    "op9_warc": warc.ORACLE,
    "op11_clusters": clustering.ORACLE,
    "op12_source_divergence": divergence.ORACLE,
    "op13_top_products": inner_product.ORACLE,
}

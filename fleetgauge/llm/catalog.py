"""The queries of this subpackage, and SQL where SQL can express them."""

from __future__ import annotations

from . import byte_bpe, chat, divergence, embedding_dedup, lines, mixing, neighbours, pages, quality, simhash, toxicity, urls, whitening

QUERIES = {
    "op1_quality": quality.query,
    "op2_mixing": mixing.query,
    "op3_embedding_dedup": embedding_dedup.query,
    "op4_toxicity": toxicity.query,
    "op5_line_dedup": lines.query,
    "op6_neighbours": neighbours.query,
    "op7_url_filter": urls.query,
    "op8_simhash": simhash.query,
    "op9_html_extraction": pages.query,
    "op10_byte_bpe": byte_bpe.query,
    "op11_whitening": whitening.query,
    "op12_source_divergence": divergence.query,
    "op13_chat_format": chat.query,
}

ORACLES = {"op2_mixing": mixing.ORACLE, "op12_source_divergence": divergence.ORACLE, "op13_chat_format": chat.ORACLE}

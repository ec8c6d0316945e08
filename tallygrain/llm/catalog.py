"""The registered corpus queries and their SQL, where SQL can express them."""

from __future__ import annotations

from tallygrain.llm.ann import ann_query
from tallygrain.llm.bpe_codec import bpe_query
from tallygrain.llm.extraction import html_query
from tallygrain.llm.jaccard_join import JACCARD_SQL, jaccard_query
from tallygrain.llm.licenses import license_query
from tallygrain.llm.lm_score import lm_query
from tallygrain.llm.packing import packing_query
from tallygrain.llm.periodic import PERIODIC_SQL, periodic_query
from tallygrain.llm.prefix_trie import TRIE_SQL, trie_query
from tallygrain.llm.quality import quality_query
from tallygrain.llm.simhash import simhash_query
from tallygrain.llm.spotsigs import spotsigs_query
from tallygrain.llm.suffix_dedup import suffix_query

QUERIES = {
    "op1_quality_gam": quality_query,
    "op2_simhash_neardup": simhash_query,
    "op3_html_lstm": html_query,
    "op4_suffix_dedup": suffix_query,
    "op5_packing": packing_query,
    "op6_bpe_trie": bpe_query,
    "op7_ann_partitions": ann_query,
    "op8_lm_score": lm_query,
    "op9_spotsigs": spotsigs_query,
    "op10_license_zstd": license_query,
    "op11_dyadic_runs": periodic_query,
    "op12_jaccard_voronoi": jaccard_query,
    "op13_prefix_trie": trie_query,
}

SQL: dict[str, str] = {
    "op11_dyadic_runs": PERIODIC_SQL,
    "op12_jaccard_voronoi": JACCARD_SQL,
    "op13_prefix_trie": TRIE_SQL,
}

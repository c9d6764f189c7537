"""The named queries of this package and the SQL that some of them must agree with."""

from __future__ import annotations

from tallygrain.llm.decontamination import OP11_SQL, op11_decontamination
from tallygrain.llm.kmeans_tree import op6_kmeans_tree
from tallygrain.llm.language_id import op7_language
from tallygrain.llm.line_dedup import op8_line_dedup
from tallygrain.llm.mixing import OP9_SQL, op9_mixing
from tallygrain.llm.packing import op10_packing
from tallygrain.llm.prefix_trie import OP12_SQL, op12_prefix_trie
from tallygrain.llm.quality_rules import OP5_SQL, op5_quality
from tallygrain.llm.simhash_dedup import op3_simhash
from tallygrain.llm.url_filter import OP2_SQL, op2_url_filter
from tallygrain.llm.warc import OP1_SQL, op1_warc
from tallygrain.llm.whitening import op13_whitening
from tallygrain.llm.wrapper_induction import op4_main_text

QUERIES = {f.__name__: f for f in (op1_warc, op2_url_filter, op3_simhash, op4_main_text, op5_quality, op6_kmeans_tree, op7_language, op8_line_dedup, op9_mixing, op10_packing, op11_decontamination, op12_prefix_trie, op13_whitening)}
ORACLES = {"op1_warc": OP1_SQL, "op2_url_filter": OP2_SQL, "op5_quality": OP5_SQL, "op9_mixing": OP9_SQL, "op11_decontamination": OP11_SQL, "op12_prefix_trie": OP12_SQL}

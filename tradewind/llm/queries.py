"""The registered queries of the operators: name -> (Spark session, folder) -> rows, and their SQL."""

from __future__ import annotations

from tradewind.llm.bpe import op9_bpe
from tradewind.llm.chat import op4_chat_windows
from tradewind.llm.clustering import OP13_SQL, op13_centroids
from tradewind.llm.fingerprints import op2_imatch
from tradewind.llm.jaccard import op10_jaccard_classes
from tradewind.llm.lengths import op7_length_histogram
from tradewind.llm.lines import op6_line_dedup
from tradewind.llm.middle import OP11_SQL, op11_fill_in_middle
from tradewind.llm.mixing import op1_mix_sources
from tradewind.llm.quality import op5_quality
from tradewind.llm.sharding import op3_balanced_shards
from tradewind.llm.topk import op8_top_k
from tradewind.llm.toxicity import op12_toxicity

QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_imatch": op2_imatch,
    "op3_balanced_shards": op3_balanced_shards,
    "op4_chat_windows": op4_chat_windows,
    "op5_quality": op5_quality,
    "op6_line_dedup": op6_line_dedup,
    "op7_length_histogram": op7_length_histogram,
    "op8_top_k": op8_top_k,
    "op9_bpe": op9_bpe,
    "op10_jaccard_classes": op10_jaccard_classes,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_toxicity": op12_toxicity,
    "op13_centroids": op13_centroids,
}
SQL: dict[str, str] = {"op11_fill_in_middle": OP11_SQL, "op13_centroids": OP13_SQL}

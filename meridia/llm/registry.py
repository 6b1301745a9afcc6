"""The queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from meridia.llm.mixing import OP8_SQL, op8_mixing
from meridia.llm.neighbours import op6_multiprobe
from meridia.llm.packing import op9_packing
from meridia.llm.pst import op7_suffix_tree
from meridia.llm.quality import OP5_SQL, op5_quality
from meridia.llm.sharding import op4_hash_tree
from meridia.llm.simhash import op1_simhash
from meridia.llm.substrings import op3_rindex
from meridia.llm.tokens import op2_tokens
from meridia.llm.urls import OP10_SQL, op10_urls

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_tokens": op2_tokens,
    "op3_rindex": op3_rindex,
    "op4_hash_tree": op4_hash_tree,
    "op5_quality": op5_quality,
    "op6_multiprobe": op6_multiprobe,
    "op7_suffix_tree": op7_suffix_tree,
    "op8_mixing": op8_mixing,
    "op9_packing": op9_packing,
    "op10_urls": op10_urls,
}

ORACLES: dict[str, str] = {
    "op5_quality": OP5_SQL,
    "op8_mixing": OP8_SQL,
    "op10_urls": OP10_SQL,
}

"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from revrecon.llm.binary_output import op9_token_output
from revrecon.llm.conversation_repair import OP11_SQL, op11_conversation_repair
from revrecon.llm.embedding_dedup import op6_embedding_dedup
from revrecon.llm.html_extract import op4_html_extract
from revrecon.llm.jaccard_join import op10_jaccard_join
from revrecon.llm.line_dedup import OP7_SQL, op7_line_dedup
from revrecon.llm.mixing import OP1_SQL, op1_mixing
from revrecon.llm.packing import op2_packing
from revrecon.llm.personal_data import op8_personal_data
from revrecon.llm.quality import op3_quality
from revrecon.llm.quality_rules import OP13_SQL, op13_quality_rules
from revrecon.llm.topk_search import OP5_SQL, op5_topk_search
from revrecon.llm.whitening import op12_whitening

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_packing": op2_packing,
    "op3_quality": op3_quality,
    "op4_html_extract": op4_html_extract,
    "op5_topk_search": op5_topk_search,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_line_dedup": op7_line_dedup,
    "op8_personal_data": op8_personal_data,
    "op9_token_output": op9_token_output,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_whitening": op12_whitening,
    "op13_quality_rules": op13_quality_rules,
}

ORACLES: dict[str, str] = {
    "op1_mixing": OP1_SQL,
    "op5_topk_search": OP5_SQL,
    "op7_line_dedup": OP7_SQL,
    "op11_conversation_repair": OP11_SQL,
    "op13_quality_rules": OP13_SQL,
}

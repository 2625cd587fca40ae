"""The queries of this folder's operators, by name, and their SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from colsink.llm.byte_cnn import op10_byte_cnn
from colsink.llm.image_copies import op1_image_copies
from colsink.llm.mixing import op7_entropy_mix
from colsink.llm.near_dup import OP3_SQL, op3_minmax_near_dup
from colsink.llm.packing import op4_config_lp_packing
from colsink.llm.pii import op9_checked_spans
from colsink.llm.quality import OP2_SQL, op2_line_rules
from colsink.llm.secret_scan import op8_parsed_secrets
from colsink.llm.sharding import op5_hash_tree_shards
from colsink.llm.token_files import op6_token_lists

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_image_copies,
        op2_line_rules,
        op3_minmax_near_dup,
        op4_config_lp_packing,
        op5_hash_tree_shards,
        op6_token_lists,
        op7_entropy_mix,
        op8_parsed_secrets,
        op9_checked_spans,
        op10_byte_cnn,
    )
}

ORACLE_SQL: dict[str, str] = {"op2_line_rules": OP2_SQL, "op3_minmax_near_dup": OP3_SQL}

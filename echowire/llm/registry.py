"""The queries of this package and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from echowire.llm.bpe_tree import op9_bpe_tree
from echowire.llm.conversation_repair import op11_conversation_repair
from echowire.llm.decontaminate import op6_pigeonhole_decontamination
from echowire.llm.hilbert_shards import op10_hilbert_shards
from echowire.llm.kernel_language import op7_kernel_language
from echowire.llm.lexical_search import OP12_SQL, op12_pipelined_search
from echowire.llm.license_scan import op2_license_scan
from echowire.llm.line_dedup import OP5_SQL, op5_line_dedup
from echowire.llm.minhash_dedup import op3_hyperminhash_dedup
from echowire.llm.pii_sanitise import op4_pii_sanitise
from echowire.llm.pstable_dedup import op1_pstable_dedup
from echowire.llm.record_files import op13_record_files
from echowire.llm.rule_quality import op8_rule_quality


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pstable_dedup": op1_pstable_dedup,
        "op2_license_scan": op2_license_scan,
        "op3_hyperminhash_dedup": op3_hyperminhash_dedup,
        "op4_pii_sanitise": op4_pii_sanitise,
        "op5_line_dedup": op5_line_dedup,
        "op6_pigeonhole_decontamination": op6_pigeonhole_decontamination,
        "op7_kernel_language": op7_kernel_language,
        "op8_rule_quality": op8_rule_quality,
        "op9_bpe_tree": op9_bpe_tree,
        "op10_hilbert_shards": op10_hilbert_shards,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_pipelined_search": op12_pipelined_search,
        "op13_record_files": op13_record_files,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_line_dedup": OP5_SQL, "op12_pipelined_search": OP12_SQL}

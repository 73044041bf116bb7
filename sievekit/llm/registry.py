"""The queries of this subpackage and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .langid import op8_language_id
from .mixing import OP9_SQL, op9_mixing
from .pii import op5_pii_surrogates
from .oracles import OP3_SQL, OP4_SQL, OP10_SQL
from .pieces import op6_sentencepiece
from .quality import op10_quality_rules
from .repeats import op3_suffix_array_dedup
from .simhash import op7_simhash_near_dedup
from .tokenfiles import op2_token_files
from .topk import OP1_SQL, op1_exact_top_k
from .warc import op4_warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_top_k": op1_exact_top_k,
        "op2_token_files": op2_token_files,
        "op3_suffix_array_dedup": op3_suffix_array_dedup,
        "op4_warc": op4_warc,
        "op5_pii_surrogates": op5_pii_surrogates,
        "op6_sentencepiece": op6_sentencepiece,
        "op7_simhash_near_dedup": op7_simhash_near_dedup,
        "op8_language_id": op8_language_id,
        "op9_mixing": op9_mixing,
        "op10_quality_rules": op10_quality_rules,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_top_k": OP1_SQL,
        "op3_suffix_array_dedup": OP3_SQL,
        "op4_warc": OP4_SQL,
        "op9_mixing": OP9_SQL,
        "op10_quality_rules": OP10_SQL,
    }

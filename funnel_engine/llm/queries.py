"""The operators' registered queries and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .byte_bpe import op12_byte_bpe
from .embedding_dedup import OP7_SQL, op7_embedding_dedup
from .minhash_dedup import OP10_SQL, op10_minhash
from .mixing import OP1_SQL, op1_mixing
from .periodic_runs import op11_periodic_runs
from .quality_rules import OP8_SQL, op8_quality_rules
from .secret_scan import op5_secret_scan
from .sentencepiece_codec import op9_sentencepiece
from .suffix_dedup import op6_suffix_dedup
from .token_counts import op4_token_counts
from .toxicity import op2_toxicity
from .url_filter import OP3_SQL, op3_url_filter
from .whitening import op13_whitening


OPERATORS = (
    op1_mixing,
    op2_toxicity,
    op3_url_filter,
    op4_token_counts,
    op5_secret_scan,
    op6_suffix_dedup,
    op7_embedding_dedup,
    op8_quality_rules,
    op9_sentencepiece,
    op10_minhash,
    op11_periodic_runs,
    op12_byte_bpe,
    op13_whitening,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_mixing": OP1_SQL,
        "op3_url_filter": OP3_SQL,
        "op7_embedding_dedup": OP7_SQL,
        "op8_quality_rules": OP8_SQL,
        "op10_minhash": OP10_SQL,
    }

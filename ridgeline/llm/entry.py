"""The subpackage's queries and their SQL."""

from __future__ import annotations

from .exact_dedup import EXACT_DEDUP_SQL, op6_exact_dedup
from .fingerprints import op7_fingerprints
from .mixing import MIX_SQL, op9_mixing
from .ngram_join import NGRAM_JOIN_SQL, op5_ngram_join
from .quality import op8_quality
from .sharding import SHARD_SQL, op10_sharding
from .substrings import SUBSTRING_SQL, op2_substring_dedup
from .tokens import op1_token_counts, op3_byte_bpe
from .warc import WARC_SQL, op4_warc


def queries() -> dict:
    return {
        "op1_token_counts": op1_token_counts,
        "op2_substring_dedup": op2_substring_dedup,
        "op3_byte_bpe": op3_byte_bpe,
        "op4_warc": op4_warc,
        "op5_ngram_join": op5_ngram_join,
        "op6_exact_dedup": op6_exact_dedup,
        "op7_fingerprints": op7_fingerprints,
        "op8_quality": op8_quality,
        "op9_mixing": op9_mixing,
        "op10_sharding": op10_sharding,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_substring_dedup": SUBSTRING_SQL,
        "op4_warc": WARC_SQL,
        "op5_ngram_join": NGRAM_JOIN_SQL,
        "op6_exact_dedup": EXACT_DEDUP_SQL,
        "op9_mixing": MIX_SQL,
        "op10_sharding": SHARD_SQL,
    }

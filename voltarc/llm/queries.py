"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import op5_bpe_round_trip
from .codes import op11_vector_codes
from .interactions import op13_filter_audit
from .langid import op10_language_id
from .mixing import op12_source_schedule
from .oracle import SQL
from .packing import op2_best_fit_packing
from .pii import op4_pii_surrogates
from .quality import op8_quality_rules
from .setjoin import op9_ngram_jaccard_join
from .sharding import op6_vector_sharding
from .spotsigs import op1_spot_signatures
from .tokens import op3_token_counts
from .warc import op7_warc_derivatives

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_spot_signatures": op1_spot_signatures,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_token_counts": op3_token_counts,
    "op4_pii_surrogates": op4_pii_surrogates,
    "op5_bpe_round_trip": op5_bpe_round_trip,
    "op6_vector_sharding": op6_vector_sharding,
    "op7_warc_derivatives": op7_warc_derivatives,
    "op8_quality_rules": op8_quality_rules,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_language_id": op10_language_id,
    "op11_vector_codes": op11_vector_codes,
    "op12_source_schedule": op12_source_schedule,
    "op13_filter_audit": op13_filter_audit,
}

__all__ = ["QUERIES", "SQL"]

"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .centroids import OP11_SQL, op11_centroids
from .decontamination import OP2_SQL, op2_decontamination
from .hard_negatives import OP12_SQL, op12_hard_negatives
from .language_id import op8_language_id
from .lm_scoring import op6_lm_scoring
from .mixing import op4_mixing
from .pii import op3_pii
from .quality_rules import op1_quality_rules
from .secret_scan import op13_secret_scan
from .sharding import op9_sharding
from .simhash import op7_simhash
from .token_ids import op10_token_ids
from .url_filter import OP5_SQL, op5_url_filter

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_decontamination": op2_decontamination,
    "op3_pii": op3_pii,
    "op4_mixing": op4_mixing,
    "op5_url_filter": op5_url_filter,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_simhash": op7_simhash,
    "op8_language_id": op8_language_id,
    "op9_sharding": op9_sharding,
    "op10_token_ids": op10_token_ids,
    "op11_centroids": op11_centroids,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_secret_scan": op13_secret_scan,
}

#: DuckDB SQL by query name.
ORACLE_SQL: dict[str, str] = {
    "op2_decontamination": OP2_SQL,
    "op5_url_filter": OP5_SQL,
    "op11_centroids": OP11_SQL,
    "op12_hard_negatives": OP12_SQL,
}

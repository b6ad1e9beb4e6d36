"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from framequarry.llm.decontamination import ORACLE as OP8_SQL
from framequarry.llm.decontamination import op8_decontamination
from framequarry.llm.exact_dedup import ORACLE as OP11_SQL
from framequarry.llm.exact_dedup import op11_exact_dedup
from framequarry.llm.jaccard import op3_jaccard
from framequarry.llm.language_id import op10_language_id
from framequarry.llm.packing import op1_packing
from framequarry.llm.perplexity import op5_perplexity
from framequarry.llm.pii import op6_pii
from framequarry.llm.quality import op4_quality
from framequarry.llm.sharding import op7_sharding
from framequarry.llm.spelling import op13_spelling_variants
from framequarry.llm.sql import JACCARD_SQL, SHARDING_SQL, SPELLING_SQL, url_filter_sql
from framequarry.llm.toxicity import op9_toxicity
from framequarry.llm.url_filter import op2_url_filter
from framequarry.llm.vector_codes import ORACLE as OP12_SQL
from framequarry.llm.vector_codes import op12_vector_codes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_url_filter": op2_url_filter,
    "op3_jaccard": op3_jaccard,
    "op4_quality": op4_quality,
    "op5_perplexity": op5_perplexity,
    "op6_pii": op6_pii,
    "op7_sharding": op7_sharding,
    "op8_decontamination": op8_decontamination,
    "op9_toxicity": op9_toxicity,
    "op10_language_id": op10_language_id,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_vector_codes": op12_vector_codes,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE_SQL: dict[str, str] = {
    "op2_url_filter": url_filter_sql(),
    "op3_jaccard": JACCARD_SQL,
    "op7_sharding": SHARDING_SQL,
    "op8_decontamination": OP8_SQL,
    "op11_exact_dedup": OP11_SQL,
    "op12_vector_codes": OP12_SQL,
    "op13_spelling_variants": SPELLING_SQL,
}

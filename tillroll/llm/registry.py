"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm.decontamination import OP7_SQL, op7_decontamination
from tillroll.llm.mixing import op5_mix
from tillroll.llm.ngram_join import op8_ngram_join
from tillroll.llm.quality import op1_quality
from tillroll.llm.secrets import op2_secrets
from tillroll.llm.sharding import op10_shard
from tillroll.llm.token_counts import op3_token_counts
from tillroll.llm.topk_search import OP4_SQL, op4_topk
from tillroll.llm.toxicity import op9_toxicity
from tillroll.llm.urls import op6_urls


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": op1_quality,
        "op2_secrets": op2_secrets,
        "op3_token_counts": op3_token_counts,
        "op4_topk": op4_topk,
        "op5_mix": op5_mix,
        "op6_urls": op6_urls,
        "op7_decontamination": op7_decontamination,
        "op8_ngram_join": op8_ngram_join,
        "op9_toxicity": op9_toxicity,
        "op10_shard": op10_shard,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_topk": OP4_SQL, "op7_decontamination": OP7_SQL}

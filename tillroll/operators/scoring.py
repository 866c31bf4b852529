"""Adjusted scores and each customer's best items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import top_per_key


def _unit(c: str) -> Column:
    return F.least(F.greatest(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)), F.lit(1.0))


def normalized_log_feature(df: DataFrame, column: str) -> Column:
    """log1p of a column by its largest over all rows: 0 where that is 0.

    ``df`` is read once for the largest, so it should be a written table.
    """
    value = F.log1p(F.greatest(F.coalesce(F.col(column).try_cast("double"), F.lit(0.0)), F.lit(0.0)))
    most = df.agg(F.max(value)).first()[0] or 0.0
    return value / F.lit(most) if most > 0 else F.lit(0.0)


def adjust_prediction_scores(df: DataFrame, repeat_boost: float = 0.02, affinity_boost: float = 0.015, popularity_penalty: float = 0.0, every: DataFrame | None = None) -> DataFrame:
    """Raise repeats and favourite categories and brands, lower popular items.

    Columns that ``df`` lacks are passed over. Where ``df`` is a part of the rows, ``every``
    has the item_n_customers of all of them, once or more often.
    """
    score = F.col("score")
    if repeat_boost and "ui_n_transactions" in df.columns:
        score = score + F.when(F.col("ui_n_transactions") > 0, F.lit(repeat_boost)).otherwise(F.lit(0.0))
    for c in ("uc_transaction_share", "ub_transaction_share"):
        if affinity_boost and c in df.columns:
            score = score + F.lit(affinity_boost) * _unit(c)
    if popularity_penalty and "item_n_customers" in df.columns:
        score = score - F.lit(popularity_penalty) * normalized_log_feature(df if every is None else every, "item_n_customers")
    return df.withColumn("score", score)


def get_topk(scored: DataFrame, k: int = 10) -> DataFrame:
    """Each customer's k best: ids, target if there is one, score and rank."""
    kept = [c for c in ("customer_id", "item_id", "target") if c in scored.columns]
    return top_per_key(scored.select(*kept, "score"), ["customer_id"], [F.desc("score"), F.asc("item_id")], k, "rank")


def formula_score(df: DataFrame) -> DataFrame:
    """A score of ranks alone, for use without a fitted model."""
    ranks = {"recent_rank": 1.0, "frequent_rank": 0.5, "cooccurrence_rank": 0.25}
    score = sum((F.lit(w) / (F.col(c) + 1).cast("double") for c, w in ranks.items()), F.lit(0.0))
    return df.withColumn("score", score)

"""Ranking metrics and the coverage of candidate sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import mean, value_quantiles
from tillroll.operators.submission import as_rows


def precision_at_k(topk: DataFrame, k: int = 10) -> DataFrame:
    """Mean over users of their hits, by k."""
    hits = topk.groupBy("customer_id").agg(F.sum(F.col("target").cast("long")).alias("hits"))
    return hits.agg((mean("hits") / F.lit(k)).alias("precision"))


def precision_at_k_buyers_only(topk: DataFrame, ground_truth: DataFrame, k: int = 10) -> DataFrame:
    return precision_at_k(topk.join(ground_truth.select("customer_id").distinct(), "customer_id", "left_semi"), k)


def ground_truth_lists(ground_truth: DataFrame) -> DataFrame:
    """customer_id and the sorted array of distinct items bought; one label period bounds it."""
    return ground_truth.groupBy("customer_id").agg(F.sort_array(F.collect_set("item_id")).alias("items"))


def server_precision_at_k(submission: DataFrame, ground_truth: DataFrame, k: int = 10, scale: float = 100.0) -> DataFrame:
    """Hits among the first k of each label user's list, by k, averaged; repeats count."""
    truth = ground_truth.select("customer_id", "item_id").distinct()
    hits = as_rows(submission).where(F.col("position") < k).join(truth, ["customer_id", "item_id"]).agg(F.count("*").alias("hits"))
    users = truth.agg(F.count_distinct("customer_id").alias("users"))
    value = F.coalesce(F.try_divide(F.col("hits").cast("double"), F.col("users") * F.lit(k)), F.lit(0.0)) * F.lit(scale)
    return users.crossJoin(hits).select("users", "hits", value.alias("precision"))


def candidate_recall_report(candidates: DataFrame, ground_truth: DataFrame, k: int = 10) -> DataFrame:
    """One row of what a labelled candidate set covers; metrics of nothing are null.

    Candidates must have a target column.
    """
    if "target" not in candidates.columns:
        raise ValueError("candidates need a target column")
    of_user = candidates.groupBy("customer_id").agg(F.count("*").alias("n_candidates"), F.sum(F.col("target").cast("long")).alias("hits"))
    truth = ground_truth.groupBy("customer_id").agg(F.count("*").alias("n_true"))
    joined = truth.join(of_user, "customer_id", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_candidates", "hits")})
    joined = joined.withColumn("recall", F.col("hits").cast("double") / F.col("n_true"))
    items = lambda df, n: df.agg(F.count_distinct("item_id").alias(n))
    sizes = of_user.agg(F.coalesce(F.sum("n_candidates"), F.lit(0)).alias("candidate_pairs"), F.count("*").alias("candidate_users"), F.coalesce(F.sum("hits"), F.lit(0)).alias("candidate_hit_pairs"))
    covered = joined.agg(
        F.coalesce(F.sum("n_true"), F.lit(0)).alias("gt_pairs"),
        F.count("*").alias("gt_users"),
        F.count_if(F.col("hits") > 0).alias("users_with_hit"),
        F.coalesce(F.sum("hits"), F.lit(0)).alias("hit_pairs"),
        F.coalesce(F.sum(F.least("hits", F.lit(k))), F.lit(0)).alias("oracle_hits_at_k"),
        F.count_if(F.col("n_candidates") == 0).alias("zero_candidate_users"),
        mean("recall").alias("avg_user_recall"),
        F.min("recall").alias("min_user_recall"),
        F.max("recall").alias("max_user_recall"),
    )
    middle = value_quantiles(joined, "recall", {"median_user_recall": 0.5})
    row = reduce(DataFrame.crossJoin, [sizes, items(candidates, "candidate_items"), covered, items(ground_truth, "gt_items"), middle])
    share = lambda x, y: F.try_divide(F.col(x).cast("double"), y)
    return row.withColumns({
        "pair_recall": share("hit_pairs", F.col("gt_pairs")),
        "user_hit_recall": share("users_with_hit", F.col("gt_users")),
        "oracle_precision_at_k": share("oracle_hits_at_k", F.col("gt_users") * k),
    })


def candidate_count_distribution(candidates: DataFrame, ground_truth: DataFrame) -> DataFrame:
    """Candidates per user, of users that have any and of label users: a row for each."""
    counts = candidates.groupBy("customer_id").agg(F.count("*").alias("n"))
    label = ground_truth.select("customer_id").distinct().join(counts, "customer_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rows = []
    for name, df in (("candidate", counts), ("label", label)):
        ends = df.agg(F.count("*").alias("users"), F.min("n").alias("min"), mean("n").alias("mean"), F.max("n").alias("max"))
        places = value_quantiles(df, "n", {"median": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95})
        rows.append(ends.crossJoin(places).withColumn("population", F.lit(name)))
    return rows[0].unionByName(rows[1])


def format_report(row: dict) -> str:
    """A report row as lines of name and value."""
    shown = lambda v: "-" if v is None else f"{v:,}" if isinstance(v, int) else f"{v:.4f}" if isinstance(v, float) else str(v)
    return "\n".join(f"{name:>24}: {shown(value)}" for name, value in row.items())

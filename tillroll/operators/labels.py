"""Ground truth and labelled candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def make_ground_truth(label_tx: DataFrame) -> DataFrame:
    """Distinct customers and items, target 1."""
    return label_tx.select("customer_id", "item_id").distinct().withColumn("target", F.lit(1).cast("byte"))


def make_labeled_dataset(candidates: DataFrame, ground_truth: DataFrame) -> DataFrame:
    """Candidates with target 1 where the pair was bought, else 0, as the last column."""
    keys = {"customer_id": F.col("customer_id").cast("int"), "item_id": F.col("item_id").cast("string")}
    truth = ground_truth.withColumns(keys).select("customer_id", "item_id", "target")
    joined = candidates.withColumns(keys).drop("target").join(truth, ["customer_id", "item_id"], "left")
    rest = [c for c in candidates.columns if c not in ("customer_id", "item_id", "target")]
    return joined.select("customer_id", "item_id", *rest, F.coalesce("target", F.lit(0)).cast("byte").alias("target"))

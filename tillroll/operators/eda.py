"""Exploratory statistics of transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import mean, rate, total, value_quantiles


def basic_stats(tx: DataFrame) -> DataFrame:
    """Rows, distinct customers, items and bills, first and last date."""
    return tx.agg(
        F.count("*").alias("n_rows"),
        *[F.count_distinct(c).alias(n) for c, n in (("customer_id", "n_customers"), ("item_id", "n_items"), ("bill_id", "n_bills"))],
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
    )


def month_stats(tx: DataFrame) -> DataFrame:
    named = (("customer_id", "n_customers"), ("item_id", "n_items"), ("bill_id", "n_bills"), ("date", "n_days"))
    return tx.groupBy("month").agg(F.count("*").alias("n_rows"), *[F.count_distinct(c).alias(n) for c, n in named]).orderBy("month")


def basket_stats(hist: DataFrame) -> DataFrame:
    """Average, median, p95 and maximum of a bill's distinct items."""
    baskets = hist.groupBy("bill_id").agg(F.count_distinct("item_id").alias("n"))
    return _summary(baskets, "basket_size", with_max=True)


def customer_stats(hist: DataFrame) -> DataFrame:
    """Average, median and p95 of a customer's bills."""
    bills = hist.groupBy("customer_id").agg(F.count_distinct("bill_id").alias("n"))
    return _summary(bills, "bills")


def _summary(groups: DataFrame, name: str, with_max: bool = False) -> DataFrame:
    most = [F.max("n").alias(f"max_{name}")] if with_max else []
    places = value_quantiles(groups, "n", {f"median_{name}": 0.5, f"p95_{name}": 0.95})
    return groups.agg(mean("n").alias(f"avg_{name}"), *most).crossJoin(places)


def top_item_popularity(hist: DataFrame, n: int = 20) -> DataFrame:
    popular = hist.groupBy("item_id").agg(F.count("*").alias("n_transactions"), F.count_distinct("customer_id").alias("n_customers"), total("quantity").alias("total_quantity"))
    return popular.orderBy(F.desc("n_transactions"), "item_id").limit(n)


def repeat_stats(hist: DataFrame, n: int = 20) -> DataFrame:
    """Share of each item's customers with more than one bill, highest first."""
    bills = hist.groupBy("customer_id", "item_id").agg(F.count_distinct("bill_id").alias("n_bills"))
    return bills.groupBy("item_id").agg(rate(F.col("n_bills") > 1).alias("repeat_rate")).orderBy(F.desc("repeat_rate"), "item_id").limit(n)

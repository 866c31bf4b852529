"""Items' columns are added as rows are read, and the best of a customer are taken with their remainder."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tillroll.operators import features
from tillroll.plans import queries as Q

SF = "/root/testdata/sf0.001"
supplied = pytest.mark.skipif(not os.path.isdir(SF), reason="the supplied tables are not here")


@supplied
def test_joined_features_need_no_shuffle_of_wide_rows(spark, monkeypatch):
    monkeypatch.setattr(Q, "CHUNK_LINES", 3_000)
    monkeypatch.setattr(Q, "TASK_ROWS", 3_000)
    made = Q.queries()["joined_features"](spark, SF)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("BuildLeft") > 1
    i = Q.Inputs(spark, SF)
    whole = Q._rounded(i.wide, "user_avg_discount_rate", "item_avg_discount_rate", "item_user_discount_rate_diff")
    assert made.columns == whole.columns and made.count() == whole.count() and made.exceptAll(whole).isEmpty()


@supplied
@pytest.mark.parametrize("name", ["model_matrix", "inference_matrix"])
def test_matrices_write_no_column_of_items(spark, monkeypatch, name):
    monkeypatch.setattr(Q, "CHUNK_LINES", 3_000)
    made = Q.queries()[name](spark, SF)
    written = [set(spark.read.parquet(f).columns) for f in made.inputFiles()]
    rows = [c for c in written if "customer_id" in c]
    assert rows and not any({"item_avg_bill_items", "item_avg_price", "brand", "ul1_transaction_share"} & c for c in rows)


@supplied
def test_only_the_best_rows_are_written(spark, monkeypatch):
    whole = Q.queries()["penalised_topk"](spark, SF)
    rows = sorted(map(tuple, whole.collect()))
    monkeypatch.setattr(Q, "CHUNK_LINES", 2_000)
    made = Q.queries()["penalised_topk"](spark, SF)
    assert sorted(map(tuple, made.collect())) == rows
    assert spark.read.parquet(*made.inputFiles()).count() == len(rows)


def test_sums_of_bills_add_up(spark):
    lines = spark.createDataFrame(
        [(1, 7, "a", 2, 1.5), (1, 7, "a", 1, 2.0), (1, 7, "b", 1, None), (2, 8, "a", 3, 1.0), (2, 9, "c", 1, 4.0)], "customer_id int, bill_id long, item_id string, quantity long, price double"
    ).withColumn("price", F.col("price").cast("decimal(12,2)"))
    parts = [features.item_basket_sums(lines.where(F.col("bill_id") % 2 == k)) for k in range(2)]
    made = features.item_baskets_of(parts[0].union(parts[1]))
    assert sorted(map(tuple, made.collect())) == sorted(map(tuple, features.make_item_basket_features(lines).collect()))

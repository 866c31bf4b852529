"""What the whole history is needed for is written in parts, with few shuffles at a time."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tillroll.operators import candidates as C
from tillroll.operators import encode
from tillroll.plans import queries as Q

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the supplied tables are not here")


def test_co_purchases_by_remainders_of_anchors(spark):
    i = Q.Inputs(spark, SF)
    parts = i._pairs(3)
    assert len(parts) == 3 and all(not p.isEmpty() for p in parts)
    made, whole = i._union(parts), C.cooccurrence_pairs(i.hist, None, Q.CO_TOP, Q.MAX_BILL_ITEMS)
    assert made.count() == whole.count() and made.exceptAll(whole).isEmpty()


def test_a_bills_lines_are_dealt_once(spark):
    lines = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (2, "a"), (3, "a"), (3, "b"), (3, "c"), (3, "d")], "bill_id long, item_id string")
    bills = C.small_bills(lines, 2)
    assert sorted(sorted(r["items"]) for r in bills.collect()) == [["a"], ["a", "b"]]
    assert bills._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange ") == 1


def test_item_columns_of_bills(spark, monkeypatch):
    monkeypatch.setattr(Q, "CHUNK_LINES", 3_000)
    columns = ["customer_id", "item_id", "item_avg_bill_items", "item_n_customers"]
    made = Q.Inputs(spark, SF).written_wide(columns)
    whole = Q.Inputs(spark, SF).wide.select(*columns)
    assert made.count() == whole.count() and made.exceptAll(whole).isEmpty()


def test_mappings_of_a_train_matrix_are_written(spark):
    df = spark.createDataFrame([(1, "x", 0, 1.5, "b"), (1, "y", 1, None, None)], "customer_id int, item_id string, target int, price double, brand string")
    matrix, _, mappings = encode.prepare_train_matrix(df, [], ["brand"], ["price", "brand"])
    assert os.path.isdir(mappings.scratch_path)
    assert "SortMergeJoin" not in matrix._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in matrix.orderBy("item_id").select("item_id", "target", "price", F.col("brand")).collect()] == [("x", 0, 1.5, 1), ("y", 1, 0.0, 0)]

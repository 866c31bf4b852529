"""Features made for one remainder of customers after another, of wanted columns only."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tillroll.operators import features
from tillroll.plans import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="the supplied tables are not here")
def test_chunks_equal_the_whole(spark, monkeypatch):
    monkeypatch.setattr(Q, "CHUNK_LINES", 2_000)
    columns = [*Q.IDS, "recent_rank", "ub_transaction_share", "item_location_customers", "ui_recency_days", "size"]
    made = Q.Inputs(spark, SF).written_wide(columns)
    assert made.columns == columns and len({os.path.dirname(f) for f in made.inputFiles()}) > 1
    whole = Q.Inputs(spark, SF).wide.select(*columns)
    assert made.count() == whole.count() and made.exceptAll(whole).isEmpty()


def test_only_tables_that_are_asked_for(spark):
    empty = {name: spark.range(0).select(*[F.lit("").alias(c) for c in [*keys, *more]]) for name, keys, more in (
        ("user", ["customer_id"], ["user_n_transactions", "user_avg_price"]),
        ("item", ["item_id"], ["brand", "item_n_customers"]),
        ("user_brand", ["customer_id", "brand"], ["ub_n_transactions", "ub_recency_days"]),
        ("user_item", ["customer_id", "item_id"], ["ui_n_transactions"]),
    )}
    chosen = features.choose_sources(empty, ["ub_transaction_share"])
    assert {n: t.columns for n, t in chosen.items()} == {"user": ["customer_id", "user_n_transactions"], "item": ["item_id", "brand"], "user_brand": ["customer_id", "brand", "ub_n_transactions"]}

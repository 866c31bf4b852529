"""Rows without columns to sort by are written too; groups of files are tasks of their own."""

from __future__ import annotations

import os

import pytest

from tillroll.operators import encode, features
from tillroll.plans import queries as Q

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the supplied tables are not here")


def test_rows_of_items_only(spark, monkeypatch):
    monkeypatch.setattr(Q, "CHUNK_LINES", 3_000)
    cat = [*features.TAXONOMY, "size"]
    made, whole = Q.queries()["category_mapping"](spark, SF), encode.build_category_mappings(Q.Inputs(spark, SF).wide, cat)
    assert made.count() == whole.count() > 0 and made.exceptAll(whole).isEmpty()


def test_groups_of_files_are_tasks(spark, monkeypatch):
    monkeypatch.setattr(Q, "CHUNK_LINES", 3_000)
    monkeypatch.setattr(Q, "TASK_ROWS", 800)
    made = Q.Inputs(spark, SF).written_wide([*Q.IDS, "item_n_customers"])
    joins = made._jdf.queryExecution().executedPlan().toString().count("BuildLeft")
    assert made.rdd.getNumPartitions() == joins > 1


def test_candidates_of_dealt_lines(spark):
    i = Q.Inputs(spark, SF)
    hist = i._hist_of(0, ["brand"])
    made = i._labeled_of(0, hist, lambda rows: rows, i._partners(["brand"]), ["brand"])
    whole = i.labeled.join(i.items.select("item_id", "brand"), "item_id").select(*made.columns)
    assert made.count() == whole.count() > 0 and made.exceptAll(whole).isEmpty()
    files = [f.rpartition("_")[2] for f in made.inputFiles()]
    assert len(files) == len(set(files)) <= i._buckets  # one of each bucket: they lay by customer

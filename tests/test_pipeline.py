"""The whole way from transactions to blended lists, on the smallest supplied tables."""

from __future__ import annotations

import os

import pytest

from tillroll import sources
from tillroll.operators.model import TrainConfig
from tillroll.plans import pipeline
from tillroll.plans.config import SELECTED_FEATURES, Config

SF = "/root/testdata/sf0.001"


def test_selection_leaves_blocked_features_out():
    assert len(SELECTED_FEATURES) == 78 and len(Config().selected) == 66
    assert len(Config(drop_popular_signals=False).selected) == 78


@pytest.mark.skipif(not os.path.isdir(SF), reason="the supplied tables are not here")
def test_train_validate_submit_blend(spark, tmp_path):
    config = Config(train=TrainConfig(max_iter=3, max_depth=3, min_instances=5))
    run = pipeline.Pipeline(spark, sources.benchmark_transactions(spark, SF), sources.benchmark_items(spark, SF), str(tmp_path / "work"), config)
    assert 0.0 <= run.train() <= 1.0
    report = run.validate()
    assert 0 < report["pair_recall"] <= 1 and report["precision"] <= 100 * report["oracle_precision_at_k"] + 1e-9
    out = str(tmp_path / "sub")
    assert run.submit(out)["users"] == 150
    pipeline.blend(spark, out, out, str(tmp_path / "blend"))
    lists = sources.load_submission(spark, str(tmp_path / "blend")).collect()
    assert len(lists) == 150 and all(len(set(r["items"])) == len(r["items"]) <= 10 for r in lists)

"""Components of few links by one task, of many by rounds: the same."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tillroll.llm import components


@pytest.mark.parametrize("few", [0, 500_000])
def test_components_in_one_task_and_in_rounds(spark, monkeypatch, few):
    monkeypatch.setattr(components, "FEW_LINKS", few)
    rng = random.Random(2)
    links = [(k, k + 1) for k in range(200) if k % 17] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(70)] + [(5, 5), (-(2**63), 2**63 - 1)]
    least = {n: n for pair in links if pair[0] != pair[1] for n in pair}
    for _ in least:
        for a, b in links:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    found = components.connected(spark.createDataFrame(links, "a long, b long"))
    assert dict(found.dtypes) == {"node": "bigint", "component": "bigint"}
    assert {r.node: r.component for r in found.collect()} == least and found.count() == len(least)
    assert found.where(F.col("component") > F.col("node")).isEmpty()

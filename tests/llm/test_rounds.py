"""Pairs of a group of components that become one aren't all compared."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from tillroll.llm import ngram_join as N
from tillroll.llm.common import materialise
from tillroll.llm.shingles import set_digest, shingle_sets


def test_few_of_a_groups_pairs_are_compared(spark, monkeypatch):
    base = [f"w{k}" for k in range(200)]
    texts = [" ".join([*base, f"end{k}"]) for k in range(40)] + [" ".join(f"x{k}" for k in range(50))]
    ids = [set_digest(s) for s in shingle_sets(texts)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    nodes = materialise(spark.createDataFrame(list(zip(ids, texts)), "node long, text string").select("node", F.xxhash64("text").alias("text_hash")))
    pairs = materialise(spark.createDataFrame([(min(p), max(p)) for p in combinations(ids, 2)], "a long, b long"))
    none = materialise(spark.createDataFrame([], "node long, component long"))
    compared, verified = [], N._verified
    monkeypatch.setattr(N, "_verified", lambda p, *rest: compared.append(p.count()) or verified(p, *rest))
    found = {r["node"]: r["component"] for r in N._joined(pairs, none, docs, "text", nodes).collect()}
    assert {found.get(i, i) for i in ids[:40]} == {min(ids[:40])} and found.get(ids[40], ids[40]) == ids[40]
    assert sum(compared) <= 4 * len(ids) < len(ids) * (len(ids) - 1) / 2

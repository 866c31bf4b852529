"""Groups give links, fewer than they have nodes, and never their candidate pairs."""

from __future__ import annotations

import pytest

from tillroll.llm import ngram_join as N


@pytest.mark.parametrize("block", [2_000, 7])
def test_no_pairs_of_near_copies_are_rows(spark, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK", block)
    star_pairs = N._star_pairs  # representatives find nothing here: all is left to the groups
    monkeypatch.setattr(N, "_star_pairs", lambda minima: star_pairs(minima).where("false"))
    written, materialise = [], N.materialise
    monkeypatch.setattr(N, "materialise", lambda df: written.append(materialise(df)) or written[-1])
    monkeypatch.setattr(N, "release", lambda *tables: None)
    monkeypatch.setattr(N, "discard", lambda *tables: None)
    base = [f"w{k}" for k in range(120)]
    texts = [" ".join([*base, f"end{k}"]) for k in range(60)] + [" ".join([*base[60:], *(f"x{k}" for k in range(90))])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = N.with_smallest(N.jaccard_components(docs, ["doc_id"]), "doc_id")
    assert {r.doc_id: r.component_id for r in found.collect()} == {k: 0 if k < 60 else k for k in range(61)}
    counts = [df.count() for df in written if df.columns == ["a", "b"]]
    # A group of one block has 59 links at most, each of 9 x 10 / 2 pairs of blocks as many as its nodes.
    assert 59 <= max(counts) <= (59 if block == 2_000 else 45 * 14) < 60 * 59 / 2

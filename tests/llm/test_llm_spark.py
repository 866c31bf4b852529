"""The operators on small frames with nulls, empty and long texts, repeats, and
extra columns whose names clash with results."""

from __future__ import annotations

import random
import zlib

import pytest
from pyspark.sql import functions as F

from tillroll.llm import common, decontamination, mixing, ngram_join, quality, secrets, sharding, token_counts, topk_search, toxicity, urls
from tillroll.llm.common import text_remainder
from tillroll.llm.components import connected

public_tokenizers = pytest.importorskip("public_tokenizers")

ROWS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta", "s1"),
    (2, "alpha beta gamma delta epsilon zeta eta theta", "s1"),
    (2, "alpha beta gamma delta epsilon zeta eta theta", "s1"),
    (3, None, None),
    (None, "a null id", None),
    (4, "", "s2"),
    (5, "word " * 20_000, "s2"),
    (6, "one two three", "s3"),
    (None, None, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    # Names that results use too.
    return df.withColumns({c: F.lit("x") for c in ("score", "n_tokens", "spans", "base", "node", "size", "taken", "shard", "n_words", "host")}).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def test_token_counts(docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    got = token_counts.prefix_token_counts(docs, path)
    assert got.columns.count("n_tokens") == 1 and got.count() == len(ROWS)
    by = {r.doc_id: r for r in got.collect() if r.doc_id is not None}
    assert (by[3].n_bytes, by[3].n_tokens, by[3].prefix_tokens) == (0, 0, []) and by[5].n_tokens == 20_000 and by[6].prefix_tokens[2] == 1 and by[6].prefix_tokens[-1] == 3
    looked_up = got.where("doc_id = 6").select(token_counts.tokens_within(F.col("prefix_tokens"), F.lit(7)).alias("n"), token_counts.chars_within(F.col("prefix_tokens"), F.lit(2)).alias("c")).first()
    assert (looked_up.n, looked_up.c) == (2, 8)
    assert token_counts.prefix_token_counts(empty, path).count() == 0


def test_secrets(spark, docs, empty):
    assert secrets.scan_secrets(docs).where(F.size("spans") > 0).count() == 0
    assert secrets.scan_secrets(empty).count() == 0
    one = spark.createDataFrame([("x token = 'deadbeefdeadbeefdeadbeefdeadbeef'",)], "text string")
    assert [s["kind"] for s in secrets.scan_secrets(one).first()["base"]] == ["assign", "hex"]


def test_urls(spark):
    long = "http://" + "casino" * 3000 + ".org/" + "a" * 50_000
    rows = [(1, "http://a.net/es/"), (2, None), (3, "x"), (4, "http://casinowin.org/x"), (4, "http://casinowin.org/x"), (5, long), (None, "http://plain.words.org/")]
    rows += [(100 + i, f"http://{w}.org/{w}") for i, w in enumerate(("river", "stone", "house", "light", "tree") * 8)] + [(200 + i, f"http://plain{c}.org/") for i, c in enumerate("abcdefghijklmnopqrstuvwxyz" * 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({"host": F.lit("clash"), "__url": F.lit("clash"), "html": F.lit("<p>win words plain</p>")})
    for taught, model in ((True, urls.fit_urls(pages)), (True, urls.fit_urls(pages, html=None)), (False, urls.fit_urls(pages.where("false")))):
        found = urls.filter_urls(pages, urls.RULES, model)
        assert found.columns == ["page_id", "url", "__url", "html", "host", "path", "rule", "verdict"] and found.count() == len(rows)
        got = {r.page_id: r for r in found.collect()}
        assert got[1].verdict == "block" and (got[2].host, got[2].path, got[2].rule, got[2].verdict) == ("", "", None, "allow") and got[3].verdict == "allow"
        assert got[4].verdict == got[5].verdict == ("block" if taught else "allow") and got[None].verdict == "allow"
    assert urls.filter_urls(pages.where("false"), urls.RULES, model).count() == 0


def test_url_counts_are_those_of_a_plain_scan(spark):
    rows = [("http://a.casino.org/x/1",), ("http://a.casino.org/x/2",), ("http://words.org/x",), (None,)]
    model = urls.fit_urls(spark.createDataFrame(rows, "url string").withColumn("html", F.lit("<b>Words</b> a<script>no</script>")))
    unwanted = {s: 1 + (s == "casino") for s in urls.SEEDS} | {"a": 1, "x": 1, "<number>": 1}
    plain = urls.UrlModel(model.words, unwanted, {"words": 1, "x": 1})
    assert model.odds == pytest.approx(plain.odds)
    assert "no" not in model.words._log and model.words.cost("words") > model.words.cost("nowords")


def labelled(spark, good, bad, n=240):
    rng = random.Random(1)
    words = ["tree", "river", "stone", "house", "light", "green", "walks", "under", "moving", "slowly"]
    rows, labels = [], []
    for i in range(n):
        text = " ".join(rng.choice(words) + str(rng.randint(0, 9)) for _ in range(40))
        label = i % 3 != 0
        rows.append((i, good(text) if label else bad(text)))
        labels.append((i, int(label)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, mark int")


def test_quality_on_held_out_rows(spark, docs, empty):
    texts, labels = labelled(spark, lambda t: t.capitalize() + ".", lambda t: t.upper().replace(" ", "!! "))
    use = text_remainder(F.col("doc_id"), 4) != 2
    model = quality.fit_quality(texts, labels, use, "mark")
    held = quality.score_quality(texts, model).where(~use).join(labels, "doc_id")
    assert held.where((F.col("score") >= 0.7) == (F.col("mark") == 1)).count() == held.count() > 0
    assert all(0 <= r.score <= 1 for r in quality.score_quality(docs, model).collect())
    nothing = quality.fit_quality(empty, labels, use, "mark")
    assert {r.score for r in quality.score_quality(docs, nothing).collect()} == {0.5}


def test_toxicity_on_held_out_rows(spark, docs, empty):
    texts, labels = labelled(spark, lambda t: t + " vile rotten awful " + t[:60], lambda t: t)
    use = text_remainder(F.col("doc_id"), 3) != 1
    model = toxicity.fit_toxicity(texts, labels, use, "mark")
    held = toxicity.score_toxicity(texts, model).where(~use).join(labels, "doc_id")
    assert held.where((F.col("score") >= 0.7) == (F.col("mark") == 1)).count() >= 0.95 * held.count() > 0
    assert model.passages("fine " * 9 + "vile rotten awful " + "fine " * 9)[0][:2] == (9, 11)
    scored = toxicity.score_toxicity(docs, model)
    assert scored.count() == len(ROWS) and scored.where("NOT score BETWEEN 0 AND 1").count() == 0
    assert toxicity.fit_toxicity(empty, labels, use, "mark").constant == 0.5


def test_fold_remainder_is_that_of_the_text(spark):
    got = {r.v: r.m for r in spark.createDataFrame([(7,), (123456,), (None,)], "v long").select("v", text_remainder(F.col("v"), 4).alias("m")).collect()}
    assert got == {7: zlib.crc32(b"7") % 4, 123456: zlib.crc32(b"123456") % 4, None: None}


def test_mix(docs, empty):
    got = mixing.mix(docs, ["doc_id"]).collect()
    assert len(got) == len(ROWS) and all(r.taken <= 2 * r["size"] and r.copies <= 2 for r in got)
    by = {}
    for r in got:
        by.setdefault(r.source, [0, r.target, r.source_size])[0] += r.taken
    assert sum(t for _, t, _ in by.values()) == pytest.approx(1.5 * sum(n for _, _, n in by.values()))
    assert all(abs(k - t) <= 8 or n > 10_000 for k, t, n in by.values())
    again = mixing.mix(docs.repartition(5), ["doc_id"]).select("doc_id", "source", "taken")
    assert again.exceptAll(mixing.mix(docs, ["doc_id"]).select("doc_id", "source", "taken")).count() == 0
    assert mixing.mix(empty, ["doc_id"]).count() == 0
    assert mixing.mixed_documents(empty, ["doc_id"]).count() == 0


def test_mixed_documents_agree_with_the_plan(spark):
    df = spark.range(300).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 37).cast("int")).alias("text"), F.concat(F.lit("s"), F.col("id") % 4).alias("source"))
    planned = {r.doc_id: r.copies for r in mixing.mix(df, ["doc_id"]).where("copies > 0").collect()}
    made = {r.doc_id: r["count"] for r in mixing.mixed_documents(df, ["doc_id"]).groupBy("doc_id").count().collect()}
    assert made == planned


def test_shards(docs, empty):
    got = sharding.shard_by_bytes(docs, ["doc_id"], shards=3).collect()
    assert len(got) == len(ROWS)
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    same = {}
    for r in got:
        same.setdefault((r.text_crc32, r["size"]), set()).add(r.shard)
    assert all(len(s) == 1 for s in same.values())
    assert {r["size"] for r in got if r.text_crc32 is None} == {8}
    assert sharding.shard_by_bytes(empty, ["doc_id"]).count() == 0


def test_many_chunks_balance(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.col("id").cast("string"), F.repeat(F.lit("x"), (F.col("id") * 7919 % 97).cast("int"))).alias("text"))
    loads = [r[0] for r in sharding.shard_by_bytes(df, ["doc_id"], shards=5, chunk_groups=100).groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()]
    assert len(loads) == 5 and max(loads) - min(loads) <= 4


def test_search_over_shards_with_odd_vectors(spark):
    rng = random.Random(6)
    rows = [(i, [rng.choice([-1.0, -0.25, 0.0, 0.5, 1.0]) for _ in range(4)]) for i in range(200)]
    odd = [(300, None), (320, [1.0, None, 0.0, 0.0]), (340, [float("nan"), 0.0, 0.0, 0.0]), (360, [1.0]), (None, [1.0, 1.0, 1.0, 1.0]), (40, rows[40][1])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    vectors = topk_search.integer_vectors(df)
    assert vectors.count() == 202
    got = {}
    for r in topk_search.top_k(vectors, F.col("id") % 20 == 0, 7, shard_rows=40, query_block=4).collect():
        got.setdefault(r.query_id, []).append((r["rank"], -r.score, r.vec_id))
    sound = [(i, [int(64 * x // 1) for x in v]) for i, v in rows] + [(40, [int(64 * x // 1) for x in rows[40][1]])]
    for q, v in dict(sound).items():
        if q % 20 == 0:
            plain = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in sound if i != q)[:7]
            times = 2 if q == 40 else 1
            assert sorted((s, i) for _, s, i in got[q]) == sorted(plain * times)
    assert got.get(360) is None
    assert topk_search.top_k(vectors.where("false"), F.lit(True), 3).count() == 0


def test_search_passes_over_regions(spark):
    rng = random.Random(8)
    rows = [(i, [x + rng.random() for x in ((9.0, 0.0), (-9.0, 0.0), (0.0, 9.0), (0.0, -9.0))[i % 4]]) for i in range(800)]
    rows += [(1000 + i, [5.0, 5.0]) for i in range(150)]  # equal ones fill several shards
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("clash") for c in ("id", "size", "region", "query")})
    report: dict = {}
    found = topk_search.top_k(topk_search.integer_vectors(df), F.col("id") % 20 == 0, 5, shard_rows=50, query_block=10, report=report).collect()
    assert report["searched"] < 0.7 * report["pairs"]
    whole = {i: [int(64 * x // 1) for x in v] for i, v in rows}
    for q in (q for q in whole if q % 20 == 0):
        plain = sorted((-sum(a * b for a, b in zip(whole[q], w)), i) for i, w in whole.items() if i != q)[:5]
        assert [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] == [(i, -s) for s, i in plain]


def test_decontamination(spark, docs, empty, monkeypatch):
    text = "One two THREE four five six seven eight nine ten eleven twelve."
    rows = [(1, "x " + text + " y"), (2, "one two three four five six seven eight nine"), (3, None), (4, "short item here"), (5, "zz SHORT, item - here! zz"), (None, text)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("hits", "__digest", "__words", "__row", "n", "window")})
    bench = spark.createDataFrame([(10, text.lower()), (9, text), (11, "short item here"), (None, "zz short"), (12, None), (13, "!!")], "item_id long, text string")
    for limits in ({}, {"max_broadcast": 0}, {"max_broadcast": 0, "cells": 2}):
        monkeypatch.setattr(decontamination, "WORD_CELLS", limits.pop("cells", 1 << 18))
        got = {r.doc_id: r for r in decontamination.contamination(df, bench, ["doc_id"], **limits).collect()}
        hit = {k: len({p for h in r.hits for p in range(h["at"], h["at"] + h["n"])}) for k, r in got.items()}
        assert hit == {1: 12, 2: 0, 3: 0, 4: 3, 5: 4, None: 12}
        assert got[1]["items"] == ["10", "9"] and got[5]["items"] == ["11"] and got[3].n_words == 0
    kept = decontamination.decontaminate(df, bench)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]
    cut = {r.doc_id: r.text for r in decontamination.decontaminate(df, bench, "spans").collect()}
    assert cut[2] == rows[1][1] and cut[3] is None and "two" not in cut[1].lower() and cut[1].startswith("x ") and cut[1].endswith("y")
    assert decontamination.contamination(empty, bench, ["doc_id"]).count() == 0
    assert decontamination.contamination(df, bench.where("false"), ["doc_id"]).where(F.size("hits") > 0).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 7), (200, 201), (5, 5), (200, 201)]
    got = {r.node: r.component for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 0, 200: 200, 201: 200}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def near_texts(seed=1):
    """Chains and groups of near copies, with passages that many share."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(30)]
    texts = []
    for _ in range(12):
        base = [word() for _ in range(rng.randint(20, 120))]
        for _ in range(rng.randint(1, 7)):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = word()
            texts.append(" ".join(own + (passage if rng.random() < 0.4 else [])))
    return texts


def plain_components(rows):
    sets = [frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []) for w in ((t or "").lower().split() for _, t in rows)]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(d, ids.get(find(i), d))
    return sorted(((d, len(sets[i]), ids.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("small", [False, True])
def test_jaccard_components_match_all_pairs(spark, monkeypatch, small):
    if small:  # blocks, parts and joins without broadcast
        monkeypatch.setattr(ngram_join, "BLOCK", 3)
        monkeypatch.setattr(ngram_join, "GROUP_ROWS", 20)
        monkeypatch.setattr(common, "BROADCAST_ROWS", -1)
        monkeypatch.setattr(ngram_join, "MIN_HASHES", 1)
    rows = list(enumerate(near_texts())) + [(900, None), (901, ""), (902, "a b"), (903, "A  b"), (None, "a b"), (902, "a b"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("clash")).repartition(4)
    found = ngram_join.with_smallest(ngram_join.jaccard_components(df, ["doc_id"]), "doc_id")
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=repr) == plain_components(rows)


def test_one_of_each(spark, empty):
    rows = [(2, "a b c d e f"), (1, "A b c d e f"), (1, "A b c d e f"), (3, None), (3, None), (4, "q"), (None, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("hash", F.lit("clash"))
    got = sorted(((r.doc_id, r.text) for r in ngram_join.one_of_each(df).collect()), key=repr)
    assert got == sorted([(1, "A b c d e f"), (3, None), (3, None), (4, "q")], key=repr)
    assert ngram_join.one_of_each(empty).count() == 0


def test_pipeline_keeps_columns_and_applies_each_stage(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("hash", F.lit("clash"))
    columns, counts = docs.columns, [docs.count()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == columns
        docs = docs.cache()
        counts.append(docs.count())
        if name == "near_duplicates":
            found = ngram_join.jaccard_components(docs, ["doc_id"])
            assert found.groupBy("component").count().where("component IS NOT NULL AND count > 1").count() == 0
        if name == "decontamination":
            left = decontamination.contamination(docs, spark.read.parquet(f"{sf}/benchmark.parquet"), ["doc_id"])
            assert left.where(F.size("hits") > 0).count() == 0
    assert counts[0] > counts[1] > counts[2] >= counts[3] > 0
    final = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert final.count() == counts[4] and final.select("shard").distinct().count() <= 24

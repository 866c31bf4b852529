"""Operators on small hand-made frames: ties, nulls, empty input, repeats."""

from __future__ import annotations

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tillroll import sources
from tillroll.functions import nearest_quantile, value_quantiles
from tillroll.operators import candidates as C
from tillroll.operators import eda, encode, features, labels, metrics, sampling, scoring, splits
from tillroll.operators import submission as S

TX = "customer_id int, item_id string, bill_id long, updated_date timestamp_ntz, quantity long, price double, discount double, location int"


def tx(spark, rows):
    """Rows of customer, item, bill, day of 2024, price, discount, location."""
    made = [(c, i, b, datetime.fromisoformat(d), 1, p, x, loc) for c, i, b, d, p, x, loc in rows]
    return sources.with_calendar(spark.createDataFrame(made, TX))


@pytest.fixture(scope="module")
def hist(spark):
    return tx(spark, [
        (1, "a", 10, "2024-01-01", 10.0, 1.0, 1), (1, "b", 10, "2024-01-01", 20.0, 0.0, 1), (1, "a", 11, "2024-01-31", 10.0, 0.0, None),
        (1, "a", 11, "2024-01-31", 10.0, 0.0, None), (2, "b", 12, "2024-02-10", 0.0, 1.0, None), (2, "c", 12, "2024-02-10", None, 1.0, 2), (3, "c", 13, "2024-03-01", 5.0, 0.0, 2),
    ]).cache()


def as_dicts(df, *keys):
    return [r.asDict() for r in df.orderBy(*keys).collect()]


def test_active_and_recent_ties_go_to_the_smaller_item(spark, hist):
    active = C.get_active_users(hist, 2)
    assert [r.customer_id for r in active.collect()] == [1]
    got = as_dicts(C.recent_candidates(hist, C.get_active_users(hist, 1), 1), "customer_id")
    assert [(r["customer_id"], r["item_id"], r["recent_rank"]) for r in got] == [(1, "a", 1), (2, "b", 1), (3, "c", 1)]


def test_chunks_partition_customers(spark):
    users = spark.createDataFrame([(-1,), (0,), (17,), (33,)], "customer_id int")
    parts = [{r[0] for r in C.filter_user_chunk(users, k, 16).collect()} for k in range(16)]
    assert parts[15] == {-1} and parts[1] == {17, 33} and sum(map(len, parts)) == 4


def test_cooccurrence_leaves_large_bills_out(spark, hist):
    anchors = spark.createDataFrame([("a",), ("b",)], "item_id string").select(F.col("item_id").alias("anchor_item_id"))
    got = {(r.anchor_item_id, r.item_id, r.n_co_bills) for r in C.cooccurrence_pairs(hist, anchors, 5, 30).collect()}
    assert got == {("a", "b", 1), ("b", "a", 1), ("b", "c", 1)}
    assert C.cooccurrence_pairs(hist, anchors, 5, 1).count() == 0


def test_merge_takes_least_ranks_and_counts_sources(spark):
    a = spark.createDataFrame([(1, "x", 3, "cooccurrence"), (1, "x", 1, "cooccurrence")], "customer_id int, item_id string, cooccurrence_rank int, candidate_source string")
    b = spark.createDataFrame([(1, "x", 7, "recent"), (2, "y", 2, "recent")], "customer_id int, item_id string, recent_rank int, candidate_source string")
    got = as_dicts(C.merge_candidates([a, b]), "customer_id")
    assert (got[0]["cooccurrence_rank"], got[0]["recent_rank"], got[0]["n_candidate_sources"]) == (1, 7, 2)
    assert (got[1]["cooccurrence_rank"], got[1]["is_recent_candidate"], got[1]["is_popular_candidate"]) == (9999, 1, 0)


def test_labels(spark):
    cands = spark.createDataFrame([(1, "x", 5), (2, "y", 6)], "customer_id int, item_id string, k int")
    truth = labels.make_ground_truth(spark.createDataFrame([(1, "x"), (1, "x")], "customer_id int, item_id string"))
    got = labels.make_labeled_dataset(cands, truth)
    assert got.columns == ["customer_id", "item_id", "k", "target"]
    assert {(r.customer_id, r.target) for r in got.collect()} == {(1, 1), (2, 0)}


def test_user_features_count_null_places_and_days_inclusively(spark, hist):
    got = {r.customer_id: r for r in features.make_user_features(hist, F.lit(date(2024, 1, 31))).collect()}
    one = got[1]
    assert (one.user_n_locations, one.user_n_transactions_30d, one.user_n_bills) == (2, 4, 2)
    assert got[2].user_avg_discount_rate == 0.0 and got[2].user_avg_price == 0.0
    assert one.user_avg_discount_rate == pytest.approx(0.1 / 4)


def test_main_location_prefers_places_over_null(spark, hist):
    got = {r.customer_id: (r.user_main_location, r.user_main_location_transactions) for r in features.make_user_main_location(hist).collect()}
    assert got == {1: (1, 2), 2: (2, 1), 3: (2, 1)}


def test_repeat_interval(spark, hist):
    got = {(r.customer_id, r.item_id): r for r in features.make_user_item_features(hist, F.lit(date(2024, 3, 1))).collect()}
    assert (got[1, "a"].ui_avg_repeat_interval_days, got[1, "a"].ui_repeat_due_ratio) == (30.0, 1.0)
    assert got[1, "b"].ui_avg_repeat_interval_days == 9999.0


def test_features_keep_rows_and_fill(spark, hist):
    items = spark.createDataFrame(
        [("a", 9.0, "l1", "l2", "l3", "c", None, "m", 1, "s"), ("b", 9.0, "l1", "l2", "l3", "c", "B", "m", 1, "s")],
        "item_id string, price double, category_l1 string, category_l2 string, category_l3 string, category string, brand string, manufacturer string, sale_status int, size string",
    )
    pairs = spark.createDataFrame([(1, "a"), (1, "c"), (9, "b"), (3, "zz")], "customer_id int, item_id string")
    got = {(r.customer_id, r.item_id): r for r in features.build_features(hist, pairs, items).collect()}
    assert len(got) == 4
    assert got[9, "b"].ui_recency_days == 9999 and got[9, "b"].uc_transaction_share == 0.0
    assert got[1, "a"].brand is None and got[1, "a"].ub_n_transactions == 0 and got[3, "zz"].item_price_in_user_iqr == 0


@pytest.mark.parametrize("n", [1, 2, 4, 5, 8])
def test_quantiles_take_the_nearest_value(spark, n):
    values = [v * v for v in range(n)]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    for q in (0.25, 0.75, 0.95):
        place = int(q * (n - 1) + 0.5)
        assert df.agg(nearest_quantile("v", q)).first()[0] == values[place]
        assert value_quantiles(df, "v", {"q": q}).first()[0] == values[place]
    assert value_quantiles(df, "v", {"median": 0.5}).first()[0] == (values[(n - 1) // 2] + values[n // 2]) / 2


def test_category_codes_leave_unknown_zero(spark):
    df = spark.createDataFrame([("b",), ("unknown",), ("zz",), (None,), ("a",)], "c string")
    codes = encode.build_category_mappings(df, ["c"])
    assert {r.value: r.code for r in codes.collect()} == {"a": 1, "b": 2, "unknown": 0, "zz": 4}
    new = spark.createDataFrame([("zz",), ("new",), (None,)], "c string")
    assert sorted(r.c for r in encode.encode_categories(new, ["c"], codes).collect()) == [0, 0, 4]


def test_preprocess_saves_and_refuses_other_selections(spark, tmp_path):
    df = spark.createDataFrame([(1, "i", 1, 2.0, None, "k")], "customer_id int, item_id string, target int, x double, y int, c string")
    matrix, spec, maps = encode.prepare_train_matrix(df, ["customer_id", "item_id", "target"], ["c"], ["x", "y", "c"])
    assert matrix.columns == ["customer_id", "item_id", "target", "x", "y", "c"] and matrix.first().y == 0
    encode.save_preprocess(spec, maps, str(tmp_path / "p"))
    again, _ = encode.load_preprocess(spark, str(tmp_path / "p"), ["c", "y", "x"])
    assert again == spec
    with pytest.raises(ValueError):
        encode.load_preprocess(spark, str(tmp_path / "p"), ["x"])
    with pytest.raises(ValueError):
        encode.assert_no_blocked_features(["x"], ["x"])


def test_adjusted_scores_and_topk(spark):
    df = spark.createDataFrame([(1, "a", 0.5, 0, 0.0), (1, "b", 0.49, 1, 2.0), (1, "c", 0.5, 0, 0.0)], "customer_id int, item_id string, score double, ui_n_transactions int, uc_transaction_share double")
    got = as_dicts(scoring.get_topk(scoring.adjust_prediction_scores(df), 2), "rank")
    assert [r["item_id"] for r in got] == ["b", "a"] and got[0]["score"] == pytest.approx(0.49 + 0.02 + 0.015)


def _blend(base, extra, k, keep, limit, blocked):
    out = list(dict.fromkeys(base[:keep]))
    added = 0
    for item in extra:
        if len(out) >= k or added >= limit:
            break
        if item not in out and item not in blocked:
            out.append(item)
            added += 1
    for item in [*base, *extra]:
        if item not in out:
            out.append(item)
    return out[:k]


def test_blend_matches_plain_lists(spark):
    rng = random.Random(3)
    pick = lambda: [rng.choice("abcdefghij") for _ in range(rng.randint(0, 8))]
    base, extra = {c: pick() for c in range(40)}, {c: pick() for c in range(20, 60)}
    frame = lambda d: spark.createDataFrame(list(d.items()), "customer_id int, items array<string>")
    blocked = spark.createDataFrame([("a",), ("b",)], "item_id string")
    for k, keep, limit in ((5, 4, 1), (3, 5, 2), (6, 2, 0)):
        got = {r.customer_id: r["items"] for r in S.blend_submissions(frame(base), frame(extra), k, keep, limit, blocked).collect()}
        assert got == {c: _blend(b, extra.get(c, []), k, keep, limit, {"a", "b"}) for c, b in base.items()}


def test_submission_tiers_rotation_and_empty_lists(spark):
    topk = spark.createDataFrame([(1, "p", 1), (1, "q", 2)], "customer_id int, item_id string, rank int")
    users = spark.createDataFrame([(2,), (3,)], "customer_id int")
    own = spark.createDataFrame([(2, "q", 1), (9, "z", 1)], "customer_id int, item_id string, position int")
    everywhere = spark.createDataFrame([("f", 1), ("g", 2), ("h", 3)], "item_id string, position int")
    lists = lambda df: {r.customer_id: r["items"] for r in df.collect()}
    assert lists(S.make_submission(topk, 3, users, everywhere, own)) == {1: ["p", "q"], 2: ["q", "f", "g"], 3: ["f", "g", "h"]}
    assert lists(S.make_submission(topk, 3, users, everywhere, rotate=True))[2] == ["h", "f", "g"]
    assert lists(S.make_submission(topk, 3, users)) == {1: ["p", "q"], 2: [], 3: []}


def test_metrics_of_nothing_are_null_or_zero(spark):
    none = spark.createDataFrame([], "customer_id int, item_id string, target byte")
    some = spark.createDataFrame([(1, "a", 1), (1, "b", 0)], "customer_id int, item_id string, target int")
    assert metrics.candidate_recall_report(some, none).first().pair_recall is None
    sub = spark.createDataFrame([(1, ["a", "a"])], "customer_id int, items array<string>")
    assert metrics.server_precision_at_k(sub, none, 2).first().precision == 0.0
    assert metrics.server_precision_at_k(sub, some.where("target = 1"), 2).first().precision == 100.0
    report = metrics.candidate_recall_report(some, some.where("target = 1")).first()
    assert report.pair_recall == 1.0 and "pair_recall" in metrics.format_report(report.asDict())
    with pytest.raises(ValueError):
        metrics.candidate_recall_report(some.drop("target"), none)


def test_sampling_ratio_and_weights(spark):
    df = spark.range(2000).select(F.col("id").cast("int").alias("customer_id"), F.lit("i").alias("item_id"), (F.col("id") % 20 == 0).cast("int").alias("target"), F.col("id").alias("pop"))
    got = sampling.sample_training(df, 3.0, max_rows=None, batch_rows=500)
    counts = {r.target: r["count"] for r in got.groupBy("target").count().collect()}
    assert counts == {1: 100, 0: 300}
    assert got.exceptAll(sampling.sample_training(df, 3.0, max_rows=None, batch_rows=500)).count() == 0
    weights = sampling.popular_negative_weights(df, "pop", 0.5)
    assert weights.agg(F.max("weight"), F.min("weight")).first()[:] == (1.5, 1.0)
    assert sampling.popular_negative_weights(df, "absent", 0.5) is None


def test_eda_and_splits(spark, hist):
    assert eda.basket_stats(hist).first().max_basket_size == 2
    assert eda.repeat_stats(hist).first().asDict() == {"item_id": "a", "repeat_rate": 1.0}
    parts = splits.make_time_splits(hist, (1, 2), 3)
    assert (parts["train_hist"].count(), parts["train_label"].count()) == (6, 1)
    assert splits.date_range(hist, "2024-01-31", "2024-02-10").count() == 2


def test_sources(spark, hist, tmp_path):
    written = sources.sink_dataset(hist, str(tmp_path / "x.parquet"))
    assert written.count() == sources.scan_dataset(spark, str(tmp_path / "x_chunks")).count() == sources.count_rows(spark, str(tmp_path / "x.parquet"))
    assert sources.cleanup_paths(spark, [str(tmp_path / "x.parquet"), str(tmp_path / "none")]) == 1
    with pytest.raises(ValueError):
        sources.require_unique_items(spark.createDataFrame([("a",), ("a",)], "item_id string"))


def test_categories_are_split_by_sets_and_lists_go_round(spark, tmp_path):
    from tillroll.operators import model

    rows = spark.range(400).select(F.col("id").cast("int").alias("customer_id"), F.lit("i").alias("item_id"), (F.col("id") % 5).cast("int").alias("code"), (F.col("id") % 7).cast("double").alias("x"))
    rows = rows.withColumn("target", F.col("code").isin(0, 2, 4).cast("int"))  # no order of codes tells them apart at depth 1
    fitted, auc = model.train_gbt(rows, ["code", "x"], model.TrainConfig(max_iter=1, max_depth=1, min_instances=1), categorical=["code"])
    assert auc == 1.0 and model.predict_scores(rows, fitted).where("(score > 0.5) <> (target = 1)").count() == 0
    held = sampling.stratified_split(rows, 0.1).where("holdout").groupBy("target").count().collect()
    assert {r.target: r["count"] for r in held} == {1: 24, 0: 16}
    lists = spark.createDataFrame([(1, ["a", "b"]), (2, [])], "customer_id int, items array<string>")
    sources.export_lists(lists, str(tmp_path / "lists"))
    assert sources.export_dict(lists, str(tmp_path / "lists.json")) == 2
    for again in (sources.import_lists(spark, str(tmp_path / "lists")), sources.import_dict(spark, str(tmp_path / "lists.json"))):
        assert {r.customer_id: r["items"] for r in again.collect()} == {1: ["a", "b"], 2: []}

"""Train, validate, submit and blend, each stage written once under a work folder.

    python -m tillroll.plans.pipeline train --transactions T --items I --work W
    python -m tillroll.plans.pipeline valid ...
    python -m tillroll.plans.pipeline submit ... --out S
    python -m tillroll.plans.pipeline blend --base A --extra B --out S

``T`` may be ``benchmark:DIR`` for the supplied tables.
"""

from __future__ import annotations

import argparse
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tillroll import sources
from tillroll.operators import candidates as C
from tillroll.operators import encode, features, labels, metrics, model, sampling, scoring, splits
from tillroll.operators import submission as S
from tillroll.plans.config import CAT_COLS, DROP_COLS, Config


def log_step(message: str) -> None:
    print(f"[{time.strftime('%H:%M:%S')}] {message}", flush=True)


@contextmanager
def log_time(name: str) -> Iterator[None]:
    began = time.time()
    log_step(f"{name} ...")
    yield
    log_step(f"{name}: {time.time() - began:.1f} s")


class Pipeline:
    def __init__(self, spark: SparkSession, tx: DataFrame, items: DataFrame, work: str, config: Config | None = None):
        self.spark, self.items, self.work = spark, sources.require_unique_items(items), work.rstrip("/")
        self.config = c = config or Config()
        self.parts = splits.make_time_splits(tx, c.train_history_months, c.train_label_month, c.valid_history_months, c.valid_label_month, c.final_history_months)

    def _cut(self, df: DataFrame, name: str) -> DataFrame:
        return sources.sink_dataset(df, f"{self.work}/{name}")

    def _candidates(self, hist: DataFrame, name: str, train: bool = False, co_hist: DataFrame | None = None) -> DataFrame:
        active = C.get_active_users(hist, self.config.min_bills)
        found = C.build_candidates(hist, self.items, active, co_hist=co_hist, cut=sources.materialise, **self.config.candidate_sizes(train))
        return self._cut(found, f"{name}_candidates")

    def _features(self, hist: DataFrame, dataset: DataFrame, name: str) -> DataFrame:
        tables = features.make_cached_feature_sources(hist, self.items, f"{self.work}/{name}_sources")
        return self._cut(features.join_features(dataset, tables), f"{name}_features")

    def train(self) -> float:
        """Fit on the training split, keep the model under the work folder; holdout AUC."""
        c, hist = self.config, self.parts["train_hist"]
        with log_time("candidates"):
            cands = self._candidates(hist, "train", train=True)
        with log_time("features"):
            dataset = self._cut(labels.make_labeled_dataset(cands, labels.make_ground_truth(self.parts["train_label"])), "train_labeled")
            wide = self._features(hist, dataset, "train")
        with log_time("matrix"):
            spec, mappings = encode.fit_preprocess(wide, DROP_COLS, CAT_COLS, c.selected, c.blocked)
            encode.save_preprocess(spec, mappings, f"{self.work}/preprocess")
            spec, mappings = encode.load_preprocess(self.spark, f"{self.work}/preprocess")
            matrix = self._cut(encode.prepare_valid_matrix(wide, spec, mappings), "train_matrix")
            sample = sampling.sample_training(matrix, c.negative_ratio, c.positive_fraction, c.max_train_rows, c.seed)
            sample = self._cut(sample, "train_sample")
            weighed = sampling.popular_negative_weights(sample, c.weight_column, c.weight_alpha)
            sample = sample if weighed is None else weighed
            if not sample.limit(1).count():
                raise ValueError("the training sample is empty")
        with log_time("fit"):
            fitted, auc = model.train_gbt(sample, [*spec.numeric, *spec.cat], c.train, "weight" if weighed is not None else None, spec.cat)
            model.save_model(fitted, f"{self.work}/model")
            sources.write_csv(model.feature_importance(self.spark, fitted), f"{self.work}/feature_importance")
        log_step(f"holdout AUC {auc:.5f}")
        return auc

    def _ranked(self, hist: DataFrame, dataset: DataFrame, name: str) -> DataFrame:
        c = self.config
        spec, mappings = encode.load_preprocess(self.spark, f"{self.work}/preprocess", c.selected)
        prepare = encode.prepare_valid_matrix if "target" in dataset.columns else encode.prepare_inference_matrix
        matrix = prepare(self._features(hist, dataset, name), spec, mappings)
        scored = model.predict_scores(matrix, model.load_model(f"{self.work}/model"))
        adjusted = scoring.adjust_prediction_scores(scored, c.repeat_boost, c.affinity_boost, c.popularity_penalty)
        return self._cut(scoring.get_topk(adjusted, c.top_k), f"{name}_topk")

    def validate(self) -> dict:
        """Coverage of the candidates and precision with and without fallback."""
        k, hist = self.config.top_k, self.parts["valid_hist"]
        truth = self._cut(labels.make_ground_truth(self.parts["valid_label"]), "valid_truth")
        with log_time("candidates"):
            dataset = self._cut(labels.make_labeled_dataset(self._candidates(hist, "valid"), truth), "valid_labeled")
        report = metrics.candidate_recall_report(dataset, truth, k).first().asDict()
        with log_time("score"):
            topk = self._ranked(hist, dataset, "valid")
        fallback = S.recent_history_fallback(hist, S.missing_users(hist, topk), k)
        bare, whole = S.make_submission(topk, k), S.make_submission(topk, k, hist, None, fallback)
        sources.save_submission(whole, f"{self.work}/valid_submission")
        report["precision_model"] = metrics.server_precision_at_k(bare, truth, k).first()["precision"]
        report["precision"] = metrics.server_precision_at_k(whole, truth, k).first()["precision"]
        print(metrics.format_report(report), flush=True)
        return report

    def submit(self, out: str, co_hist: DataFrame | None = None) -> dict:
        """Lists of all customers of the final history; returns their concentration."""
        k, hist = self.config.top_k, self.parts["final_hist"]
        with log_time("candidates"):
            cands = self._candidates(hist, "final", co_hist=co_hist)
        with log_time("score"):
            topk = self._ranked(hist, cands, "final")
        fallback = S.recent_history_fallback(hist, S.missing_users(hist, cands), k)
        sources.save_submission(S.make_submission(topk, k, hist, None, fallback), out)
        report = S.item_concentration(sources.load_submission(self.spark, out), k).first().asDict()
        print(metrics.format_report(report), flush=True)
        return report


def blend(spark: SparkSession, base: str, extra: str, out: str, k: int = 10, keep: int = 9, limit: int = 1, block: int = 20) -> None:
    """Blend two saved submissions; the most frequent items of ``extra`` are blocked."""
    more = sources.load_submission(spark, extra)
    sources.save_submission(S.blend_submissions(sources.load_submission(spark, base), more, k, keep, limit, S.top_frequent_items(more, block)), out)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("step", choices=["train", "valid", "all", "submit", "blend"])
    for name in ("--transactions", "--items", "--work", "--out", "--base", "--extra"):
        parser.add_argument(name)
    for name, value in (("--k", 10), ("--base-keep", 9), ("--extra-limit", 1), ("--block-top", 20)):
        parser.add_argument(name, type=int, default=value)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("tillroll").config("spark.sql.session.timeZone", "UTC").config("spark.sql.requireAllClusterKeysForCoPartition", "false").getOrCreate()
    if args.step == "blend":
        return blend(spark, args.base, args.extra, args.out, args.k, args.base_keep, args.extra_limit, args.block_top)
    if args.transactions.startswith("benchmark:"):
        path = args.transactions.removeprefix("benchmark:")
        tx, items = sources.benchmark_transactions(spark, path), sources.benchmark_items(spark, path)
    else:
        tx, items = sources.load_data(spark, args.transactions, args.items)
    run = Pipeline(spark, tx, items, args.work)
    if args.step in ("train", "all"):
        run.train()
    if args.step in ("valid", "all"):
        run.validate()
    if args.step == "submit":
        run.submit(args.out)


if __name__ == "__main__":
    main()

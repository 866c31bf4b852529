"""Toxicity: maximum-scoring segments over token log-odds, calibrated by extreme values.

Labelled texts give each token, a word or the beginning of one, the log-odds ratio
of its use in toxic and clean documents under a Dirichlet prior that follows its use
overall; tokens whose ratio is significant keep it as their score, and all
others cost a little. A linear-time scan finds every maximal-scoring segment.

For scores of independent tokens the best segment of n tokens passes x with
probability 1 - exp(-K n exp(-lambda x)). lambda and K come from the clean training
documents, so a segment's excess lambda x - log(K n) tells how surprising it is in
a text of that length; segments with a positive excess are significant, their
excesses add up to a document's evidence, and a logistic curve turns that into a
score.

Fitting takes at most ``max_rows`` labelled documents, the first by seeded hash of
their id; scoring is one pass over every whole text, with nothing shuffled.

Defined results: null and empty texts have no segment and are scored; labels of
null or absent documents aren't used, of an id with several labels the highest
counts; without labels of both classes every score is the training rows' mean
label, or 0.5. Other columns pass through, and result names replace input columns
of the same name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import exp, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import discard, materialise, prepare_workers, read_table, reserved, text_remainder
from tillroll.llm.quality import logistic, sampled_labels

#: Labelled documents that a model is fitted on at most.
MAX_ROWS = 20_000
#: Beginnings of words that are tokens too, by their number of letters.
BEGINNINGS = (4, 5, 6, 7)
#: Pseudo-counts of the Dirichlet prior by use overall and for each token alike, score of a significant
#: token, documents that must hold it, and the cost of any other token.
PRIOR, EVEN, LEAST_ODDS, LEAST_DOCS, COST = 100.0, 0.5, 1.5, 4, 0.15
#: z-values from which a token is significant: the fit takes the one that serves best from
#: one half of its texts to the other.
Z_VALUES = (3.0, 3.5, 4.0, 4.75)
#: How far the calibration evens out the rarity of toxic documents: both classes weigh
#: the same. Of 0.5 and 1, the better by folds of the training rows.
BALANCE = 1.0
#: Evidence beyond this counts as this much.
MOST_EVIDENCE = 60.0

#: Cut from the ends of words.
_EDGES = "".join(map(chr, range(0x21, 0x30))) + ":;<=>?@[\\]^_`{|}~“”‘’…–—¡¿"


def words_of(text: str | None) -> list[str]:
    """Lower-cased words without punctuation at their ends."""
    return [w.strip(_EDGES) for w in (text or "").lower().split()]


def tokens_of(word: str) -> list[str]:
    """The word itself, and its beginnings marked by a bar."""
    return [word, *[word[:n] + "|" for n in BEGINNINGS if len(word) > n]]


def log_odds(toxic: int, clean: int, n_toxic: int, n_clean: int) -> tuple[float, float]:
    """Log-odds ratio of a token under the Dirichlet prior, and its z-value."""
    alpha = EVEN + PRIOR * (toxic + clean) / (n_toxic + n_clean)
    odds = [log((y + alpha) / (n + PRIOR - y)) for y, n in ((toxic, n_toxic), (clean, n_clean))]
    ratio = odds[0] - odds[1]
    return ratio, ratio / sqrt(1 / (toxic + alpha) + 1 / (clean + alpha))


def maximal_segments(scored: list[tuple[int, float]], cost: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments as (first, last, score).

    ``scored`` holds the places and scores of positive tokens; each token between
    two of them costs ``cost``. Segments kept so far are joined from the right as
    long as the sum before the joined one is lower, each at most once.
    """
    kept: list[list[float]] = []  # first, last, sum before, sum after
    total, before = 0.0, None
    for place, score in scored:
        total -= cost * (place - (before if before is not None else place - 1) - 1)
        before = place
        low, total = total, total + score
        new = [place, place, low, total]
        while True:
            k = len(kept) - 1
            while k >= 0 and kept[k][2] >= new[2]:
                k -= 1
            if k < 0 or kept[k][3] >= new[3]:
                kept.append(new)
                break
            new = [kept[k][0], new[1], kept[k][2], new[3]]
            del kept[k:]
    return [(int(a), int(b), high - low) for a, b, low, high in kept]


@dataclass
class SegmentModel:
    """Token scores, the extreme-value parameters, and the calibration."""

    scores: dict[str, float]
    cost: float
    decay: float = 1.0
    factor: float = 1.0
    slope: float = 1.0
    offset: float = 0.0
    constant: float | None = None
    _known: dict[str, float] = field(default_factory=dict, repr=False)

    def word_score(self, word: str) -> float:
        """Of the word if it has a score, else of its longest beginning that has."""
        known = self._known.get(word)
        if known is None:
            if len(self._known) > 500_000:
                self._known.clear()
            own = self.scores.get(word)
            if own is None:
                own = next((s for n in reversed(BEGINNINGS) if len(word) > n and (s := self.scores.get(word[:n] + "|")) is not None), 0.0)
            known = self._known[word] = own
        return known

    def segments(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        """The text's number of words and its maximal segments."""
        words = words_of(text)
        scores = list(map(self.word_score, words))
        return len(words), maximal_segments([(i, s) for i, s in enumerate(scores) if s > 0], self.cost)

    def excess(self, score: float, n: int) -> float:
        return self.decay * score - log(max(self.factor * n, 1.0))

    def evidence(self, n: int, segments: list[tuple[int, int, float]]) -> float:
        """Sum of the excesses of significant segments; without one, the largest excess."""
        if not segments:
            return self.excess(0.0, n)
        excesses = [self.excess(s, n) for _, _, s in segments]
        return min(max(sum(x for x in excesses if x > 0), max(excesses)), MOST_EVIDENCE)

    def passages(self, text: str | None) -> list[tuple[int, int, float]]:
        """Significant segments: first and last word, and excess."""
        n, segments = self.segments(text)
        return [(a, b, x) for a, b, s in segments if (x := self.excess(s, n)) > 0]

    def score(self, text: str | None) -> float:
        if self.constant is not None:
            return self.constant
        return 1 / (1 + exp(-max(-500.0, min(500.0, self.slope * self.evidence(*self.segments(text)) + self.offset))))


def _root(score_counts: Counter) -> float:
    """lambda > 0 with E exp(lambda s) = 1 for the distribution of token scores."""
    values = np.array(list(score_counts), dtype=float)
    shares = np.array([score_counts[v] for v in score_counts], dtype=float)
    shares /= shares.sum()
    if values.max(initial=0) <= 0 or (values * shares).sum() >= 0:
        return 1.0
    low, high = 1e-6, 1.0
    while (shares * np.exp(high * values)).sum() < 1 and high < 50:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if (shares * np.exp(middle * values)).sum() < 1 else (low, middle)
    return (low + high) / 2


def calibrate(model: SegmentModel, texts: list[tuple[list[tuple[int, int, float]], int, int]], background: Counter) -> SegmentModel:
    """Fit the extreme-value parameters on clean texts and the curve on all.

    ``texts``: segments, number of words and label of each training text.
    """
    model.decay = min(_root(background), 3.0)
    clean = [(max((s for _, _, s in segs), default=0.0), n) for segs, n, label in texts if label == 0]
    spread = sum(n * exp(-model.decay * best) for best, n in clean)
    model.factor = max(len(clean) / spread if spread else 1.0, 1e-6)
    x = np.array([model.evidence(n, segs) for segs, n, _ in texts])
    model.slope, model.offset = logistic(x, np.array([label for _, _, label in texts]), BALANCE)
    return model


def _counted(labelled: DataFrame, among: frozenset[str] | None) -> dict[str, tuple[int, int]]:
    """Number of documents of each half that hold each token, added up per batch first.

    Without ``among`` tokens of LEAST_DOCS documents or more, else those in it. The
    token "" counts the tokens of all documents, each once a document. What is
    collected is bounded by the labelled sample.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs: Counter[tuple[str, int]] = Counter()
            for text, half in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = {t for word in set(words_of(text)) if word for t in tokens_of(word)}
                docs["", half] += len(own)
                docs.update((t, half) for t in (own if among is None else own & among))
            columns = [[t for t, _ in docs], [h for _, h in docs], list(docs.values())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int64()))], names=["token", "half", "n"])

    counts = labelled.select("text", "__half").mapInArrow(run, "token string, half int, n long")
    each = [F.sum(F.when(F.col("half") == h, F.col("n")).otherwise(0)).alias(f"n{h}") for h in (0, 1)]
    found = counts.groupBy("token").agg(*each).where(F.col("n0") + F.col("n1") >= (LEAST_DOCS if among is None else 1))
    return {r["token"]: (int(r["n0"]), int(r["n1"])) for r in found.collect()}


def _significant(toxic: dict[str, int], clean: dict[str, int], least_z: float) -> dict[str, float]:
    """Log-odds of the significant tokens."""
    n_toxic, n_clean = toxic.get("", 0), clean.get("", 0)
    if not n_toxic or not n_clean:
        return {}
    rated = ((t, *log_odds(n, clean.get(t, 0), n_toxic, n_clean)) for t, n in toxic.items() if t and n >= LEAST_DOCS)
    return {t: ratio for t, ratio, z in rated if z >= least_z and ratio >= LEAST_ODDS}


def _scanned(labelled: DataFrame, models: list[SegmentModel]) -> list[list[tuple]]:
    """For each model, of every labelled document: segments, words, label, half and token scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for doc, text, label, half in zip(*[batch.column(k).to_pylist() for k in range(4)]):
                for k, model in enumerate(models):
                    n, segments = model.segments(text)
                    scores = sorted(round(s, 2) for w in words_of(text) if (s := model.word_score(w)) > 0)
                    made.append((doc, label, half, k, n, [s for _, _, s in segments], scores))
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made) if made else [[]] * 7, types)], names=["doc_id", "label", "half", "model", "n", "segments", "scores"])

    schema = "doc_id long, label int, half int, model int, n long, segments array<double>, scores array<double>"
    made = labelled.select("doc_id", "text", "__label", "__half").mapInArrow(run, schema)
    rows: list[list[tuple]] = [[] for _ in models]
    for r in made.dropDuplicates(["doc_id", "model"]).orderBy("doc_id").collect():
        rows[r["model"]].append(([(0, 0, s) for s in r["segments"]], r["n"], r["label"], r["half"], r["scores"]))
    return rows


def _calibrated(model: SegmentModel, rows: list[tuple]) -> SegmentModel:
    background: Counter = Counter()
    for _, n, label, _, scores in rows:
        if label == 0:
            background.update(scores)
            background[-COST] += n - len(scores)
    return calibrate(model, [r[:3] for r in rows], background)


def _loss(model: SegmentModel, rows: list[tuple]) -> float:
    """Mean log loss with both classes weighing the same."""
    sums, counts = [0.0, 0.0], [0, 0]
    for segments, n, label, _, _ in rows:
        x = model.slope * model.evidence(n, segments) + model.offset
        sums[label] += float(np.logaddexp(0.0, -x if label else x))
        counts[label] += 1
    return sum(s / max(c, 1) for s, c in zip(sums, counts))


def fit_toxicity(docs: DataFrame, labels: DataFrame, use: Column, label: str = "toxic", text: str = "text", max_rows: int = MAX_ROWS) -> SegmentModel:
    """Fit on labelled documents for which ``use``, over columns of ``labels``, holds.

    Each text counts once for the tokens, however often it occurs. The texts are
    halved by digest; scores from the first half, at each of Z_VALUES, are tried on
    the second, and the best z-value is then used with all texts.
    """
    prepare_workers(docs.sparkSession)
    chosen = sampled_labels(labels, label, use, max_rows)
    labelled = docs.select("doc_id", F.col(f"`{text}`").alias("text")).where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
    half = F.pmod(F.xxhash64(F.md5(F.encode("text", "UTF-8"))), F.lit(2)).cast("int")
    labelled = materialise(labelled.withColumns({"__label": (F.col("__label") > 0).cast("int"), "__half": half}))
    of_label = {r["__label"]: r["count"] for r in labelled.groupBy("__label").count().collect()}
    if len(of_label) < 2:
        return SegmentModel({}, COST, constant=float(next(iter(of_label), 0.5)))
    texts = labelled.groupBy(F.md5(F.encode("text", "UTF-8")).alias("digest"), "__half").agg(F.first("text").alias("text"), F.max("__label").alias("__label"))
    texts = materialise(texts)
    toxic = _counted(texts.where("__label = 1"), None)
    clean = _counted(texts.where("__label = 0"), frozenset(toxic))
    first = [{t: n[0] for t, n in counts.items()} for counts in (toxic, clean)]
    tried = [SegmentModel(_significant(*first, z), COST) for z in Z_VALUES]
    losses = []
    for model, rows in zip(tried, _scanned(labelled, tried)):
        own, other = ([r for r in rows if r[3] == h] for h in (0, 1))
        usable = len({r[2] for r in own}) == 2
        losses.append(_loss(_calibrated(model, own), other) if usable else 0.0)
    best_z = Z_VALUES[int(np.argmin(losses))]
    model = SegmentModel(_significant(*[{t: sum(n) for t, n in counts.items()} for counts in (toxic, clean)], best_z), COST)
    model = _calibrated(model, _scanned(labelled, [model])[0])
    discard(labelled, texts)
    return model


def score_toxicity(df: DataFrame, model: SegmentModel, text: str = "text") -> DataFrame:
    """Add score and passages (first and last word and excess of each significant segment)."""
    prepare_workers(df.sparkSession)
    passage = T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType()), T.StructField("excess", T.DoubleType())])
    added = [T.StructField("score", T.DoubleType()), T.StructField("passages", T.ArrayType(passage))]
    kept = [f for f in df.schema.fields if f.name.lower() not in ("score", "passages")]
    width = len(kept)
    source = df.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text}`").alias(reserved(df, "text")["text"]))
    arrow = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("excess", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, passages = [], []
            for t in batch.column(width).to_pylist():
                n, segments = model.segments(t)
                if model.constant is None:
                    x = model.slope * model.evidence(n, segments) + model.offset
                    scores.append(1 / (1 + exp(-max(-500.0, min(500.0, x)))))
                else:
                    scores.append(model.constant)
                passages.append([{"first": a, "last": b, "excess": e} for a, b, s in segments if (e := model.excess(s, n)) > 0])
            made = [pa.array(scores, pa.float64()), pa.array(passages, arrow)]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(width)], *made], names=[f.name for f in kept] + ["score", "passages"])

    return source.mapInArrow(run, T.StructType([*kept, *added]))


#: Ids of which a fold of this many is held out, and which of them; the least score of label 1.
FOLDS, HELD_OUT, LEAST = 3, 1, 0.7


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = fit_toxicity(docs, labels, text_remainder(F.col("doc_id"), FOLDS) != HELD_OUT)
    scored = score_toxicity(docs.select("doc_id", "text"), model)
    held_out = F.coalesce(text_remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= LEAST).cast("int").alias("predicted"))

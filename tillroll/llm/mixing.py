"""Mixing sources to target weights by subset-sum budget fitting.

Each source gets a budget of words: its weight's share of ``share`` times all
words, at most ``most`` times its own, the excess going to the others by weight.
Within a source all documents are taken whole as many times as the budget allows;
for what remains, documents are counted by exact length. A share of each length's
count is laid in first, then long documents while far from the budget, and
bounded-knapsack dynamic programming over the lengths left fits the rest to the
word, or to the nearest sum there is. Which documents of a length are taken is
decided by a seeded hash, so reruns agree.

Counts per (source, length) are the only thing gathered, one group per source and
one row per length. Picking the first m of a length by hash never brings a length's
documents into one task: counts per hash bucket find the bucket in which the m-th
falls, and only within buckets documents are numbered.

Defined results: a null text has no words; a null source is a source of its own,
last in order; documents without words are taken 0; of repeated rows each is a
document; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.llm.common import hinted, materialise, prepare_workers, read_table, reserved

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: Of one source and length, documents are numbered within buckets of leading bits of
#: their hash: this many bits, or as many more as keep buckets to BUCKET_ROWS or so.
BUCKET_BITS, BUCKET_ROWS = 10, 100_000
#: Words left to the dynamic program where the lengths at hand allow it.
FITTED_WORDS = 8192


def count_words(text: Column) -> Column:
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def source_targets(sizes: list[tuple[str | None, int]], share: Fraction = Fraction(3, 2), most: int = 2, weights: tuple[int, ...] = WEIGHTS) -> dict[str | None, float]:
    """Budget of each source: min(most x size, level x weight) with one level for all.

    That is where sharing the excess by weight again and again ends.
    """
    ordered = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {s: weights[k % len(weights)] for k, (s, _) in enumerate(ordered)}
    rest, open_weight = share * sum(n for _, n in ordered), sum(weight.values())
    targets, level = {}, Fraction(0)
    for s, n in sorted(ordered, key=lambda x: (Fraction(most * x[1], weight[x[0]]), x[0] is None, x[0] or "")):
        level = Fraction(rest, open_weight)
        cap = Fraction(most * n)
        got = min(cap, level * weight[s])
        targets[s] = float(got)
        rest, open_weight = rest - got, open_weight - weight[s]
    return targets


def fit_budget(lengths: list[int], counts: list[int], budget: int, fitted: int = FITTED_WORDS) -> list[int]:
    """How many documents of each length to take so that their words come nearest ``budget``."""
    total = sum(n * c for n, c in zip(lengths, counts))
    if budget <= 0 or not total:
        return [0] * len(lengths)
    if budget >= total:
        return list(counts)
    taken = [c * budget // total for c in counts]
    rest = budget - sum(n * m for n, m in zip(lengths, taken))
    by_length = sorted(range(len(lengths)), key=lambda k: -lengths[k])
    for k in by_length:
        n, spare = lengths[k], counts[k] - taken[k]
        if n and rest > fitted:
            more = min(spare, max(0, rest - fitted) // n)
            taken[k] += more
            rest -= more * n
    # Bits of ``reach`` are the sums that the pieces so far can make.
    left = [(lengths[k], counts[k] - taken[k], k) for k in reversed(by_length) if lengths[k] and counts[k] > taken[k]]
    capacity = rest + min((n for n, _, _ in left), default=0)
    mask, reach, stages = (1 << capacity + 1) - 1, 1, []
    for n, spare, k in left:
        spare, piece = min(spare, capacity // n), 1
        while spare > 0 and not reach >> rest & 1:
            piece = min(piece, spare)
            stages.append((reach, n, piece, k))
            reach = (reach | reach << n * piece) & mask
            spare, piece = spare - piece, piece * 2
    at = next(s for d in range(capacity + 1) for s in (rest - d, rest + d) if 0 <= s <= capacity and reach >> s & 1)
    for before, n, piece, k in reversed(stages):
        if not before >> at & 1:
            at -= n * piece
            taken[k] += piece
    return taken


def mix(docs: DataFrame, keys: list[str], seed: int = 17, text: str = "text", source: str = "source", share: Fraction = Fraction(3, 2), most: int = 2) -> DataFrame:
    """``keys``, source, size, source_size, target, whole, h, copies and taken of each document.

    Every document is taken ``whole`` times and, of its source and length, those of
    the least hashes h once more.
    """
    prepare_workers(docs.sparkSession)
    kept = [F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)]
    digest = seeded_hash(keys, seed, text)
    sized = materialise(docs.select(*kept, F.col(f"`{source}`").cast("string").alias("source"), count_words(F.col(f"`{text}`")).alias("size"), digest.alias("h")))
    counted = sized.groupBy("source", "size").agg(F.count("*").alias("n"))
    totals = [(r["source"], int(r["words"] or 0)) for r in counted.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words")).collect()]
    targets = source_targets(totals, share, most)
    words = dict(totals)

    def plan(lengths: pd.DataFrame) -> pd.DataFrame:
        name = lengths["source"].iloc[0]
        name = None if pd.isna(name) else name
        own, target = words[name], targets[name]
        whole = int(target // own) if own else 0
        sizes, counts = lengths["size"].tolist(), lengths["n"].tolist()
        extra = fit_budget(sizes, counts, round(target) - whole * own) if whole < most else [0] * len(sizes)
        return pd.DataFrame({"source": name, "size": sizes, "source_size": own, "target": target, "whole": whole, "extra": extra})

    planned = counted.groupBy("source").applyInPandas(plan, "source string, size long, source_size long, target double, whole long, extra long")

    largest = counted.agg(F.max("n")).first()[0] or 0
    bits = min(max(BUCKET_BITS, (largest // BUCKET_ROWS).bit_length()), 31)
    bucket = F.shiftright("h", 64 - bits).cast("int")
    place = ["p_source", "p_size", "bucket"]
    # Null sources take part in the joins: their key is told from every name.
    name = source_key("source")
    rows = sized.select("*", name.alias("p_source"), F.col("size").alias("p_size"), bucket.alias("bucket"))
    before = Window.partitionBy("p_source", "p_size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    plans = planned.select(name.alias("p_source"), F.col("size").alias("p_size"), "source_size", "target", "whole", "extra")
    offsets = rows.groupBy(*place).agg(F.count("*").alias("c")).withColumn("before", F.coalesce(F.sum("c").over(before), F.lit(0)))
    offsets = offsets.join(plans, ["p_source", "p_size"]).drop("c")
    rank = F.row_number().over(Window.partitionBy(*place).orderBy("h", *[f"__k{i}" for i in range(len(keys))]))
    ranked = rows.withColumn("rank", rank).join(offsets, place)
    copies = F.when(F.col("size") > 0, F.col("whole") + (F.col("before") + F.col("rank") <= F.col("extra")).cast("long")).otherwise(F.lit(0).cast("long"))
    return ranked.withColumn("copies", copies).select(
        *[F.col(f"__k{i}").alias(k) for i, k in enumerate(keys)], "source", "size", "source_size", "target", "whole", "h", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def seeded_hash(keys: list[str], seed: int, text: str) -> Column:
    return F.xxhash64(F.lit(seed), *[F.col(f"`{k}`") for k in keys], F.crc32(F.encode(F.col(f"`{text}`"), "UTF-8")))


def source_key(source: str) -> Column:
    """A join key of a source's name in which null is told from every name."""
    return F.when(F.col(source).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(source)))


def mixed_documents(docs: DataFrame, keys: list[str], seed: int = 17, text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: the rows of ``docs``, each as many times as it is taken.

    Texts aren't moved: whether a document is taken follows from its source, length
    and hash. Rows that agree in ``keys`` and text are taken alike.
    """
    planned = mix(docs, keys, seed, text, source)
    upto = F.max(F.when(F.col("copies") > F.col("whole"), F.col("h"))).alias("__upto")
    own = reserved(docs, "source", "size", "h", "whole", "upto", "copies", "copy")
    plan = planned.groupBy(source_key("source").alias("__source"), F.col("size").alias("__size")).agg(F.max("whole").alias("__whole"), upto)
    plan = materialise(plan.select(*[F.col(f"__{n}").alias(own[n]) for n in ("source", "size", "whole", "upto")]))
    rows = docs.withColumns({own["source"]: source_key(f"`{source}`"), own["size"]: count_words(F.col(f"`{text}`")), own["h"]: seeded_hash(keys, seed, text)}).where(F.col(own["size"]) > 0)
    joined = rows.join(hinted(plan), [own["source"], own["size"]])
    copies = F.col(own["whole"]) + F.coalesce((F.col(own["h"]) <= F.col(own["upto"])).cast("long"), F.lit(0))
    taken = joined.withColumn(own["copies"], copies).where(F.col(own["copies"]) > 0)
    return taken.withColumn(own["copy"], F.explode(F.array_repeat(F.lit(1), F.col(own["copies"]).cast("int")))).select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents"), ["doc_id"]).select("doc_id", "size", "source_size", "target", "taken")

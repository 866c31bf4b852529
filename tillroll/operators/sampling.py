"""Training samples and weights, by seeded hash of the pair."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


#: Rows from which negatives are drawn together.
BATCH_ROWS = 500_000


def draw(seed: int, keys: tuple[str, ...] = ("customer_id", "item_id")) -> Column:
    """A seeded number of a row's keys, as 32 hexadecimal digits that order like it."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def _first_digits(hexadecimal: Column, digits: int = 8) -> Column:
    return F.conv(F.substring(hexadecimal, 1, digits), 16, 10).cast("long")


def sample_training(df: DataFrame, negative_ratio: float = 3.0, positive_fraction: float = 1.0, max_rows: int | None = 3_000_000, seed: int = 42, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """A share of positives and up to ``negative_ratio`` negatives for each kept one.

    Exact within each of the hash batches of customers, of ``batch_rows`` rows or so;
    at most ``max_rows`` rows in all, taken evenly from the batches. Only keys and
    draws are ordered; each batch's last draws then select from the wide rows.
    ``df`` is read three times: it should be a written table.
    """
    batches = max(1, -(-df.count() // batch_rows))
    batch = (_first_digits(draw(seed + 1, ("customer_id",))) % F.lit(batches)).cast("int")
    rows = df.select(batch.alias("__b"), F.col("target").alias("__target"), draw(seed).alias("__d"))
    of_batch = Window.partitionBy("__b")
    place = F.row_number().over(Window.partitionBy("__b", "__target").orderBy("__d"))
    positives = F.ceil(F.count_if(F.col("__target") == 1).over(of_batch) * F.lit(positive_fraction))
    most = F.when(F.col("__target") == 1, positives).otherwise(F.ceil(positives * F.lit(negative_ratio)))
    taken = rows.withColumns({"__n": place, "__most": most}).where("__n <= __most")
    if max_rows is not None:
        taken = taken.withColumn("__s", F.row_number().over(of_batch.orderBy("__d"))).where(F.col("__s") <= -(-max_rows // batches))
    last = taken.groupBy("__b", "__target").agg(F.max("__d").alias("__last"))
    joined = df.withColumns({"__b": batch, "__target": F.col("target"), "__d": draw(seed)}).join(last, ["__b", "__target"])
    return joined.where("__d <= __last").select(*[F.col(f"`{c}`") for c in df.columns])


def negative_sample_counts(df: DataFrame, negative_ratio: float = 3.0) -> DataFrame:
    """Positives, negatives, and the negatives that a sample of the whole takes."""
    counted = df.agg(F.count_if(F.col("target") == 1).alias("n_positive"), F.count_if(F.col("target") == 0).alias("n_negative"))
    return counted.withColumn("n_sampled_negative", F.least("n_negative", F.ceil(F.col("n_positive") * F.lit(negative_ratio))).cast("long"))


def stratified_split(df: DataFrame, fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """Add ``holdout``: whether a row is among ``fraction`` of its target, rounded up.

    Those of the least draws. Draws are counted by their first digits, and only the
    rows that share the last ones' digits are ordered. ``df`` is read three times.
    """
    rows = df.select(F.col("target").alias("t"), draw(seed).alias("d")).withColumn("bin", _first_digits(F.col("d"), 4).cast("int"))
    counts: dict[int, list[tuple[int, int]]] = {}
    for r in rows.groupBy("t", "bin").count().collect():  # at most 65,536 a target
        counts.setdefault(r["t"], []).append((r["bin"], r["count"]))
    holdout = F.lit(False)
    for target, bins in counts.items():
        rest = ceil(sum(n for _, n in bins) * fraction)
        for edge, n in sorted(bins):
            if rest <= n:
                break
            rest -= n
        last = rows.where((F.col("t") == target) & (F.col("bin") == edge)).orderBy("d").select("d").limit(rest).agg(F.max("d")).first()[0]
        if last is not None:
            holdout = holdout | ((F.col("target") == target) & (draw(seed) <= F.lit(last)))
    return df.withColumn("holdout", holdout)


def popular_negative_weights(df: DataFrame, column: str | None, alpha: float) -> DataFrame | None:
    """Add ``weight``: 1, and on negatives more by their share of the log popularity.

    None if there is nothing to weigh by. ``df`` is read once for the largest value,
    so it should be a written table.
    """
    if not alpha or column is None or column not in df.columns:
        return None
    value = F.log1p(F.greatest(F.coalesce(F.col(column).try_cast("double"), F.lit(0.0)), F.lit(0.0)))
    most = df.agg(F.max(value)).first()[0]
    if not most or most <= 0:
        return None
    return df.withColumn("weight", F.when(F.col("target") == 0, 1 + F.lit(alpha) * value / F.lit(most)).otherwise(F.lit(1.0)))

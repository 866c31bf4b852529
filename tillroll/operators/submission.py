"""Recommendation lists: predictions with fallbacks, blends, and their concentration.

A submission has customer_id and an ordered array of items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.functions import top_overall, top_per_key
from tillroll.operators.candidates import recent_candidates


def collect_user_ids(df: DataFrame) -> DataFrame:
    return df.select(F.col("customer_id").cast("int").alias("customer_id")).distinct()


def popular_items(hist: DataFrame, top_k: int = 50, skip_top_k: int = 0) -> DataFrame:
    """item_id and place from 1 of the most popular items after the first ``skip_top_k``."""
    each = hist.groupBy("item_id", "customer_id").agg(F.count("*").alias("n"))
    popular = each.groupBy("item_id").agg(F.count("*").alias("n_customers"), F.sum("n").alias("n_transactions"))
    order = [F.desc("n_customers"), F.desc("n_transactions"), F.asc("item_id")]
    return top_overall(popular, order, top_k, "position", skip_top_k).select("item_id", "position")


def missing_users(users: DataFrame, having: DataFrame) -> DataFrame:
    """Users that aren't in ``having``."""
    return collect_user_ids(users).join(collect_user_ids(having), "customer_id", "left_anti")


def recent_history_fallback(hist: DataFrame, users: DataFrame, k: int = 10) -> DataFrame:
    """Each user's k most recent items: customer_id, item_id, position."""
    found = recent_candidates(hist, collect_user_ids(users), k, source=None)
    return found.withColumnRenamed("recent_rank", "position")


def as_lists(rows: DataFrame, position: str = "position") -> DataFrame:
    """customer_id and items in order of position; lists are of bounded length."""
    items = F.transform(F.array_sort(F.collect_list(F.struct(position, "item_id"))), lambda x: x["item_id"])
    return rows.groupBy("customer_id").agg(items.alias("items"))


def as_rows(submission: DataFrame) -> DataFrame:
    """customer_id, position from 0, item_id."""
    return submission.select("customer_id", F.posexplode("items").alias("position", "item_id"))


def _first_places(rows: DataFrame, k: int) -> DataFrame:
    """Of (customer_id, item_id, tier, position): each item once, the first k by tier and position."""
    once = rows.groupBy("customer_id", "item_id").agg(F.min(F.struct("tier", "position")).alias("at"))
    return top_per_key(once, ["customer_id"], [F.asc("at"), F.asc("item_id")], k, "place").select("customer_id", "item_id", F.col("place").alias("position"))


def make_submission(
    topk: DataFrame, k: int = 10, users: DataFrame | None = None, fallback_items: DataFrame | None = None, fallback_by_user: DataFrame | None = None, rotate: bool = False
) -> DataFrame:
    """Predictions by rank, then a user's own fallback, then the global one, to k items.

    Fallbacks are for ``users`` only; those with nothing at all keep an empty list.
    A list has k places, so k of the global items are enough for a user short of any.
    With ``rotate`` a customer starts in the global list at customer_id mod its length.
    """
    tier = lambda df, t, position: df.select("customer_id", "item_id", F.lit(t).alias("tier"), F.col(position).cast("long").alias("position"))
    rows = tier(topk, 1, "rank")
    if users is not None:
        users = collect_user_ids(users)
        if fallback_by_user is not None:
            rows = rows.unionByName(tier(fallback_by_user.join(users, "customer_id", "left_semi"), 2, "position"))
        if fallback_items is not None:
            # Only users short of k items, and of the list as many items as can be missing.
            having = rows.select("customer_id", "item_id").distinct().groupBy("customer_id").agg(F.count("*").alias("having"))
            short = users.join(having.where(F.col("having") >= k), "customer_id", "left_anti")
            whole = short.crossJoin(F.broadcast(fallback_items.withColumn("n", F.count("*").over(Window.partitionBy(F.lit(0))))))
            place = F.pmod(F.col("position") - 1 - F.col("customer_id"), F.col("n")) if rotate else F.col("position") - 1
            rows = rows.unionByName(tier(whole.withColumn("position", place).where(F.col("position") < k), 3, "position"))
    lists = as_lists(_first_places(rows, k))
    if users is not None:
        lists = lists.join(users, "customer_id", "full").withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    return lists


def top_frequent_items(submission: DataFrame, n: int) -> DataFrame:
    """The n items on most lists; none for n of 0 or less."""
    counted = as_rows(submission).groupBy("item_id").agg(F.count("*").alias("n_lists"))
    return counted.orderBy(F.desc("n_lists"), "item_id").limit(max(n, 0))


def blend_submissions(base: DataFrame, extra: DataFrame, k: int = 10, base_keep: int = 9, extra_limit: int = 1, blocked: DataFrame | None = None) -> DataFrame:
    """base[:keep], up to ``extra_limit`` new extras that aren't blocked, the rest of base,
    the rest of extra, cut at k. Only base's customers appear."""
    first = as_rows(base)
    once = first.groupBy("customer_id", "item_id").agg(F.min("position").alias("position"))
    # Room and kept items are of the distinct prefix.
    kept = once.where(F.col("position") < base_keep)
    room = base.select("customer_id").join(kept.groupBy("customer_id").agg(F.count("*").alias("n")), "customer_id", "left")
    room = room.select("customer_id", F.greatest(F.lit(k) - F.coalesce("n", F.lit(0)), F.lit(0)).alias("room"))
    other = as_rows(extra).join(base.select("customer_id"), "customer_id", "left_semi").groupBy("customer_id", "item_id").agg(F.min("position").alias("position"))
    fresh = other.join(kept.select("customer_id", "item_id"), ["customer_id", "item_id"], "left_anti")
    if blocked is not None:
        fresh = fresh.join(F.broadcast(blocked.select("item_id")), "item_id", "left_anti")
    chosen = top_per_key(fresh, ["customer_id"], [F.asc("position"), F.asc("item_id")], max(extra_limit, 0), "place") if extra_limit > 0 else fresh.withColumn("place", F.lit(1)).limit(0)
    chosen = chosen.join(room, "customer_id").where(F.col("place") <= F.col("room"))
    tier = lambda df, t: df.select("customer_id", "item_id", F.lit(t).alias("tier"), F.col("position").cast("long").alias("position"))
    rows = tier(kept, 1).unionByName(tier(chosen, 2)).unionByName(tier(once, 3)).unionByName(tier(other, 4))
    lists = as_lists(_first_places(rows, k))
    return base.select("customer_id").join(lists, "customer_id", "left").withColumn("items", F.coalesce("items", F.array().cast("array<string>")))


def item_concentration(submission: DataFrame, k: int = 10, tops: tuple[int, ...] = (1, 5, 10, 20, 50, 100)) -> DataFrame:
    """One row: users, slots, items, list lengths and the share of the most frequent items."""
    first = submission.select("customer_id", F.slice("items", 1, k).alias("items"))
    lengths = first.agg(
        F.count("*").alias("users"), F.coalesce(F.sum(F.size("items")), F.lit(0)).alias("slots"), F.min(F.size("items")).alias("min_length"), F.max(F.size("items")).alias("max_length"),
        F.try_divide(F.sum(F.size("items")).cast("double"), F.count("*")).alias("mean_length"),
    )
    counted = as_rows(first).groupBy("item_id").agg(F.count("*").alias("n"))
    ranked = top_overall(counted, [F.desc("n"), F.asc("item_id")], max(tops), "rank")
    heads = ranked.agg(*[F.coalesce(F.sum(F.when(F.col("rank") <= t, F.col("n"))), F.lit(0)).alias(f"top_{t}") for t in tops])
    whole = lengths.crossJoin(counted.agg(F.count("*").alias("unique_items"))).crossJoin(heads)
    shares = {f"share_top_{t}": F.coalesce(F.try_divide(F.col(f"top_{t}").cast("double"), F.col("slots")), F.lit(0.0)) for t in tops}
    return whole.withColumns(shares).drop(*[f"top_{t}" for t in tops])


def frequent_slots(submission: DataFrame, n: int, slot: int | None = None, k: int = 10) -> DataFrame:
    """The n items most often in the first k places, or in one ``slot`` from 1."""
    rows = as_rows(submission).where(F.col("position") < k)
    rows = rows if slot is None else rows.where(F.col("position") == slot - 1)
    return rows.groupBy("item_id").agg(F.count("*").alias("n_lists")).orderBy(F.desc("n_lists"), "item_id").limit(n)

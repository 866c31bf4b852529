"""Candidate items of customers from several sources, and their merge.

Sources rank by counts; ties go to the smaller key, so results are the same in
every run. Item rankings are over the whole history.

Sources take a history's lines or, cheaper where several are made, its cells from
:func:`purchase_cells`: one aggregation that all but co-purchases start from.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.functions import top_overall, top_per_key, total

#: Sources and the flag of each in the merge.
SOURCE_FLAGS = {
    "recent": "is_recent_candidate",
    "frequent": "is_frequent_candidate",
    "popular": "is_popular_candidate",
    "category_popular": "is_category_candidate",
    "location_popular": "is_location_candidate",
    "cooccurrence": "is_cooccurrence_candidate",
}
#: Rank columns of the sources, in the order of the merge.
RANKS = ("recent_rank", "frequent_rank", "popular_rank", "user_category_rank", "category_item_rank", "user_location_rank", "location_item_rank", "cooccurrence_rank")
#: Rank of a pair that a source doesn't have.
ABSENT_RANK = 9999


def get_active_users(hist: DataFrame, min_bills: int = 2) -> DataFrame:
    return hist.groupBy("customer_id").agg(F.count_distinct("bill_id").alias("n")).where(F.col("n") >= min_bills).select("customer_id")


def filter_user_chunk(users: DataFrame, chunk: int, n_chunks: int) -> DataFrame:
    """Customers of one of ``n_chunks`` remainders; all of them for one chunk."""
    return users if n_chunks <= 1 else users.where(F.pmod(F.col("customer_id").cast("long"), F.lit(n_chunks)) == chunk)


def purchase_cells(hist: DataFrame) -> DataFrame:
    """Lines counted by customer, item and place: n_lines, quantity, updated_date (the last)."""
    return hist.groupBy("customer_id", "item_id", "location").agg(
        F.count("*").alias("n_lines"), F.sum("quantity").alias("quantity"), F.max("updated_date").alias("updated_date")
    )


def n_lines(hist: DataFrame) -> Column:
    """Number of lines of a group of lines or cells."""
    return F.sum("n_lines") if "n_lines" in hist.columns else F.count("*")


def _of(hist: DataFrame, active: DataFrame) -> DataFrame:
    return hist.join(active, "customer_id", "left_semi")


def _named(df: DataFrame, source: str | None) -> DataFrame:
    return df if source is None else df.withColumn("candidate_source", F.lit(source))


def recent_candidates(hist: DataFrame, active: DataFrame, top_k: int = 20, source: str | None = "recent") -> DataFrame:
    """Items that a customer bought last."""
    bought = _of(hist, active).groupBy("customer_id", "item_id").agg(F.max("updated_date").alias("seen"), n_lines(hist).alias("n")).where(F.col("seen").isNotNull())
    top = top_per_key(bought, ["customer_id"], [F.desc("seen"), F.desc("n"), F.asc("item_id")], top_k, "recent_rank")
    return _named(top.select("customer_id", "item_id", "recent_rank"), source)


def frequent_items(hist: DataFrame, active: DataFrame, top_k: int, rank: str) -> DataFrame:
    """Items that a customer bought most often."""
    bought = _of(hist, active).groupBy("customer_id", "item_id").agg(n_lines(hist).alias("n"), total("quantity").alias("q"))
    return top_per_key(bought, ["customer_id"], [F.desc("n"), F.desc("q"), F.asc("item_id")], top_k, rank).select("customer_id", "item_id", rank)


def frequent_candidates(hist: DataFrame, active: DataFrame, top_k: int = 20, source: str | None = "frequent") -> DataFrame:
    return _named(frequent_items(hist, active, top_k, "frequent_rank"), source)


def _popularity(hist: DataFrame, *keys: str) -> DataFrame:
    """Distinct customers, rows and quantity by key: by customer first, so that a
    popular key's customers are counted and not gathered."""
    each = hist.groupBy(*keys, "customer_id").agg(n_lines(hist).alias("n"), total("quantity").alias("q"))
    return each.groupBy(*keys).agg(F.count("*").alias("n_customers"), F.sum("n").alias("n_transactions"), F.sum("q").alias("total_quantity"))


def popular_candidates(hist: DataFrame, active: DataFrame, top_k: int = 50, source: str | None = "popular") -> DataFrame:
    """The items of most customers, for every active customer."""
    order = [F.desc("n_customers"), F.desc("n_transactions"), F.asc("item_id")]
    top = top_overall(_popularity(hist, "item_id"), order, top_k, "popular_rank").select("item_id", "popular_rank")
    return _named(active.crossJoin(F.broadcast(top)).select("customer_id", "item_id", "popular_rank"), source)


def category_popular_candidates(
    hist: DataFrame, items: DataFrame, active: DataFrame, category_col: str = "category_l2", user_top_categories: int = 3, items_per_category: int = 20, source: str | None = "category_popular"
) -> DataFrame:
    """Items of most customers within the categories that a customer buys most."""
    known = hist.join(items.select("item_id", category_col), "item_id").where(F.col(category_col).isNotNull())
    own = _of(known, active).groupBy("customer_id", category_col).agg(n_lines(known).alias("n"))
    own = top_per_key(own, ["customer_id"], [F.desc("n"), F.asc(category_col)], user_top_categories, "user_category_rank")
    best = _top_items(known, category_col, items_per_category, "category_item_rank")
    return _named(own.join(best, category_col).select("customer_id", "item_id", "user_category_rank", "category_item_rank"), source)


def location_popular_candidates(
    hist: DataFrame, active: DataFrame, user_top_locations: int = 0, items_per_location: int = 0, source: str | None = "location_popular"
) -> DataFrame:
    """Items of most customers at the places where a customer buys most."""
    known = hist.where(F.col("location").isNotNull())
    own = _of(known, active).groupBy("customer_id", "location").agg(n_lines(known).alias("n"), F.max("updated_date").alias("seen"))
    own = top_per_key(own, ["customer_id"], [F.desc("n"), F.desc("seen"), F.asc("location")], user_top_locations, "user_location_rank")
    best = _top_items(known, "location", items_per_location, "location_item_rank")
    return _named(own.join(best, "location").select("customer_id", "item_id", "user_location_rank", "location_item_rank"), source)


def _top_items(known: DataFrame, key: str, k: int, rank: str) -> DataFrame:
    order = [F.desc("n_customers"), F.desc("n_transactions"), F.desc("total_quantity"), F.asc("item_id")]
    return top_per_key(_popularity(known, key, "item_id"), [key], order, k, rank).select(key, "item_id", rank)


def cooccurrence_pairs(hist: DataFrame, anchors: DataFrame | None, co_top_k: int, max_bill_items: int) -> DataFrame:
    """Items bought with each anchor item (without ``anchors``: each item) on most bills: anchor_item_id, item_id, rank.

    Bills of more than ``max_bill_items`` items are left out.
    """
    return pairs_of_bills(small_bills(hist, max_bill_items), anchors, co_top_k)


def small_bills(hist: DataFrame, max_bill_items: int) -> DataFrame:
    """items, an array, of each bill of at most ``max_bill_items``; of larger ones one item more is gathered.

    Lines are dealt by bill once: its distinct items, their places and the array all come of that.
    """
    lines = hist.select("bill_id", "item_id").repartition("bill_id").distinct()
    lines = top_per_key(lines, ["bill_id"], [F.asc("item_id")], max_bill_items + 1, "place")
    return lines.groupBy("bill_id").agg(F.collect_list("item_id").alias("items")).where(F.size("items") <= max_bill_items).select("items")


def pairs_of_bills(bills: DataFrame, anchors: DataFrame | None, co_top_k: int, chunk: int = 0, n_chunks: int = 1) -> DataFrame:
    """:func:`cooccurrence_pairs` from :func:`small_bills`, for one of ``n_chunks`` remainders of anchor items.

    Pairs come from the bill's row with no self-join, at most the square of its items.
    """
    first = bills.select("items", F.explode("items").alias("anchor_item_id"))
    first = first if n_chunks <= 1 else first.where(F.pmod(F.xxhash64("anchor_item_id"), F.lit(n_chunks)) == chunk)
    first = first if anchors is None else first.join(anchors, "anchor_item_id", "left_semi")
    pairs = first.select("anchor_item_id", F.explode("items").alias("item_id")).where("anchor_item_id <> item_id")
    counted = pairs.groupBy("anchor_item_id", "item_id").agg(F.count("*").alias("n_co_bills"))
    return top_per_key(counted, ["anchor_item_id"], [F.desc("n_co_bills"), F.asc("item_id")], co_top_k, "cooccurrence_rank")


def partners_of(pairs: DataFrame, meta: DataFrame | None = None) -> DataFrame:
    """:func:`cooccurrence_pairs` as one row for each anchor item: its ``partners``, an array,
    with the columns that ``meta`` has of items."""
    known = pairs if meta is None else pairs.join(meta, "item_id", "left")
    each = F.struct(*[c for c in known.columns if c not in ("anchor_item_id", "n_co_bills")])
    return known.groupBy("anchor_item_id").agg(F.collect_list(each).alias("partners"))


def candidates_of_dealt(cells: DataFrame, partners: DataFrame, n: int, recent_top_k: int, frequent_top_k: int, own: Iterable[str] = ()) -> DataFrame:
    """Recent, frequent and co-purchased items of active customers, merged as by :func:`merge_candidates`.

    ``cells``, a row for each customer and item, lie by customer. Their best go to their
    partners, by item, and back to ``n`` parts of customers with these as an array: one
    relation, as a union would be dealt again.
    """
    place = lambda *order: F.row_number().over(Window.partitionBy("customer_id").orderBy(*order, F.asc("item_id"))).cast("int")
    ranked = cells.withColumns({
        "recent_rank": F.when(F.col("updated_date").isNotNull(), place(F.desc("updated_date"), F.desc("n_lines"))),
        "frequent_rank": place(F.desc("n_lines"), F.desc(F.coalesce("quantity", F.lit(0)))),
    })
    ranks = {"recent_rank": recent_top_k, "frequent_rank": frequent_top_k}
    ranked = ranked.select("customer_id", "item_id", *own, *[F.when(F.col(r) <= k, F.col(r)).alias(r) for r, k in ranks.items()]).where("recent_rank IS NOT NULL OR frequent_rank IS NOT NULL")
    anchor = F.when(F.col("frequent_rank").isNotNull(), F.col("item_id"))
    met = ranked.withColumn("anchor_item_id", anchor).join(partners, "anchor_item_id", "left").drop("anchor_item_id").repartition(n, "customer_id")
    no_rank = F.lit(None).cast("int")
    itself = F.struct("item_id", *own, *ranks, no_rank.alias("cooccurrence_rank"))
    theirs = F.transform("partners", lambda x: F.struct(x["item_id"].alias("item_id"), *[x[c].alias(c) for c in own], *[no_rank.alias(r) for r in ranks], x["cooccurrence_rank"].alias("cooccurrence_rank")))
    rows = met.select("customer_id", F.explode(F.concat(F.array(itself), F.coalesce(theirs, F.array().cast(met.select(F.array(itself)).schema[0].dataType)))).alias("x")).select("customer_id", "x.*")
    least = rows.groupBy("customer_id", "item_id", *own).agg(*[F.min(r).alias(r) for r in (*ranks, "cooccurrence_rank")])
    from_source = {f: (F.col(r).isNotNull() if (r := f"{s}_rank") in least.columns else F.lit(False)) for s, f in SOURCE_FLAGS.items()}
    rank = lambda r: F.coalesce(r, F.lit(ABSENT_RANK)) if r in least.columns else F.lit(ABSENT_RANK)
    return least.select(
        "customer_id", "item_id", *own,
        *[p.cast("byte").alias(f) for f, p in from_source.items()],
        sum((p.cast("int") for p in from_source.values()), F.lit(0)).alias("n_candidate_sources"),
        *[rank(r).cast("int").alias(r) for r in RANKS],
    )


def cooccurrence_candidates(
    hist: DataFrame,
    active: DataFrame,
    anchor_top_k: int = 20,
    co_top_k: int = 10,
    max_bill_items: int = 30,
    source: str | None = "cooccurrence",
    frequent: DataFrame | None = None,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """Items bought along with a customer's most frequent ones; a pair may come by several.

    ``frequent``, if given, holds the ``anchor_top_k`` items of each customer; else
    they are taken from ``hist``. Lines of bills are needed of ``hist``, not cells;
    ``pairs``, if given, are :func:`cooccurrence_pairs` of all these items or more.
    """
    if frequent is None:
        frequent = frequent_items(hist, active, anchor_top_k, "anchor_rank")
    own = frequent.select("customer_id", F.col("item_id").alias("anchor_item_id"))
    if pairs is None:
        pairs = cooccurrence_pairs(hist, own.select("anchor_item_id").distinct(), co_top_k, max_bill_items)
    return _named(own.join(pairs, "anchor_item_id").select("customer_id", "item_id", "cooccurrence_rank"), source)


def merge_candidates(sources: list[DataFrame]) -> DataFrame:
    """One row for each customer and item: flags, number of sources, least ranks.

    Sources without a name, or with one of their own, count as one source.
    """
    padded = []
    for df in sources:
        df = df if "candidate_source" in df.columns else df.withColumn("candidate_source", F.lit("unknown"))
        padded.append(df.withColumns({r: F.lit(None).cast("int") for r in RANKS if r not in df.columns}))
    rows = reduce(DataFrame.unionByName, padded)
    has = lambda s: F.max((F.col("candidate_source") == s).cast("byte"))
    other = F.max((~F.col("candidate_source").isin(*SOURCE_FLAGS)).cast("byte"))
    return rows.groupBy("customer_id", "item_id").agg(
        *[has(s).alias(f) for s, f in SOURCE_FLAGS.items()],
        sum((has(s).cast("int") for s in SOURCE_FLAGS), other.cast("int")).alias("n_candidate_sources"),
        *[F.coalesce(F.min(r), F.lit(ABSENT_RANK)).cast("int").alias(r) for r in RANKS],
    )


def build_candidates(
    hist: DataFrame,
    items: DataFrame,
    active: DataFrame,
    *,
    recent_top_k: int = 20,
    frequent_top_k: int = 12,
    popular_top_k: int = 0,
    category_col: str = "category_l2",
    user_top_categories: int = 0,
    items_per_category: int = 0,
    user_top_locations: int = 0,
    items_per_location: int = 0,
    include_cooccurrence: bool = True,
    anchor_top_k: int = 12,
    co_top_k: int = 8,
    max_bill_items: int = 20,
    co_hist: DataFrame | None = None,
    co_pairs: DataFrame | None = None,
    cut: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Merged candidates; sources without a size are left out. Co-purchases may come
    from a history of their own, ``co_hist``, or from pairs at hand, ``co_pairs``.

    ``cut`` is applied to what several sources start from: active customers, cells
    and frequent items. Where it writes them, the history is read three times in all.
    """
    active, cells = cut(active), cut(purchase_cells(hist))
    frequent = cut(frequent_items(cells, active, frequent_top_k, "frequent_rank"))
    sources = [recent_candidates(cells, active, recent_top_k), _named(frequent, "frequent")]
    if popular_top_k > 0:
        sources.append(popular_candidates(cells, active, popular_top_k))
    if user_top_categories > 0 and items_per_category > 0:
        sources.append(category_popular_candidates(cells, items, active, category_col, user_top_categories, items_per_category))
    if user_top_locations > 0 and items_per_location > 0:
        sources.append(location_popular_candidates(cells, active, user_top_locations, items_per_location))
    if include_cooccurrence:
        same = frequent if co_hist is None and anchor_top_k == frequent_top_k else None
        sources.append(cooccurrence_candidates(hist if co_hist is None else co_hist, active, anchor_top_k, co_top_k, max_bill_items, frequent=same, pairs=co_pairs))
    return merge_candidates(sources)

"""Thirteen feature tables of a history, and their assembly for candidate pairs.

All are aggregations of transactions up to ``max_date``, the history's last date
if not given. "Within 30 days" takes both ends, so 31 calendar days.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import days_between, mean, n_set, nearest_quantile, rate, ratio, total, within_days
from tillroll.operators.candidates import n_lines, purchase_cells
from tillroll.sources import materialise_all, sink_dataset

#: Item columns that have customer features, and the prefix of each.
TAXONOMY = {"category_l1": "ul1", "category_l2": "ul2", "category_l3": "ul3", "category": "uc", "brand": "ub", "manufacturer": "uman"}
#: Interval of a pair bought on one bill only, and recency of one never bought.
NEVER = 9999


def max_date_of(hist: DataFrame) -> Column:
    """The history's last date as a literal."""
    return F.lit(hist.agg(F.max("date")).first()[0])


def discount_rate() -> Column:
    price = F.col("price").cast("double")
    return F.when(price > 0, F.try_divide(F.col("discount").cast("double"), price)).otherwise(F.lit(0.0))


def make_item_meta(items: DataFrame) -> DataFrame:
    kept = ["category_l1", "category_l2", "category_l3", "category", "brand", "manufacturer", "sale_status", "size"]
    return items.select("item_id", F.col("price").cast("double").alias("item_catalog_price"), *kept)


def _when(p: Column, c: str) -> Column:
    return F.when(p, F.col(c))


def make_user_features(hist: DataFrame, max_date: Column) -> DataFrame:
    """Of each customer; distinct values by sets, which a customer's lines bound."""
    in30, in60 = within_days(max_date, 30), within_days(max_date, 60)
    rows = hist.withColumns({"line_value": F.col("price") * F.col("quantity"), "discount_rate": discount_rate()})
    user = rows.groupBy("customer_id").agg(
        F.count("*").alias("user_n_transactions"),
        n_set("bill_id").alias("user_n_bills"),
        n_set("item_id").alias("user_n_unique_items"),
        total("quantity").alias("user_total_quantity"),
        n_set("date").alias("user_n_active_days"),
        days_between(F.max("date"), max_date).alias("user_days_since_last_bill"),
        (n_set("location") + F.max(F.col("location").isNull().cast("long"))).alias("user_n_locations"),
        mean("price").alias("user_avg_price"),
        F.median(F.col("price").cast("double")).alias("user_median_price"),
        nearest_quantile("price", 0.25).cast("double").alias("user_price_p25"),
        nearest_quantile("price", 0.75).cast("double").alias("user_price_p75"),
        mean("discount").alias("user_avg_discount"),
        mean("discount_rate").alias("user_avg_discount_rate"),
        rate(F.col("discount") > 0).alias("user_discount_positive_rate"),
        total("line_value").cast("double").alias("user_total_spend"),
        mean("line_value").alias("user_avg_line_value"),
        F.count(_when(in30, "item_id")).alias("user_n_transactions_30d"),
        F.count(_when(in60, "item_id")).alias("user_n_transactions_60d"),
        n_set(_when(in30, "bill_id")).alias("user_n_bills_30d"),
        n_set(_when(in60, "bill_id")).alias("user_n_bills_60d"),
        n_set(_when(in30, "item_id")).alias("user_n_unique_items_30d"),
        n_set(_when(in60, "item_id")).alias("user_n_unique_items_60d"),
    )
    per_bill = {"user_avg_items_per_bill": "user_n_transactions", "user_avg_quantity_per_bill": "user_total_quantity", "user_avg_bill_value": "user_total_spend"}
    return user.withColumns({name: F.try_divide(F.col(c).cast("double"), F.col("user_n_bills")) for name, c in per_bill.items()})


def purchase_pairs(hist: DataFrame, max_date: Column, n_bills: Callable[[str], Column] = n_set) -> DataFrame:
    """Lines of each customer and item: what item and pair features are made of. ``n_bills`` counts distinct
    bills: ``F.count_distinct`` is better for lines that lie by customer, as it needs no sets."""
    sums = {"price": F.col("price"), "discount": F.col("discount"), "rate": discount_rate(), "on_sale": (F.col("discount") > 0).cast("int")}
    return hist.groupBy("customer_id", "item_id").agg(
        F.count("*").alias("n"),
        n_bills("bill_id").alias("bills"),
        total("quantity").alias("q"),
        *[F.sum(c).alias(f"s_{k}") for k, c in sums.items()],
        *[F.count(c).alias(f"c_{k}") for k, c in sums.items()],
        F.min("date").alias("first"),
        F.max("date").alias("last"),
        F.count_if(within_days(max_date, 30)).alias("n30"),
        F.count_if(within_days(max_date, 60)).alias("n60"),
    )


def bill_items(hist: DataFrame) -> DataFrame:
    """Lines of each customer, bill and item: what basket features are made of."""
    return hist.groupBy("customer_id", "bill_id", "item_id").agg(F.count("*").alias("n"), total("quantity").alias("q"), total(F.col("price") * F.col("quantity")).alias("value"))


def make_item_features(hist: DataFrame, meta: DataFrame, max_date: Column, pairs: DataFrame | None = None, baskets: DataFrame | None = None, n_bills: bool = True) -> DataFrame:
    """Of each item: by customer first, so that a popular item's customers and lines
    are reduced before they meet. ``pairs`` and ``baskets`` as made of ``hist``, if at hand;
    without ``n_bills`` its column, a pass over the lines, is left out."""
    each = purchase_pairs(hist, max_date) if pairs is None else pairs
    average = lambda k: F.try_divide(F.sum(f"s_{k}").cast("double"), F.sum(f"c_{k}"))
    item = each.groupBy("item_id").agg(
        F.sum("n").alias("item_n_transactions"),
        F.count("*").alias("item_n_customers"),
        F.sum("q").alias("item_total_quantity"),
        average("price").alias("item_avg_price"),
        average("discount").alias("item_avg_discount"),
        average("rate").alias("item_avg_discount_rate"),
        average("on_sale").alias("item_discount_positive_rate"),
        days_between(F.max("last"), max_date).alias("item_days_since_last_seen"),
        days_between(F.min("first"), max_date).alias("item_days_since_first_seen"),
        F.count_if(F.col("n30") > 0).alias("item_n_customers_30d"),
        F.count_if(F.col("n60") > 0).alias("item_n_customers_60d"),
        F.sum("n30").alias("item_n_transactions_30d"),
        F.sum("n60").alias("item_n_transactions_60d"),
    )
    if n_bills:
        bills = (hist if baskets is None else baskets).groupBy("item_id").agg(F.count_distinct("bill_id").alias("item_n_bills"))
        item = item.join(bills, "item_id")
    whole = item.where(F.col("item_id").isNotNull()).join(meta, "item_id", "left")
    return whole.withColumns({f"item_transaction_share_{d}d": ratio(f"item_n_transactions_{d}d", "item_n_transactions") for d in (30, 60)})


def make_user_item_features(hist: DataFrame, max_date: Column, pairs: DataFrame | None = None) -> DataFrame:
    """Of each customer and item, with the interval of repeats and how due the next is."""
    pairs = purchase_pairs(hist, max_date) if pairs is None else pairs
    named = {"n": "ui_n_transactions", "bills": "ui_n_bills", "q": "ui_total_quantity", "last": "ui_last_date", "first": "ui_first_date", "n30": "ui_n_transactions_30d", "n60": "ui_n_transactions_60d"}
    pair = pairs.select("customer_id", "item_id", *[F.col(c).alias(name) for c, name in named.items()])
    pair = pair.withColumns({"ui_recency_days": days_between("ui_last_date", max_date), "ui_purchase_span_days": days_between("ui_first_date", "ui_last_date")})
    interval = F.when(F.col("ui_n_bills") > 1, F.col("ui_purchase_span_days").cast("double") / (F.col("ui_n_bills") - 1).cast("double"))
    pair = pair.withColumn("ui_avg_repeat_interval_days", F.coalesce(interval, F.lit(float(NEVER))))
    due = F.when(F.col("ui_avg_repeat_interval_days") > 0, F.col("ui_recency_days").cast("double") / F.col("ui_avg_repeat_interval_days"))
    return pair.withColumn("ui_repeat_due_ratio", F.coalesce(due, F.lit(0.0)))


def _taxonomy_aggregates(prefix: str, max_date: Column) -> list[Column]:
    return [
        F.count("*").alias(f"{prefix}_n_transactions"),
        n_set("bill_id").alias(f"{prefix}_n_bills"),
        total("quantity").alias(f"{prefix}_total_quantity"),
        F.count(_when(within_days(max_date, 30), "item_id")).alias(f"{prefix}_n_transactions_30d"),
        days_between(F.max("date"), max_date).alias(f"{prefix}_recency_days"),
    ]


def make_user_taxonomy_features(hist: DataFrame, meta: DataFrame, column: str, prefix: str, max_date: Column) -> DataFrame:
    """Of each customer and value of an item column; items without a value are left out. Lines may have the column."""
    known = hist.where(F.col(column).isNotNull()) if column in hist.columns else hist.join(meta.where(F.col(column).isNotNull()).select("item_id", column), "item_id")
    return known.groupBy("customer_id", column).agg(*_taxonomy_aggregates(prefix, max_date))


def make_taxonomy_table(hist: DataFrame, meta: DataFrame, max_date: Column) -> DataFrame:
    """Those of all item columns in one pass over the lines: a grouping set for each, ``kind`` its column."""
    known = hist.join(meta.select("item_id", *TAXONOMY), "item_id")
    sets = [["customer_id", c] for c in TAXONOMY]
    grouped = known.groupingSets(sets, "customer_id", *TAXONOMY).agg(*[F.grouping(c).alias(f"__{c}") for c in TAXONOMY], *_taxonomy_aggregates("t", max_date))
    kind = F.coalesce(*[F.when(F.col(f"__{c}") == 0, F.lit(c)) for c in TAXONOMY])
    value = F.coalesce(*[F.when(F.col(f"__{c}") == 0, F.col(c)) for c in TAXONOMY])
    return grouped.withColumns({"kind": kind, "value": value}).where("value IS NOT NULL").drop(*TAXONOMY, *[f"__{c}" for c in TAXONOMY])


def taxonomy_of(table: DataFrame, column: str, prefix: str) -> DataFrame:
    """One column's features from :func:`make_taxonomy_table`'s."""
    named = [F.col(c).alias(f"{prefix}{c.removeprefix('t')}") for c in table.columns if c.startswith("t_")]
    return table.where(F.col("kind") == column).select("customer_id", F.col("value").alias(column), *named)


def make_user_basket_features(hist: DataFrame, baskets: DataFrame | None = None) -> DataFrame:
    """Averages over a customer's bills."""
    baskets = bill_items(hist) if baskets is None else baskets
    bills = baskets.groupBy("customer_id", "bill_id").agg(F.sum("n").alias("lines"), F.count("item_id").alias("items"), F.sum("q").alias("quantity"), F.sum("value").alias("value"))
    named = {"lines": "user_avg_bill_lines", "items": "user_avg_bill_items", "quantity": "user_avg_bill_quantity", "value": "user_avg_bill_value_from_bills"}
    return bills.groupBy("customer_id").agg(*[mean(c).alias(n) for c, n in named.items()])


def make_item_basket_features(hist: DataFrame, baskets: DataFrame | None = None, cut: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Averages of the bills that an item is on, each of its lines counting. ``cut`` is
    applied to the bills: where it writes them, their shuffles go before the lines are read."""
    baskets = bill_items(hist) if baskets is None else baskets
    bills = baskets.groupBy("bill_id").agg(F.count_distinct("item_id").alias("items"), F.sum("value").alias("bill_value"))
    bills = cut(bills)
    lines = baskets.select("bill_id", "item_id", "n").join(bills, "bill_id")
    average = lambda c: F.try_divide(F.sum(F.col(c) * F.col("n")).cast("double"), F.sum("n"))
    return lines.groupBy("item_id").agg(average("items").alias("item_avg_bill_items"), average("bill_value").alias("item_avg_bill_value"))


#: Columns of :func:`make_item_basket_features` and the sum that each is made of.
BASKET_SUMS = {"item_avg_bill_items": "s_items", "item_avg_bill_value": "s_value"}


def item_basket_sums(hist: DataFrame) -> DataFrame:
    """What :func:`make_item_basket_features` divides, by item: those of different bills add up.

    Lines are dealt by bill once; a bill's items, value and lines all come of that.
    """
    lines = hist.select("bill_id", "item_id", (F.col("price") * F.col("quantity")).alias("value")).where(F.col("bill_id").isNotNull()).repartition("bill_id")
    each = lines.groupBy("bill_id", "item_id").agg(F.count("*").alias("n"), total("value").alias("value"))
    bills = each.groupBy("bill_id").agg(F.count("item_id").alias("items"), F.sum("value").alias("bill_value"), F.collect_list(F.struct("item_id", "n")).alias("lines"))
    again = bills.select("items", "bill_value", F.explode("lines").alias("line")).select("items", "bill_value", "line.*")
    return again.groupBy("item_id").agg(F.sum(F.col("items") * F.col("n")).alias("s_items"), F.sum(F.col("bill_value") * F.col("n")).alias("s_value"), F.sum("n").alias("n"))


def item_baskets_of(sums: DataFrame) -> DataFrame:
    """The averages from :func:`item_basket_sums`, of one or several sets of bills; those that there are sums for."""
    average = lambda c: F.try_divide(F.sum(c).cast("double"), F.sum("n"))
    return sums.groupBy("item_id").agg(*[average(s).alias(c) for c, s in BASKET_SUMS.items() if s in sums.columns])


def make_user_main_location(hist: DataFrame) -> DataFrame:
    """The place of most of a customer's lines; ties to the smaller, null last. From lines or cells."""
    counted = hist.groupBy("customer_id", "location").agg(n_lines(hist).alias("n"))
    best = F.max_by("location", F.struct("n", F.coalesce(-F.col("location").cast("long"), F.lit(-(2**62)))))
    return counted.groupBy("customer_id").agg(best.alias("user_main_location"), F.max("n").alias("user_main_location_transactions"))


def make_item_location_features(hist: DataFrame) -> DataFrame:
    """Lines and customers of each item and place. From lines or cells."""
    each = hist.groupBy("item_id", "location", "customer_id").agg(n_lines(hist).alias("n"))
    places = each.groupBy("item_id", "location").agg(F.sum("n").alias("item_location_transactions"), F.count("*").alias("item_location_customers"))
    return places.withColumnRenamed("location", "user_main_location")


def make_feature_sources(hist: DataFrame, items: DataFrame, max_date: Column | None = None, item_n_bills: bool = True) -> dict[str, DataFrame]:
    """The thirteen tables by name, in the order in which they are joined."""
    max_date = max_date_of(hist) if max_date is None else max_date
    meta = make_item_meta(items)
    taxonomy = partial(make_user_taxonomy_features, hist, meta, max_date=max_date)
    return {
        "user": make_user_features(hist, max_date),
        "user_basket": make_user_basket_features(hist),
        "user_main_location": make_user_main_location(hist),
        "item": make_item_features(hist, meta, max_date, n_bills=item_n_bills),
        "item_basket": make_item_basket_features(hist),
        "item_location": make_item_location_features(hist),
        **{f"user_{column}": taxonomy(column=column, prefix=prefix) for column, prefix in TAXONOMY.items()},
        "user_item": make_user_item_features(hist, max_date),
    }


def make_written_sources(hist: DataFrame, items: DataFrame, max_date: Column | None = None, write: Callable[[dict[str, DataFrame]], dict[str, DataFrame]] = materialise_all) -> dict[str, DataFrame]:
    """The thirteen tables, written once from five passes over the lines.

    The passes: customers; customers and items; bills and items; customers, items and
    places; customers and item columns. ``write`` writes named tables and returns them
    read back; joins of what it returns know the tables' sizes.
    """
    max_date = max_date_of(hist) if max_date is None else max_date
    meta = make_item_meta(items)
    passes = write({
        "user": make_user_features(hist, max_date),
        "pairs": purchase_pairs(hist, max_date),
        "baskets": bill_items(hist),
        "cells": purchase_cells(hist),
        "taxonomy": make_taxonomy_table(hist, meta, max_date),
    })
    pairs, baskets, cells = passes["pairs"], passes["baskets"], passes["cells"]
    small = write({
        "user_basket": make_user_basket_features(hist, baskets),
        "user_main_location": make_user_main_location(cells),
        "item": make_item_features(hist, meta, max_date, pairs, baskets),
        "item_basket": make_item_basket_features(hist, baskets),
        "item_location": make_item_location_features(cells),
    })
    taxonomy = {f"user_{column}": taxonomy_of(passes["taxonomy"], column, prefix) for column, prefix in TAXONOMY.items()}
    return {"user": passes["user"], **small, **taxonomy, "user_item": make_user_item_features(hist, max_date, pairs)}


#: The columns on which each table is joined.
JOIN_KEYS = {
    "user": ["customer_id"],
    "user_basket": ["customer_id"],
    "user_main_location": ["customer_id"],
    "item": ["item_id"],
    "item_basket": ["item_id"],
    "item_location": ["item_id", "user_main_location"],
    **{f"user_{column}": ["customer_id", column] for column in TAXONOMY},
    "user_item": ["customer_id", "item_id"],
}


SHARES = ("uc", "ub", "ul1", "ul2", "ul3", "uman")
#: The cross features, and what each is made of.
CROSS = {
    **{f"{p}_transaction_share": (f"{p}_n_transactions", "user_n_transactions") for p in SHARES},
    "item_price_to_user_avg": ("item_avg_price", "user_avg_price"),
    "item_price_user_avg_abs_diff": ("item_avg_price", "user_avg_price"),
    "item_price_in_user_iqr": ("item_avg_price", "user_price_p25", "user_price_p75"),
    "item_user_discount_rate_diff": ("item_avg_discount_rate", "user_avg_discount_rate"),
    "item_main_location_transaction_share": ("item_location_transactions", "item_n_transactions"),
}


def choose_sources(sources: dict[str, DataFrame], columns: Iterable[str]) -> dict[str, DataFrame]:
    """Of the thirteen tables those that ``columns`` of the assembly are made of, with the columns that it takes."""
    need = {x for c in columns for x in (c, *CROSS.get(c, ()))}
    chosen = {}
    for name, keys in reversed(JOIN_KEYS.items()):  # a table's keys may be an earlier one's columns
        if name in sources and (own := [c for c in sources[name].columns if c in need and c not in keys]):
            chosen[name] = sources[name].select(*keys, *own)
            need.update(keys)
    return {name: chosen[name] for name in JOIN_KEYS if name in chosen}


def join_features(dataset: DataFrame, sources: dict[str, DataFrame], columns: Iterable[str] | None = None) -> DataFrame:
    """Left-join the tables to candidate pairs, fill counts and add cross features.

    Customer tables share the dataset's partitioning by customer_id; item tables
    are for Spark to broadcast if they are small. With ``columns`` only those are
    made and returned, and only the tables read that they are made of.
    """
    wide = dataset
    chosen = sources if columns is None else choose_sources(sources, columns)
    for name, keys in JOIN_KEYS.items():
        wide = wide.join(chosen[name], keys, "left") if name in chosen else wide
    there = lambda *names: columns is None or {*names} <= {*wide.columns}
    zero = ["ui_n_transactions", "ui_n_bills", "ui_total_quantity"]
    zero += [f"{p}_{c}" for p in ("uc", "ub") for c in ("n_transactions", "n_bills", "total_quantity")]
    zero += [f"{p}_n_transactions" for p in ("ul1", "ul2", "ul3", "uman")]
    zero += ["ui_n_transactions_30d", "ui_n_transactions_60d", "item_location_transactions", "item_location_customers"]
    filled = {c: F.coalesce(c, F.lit(0)).cast("int") for c in zero if there(c)}
    if there("ui_recency_days"):
        filled["ui_recency_days"] = F.coalesce("ui_recency_days", F.lit(NEVER)).cast("int")
    wide = wide.withColumns(filled) if filled else wide
    price, own = F.col("item_avg_price"), F.col("user_avg_price")
    within = (price >= F.col("user_price_p25")) & (price <= F.col("user_price_p75"))
    cross = {f"{p}_transaction_share": ratio(f"{p}_n_transactions", "user_n_transactions") for p in SHARES} | {
        "item_price_to_user_avg": ratio(price, own),
        "item_price_user_avg_abs_diff": F.coalesce(F.abs(price - own), F.lit(0.0)),
        "item_price_in_user_iqr": F.coalesce(within, F.lit(False)).cast("byte"),
        "item_user_discount_rate_diff": F.coalesce(F.col("item_avg_discount_rate") - F.col("user_avg_discount_rate"), F.lit(0.0)),
        "item_main_location_transaction_share": ratio("item_location_transactions", "item_n_transactions"),
    }
    made = {c: e for c, e in cross.items() if columns is None or c in columns}
    wide = wide.withColumns(made) if made else wide
    return wide if columns is None else wide.select(*columns)


def build_features(hist: DataFrame, dataset: DataFrame, items: DataFrame, max_date: Column | None = None) -> DataFrame:
    return join_features(dataset, make_feature_sources(hist, items, max_date))


def make_cached_feature_sources(hist: DataFrame, items: DataFrame, path: str, max_date: Column | None = None) -> dict[str, DataFrame]:
    """The thirteen tables, written once under ``path``."""
    return make_written_sources(hist, items, max_date, lambda tables: {name: sink_dataset(df, f"{path}/{name}") for name, df in tables.items()})


def build_feature_chunk(dataset: DataFrame, sources: dict[str, DataFrame], chunk: int, n_chunks: int) -> DataFrame:
    """Features of one remainder of customers."""
    return join_features(dataset.where(F.pmod("customer_id", F.lit(n_chunks)) == chunk), sources)


def build_features_chunked(hist: DataFrame, dataset: DataFrame, items: DataFrame, path: str, max_date: Column | None = None) -> DataFrame:
    """Features of all customers as one dataset under ``path``: Spark's partitions by
    customer are the chunks."""
    sources = make_cached_feature_sources(hist, items, f"{path}/sources", max_date)
    return sink_dataset(join_features(dataset.repartition("customer_id"), sources), f"{path}/features")

"""The registered queries once more, as SQL that DuckDB runs on the same tables."""

from __future__ import annotations

TX = """
tx AS (
  SELECT CAST(o.o_custkey AS INT) AS customer_id, CAST(l.l_partkey AS VARCHAR) AS item_id, l.l_orderkey AS bill_id,
         o.o_orderdate AS updated_date, CAST(o.o_orderdate AS DATE) AS "date",
         CAST(month(o.o_orderdate) AS INT) AS "month", CAST(year(o.o_orderdate) AS INT) AS "year",
         CAST(l.l_quantity AS BIGINT) AS quantity, CAST(l.l_extendedprice AS DECIMAL(12,2)) AS price,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_discount AS DECIMAL(4,2)) AS discount,
         CAST(nullif(s.s_nationkey, 24) AS INT) AS location
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
), items AS (
  SELECT CAST(p_partkey AS VARCHAR) AS item_id, CAST(p_retailprice AS DECIMAL(12,2)) AS price, p_type AS category_l1,
         split_part(p_name, ' ', 2) AS category_l2, split_part(p_name, ' ', 1) AS category_l3, p_name AS category,
         CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_brand END AS brand,
         'Mfr#' || CAST(CAST(substr(p_brand, 7) AS INT) % 5 AS VARCHAR) AS manufacturer,
         CAST(p_partkey % 3 AS INT) AS sale_status, CAST(p_size AS VARCHAR) AS size
  FROM part
), hist AS (SELECT * FROM tx WHERE "month" BETWEEN 1 AND 11), label_tx AS (SELECT * FROM tx WHERE "month" = 12),
active AS (SELECT customer_id FROM hist GROUP BY customer_id HAVING count(DISTINCT bill_id) >= 8),
ah AS (SELECT hist.* FROM hist SEMI JOIN active USING (customer_id)),
md AS (SELECT max("date") AS d FROM hist)"""

RECENT = """
recent AS (
  SELECT customer_id, item_id, CAST(r AS INT) AS recent_rank FROM (
    SELECT customer_id, item_id, row_number() OVER (PARTITION BY customer_id ORDER BY max(updated_date) DESC, count(*) DESC, item_id) AS r
    FROM ah GROUP BY ALL) WHERE r <= 15
)"""
RECENT = RECENT.replace("FROM ah GROUP BY ALL", "FROM ah GROUP BY customer_id, item_id")
FREQUENT = """
frequent AS (
  SELECT customer_id, item_id, CAST(r AS INT) AS frequent_rank FROM (
    SELECT customer_id, item_id, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, sum(quantity) DESC, item_id) AS r
    FROM ah GROUP BY customer_id, item_id) WHERE r <= 12
)"""
POPULAR = """
poptop AS (
  SELECT item_id, CAST(row_number() OVER (ORDER BY count(DISTINCT customer_id) DESC, count(*) DESC, item_id) AS INT) AS popular_rank
  FROM hist GROUP BY item_id QUALIFY popular_rank <= 20
), popular AS (SELECT customer_id, item_id, popular_rank FROM active CROSS JOIN poptop)"""
CATEGORY = """
hc AS (SELECT h.*, i.category_l2 FROM hist h JOIN items i USING (item_id) WHERE i.category_l2 IS NOT NULL),
uc AS (
  SELECT customer_id, category_l2, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, category_l2) AS INT) AS user_category_rank
  FROM hc SEMI JOIN active USING (customer_id) GROUP BY customer_id, category_l2 QUALIFY user_category_rank <= 3
), ci AS (
  SELECT category_l2, item_id, CAST(row_number() OVER (PARTITION BY category_l2 ORDER BY count(DISTINCT customer_id) DESC, count(*) DESC, sum(quantity) DESC, item_id) AS INT) AS category_item_rank
  FROM hc GROUP BY category_l2, item_id QUALIFY category_item_rank <= 10
), category AS (SELECT customer_id, item_id, user_category_rank, category_item_rank FROM uc JOIN ci USING (category_l2))"""
LOCATION = """
ul AS (
  SELECT customer_id, location, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, max(updated_date) DESC, location) AS INT) AS user_location_rank
  FROM ah WHERE location IS NOT NULL GROUP BY customer_id, location QUALIFY user_location_rank <= 2
), li AS (
  SELECT location, item_id, CAST(row_number() OVER (PARTITION BY location ORDER BY count(DISTINCT customer_id) DESC, count(*) DESC, sum(quantity) DESC, item_id) AS INT) AS location_item_rank
  FROM hist WHERE location IS NOT NULL GROUP BY location, item_id QUALIFY location_item_rank <= 10
), location AS (SELECT customer_id, item_id, user_location_rank, location_item_rank FROM ul JOIN li USING (location))"""
CO = """
bi AS (SELECT DISTINCT bill_id, item_id FROM hist),
sb AS (SELECT bi.* FROM bi SEMI JOIN (SELECT bill_id FROM bi GROUP BY bill_id HAVING count(*) <= 6) USING (bill_id)),
copairs AS (
  SELECT a.item_id AS anchor_item_id, b.item_id, CAST(count(*) AS BIGINT) AS n_co_bills,
         CAST(row_number() OVER (PARTITION BY a.item_id ORDER BY count(*) DESC, b.item_id) AS INT) AS cooccurrence_rank
  FROM sb a JOIN sb b ON a.bill_id = b.bill_id AND a.item_id <> b.item_id
  WHERE a.item_id IN (SELECT item_id FROM frequent)
  GROUP BY a.item_id, b.item_id QUALIFY cooccurrence_rank <= 8
), co AS (SELECT f.customer_id, p.item_id, p.cooccurrence_rank FROM frequent f JOIN copairs p ON f.item_id = p.anchor_item_id)"""

_RANKS = ["recent_rank", "frequent_rank", "popular_rank", "user_category_rank", "category_item_rank", "user_location_rank", "location_item_rank", "cooccurrence_rank"]
_SOURCES = {"recent": ["recent_rank"], "frequent": ["frequent_rank"], "popular": ["popular_rank"], "category": ["user_category_rank", "category_item_rank"], "location": ["user_location_rank", "location_item_rank"], "co": ["cooccurrence_rank"]}
_FLAGS = {"recent": "is_recent_candidate", "frequent": "is_frequent_candidate", "popular": "is_popular_candidate", "category": "is_category_candidate", "location": "is_location_candidate", "co": "is_cooccurrence_candidate"}


def _merged(sources: list[str], name: str = "merged") -> str:
    parts = [f"SELECT customer_id, item_id, '{s}' AS src, " + ", ".join(r if r in _SOURCES[s] else f"CAST(NULL AS INT) AS {r}" for r in _RANKS) + f" FROM {s}" for s in sources]
    flags = ", ".join(f"CAST(max(CASE WHEN src = '{s}' THEN 1 ELSE 0 END) AS TINYINT) AS {f}" for s, f in _FLAGS.items())
    ranks = ", ".join(f"CAST(coalesce(min({r}), 9999) AS INT) AS {r}" for r in _RANKS)
    return f"{name} AS (SELECT customer_id, item_id, {flags}, CAST(count(DISTINCT src) AS INT) AS n_candidate_sources, {ranks} FROM ({' UNION ALL '.join(parts)}) GROUP BY customer_id, item_id)"


GT = "gt AS (SELECT DISTINCT customer_id, item_id, CAST(1 AS TINYINT) AS target FROM label_tx)"
#: The candidate set of the downstream queries: recent, frequent and co-purchases.
CANDS = ", ".join([RECENT, FREQUENT, CO, _merged(["recent", "frequent", "co"], "cands")])
LABELED = CANDS + ", " + GT + ", labeled AS (SELECT c.*, coalesce(g.target, CAST(0 AS TINYINT)) AS target FROM cands c LEFT JOIN (SELECT * FROM gt) g USING (customer_id, item_id))"


def with_(*parts: str) -> str:
    return "WITH " + ", ".join([TX, *parts]) + "\n"


def _mean(x: str) -> str:
    return f"CAST(sum({x}) AS DOUBLE) / count({x})"


def _near(x: str, q: float) -> str:
    return f"list_sort(list({x}))[1 + CAST(round({q} * (count({x}) - 1)) AS INT)]"


_DR = "(CASE WHEN price > 0 THEN CAST(discount AS DOUBLE) / CAST(price AS DOUBLE) ELSE 0 END)"
_IN = '"date" >= (SELECT d FROM md) - INTERVAL {} DAY'
_IN30, _IN60 = _IN.format(30), _IN.format(60)


def _since(x: str) -> str:
    return f"CAST(date_diff('day', {x}, (SELECT d FROM md)) AS INT)"


USER = f"""
uf AS (
  SELECT customer_id, count(*) AS user_n_transactions, count(DISTINCT bill_id) AS user_n_bills, count(DISTINCT item_id) AS user_n_unique_items,
    CAST(sum(quantity) AS BIGINT) AS user_total_quantity, count(DISTINCT "date") AS user_n_active_days, {_since('max("date")')} AS user_days_since_last_bill,
    count(DISTINCT location) + max(CAST(location IS NULL AS BIGINT)) AS user_n_locations, {_mean('price')} AS user_avg_price,
    median(CAST(price AS DOUBLE)) AS user_median_price, CAST({_near('price', 0.25)} AS DOUBLE) AS user_price_p25, CAST({_near('price', 0.75)} AS DOUBLE) AS user_price_p75,
    {_mean('discount')} AS user_avg_discount, {_mean(_DR)} AS user_avg_discount_rate, CAST(count(*) FILTER (discount > 0) AS DOUBLE) / count(discount) AS user_discount_positive_rate,
    CAST(sum(price * quantity) AS DOUBLE) AS user_total_spend, {_mean('price * quantity')} AS user_avg_line_value,
    count(*) FILTER ({_IN30}) AS user_n_transactions_30d, count(*) FILTER ({_IN60}) AS user_n_transactions_60d,
    count(DISTINCT bill_id) FILTER ({_IN30}) AS user_n_bills_30d, count(DISTINCT bill_id) FILTER ({_IN60}) AS user_n_bills_60d,
    count(DISTINCT item_id) FILTER ({_IN30}) AS user_n_unique_items_30d, count(DISTINCT item_id) FILTER ({_IN60}) AS user_n_unique_items_60d,
    CAST(user_n_transactions AS DOUBLE) / user_n_bills AS user_avg_items_per_bill, CAST(user_total_quantity AS DOUBLE) / user_n_bills AS user_avg_quantity_per_bill,
    user_total_spend / user_n_bills AS user_avg_bill_value
  FROM hist GROUP BY customer_id
)"""
ITEM = f"""
itf AS (
  SELECT h.*, i.item_catalog_price, i.category_l1, i.category_l2, i.category_l3, i.category, i.brand, i.manufacturer, i.sale_status, i.size,
    CAST(item_n_transactions_30d AS DOUBLE) / item_n_transactions AS item_transaction_share_30d, CAST(item_n_transactions_60d AS DOUBLE) / item_n_transactions AS item_transaction_share_60d
  FROM (
    SELECT item_id, count(*) AS item_n_transactions, count(DISTINCT customer_id) AS item_n_customers, count(DISTINCT bill_id) AS item_n_bills,
      CAST(sum(quantity) AS BIGINT) AS item_total_quantity, {_mean('price')} AS item_avg_price, {_mean('discount')} AS item_avg_discount, {_mean(_DR)} AS item_avg_discount_rate,
      CAST(count(*) FILTER (discount > 0) AS DOUBLE) / count(discount) AS item_discount_positive_rate,
      {_since('max("date")')} AS item_days_since_last_seen, {_since('min("date")')} AS item_days_since_first_seen,
      count(DISTINCT customer_id) FILTER ({_IN30}) AS item_n_customers_30d, count(DISTINCT customer_id) FILTER ({_IN60}) AS item_n_customers_60d,
      count(*) FILTER ({_IN30}) AS item_n_transactions_30d, count(*) FILTER ({_IN60}) AS item_n_transactions_60d
    FROM hist GROUP BY item_id) h
  LEFT JOIN (SELECT item_id, CAST(price AS DOUBLE) AS item_catalog_price, category_l1, category_l2, category_l3, category, brand, manufacturer, sale_status, size FROM items) i USING (item_id)
)"""
USER_ITEM = f"""
uif AS (
  SELECT *, CASE WHEN ui_avg_repeat_interval_days > 0 THEN CAST(ui_recency_days AS DOUBLE) / ui_avg_repeat_interval_days ELSE 0 END AS ui_repeat_due_ratio FROM (
    SELECT *, {_since('ui_last_date')} AS ui_recency_days, CAST(date_diff('day', ui_first_date, ui_last_date) AS INT) AS ui_purchase_span_days,
      CASE WHEN ui_n_bills > 1 THEN CAST(date_diff('day', ui_first_date, ui_last_date) AS DOUBLE) / (ui_n_bills - 1) ELSE 9999 END AS ui_avg_repeat_interval_days FROM (
      SELECT customer_id, item_id, count(*) AS ui_n_transactions, count(DISTINCT bill_id) AS ui_n_bills, CAST(sum(quantity) AS BIGINT) AS ui_total_quantity,
        max("date") AS ui_last_date, min("date") AS ui_first_date, count(*) FILTER ({_IN30}) AS ui_n_transactions_30d, count(*) FILTER ({_IN60}) AS ui_n_transactions_60d
      FROM hist GROUP BY customer_id, item_id))
)"""


def taxonomy(column: str, prefix: str) -> str:
    return f"""
{prefix}f AS (
  SELECT customer_id, {column}, count(*) AS {prefix}_n_transactions, count(DISTINCT bill_id) AS {prefix}_n_bills, CAST(sum(quantity) AS BIGINT) AS {prefix}_total_quantity,
    count(*) FILTER ({_IN30}) AS {prefix}_n_transactions_30d, {_since('max("date")')} AS {prefix}_recency_days
  FROM hist JOIN (SELECT item_id, {column} FROM items WHERE {column} IS NOT NULL) USING (item_id) GROUP BY customer_id, {column}
)"""


USER_BASKET = f"""
ubk AS (
  SELECT customer_id, {_mean('lines')} AS user_avg_bill_lines, {_mean('its')} AS user_avg_bill_items, {_mean('q')} AS user_avg_bill_quantity, {_mean('v')} AS user_avg_bill_value_from_bills
  FROM (SELECT customer_id, bill_id, count(*) AS lines, count(DISTINCT item_id) AS its, sum(quantity) AS q, sum(price * quantity) AS v FROM hist GROUP BY customer_id, bill_id) GROUP BY customer_id
)"""
ITEM_BASKET = f"""
ibf AS (
  SELECT item_id, {_mean('its')} AS item_avg_bill_items, {_mean('v')} AS item_avg_bill_value
  FROM hist JOIN (SELECT bill_id, count(DISTINCT item_id) AS its, sum(price * quantity) AS v FROM hist GROUP BY bill_id) USING (bill_id) GROUP BY item_id
)"""
MAIN_LOCATION = """
mlf AS (
  SELECT customer_id, location AS user_main_location, n AS user_main_location_transactions
  FROM (SELECT customer_id, location, count(*) AS n FROM hist GROUP BY customer_id, location)
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, location NULLS LAST) = 1
)"""
ITEM_LOCATION = """
ilf AS (
  SELECT item_id, location AS user_main_location, count(*) AS item_location_transactions, count(DISTINCT customer_id) AS item_location_customers FROM hist GROUP BY item_id, location
)"""
_TAX = {"category_l1": "ul1", "category_l2": "ul2", "category_l3": "ul3", "category": "uc", "brand": "ub", "manufacturer": "uman"}
_ZERO = ["ui_n_transactions", "ui_n_bills", "ui_total_quantity", "uc_n_transactions", "uc_n_bills", "uc_total_quantity", "ub_n_transactions", "ub_n_bills", "ub_total_quantity",
         "ul1_n_transactions", "ul2_n_transactions", "ul3_n_transactions", "uman_n_transactions", "ui_n_transactions_30d", "ui_n_transactions_60d", "item_location_transactions", "item_location_customers"]
JOINED = ", ".join([
    LABELED, USER, ITEM, USER_ITEM, USER_BASKET, ITEM_BASKET, MAIN_LOCATION, ITEM_LOCATION, *[taxonomy(c, p) for c, p in _TAX.items()],
    "wide0 AS (SELECT labeled.*, uf.* EXCLUDE (customer_id), ubk.* EXCLUDE (customer_id), mlf.* EXCLUDE (customer_id), itf.* EXCLUDE (item_id), ibf.* EXCLUDE (item_id), ilf.* EXCLUDE (item_id, user_main_location), "
    + ", ".join(f"{p}f.* EXCLUDE (customer_id, {c})" for c, p in _TAX.items())
    + ", uif.* EXCLUDE (customer_id, item_id) FROM labeled LEFT JOIN uf ON labeled.customer_id = uf.customer_id LEFT JOIN ubk ON labeled.customer_id = ubk.customer_id "
    + "LEFT JOIN mlf ON labeled.customer_id = mlf.customer_id LEFT JOIN itf ON labeled.item_id = itf.item_id LEFT JOIN ibf ON labeled.item_id = ibf.item_id "
    + "LEFT JOIN ilf ON labeled.item_id = ilf.item_id AND mlf.user_main_location = ilf.user_main_location "
    + " ".join(f"LEFT JOIN {p}f ON labeled.customer_id = {p}f.customer_id AND itf.{c} = {p}f.{c}" for c, p in _TAX.items())
    + " LEFT JOIN uif ON labeled.customer_id = uif.customer_id AND labeled.item_id = uif.item_id)",
    "wide1 AS (SELECT * REPLACE (" + ", ".join(f"CAST(coalesce({c}, 0) AS INT) AS {c}" for c in _ZERO) + ", CAST(coalesce(ui_recency_days, 9999) AS INT) AS ui_recency_days) FROM wide0)",
    "wide AS (SELECT *, " + ", ".join(f"coalesce(CAST({p}_n_transactions AS DOUBLE) / user_n_transactions, 0) AS {p}_transaction_share" for p in _TAX.values())
    + ", coalesce(item_avg_price / user_avg_price, 0) AS item_price_to_user_avg, coalesce(abs(item_avg_price - user_avg_price), 0) AS item_price_user_avg_abs_diff"
    + ", CAST(coalesce(item_avg_price >= user_price_p25 AND item_avg_price <= user_price_p75, false) AS TINYINT) AS item_price_in_user_iqr"
    + ", coalesce(item_avg_discount_rate - user_avg_discount_rate, 0) AS item_user_discount_rate_diff"
    + ", coalesce(CAST(item_location_transactions AS DOUBLE) / item_n_transactions, 0) AS item_main_location_transaction_share FROM wide1)",
])

#: Formula scores, adjusted, and the ten best.
SCORED = "scored AS (SELECT customer_id, item_id, target, CAST(1 AS DOUBLE) / (recent_rank + 1) + CAST(0.5 AS DOUBLE) / (frequent_rank + 1) + CAST(0.25 AS DOUBLE) / (cooccurrence_rank + 1) AS score FROM labeled)"
TOPK = SCORED + ", topk AS (SELECT customer_id, item_id, target, score, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY score DESC, item_id) AS INT) AS rank FROM scored QUALIFY rank <= 10)"
USERS = "users AS (SELECT DISTINCT customer_id FROM hist)"
FALLBACK_RECENT = """
fr AS (
  SELECT customer_id, item_id, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY max(updated_date) DESC, count(*) DESC, item_id) AS INT) AS position
  FROM hist ANTI JOIN active USING (customer_id) GROUP BY customer_id, item_id QUALIFY position <= 4
)"""
FALLBACK_POPULAR = """
fp AS (
  SELECT item_id, CAST(r - 3 AS INT) AS position FROM (
    SELECT item_id, row_number() OVER (ORDER BY count(DISTINCT customer_id) DESC, count(*) DESC, item_id) AS r FROM hist GROUP BY item_id) WHERE r BETWEEN 4 AND 18
)"""


def submission(rotate: bool, name: str = "sub") -> str:
    place = "((fp.position - 1 - u.customer_id) % 15 + 15) % 15" if rotate else "fp.position"
    return f"""
{name} AS (
  SELECT customer_id, item_id, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY tier, position, item_id) AS INT) AS place FROM (
    SELECT customer_id, item_id, tier, position FROM (
      SELECT customer_id, item_id, 1 AS tier, rank AS position FROM topk
      UNION ALL SELECT customer_id, item_id, 2, position FROM fr
      UNION ALL SELECT u.customer_id, fp.item_id, 3, {place} FROM users u CROSS JOIN fp)
    QUALIFY row_number() OVER (PARTITION BY customer_id, item_id ORDER BY tier, position) = 1)
  QUALIFY place <= 10
)"""


SUB = ", ".join([LABELED, TOPK, USERS, FALLBACK_RECENT, FALLBACK_POPULAR, submission(False), submission(True, "rot")])
LISTS = "SELECT customer_id, string_agg(item_id, ',' ORDER BY place) AS items FROM {} GROUP BY customer_id"
BLEND = """
blocked AS (SELECT item_id FROM rot GROUP BY item_id ORDER BY count(*) DESC, item_id LIMIT 5),
kept AS (SELECT customer_id, item_id, place FROM sub WHERE place <= 7),
fresh AS (SELECT customer_id, item_id, place, row_number() OVER (PARTITION BY customer_id ORDER BY place) AS n FROM rot ANTI JOIN kept USING (customer_id, item_id) WHERE item_id NOT IN (SELECT item_id FROM blocked)),
tiers AS (
  SELECT customer_id, item_id, 1 AS tier, place FROM kept
  UNION ALL SELECT customer_id, item_id, 2, place FROM fresh WHERE n <= 2
  UNION ALL SELECT customer_id, item_id, 3, place FROM sub UNION ALL SELECT customer_id, item_id, 4, place FROM rot
), firsts AS (SELECT customer_id, item_id, tier, place FROM tiers QUALIFY row_number() OVER (PARTITION BY customer_id, item_id ORDER BY tier, place) = 1),
blend AS (SELECT customer_id, item_id, spot AS place FROM (SELECT customer_id, item_id, row_number() OVER (PARTITION BY customer_id ORDER BY tier, place) AS spot FROM firsts) WHERE spot <= 10)"""

_COUNTS = "cc AS (SELECT customer_id, count(*) AS n, sum(target) AS hits FROM labeled GROUP BY customer_id), gu AS (SELECT customer_id, count(*) AS t FROM gt GROUP BY customer_id), ju AS (SELECT gu.customer_id, t, coalesce(n, 0) AS n, coalesce(hits, 0) AS hits, CAST(coalesce(hits, 0) AS DOUBLE) / t AS recall FROM gu LEFT JOIN cc USING (customer_id))"
_SIZES = 'count(*) AS users, CAST(min(n) AS BIGINT) AS "min", CAST(sum(n) AS DOUBLE) / count(n) AS mean, CAST(max(n) AS BIGINT) AS "max", CAST(median(n) AS DOUBLE) AS median, ' + ", ".join(f"CAST({_near('n', q)} AS BIGINT) AS {name}" for name, q in (("p75", 0.75), ("p90", 0.9), ("p95", 0.95)))


def rounded(names: list[str], table: str, places: int = 8) -> str:
    """Means of inexact values depend on the order of their terms: they are rounded."""
    return f"SELECT * REPLACE ({', '.join(f'round({n}, {places}) AS {n}' for n in names)}) FROM {table}"


_MAPPED = "cat AS (" + " UNION ALL ".join(f"SELECT DISTINCT '{c}' AS \"column\", coalesce(CAST({c} AS VARCHAR), 'unknown') AS value FROM wide" for c in [*_TAX, "size"]) + "), codes AS (SELECT \"column\", value, CAST(CASE WHEN value = 'unknown' THEN 0 ELSE row_number() OVER (PARTITION BY \"column\" ORDER BY value) END AS INT) AS code FROM cat)"

#: Columns of the registered matrix.
MATRIX_NUMERIC = ["item_avg_bill_items", "ui_recency_days", "ui_repeat_due_ratio", "item_avg_price", "ub_recency_days", "user_median_price", "ul1_transaction_share", "user_main_location", "sale_status"]
MATRIX_CAT = ["category_l1", "brand", "manufacturer"]
_MATRIX = "SELECT customer_id, item_id, target, " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in MATRIX_NUMERIC) + ", " + ", ".join(f"coalesce((SELECT code FROM codes WHERE \"column\" = '{c}' AND value = coalesce(CAST(w.{c} AS VARCHAR), 'unknown')), 0) AS {c}" for c in MATRIX_CAT) + " FROM wide w"

SQL: dict[str, str] = {
    "basic_stats": with_() + 'SELECT count(*) AS n_rows, count(DISTINCT customer_id) AS n_customers, count(DISTINCT item_id) AS n_items, count(DISTINCT bill_id) AS n_bills, min("date") AS min_date, max("date") AS max_date FROM tx',
    "month_stats": with_() + 'SELECT "month", count(*) AS n_rows, count(DISTINCT customer_id) AS n_customers, count(DISTINCT item_id) AS n_items, count(DISTINCT bill_id) AS n_bills, count(DISTINCT "date") AS n_days FROM tx GROUP BY "month"',
    "basket_stats": with_() + f"SELECT {_mean('n')} AS avg_basket_size, CAST(max(n) AS BIGINT) AS max_basket_size, CAST(median(n) AS DOUBLE) AS median_basket_size, CAST({_near('n', 0.95)} AS BIGINT) AS p95_basket_size FROM (SELECT bill_id, count(DISTINCT item_id) AS n FROM hist GROUP BY bill_id)",
    "customer_stats": with_() + f"SELECT {_mean('n')} AS avg_bills, CAST(median(n) AS DOUBLE) AS median_bills, CAST({_near('n', 0.95)} AS BIGINT) AS p95_bills FROM (SELECT customer_id, count(DISTINCT bill_id) AS n FROM hist GROUP BY customer_id)",
    "top_item_popularity": with_() + "SELECT item_id, count(*) AS n_transactions, count(DISTINCT customer_id) AS n_customers, CAST(sum(quantity) AS BIGINT) AS total_quantity FROM hist GROUP BY item_id ORDER BY n_transactions DESC, item_id LIMIT 20",
    "repeat_stats": with_() + "SELECT item_id, CAST(count(*) FILTER (n > 1) AS DOUBLE) / count(*) AS repeat_rate FROM (SELECT customer_id, item_id, count(DISTINCT bill_id) AS n FROM hist GROUP BY customer_id, item_id) GROUP BY item_id ORDER BY repeat_rate DESC, item_id LIMIT 20",
    "active_users": with_() + "SELECT customer_id FROM active",
    "user_chunk": with_() + "SELECT customer_id FROM active WHERE customer_id % 16 = 3",
    "recent_candidates": with_(RECENT) + "SELECT *, 'recent' AS candidate_source FROM recent",
    "frequent_candidates": with_(FREQUENT) + "SELECT *, 'frequent' AS candidate_source FROM frequent",
    "popular_candidates": with_(POPULAR) + "SELECT *, 'popular' AS candidate_source FROM popular",
    "category_candidates": with_(CATEGORY) + "SELECT *, 'category_popular' AS candidate_source FROM category",
    "location_candidates": with_(LOCATION) + "SELECT *, 'location_popular' AS candidate_source FROM location",
    "cooccurrence_pairs": with_(FREQUENT, CO) + "SELECT * FROM copairs",
    "cooccurrence_candidates": with_(FREQUENT, CO) + "SELECT *, 'cooccurrence' AS candidate_source FROM co",
    "merged_candidates": with_(RECENT, FREQUENT, POPULAR, CATEGORY, LOCATION, CO, _merged(list(_SOURCES))) + "SELECT * FROM merged",
    "ground_truth": with_(GT) + "SELECT * FROM gt",
    "labeled_dataset": with_(LABELED) + "SELECT * FROM labeled",
    "user_features": with_(USER) + rounded(["user_avg_discount_rate"], "uf"),
    "item_features": with_(ITEM) + rounded(["item_avg_discount_rate"], "itf"),
    "user_item_features": with_(USER_ITEM) + "SELECT * FROM uif",
    **{f"user_{c}_features": with_(taxonomy(c, p)) + f"SELECT * FROM {p}f" for c, p in _TAX.items()},
    "user_basket": with_(USER_BASKET) + "SELECT * FROM ubk",
    "item_basket": with_(ITEM_BASKET) + "SELECT * FROM ibf",
    "user_main_location": with_(MAIN_LOCATION) + "SELECT * FROM mlf",
    "item_location": with_(ITEM_LOCATION) + "SELECT * FROM ilf",
    "joined_features": with_(JOINED) + rounded(["user_avg_discount_rate", "item_avg_discount_rate", "item_user_discount_rate_diff"], "wide"),
    "category_mapping": with_(JOINED, _MAPPED) + 'SELECT "column", value, code FROM codes',
    "model_matrix": with_(JOINED, _MAPPED) + _MATRIX,
    "adjusted_topk": with_(JOINED, "sc AS (SELECT customer_id, item_id, target, CAST(1 AS DOUBLE) / (recent_rank + 1) + CAST(0.5 AS DOUBLE) / (frequent_rank + 1) + CAST(0.25 AS DOUBLE) / (cooccurrence_rank + 1) + CASE WHEN ui_n_transactions > 0 THEN CAST(0.02 AS DOUBLE) ELSE 0 END + CAST(0.015 AS DOUBLE) * least(greatest(uc_transaction_share, 0), 1) + CAST(0.015 AS DOUBLE) * least(greatest(ub_transaction_share, 0), 1) AS score FROM wide)")
    + "SELECT customer_id, item_id, target, round(score, 8) AS score, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY score DESC, item_id) AS INT) AS rank FROM sc QUALIFY rank <= 10",
    "fallback_recent": with_(FALLBACK_RECENT) + "SELECT * FROM fr",
    "fallback_popular": with_(FALLBACK_POPULAR) + "SELECT * FROM fp",
    "missing_users": with_() + "SELECT DISTINCT customer_id FROM hist ANTI JOIN active USING (customer_id)",
    "submission": with_(SUB) + LISTS.format("sub"),
    "submission_rotated": with_(SUB) + LISTS.format("rot"),
    "top_frequent_items": with_(SUB) + "SELECT item_id, count(*) AS n_lists FROM sub GROUP BY item_id ORDER BY n_lists DESC, item_id LIMIT 20",
    "blend": with_(SUB, BLEND) + LISTS.format("blend"),
    "item_concentration": with_(SUB, "li AS (SELECT customer_id, count(*) AS n FROM sub GROUP BY customer_id), ic AS (SELECT item_id, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, item_id) AS r FROM sub GROUP BY item_id)")
    + "SELECT (SELECT count(*) FROM li) AS users, (SELECT CAST(sum(n) AS BIGINT) FROM li) AS slots, (SELECT CAST(min(n) AS INT) FROM li) AS min_length, (SELECT CAST(max(n) AS INT) FROM li) AS max_length, (SELECT CAST(sum(n) AS DOUBLE) / count(*) FROM li) AS mean_length, count(*) AS unique_items, "
    + ", ".join(f"CAST(sum(n) FILTER (r <= {t}) AS DOUBLE) / sum(n) AS share_top_{t}" for t in (1, 5, 10, 20, 50, 100)) + " FROM ic",
    "frequent_first_slots": with_(SUB) + "SELECT item_id, count(*) AS n_lists FROM sub WHERE place = 1 GROUP BY item_id ORDER BY n_lists DESC, item_id LIMIT 8",
    "candidate_recall": with_(LABELED, _COUNTS) + """SELECT (SELECT count(*) FROM labeled) AS candidate_pairs, (SELECT count(*) FROM cc) AS candidate_users, (SELECT CAST(sum(target) AS BIGINT) FROM labeled) AS candidate_hit_pairs,
      (SELECT count(DISTINCT item_id) FROM labeled) AS candidate_items, CAST(sum(t) AS BIGINT) AS gt_pairs, count(*) AS gt_users, count(*) FILTER (hits > 0) AS users_with_hit, CAST(sum(hits) AS BIGINT) AS hit_pairs,
      CAST(sum(least(hits, 10)) AS BIGINT) AS oracle_hits_at_k, count(*) FILTER (n = 0) AS zero_candidate_users, round(sum(recall) / count(recall), 8) AS avg_user_recall, min(recall) AS min_user_recall, max(recall) AS max_user_recall,
      (SELECT count(DISTINCT item_id) FROM gt) AS gt_items, CAST(median(recall) AS DOUBLE) AS median_user_recall, CAST(sum(hits) AS DOUBLE) / sum(t) AS pair_recall, CAST(count(*) FILTER (hits > 0) AS DOUBLE) / count(*) AS user_hit_recall,
      CAST(sum(least(hits, 10)) AS DOUBLE) / (count(*) * 10) AS oracle_precision_at_k FROM ju""",
    "candidate_count_dist": with_(LABELED, _COUNTS) + f"SELECT 'candidate' AS population, {_SIZES} FROM cc UNION ALL SELECT 'label' AS population, {_SIZES} FROM ju",
    "ground_truth_lists": with_(GT) + "SELECT customer_id, string_agg(item_id, ',' ORDER BY item_id) AS items FROM gt GROUP BY customer_id",
    "precision_at_k": with_(LABELED, TOPK) + "SELECT CAST(sum(h) AS DOUBLE) / count(*) / 10 AS precision FROM (SELECT customer_id, sum(target) AS h FROM topk GROUP BY customer_id)",
    "precision_buyers": with_(LABELED, TOPK) + "SELECT CAST(sum(h) AS DOUBLE) / count(*) / 10 AS precision FROM (SELECT customer_id, sum(target) AS h FROM topk SEMI JOIN gt USING (customer_id) GROUP BY customer_id)",
    "server_precision": with_(SUB) + "SELECT (SELECT count(DISTINCT customer_id) FROM gt) AS users, count(*) AS hits, CAST(count(*) AS DOUBLE) / ((SELECT count(DISTINCT customer_id) FROM gt) * 10) * 100 AS precision FROM sub JOIN gt USING (customer_id, item_id)",
    "negative_sample_counts": with_(LABELED) + "SELECT count(*) FILTER (target = 1) AS n_positive, count(*) FILTER (target = 0) AS n_negative, CAST(least(count(*) FILTER (target = 0), 3 * count(*) FILTER (target = 1)) AS BIGINT) AS n_sampled_negative FROM labeled",
    "popularity_weights": with_(JOINED, "pw AS (SELECT customer_id, item_id, target, ln(1 + CAST(coalesce(item_n_customers, 0) AS DOUBLE)) AS v FROM wide)") + "SELECT customer_id, item_id, round(CASE WHEN target = 0 THEN 1 + 0.5 * v / (SELECT max(v) FROM pw) ELSE 1 END, 8) AS weight FROM pw",
}

_DRAWN = """
nb AS (SELECT CAST(greatest(1, ceil(count(*) / 20000.0)) AS BIGINT) AS k FROM labeled),
drawn AS (SELECT l.*, md5('42|' || customer_id || '|' || item_id) AS d, CAST('0x' || substr(md5('43|' || customer_id), 1, 8) AS BIGINT) % k AS b, k FROM labeled l, nb),
placed AS (SELECT *, row_number() OVER (PARTITION BY b, target ORDER BY d) AS n, ceil(count(*) FILTER (target = 1) OVER (PARTITION BY b) * 0.5) AS pos FROM drawn),
taken AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY d) AS s FROM placed WHERE n <= CASE WHEN target = 1 THEN pos ELSE ceil(pos * 3) END)"""
SQL |= {
    "train_matrix": SQL["model_matrix"],
    "valid_matrix": SQL["model_matrix"],
    "inference_matrix": SQL["model_matrix"].replace("SELECT customer_id, item_id, target, coalesce(", "SELECT customer_id, item_id, coalesce("),
    "penalised_topk": SQL["adjusted_topk"].replace(" AS score FROM wide)", " - CAST(0.05 AS DOUBLE) * (ln(1 + CAST(item_n_customers AS DOUBLE)) / (SELECT max(ln(1 + CAST(item_n_customers AS DOUBLE))) FROM wide)) AS score FROM wide)"),
    "training_sample": with_(LABELED, _DRAWN) + "SELECT * EXCLUDE (d, b, k, n, pos, s) FROM taken WHERE s <= ceil(400.0 / k)",
    "stratified_split": with_(LABELED) + "SELECT customer_id, item_id, target, row_number() OVER (PARTITION BY target ORDER BY md5('42|' || customer_id || '|' || item_id)) <= ceil(count(*) OVER (PARTITION BY target) * CAST(0.1 AS DOUBLE)) AS holdout FROM labeled",
}

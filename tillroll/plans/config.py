"""Settings of the pipelines."""

from __future__ import annotations

from dataclasses import dataclass, field

from tillroll.operators.model import TrainConfig

# Features that a model takes if they are there, by importance.
SELECTED_FEATURES = """item_avg_bill_items ui_recency_days category_l1 item_avg_bill_value ui_repeat_due_ratio
item_transaction_share_30d item_discount_positive_rate category_l2 item_avg_price item_avg_discount item_n_customers
item_avg_discount_rate item_n_transactions_30d ub_recency_days brand category_l3 ul3_recency_days ul1_recency_days
category item_total_quantity item_catalog_price ui_avg_repeat_interval_days item_n_customers_30d
user_days_since_last_bill item_transaction_share_60d ul2_recency_days item_n_transactions manufacturer
user_n_active_days ui_total_quantity item_n_customers_60d ui_purchase_span_days user_avg_discount
uman_transaction_share uman_recency_days user_price_p25 is_cooccurrence_candidate item_days_since_first_seen
user_price_p75 ui_n_transactions user_median_price item_n_transactions_60d user_n_unique_items
item_user_discount_rate_diff ui_n_transactions_60d ul1_n_transactions_30d user_discount_positive_rate ul3_n_bills
user_main_location ul1_n_bills item_price_to_user_avg ui_n_bills ul1_transaction_share ub_transaction_share
user_avg_bill_value item_main_location_transaction_share ub_n_transactions ul3_transaction_share
user_n_transactions_60d user_avg_discount_rate user_total_spend user_avg_quantity_per_bill user_total_quantity
ul3_n_transactions_30d ul2_total_quantity user_n_bills_30d ul3_n_transactions user_avg_price user_avg_items_per_bill
uc_transaction_share sale_status uc_n_bills uc_total_quantity item_n_bills ub_n_bills uc_n_transactions
ub_total_quantity user_n_transactions""".split()

# Features that tell an item's popularity, which a model may be kept from.
POPULAR_SIGNAL_FEATURES = """item_n_transactions item_n_customers item_n_bills item_total_quantity item_n_customers_30d
item_n_customers_60d item_n_transactions_30d item_n_transactions_60d item_transaction_share_30d
item_transaction_share_60d item_days_since_first_seen item_main_location_transaction_share is_popular_candidate
popular_rank is_category_candidate category_item_rank is_location_candidate location_item_rank user_location_rank
item_location_transactions item_location_customers""".split()

# Columns that are no features, and those that are categories.
DROP_COLS = ["customer_id", "item_id", "target", "ui_last_date", "ui_first_date", "description"]
CAT_COLS = ["category_l1", "category_l2", "category_l3", "category", "brand", "manufacturer", "size"]


@dataclass(frozen=True)
class Config:
    train_history_months: tuple[int, int] = (1, 10)
    train_label_month: int = 11
    valid_history_months: tuple[int, int] = (1, 11)
    valid_label_month: int = 12
    final_history_months: tuple[int, int] = (1, 12)
    min_bills: int = 2
    train_recent_top_k: int = 20
    recent_top_k: int = 15
    frequent_top_k: int = 12
    popular_top_k: int = 0
    category_col: str = "category_l2"
    user_top_categories: int = 0
    items_per_category: int = 0
    user_top_locations: int = 0
    items_per_location: int = 0
    include_cooccurrence: bool = True
    anchor_top_k: int = 12
    co_top_k: int = 8
    max_bill_items: int = 20
    negative_ratio: float = 3.0
    positive_fraction: float = 1.0
    max_train_rows: int = 3_000_000
    weight_column: str = "item_n_customers"
    weight_alpha: float = 0.0
    repeat_boost: float = 0.02
    affinity_boost: float = 0.015
    popularity_penalty: float = 0.0
    top_k: int = 10
    drop_popular_signals: bool = True
    seed: int = 42
    train: TrainConfig = field(default_factory=TrainConfig)

    @property
    def selected(self) -> list[str]:
        blocked = set(self.blocked)
        return [c for c in SELECTED_FEATURES if c not in blocked]

    @property
    def blocked(self) -> list[str]:
        return POPULAR_SIGNAL_FEATURES if self.drop_popular_signals else []

    def candidate_sizes(self, train: bool = False) -> dict:
        names = ("frequent_top_k", "popular_top_k", "category_col", "user_top_categories", "items_per_category", "user_top_locations", "items_per_location", "include_cooccurrence", "anchor_top_k", "co_top_k", "max_bill_items")
        return {n: getattr(self, n) for n in names} | {"recent_top_k": self.train_recent_top_k if train else self.recent_top_k}

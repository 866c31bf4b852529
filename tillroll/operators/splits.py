"""Time splits of transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Months = tuple[int, int]


def make_time_splits(
    tx: DataFrame,
    train_history_months: Months = (1, 10),
    train_label_month: int = 11,
    valid_history_months: Months = (1, 11),
    valid_label_month: int = 12,
    final_history_months: Months = (1, 12),
) -> dict[str, DataFrame]:
    """Histories and labels by month of the year, of whatever year."""
    month = F.col("month")
    return {
        "train_hist": tx.where(month.between(*train_history_months)),
        "train_label": tx.where(month == train_label_month),
        "valid_hist": tx.where(month.between(*valid_history_months)),
        "valid_label": tx.where(month == valid_label_month),
        "final_hist": tx.where(month.between(*final_history_months)),
        "test_target": tx.where(month == valid_label_month),
    }


def date_range(tx: DataFrame, start: str, end: str) -> DataFrame:
    """Rows from ``start`` up to, not including, ``end``: unlike months, pushed to the scan."""
    when = F.col("updated_date")
    return tx.where((when >= F.lit(start).cast("timestamp_ntz")) & (when < F.lit(end).cast("timestamp_ntz")))

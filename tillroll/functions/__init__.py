"""Column expressions and small plans shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mean(c: str | Column) -> Column:
    """Sum over non-null count as a double: exact for decimals, whatever the order."""
    return F.try_divide(F.sum(col(c)).cast("double"), F.count(col(c)))


def rate(p: Column) -> Column:
    """Share of rows for which ``p`` holds among those where it isn't null."""
    return mean(p.cast("int"))


def total(c: str | Column) -> Column:
    """Sum that is 0 for a group without values."""
    return F.coalesce(F.sum(col(c)), F.lit(0))


def n_set(c: str | Column) -> Column:
    """Distinct non-null values by a set for each group: for groups of bounded size.

    Several of these in one aggregation don't multiply its rows as several distinct
    counts do.
    """
    return F.size(F.collect_set(col(c))).cast("long")


def nearest_quantile(c: str | Column, q: float) -> Column:
    """The value at the place nearest to q (n - 1), for groups of bounded size."""
    values = F.sort_array(F.collect_list(col(c)))
    return F.get(values, F.round(F.lit(q) * (F.size(values) - 1)).cast("int"))


def ratio(x: str | Column, y: str | Column) -> Column:
    """x / y as a double; 0 where it has no value."""
    return F.coalesce(F.try_divide(col(x).cast("double"), col(y).cast("double")), F.lit(0.0))


def days_between(start: str | Column, end: str | Column) -> Column:
    return F.datediff(col(end), col(start))


def within_days(max_date: Column, days: int, date: str | Column = "date") -> Column:
    """Whether a date is at most ``days`` before ``max_date``, both ends included."""
    return col(date) >= F.date_sub(max_date, days)


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str) -> DataFrame:
    """The first k rows of each key with their place from 1; Spark prunes before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(rank, place.cast("int")).where(F.col(rank) <= k)


def top_overall(df: DataFrame, order: list[Column], k: int, rank: str, skip: int = 0) -> DataFrame:
    """The first k rows after ``skip`` with their place from 1; only they meet in one task."""
    first = df.orderBy(*order).limit(skip + k)
    place = F.row_number().over(Window.orderBy(*order)) - skip
    return first.withColumn(rank, place.cast("int")).where(F.col(rank) > 0)


def value_quantiles(df: DataFrame, c: str, quantiles: dict[str, float]) -> DataFrame:
    """One row of nearest quantiles and the median over all rows of ``df``.

    Rows are counted by value first, so that one task sees distinct values only.
    ``quantiles`` maps names to q; the name "median" takes the mean of the middle two.
    """
    counted = df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("v")).agg(F.count("*").alias("c"))
    upto = F.sum("c").over(Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    n = F.sum("c").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    placed = counted.withColumns({"upto": upto, "n": n})
    at = lambda place: F.min(F.when(F.col("upto") > place, F.col("v")))
    found = []
    for name, q in quantiles.items():
        if name.startswith("median"):
            low, high = at(F.floor((F.col("n") - 1) / 2)), at(F.ceil((F.col("n") - 1) / 2))
            found.append(((low.cast("double") + high.cast("double")) / 2).alias(name))
        else:
            found.append(at(F.round(F.lit(q) * (F.col("n") - 1))).alias(name))
    return placed.agg(*found)

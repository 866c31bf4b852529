"""Model matrices: numeric columns filled, categories as codes."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tillroll.sources import materialise

UNKNOWN = "unknown"


def infer_numeric_columns(df: DataFrame, drop: Iterable[str], cat: Iterable[str]) -> list[str]:
    """Columns in the schema's order that are neither dropped nor categories."""
    out = {*drop, *cat}
    return [c for c in df.columns if c not in out]


def infer_feature_columns(df: DataFrame, drop: Iterable[str], cat: Iterable[str], selected: Iterable[str] | None = None) -> tuple[list[str], list[str]]:
    """Numeric columns and categories that there are, of ``selected`` if any are given."""
    drop, cat = list(drop), list(cat)
    chosen = set(selected or [])
    keep = lambda c: not chosen or c in chosen
    return [c for c in infer_numeric_columns(df, drop, cat) if keep(c)], [c for c in cat if c in df.columns and c not in drop and keep(c)]


def inference_selected_features(saved: list[str] | None, configured: list[str] | None) -> list[str] | None:
    """A fitted model's columns go before the configured ones."""
    return saved or configured or None


def assert_no_blocked_features(columns: Iterable[str], blocked: Iterable[str]) -> None:
    found = sorted(set(columns) & set(blocked))
    if found:
        raise ValueError(f"{len(found)} blocked features: {', '.join(found[:20])}")


def build_category_mappings(df: DataFrame, cat: Iterable[str]) -> DataFrame:
    """column, value, code: places from 1 in the sorted values, 0 for unknown.

    Null counts as the value "unknown", whose own place stays unused.
    """
    cat = list(cat)
    if not cat:
        return df.sparkSession.createDataFrame([], "column string, value string, code int")
    # One pass over the rows for all columns; one task sorts a column's distinct values.
    shown = [F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias("value")) for c in cat]
    values = df.select(F.explode(F.array(*shown)).alias("x")).select("x.column", "x.value").distinct()
    place = F.row_number().over(Window.partitionBy("column").orderBy("value"))
    return values.withColumn("code", F.when(F.col("value") == UNKNOWN, 0).otherwise(place).cast("int"))


def encode_categories(df: DataFrame, cat: Iterable[str], mappings: DataFrame) -> DataFrame:
    """Replace each category by its code; values without one get 0."""
    for c in cat:
        codes = mappings.where(F.col("column") == c).select(F.col("value").alias("__value"), F.col("code").alias("__code"))
        keyed = df.withColumn("__value", F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)))
        df = keyed.join(codes, "__value", "left").withColumn(c, F.coalesce("__code", F.lit(0)).cast("int")).drop("__value", "__code")
    return df


def fill_numeric(df: DataFrame, numeric: Iterable[str]) -> DataFrame:
    """Null numbers become 0, in their own type."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    zero = lambda c: F.lit(0).cast("int" if isinstance(kinds[c], T.BooleanType) else kinds[c])
    value = lambda c: F.col(c).cast("int") if isinstance(kinds[c], T.BooleanType) else F.col(c)
    return df.withColumns({c: F.coalesce(value(c), zero(c)) for c in numeric})


@dataclass
class PreprocessSpec:
    """What a model matrix is made of, in the order of its columns."""

    numeric: list[str]
    cat: list[str]
    selected: list[str] | None


def prepare_matrix(df: DataFrame, spec: PreprocessSpec, mappings: DataFrame, ids: list[str]) -> DataFrame:
    """ids, numeric columns, category codes."""
    return fill_numeric(encode_categories(df, spec.cat, mappings), spec.numeric).select(*ids, *spec.numeric, *spec.cat)


def fit_preprocess(df: DataFrame, drop: Iterable[str], cat: Iterable[str], selected: list[str] | None = None, blocked: Iterable[str] = (), seen: DataFrame | None = None) -> tuple[PreprocessSpec, DataFrame]:
    """``seen``, if given, has the categories' values of ``df`` in fewer rows."""
    numeric, kept = infer_feature_columns(df, drop, cat, selected)
    assert_no_blocked_features([*numeric, *kept], blocked)
    return PreprocessSpec(numeric, kept, selected), build_category_mappings(df if seen is None else seen, kept)


def prepare_train_matrix(df: DataFrame, drop: Iterable[str], cat: Iterable[str], selected: list[str] | None = None, blocked: Iterable[str] = (), keep_ids: bool = True, seen: DataFrame | None = None) -> tuple[DataFrame, PreprocessSpec, DataFrame]:
    """Matrix with target, spec and mappings; with the ids, which seeded sampling needs.

    The mappings are written: of known size, they are broadcast, and ``df`` isn't shuffled.
    """
    spec, mappings = fit_preprocess(df, drop, cat, selected, blocked, seen)
    mappings = materialise(mappings)
    return prepare_matrix(df, spec, mappings, ["customer_id", "item_id", "target"] if keep_ids else ["target"]), spec, mappings


def prepare_valid_matrix(df: DataFrame, spec: PreprocessSpec, mappings: DataFrame) -> DataFrame:
    return prepare_matrix(df, spec, mappings, ["customer_id", "item_id", "target"])


def prepare_inference_matrix(df: DataFrame, spec: PreprocessSpec, mappings: DataFrame) -> DataFrame:
    return prepare_matrix(df, spec, mappings, ["customer_id", "item_id"])


def save_preprocess(spec: PreprocessSpec, mappings: DataFrame, path: str) -> None:
    """The spec as one JSON row and the mappings as Parquet, in any store Spark writes."""
    spark = mappings.sparkSession
    spark.createDataFrame([(json.dumps(asdict(spec)),)], "spec string").coalesce(1).write.mode("overwrite").parquet(f"{path}/spec")
    mappings.write.mode("overwrite").parquet(f"{path}/mappings")


def load_preprocess(spark: SparkSession, path: str, selected: list[str] | None = None) -> tuple[PreprocessSpec, DataFrame]:
    """What :func:`save_preprocess` wrote; fails if it was made for another selection."""
    spec = PreprocessSpec(**json.loads(spark.read.parquet(f"{path}/spec").first()["spec"]))
    if selected is not None and set(selected) != set(spec.selected or []):
        raise ValueError("saved preprocessing was made for other features: fit it again")
    return spec, spark.read.parquet(f"{path}/mappings")

"""Shared helpers of the training-data operators."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources import discard, materialise

__all__ = ["ascii_lower", "discard", "hinted", "materialise", "prepare_workers", "read_table", "release", "reserved", "text_remainder"]

#: Rows of one Arrow batch handed to Python: long texts make large batches.
BATCH_ROWS = 512


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def release(*tables: DataFrame) -> None:
    """Delete materialised tables that are done, and let Spark delete the shuffle files
    of the plans that made them.

    It does so when the driver's garbage is collected, which many small jobs in a row
    don't bring about by themselves.
    """
    discard(*tables)
    gc.collect()
    SparkSession.getActiveSession().sparkContext._jvm.System.gc()


#: Rows up to which a counted table is broadcast.
BROADCAST_ROWS = 500_000


def hinted(df: DataFrame) -> DataFrame:
    """Broadcast a materialised table only if it is counted to be small."""
    return F.broadcast(df) if df.limit(max(BROADCAST_ROWS, 0) + 1).count() <= BROADCAST_ROWS else df


def prepare_workers(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch, and send workers this package.

    Executors share no folder with the driver; the package goes as a small archive
    with the session's files, so that workers keep its caches from task to task.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    _sent.add(context.applicationId)
    top = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{top.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(top.rglob("*.py")):
            out.write(file, file.relative_to(top.parent))
    context.addPyFile(str(archive))


_sent: set[str] = set()


def reserved(df: DataFrame, *names: str) -> dict[str, str]:
    """Column names that begin with ``names`` and that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    end = next(e for e in ["", *map(str, range(len(taken) + 1))] if not any(f"__{n}{e}" in taken for n in names))
    return {n: f"__{n}{end}" for n in names}


def text_remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id written as text, modulo ``parts``; null ids give null."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % F.lit(parts)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII texts take the vectorised built-in."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))

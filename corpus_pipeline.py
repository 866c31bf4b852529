"""A training corpus from raw documents: five stages of the operators in llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``docs``, for the rows that they keep.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import materialise, read_table, reserved, text_remainder
from tillroll.llm.decontamination import decontaminate
from tillroll.llm.mixing import mixed_documents
from tillroll.llm.ngram_join import one_of_each
from tillroll.llm.quality import FOLDS, HELD_OUT, LEAST, fit_quality, score_quality
from tillroll.llm.sharding import shard_by_bytes


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality classifier rejects.

    It is fitted on the labelled documents of the whole table, whatever of them
    ``docs`` holds. Null and empty texts are scored as empty ones; repeated rows are
    judged alike; an empty ``docs`` gives no rows.
    """
    use = text_remainder(F.col("doc_id"), FOLDS) != HELD_OUT
    model = fit_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), use)
    own = reserved(docs, "score")["score"]
    scored = score_quality(docs, model, score=own).where(F.col(own) >= LEAST)
    return scored.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: that of the smallest id.

    Null and empty texts and those without words all stay; of rows that agree in id
    and text one stays, of equal ids with other texts that of the smaller hash.
    """
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item.

    Null and empty texts stay, repeated rows go or stay together.
    """
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"), how="documents")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents up to the sources' targets, some of them twice.

    Null sources are a source; null and empty texts and those without words aren't
    taken; repeated rows are taken alike.
    """
    return mixed_documents(docs, ["doc_id"])


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deal documents out to shards of equal bytes.

    Equal texts, null ones among them, share a shard; each row has a slot.
    """
    return shard_by_bytes(docs, ["doc_id"])


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: Classifier and seeded choices have no SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

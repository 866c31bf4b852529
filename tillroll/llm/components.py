"""Connected components of a link table; many links are not gathered anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import materialise, release


#: Counted links that one task joins (16 bytes each): rounds of small jobs cost more,
#: in the driver's memory too.
FEW_LINKS = 500_000


def _of_few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) of all links (u, v) of a task."""
    links = [np.stack([batch.column(k).to_numpy() for k in (0, 1)]) for batch in batches]
    if not links:
        return
    nodes, at = np.unique(np.concatenate(links, axis=1), return_inverse=True)
    u, v = at.reshape(2, -1)
    least = np.arange(len(nodes))
    while True:
        before = least.copy()
        both = np.minimum(least[u], least[v])
        for side in (least[u], least[v], u, v):
            np.minimum.at(least, side, both)
        least = least[least]
        if (least == before).all():
            break
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[least])], names=["node", "component"])


def _to_least(pairs: DataFrame) -> DataFrame:
    """Hang each neighbour of u, and u itself, on the least of them.

    ``pairs``: (u, v). The minima are aggregated before the shuffle; the join back
    can be split where one u has very many neighbours.
    """
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return pairs.join(least, "u")


def connected(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b): component is the least node.

    More than FEW_LINKS links by alternating large-star and small-star rounds until a
    round changes nothing: each moves nodes to smaller ones only, so there is such a round.
    """
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs, before = materialise(pairs), None
    if pairs.limit(max(FEW_LINKS, 0) + 1).count() <= FEW_LINKS:
        found = materialise(pairs.coalesce(1).mapInArrow(_of_few, "node long, component long"))
        release(pairs)
        return found
    while True:
        now = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before, last = now, pairs
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _to_least(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        pairs = materialise(small.where("u <> v").distinct())
        del both, large, small
        release(last)
    node = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    found = materialise(node.unionByName(roots))
    release(pairs)
    return found

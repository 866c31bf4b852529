"""Sharding by Karmarkar-Karp differencing over indivisible groups of equal texts.

A partial partition is a group's bytes on one of the shards and nothing on the
others. The two partial partitions with the largest spread are combined again and
again, the fullest shard of one on the emptiest of the other, until one is left.

Groups are dealt out by hash to chunks of about ``chunk_groups``; each chunk is
partitioned by itself and leaves one partial partition, ``shards`` numbers. Up to
``fan_in`` partial partitions at a time are combined in the same way, level by level
until one is left; each level's moves are a table, and from the last level back
they tell where each chunk's parts ended. A task holds one chunk or ``fan_in``
partial partitions; the driver holds none of them.

A group of copies may be large: its bytes are summed before the shuffle, and its
rows are never gathered: the few groups with more than their share of rows find
their shard by a broadcast table. Slots are numbered by buckets of rows with offsets
from counts, so no shard's rows meet in one task either.

Defined results: equal texts, null texts among them, share a shard; a null text
has no bytes and no crc32; repeated rows each get a slot; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.llm.common import hinted, materialise, prepare_workers, read_table

SHARDS = 24
#: Bytes of a row besides its text.
ROW_BYTES = 8
CHUNK_GROUPS = 20_000
#: Partial partitions that one task combines.
FAN_IN = 512
#: A group of more than one in HOT_SHARE of all rows is told its shard by broadcast:
#: there are fewer than HOT_SHARE such groups.
HOT_SHARE = 1_000
#: Rows of a shard are numbered in this many buckets at least, and more of them
#: where buckets would pass BUCKET_ROWS.
BUCKETS, BUCKET_ROWS = 64, 100_000


def difference(parts: list[np.ndarray], shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Combine partial partitions by Karmarkar-Karp.

    ``parts``: bytes by slot of each. Returns the combined bytes by slot, sorted
    downwards, and for each part the slot of the result that each of its own
    slots went to.
    """
    moves = np.tile(np.arange(shards), (len(parts), 1))
    if not parts:
        return np.zeros(shards, dtype=np.int64), moves
    orders = [np.argsort(-p, kind="stable") for p in parts]
    loads = {k: p[o] for k, (p, o) in enumerate(zip(parts, orders))}
    heap = [(int(v[-1] - v[0]), k) for k, v in loads.items()]
    heapq.heapify(heap)
    merged: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        _, x = heapq.heappop(heap)
        _, y = heapq.heappop(heap)
        both = loads.pop(x) + loads.pop(y)[::-1]
        order = np.argsort(-both, kind="stable")
        node = len(parts) + len(merged)
        merged.append((x, y, order))
        loads[node] = both[order]
        heapq.heappush(heap, (int(loads[node][-1] - loads[node][0]), node))
    # From the last combination back: where each node's slots are in the result.
    root = heap[0][1]
    at = {root: np.arange(shards)}
    for node in range(len(parts) + len(merged) - 1, len(parts) - 1, -1):
        x, y, order = merged[node - len(parts)]
        placed = np.empty(shards, dtype=np.int64)
        placed[order] = at.pop(node)
        at[x], at[y] = placed, placed[::-1]
    for k, order in enumerate(orders):
        moves[k, order] = at[k]
    return loads[root], moves


def _combined(loads: DataFrame, shards: int, fan_in: int) -> tuple[DataFrame, DataFrame]:
    """One level up: the moves (node, part, parent, to) and the loads (node, loads) of the parents."""

    def combine(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node", kind="stable")
        whole, moves = difference([np.array(x, dtype=np.int64) for x in group["loads"]], shards)
        row = lambda node, to, loads: {"node": node, "parent": group["parent"].iloc[0], "to": to, "loads": loads}
        made = [row(n, m.tolist(), None) for n, m in zip(group["node"], moves)]
        return pd.DataFrame([*made, row(-1, None, whole.tolist())], columns=["node", "parent", "to", "loads"])

    parent = F.floor(F.col("node") / F.lit(fan_in)).cast("long")
    done = materialise(loads.withColumn("parent", parent).groupBy("parent").applyInPandas(combine, "node long, parent long, to array<int>, loads array<long>"))
    moves = done.where("to IS NOT NULL").select("node", "parent", F.posexplode("to").alias("part", "to"))
    return moves, done.where("loads IS NOT NULL").select(F.col("parent").alias("node"), "loads")


def shard_by_bytes(docs: DataFrame, keys: list[str], shards: int = SHARDS, text: str = "text", chunk_groups: int = CHUNK_GROUPS, fan_in: int = FAN_IN) -> DataFrame:
    """``keys``, size, text_crc32, shard and slot of each row."""
    prepare_workers(docs.sparkSession)
    content = F.encode(F.col(f"`{text}`"), "UTF-8")
    named = [f"__k{i}" for i in range(len(keys))]
    rows = materialise(docs.select(
        *[F.col(f"`{k}`").alias(n) for k, n in zip(keys, named)],
        (F.coalesce(F.octet_length(f"`{text}`"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"),
        F.coalesce(F.unhex(F.md5(content)), F.lit(b"null")).alias("__group"),
        F.monotonically_increasing_id().alias("__row"),
    ))
    groups = materialise(rows.groupBy("__group").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")))
    chunks = max(1, -(-groups.count() // chunk_groups))
    chunk = F.pmod(F.xxhash64("__group"), F.lit(chunks)).alias("chunk")

    def partition(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["bytes", "__group"], ascending=False, kind="stable")
        parts = list(np.zeros((len(group), shards), dtype=np.int64))
        for part, size in zip(parts, group["bytes"]):
            part[0] = size
        _, moves = difference(parts, shards)
        return pd.DataFrame({"__group": group["__group"], "bytes": group["bytes"], "rows": group["rows"], "chunk": group["chunk"], "part": moves[:, 0] if len(group) else []})

    placed = materialise(groups.select("*", chunk).groupBy("chunk").applyInPandas(partition, "__group binary, bytes long, rows long, chunk long, part int"))
    by_part = placed.groupBy("chunk", "part").agg(F.sum("bytes").alias("bytes"))
    of_chunk = F.map_from_entries(F.collect_list(F.struct("part", "bytes")))
    filled = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda k: F.coalesce(F.try_element_at("found", k), F.lit(0)))
    loads = by_part.groupBy(F.col("chunk").alias("node")).agg(of_chunk.alias("found")).select("node", filled.alias("loads"))
    levels, nodes = [], chunks
    while nodes > 1:
        moves, loads = _combined(loads, shards, fan_in)
        levels.append(moves)
        nodes = -(-nodes // fan_in)
    # From the last level back: the shard of each node's parts.
    where = None
    for moves in reversed(levels):
        up = moves.select("node", "part", "parent", "to")
        if where is None:
            where = up.select("node", "part", F.col("to").alias("shard"))
        else:
            above = where.select(F.col("node").alias("parent"), F.col("part").alias("to"), "shard")
            where = materialise(up.join(hinted(materialise(above)), ["parent", "to"]).select("node", "part", "shard"))
    if where is None:
        found = placed.select("__group", "rows", F.col("part").alias("shard"))
    else:
        where = hinted(materialise(where.select(F.col("node").alias("chunk"), "part", "shard")))
        found = placed.join(where, ["chunk", "part"]).select("__group", "rows", "shard")
    total = rows.count()
    hot = F.broadcast(found.where(F.col("rows") * HOT_SHARE > total).select("__group", "shard"))
    few = found.where(F.col("rows") * HOT_SHARE <= total).select("__group", "shard")
    sharded = rows.join(hot, "__group").unionByName(rows.join(hot, "__group", "left_anti").join(few, "__group"))
    return number_rows(sharded.drop("__group"), "shard", named).select(*[F.col(n).alias(k) for n, k in zip(named, keys)], "size", "text_crc32", "shard", "slot")


def number_rows(df: DataFrame, within: str, keys: list[str]) -> DataFrame:
    """Add slot: gapless from 0 within each value of ``within``.

    Buckets take the row's number in, so that repeated rows are spread too.
    """
    df = materialise(df)
    most = df.groupBy(within).count().agg(F.max("count")).first()[0] or 0
    buckets = max(BUCKETS, -(-most // BUCKET_ROWS))
    rows = df.withColumn("__bucket", F.pmod(F.xxhash64(*keys, "__row"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(within).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(within, "__bucket").agg(F.count("*").alias("__c")).withColumn("__before", F.coalesce(F.sum("__c").over(before), F.lit(0))).drop("__c")
    number = F.row_number().over(Window.partitionBy(within, "__bucket").orderBy(*keys, "size", "text_crc32", "__row"))
    numbered = rows.withColumn("__n", number).join(hinted(materialise(offsets)), [within, "__bucket"])
    return numbered.withColumn("slot", (F.col("__before") + F.col("__n") - 1).cast("long"))


def op10_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_by_bytes(read_table(spark, sf_dir, "documents"), ["doc_id"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

"""Exact top-k search by inner product with one KD-tree per shard.

Vectors are dealt to shards by place: median splits of a bounded sample's widest
side give regions, at most MAX_REGIONS of them, and every vector goes to the region
that it falls in. A region of many vectors, equal ones among them, is several shards
by hash. Each shard's tree splits at medians of the widest side and keeps each
node's tight bounding box. A query visits a tree's nodes best first by the largest
inner product that their boxes allow, and stops where that falls below its k-th
score so far.

Queries are dealt by place too, in blocks. A block meets the regions in the order of
what their boxes allow, some at a time: one, then a few, then more. After each step
the k-th scores found so far are propagated, and a region that can't reach any of a
block's k-th scores is passed over with all its shards, unread.

A task holds one shard and a few blocks, all of bounded size, and no pair of vectors
is ever a row: a shard returns at most k rows for each query. The driver holds the
sample and the regions' boxes.

Components are integers held as doubles. Inner products below 2^53 are exact as
such; shards that could pass that are searched with whole numbers instead.

Defined results: vectors that are null, without id, or hold null or non-finite
components take no part; vectors of different lengths don't meet; a query passes
over rows of its own id; of repeated query rows each is answered, ties go to the
smaller id; fewer candidates than k give fewer rows; scores beyond 64 bits are held
at their ends; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.llm.common import discard, materialise, prepare_workers, read_table

SHARD_ROWS = 16_384
QUERY_BLOCK = 256
#: Blocks that one task searches in a shard.
BLOCKS_AT_ONCE = 32
#: Regions and the sample of vectors that they are made from: they change the cost only.
MAX_REGIONS, SAMPLE_ROWS = 2_048, 20_000
#: Regions that a block meets up to the end of each step; the last step takes the rest.
STEPS = (1, 4, 16, 64)
LEAF = 64
#: Leaves that are scored at once, first; each further turn takes twice as many.
LEAVES_AT_ONCE = 4
_EXACT = 2.0**53


class KdTree:
    """A tree over integer vectors, as arrays that pickle well."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(ids))
        low, high, left, right, first, last = [], [], [], [], [], []

        def node(a: int, b: int) -> int:
            own = points[order[a:b]]
            low.append(own.min(axis=0))
            high.append(own.max(axis=0))
            left.append(-1)
            right.append(-1)
            first.append(a)
            last.append(b)
            return len(low) - 1

        stack = [node(0, len(ids))]
        while stack:
            at = stack.pop()
            a, b = first[at], last[at]
            if b - a <= leaf or not points.shape[1]:
                continue
            axis = int(np.argmax(high[at] - low[at]))
            if high[at][axis] == low[at][axis]:
                continue
            middle = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(points[order[a:b], axis], middle)]
            left[at], right[at] = node(a, a + middle), node(a + middle, b)
            stack += [left[at], right[at]]
        self.ids, self.points = ids[order], points[order]
        self.low, self.high = np.array(low), np.array(high)
        self.left, self.right = left, right
        self.first, self.last = first, last

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, floor: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids and scores of each query's k best, no score below its ``floor``."""
        largest = max(np.abs(self.points).max(initial=0), np.abs(queries).max(initial=0))
        if largest * largest * max(1, queries.shape[1]) >= _EXACT:
            return [self._whole_numbers(q, i, k) for q, i in zip(queries, own)]
        bounds = _bounds(queries, self.low, self.high)
        return [self._best_first(q, i, k, b, f) for q, i, b, f in zip(queries, own, bounds, floor)]

    def _best_first(self, query: np.ndarray, own: int, k: int, bounds: np.ndarray, kth: float) -> tuple[np.ndarray, np.ndarray]:
        heap = [(-bounds[0], 0)]
        ids, scores = np.empty(0, dtype=np.int64), np.empty(0)
        left, right = self.left, self.right
        at_once = LEAVES_AT_ONCE
        while heap:
            leaves = []
            while heap and len(leaves) < at_once:
                bound, at = heapq.heappop(heap)
                if -bound < kth:
                    heap = []
                    break
                if left[at] < 0:
                    leaves.append(at)
                else:
                    for child in (left[at], right[at]):
                        if bounds[child] >= kth:
                            heapq.heappush(heap, (-bounds[child], child))
            if not leaves:
                break
            rows = np.concatenate([np.arange(self.first[n], self.last[n]) for n in leaves])
            found = self.points[rows] @ query
            keep = (found >= kth) & (self.ids[rows] != own)
            ids = np.concatenate([ids, self.ids[rows[keep]]])
            scores = np.concatenate([scores, found[keep]])
            if len(ids) > k:
                best = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[best], scores[best]
            if len(ids) == k:
                kth = max(kth, scores.min())
            at_once *= 2
        return ids, scores

    def _whole_numbers(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        q = [int(x) for x in query]
        found = [(min(max(sum(x * int(y) for x, y in zip(q, p)), -(2**63)), 2**63 - 1), int(i)) for p, i in zip(self.points, self.ids) if i != own]
        best = heapq.nsmallest(k, found, key=lambda f: (-f[0], f[1]))
        return np.array([i for _, i in best], dtype=np.int64), np.array([s for s, _ in best], dtype=object)


def integer_vectors(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 64) -> DataFrame:
    """id, size and v (floor of ``scale`` times each component, as doubles) of sound vectors."""
    v = F.transform(F.col(f"`{embedding}`"), lambda x: x.cast("double"))
    sound = F.col(f"`{vec_id}`").isNotNull() & F.col(f"`{embedding}`").isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.where(sound).select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.size(f"`{embedding}`").alias("size"), F.transform(v, lambda x: x * scale).alias("v"))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.floor(np.stack(column.to_numpy())) if len(column) and len(column.iloc[0]) else np.zeros((len(column), 0))


def _bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Largest inner product of each query with a point of each box."""
    return np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T


class Regions:
    """Median splits of a sample's widest side; a point falls in one leaf."""

    def __init__(self, sample: np.ndarray, regions: int):
        self.axis, self.cut, self.child, self.leaves = [], [], [], 1
        parts = [(-sample.shape[0], 0, sample, None)] if len(sample) and sample.shape[1] else []
        heapq.heapify(parts)
        count = 0
        while parts and self.leaves < regions:
            _, _, own, parent = heapq.heappop(parts)
            axis = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
            cut = float(np.median(own[:, axis]))
            below = own[:, axis] < cut
            if not below.any():  # the median is the least: the others go above
                cut = float(np.nextafter(cut, np.inf))
                below = own[:, axis] < cut
            if below.all():
                continue
            node = len(self.axis)
            self.axis.append(axis)
            self.cut.append(cut)
            # Children are leaves till split: negative numbers.
            if parent is None:
                self.child.append([-1, -2])
            else:
                at, side = parent
                self.child.append([self.child[at][side], -self.leaves - 1])
                self.child[at][side] = node
            self.leaves += 1
            for side, rows in ((0, own[below]), (1, own[~below])):
                count += 1
                heapq.heappush(parts, (-len(rows), count, rows, (node, side)))

    def of(self, points: np.ndarray) -> np.ndarray:
        """Leaf of each point."""
        at = np.full(len(points), 0 if self.axis else -1)
        if self.axis:
            axis, cut, child = np.array(self.axis), np.array(self.cut), np.array(self.child)
            while (inner := at >= 0).any():
                node = at[inner]
                side = (points[np.flatnonzero(inner), axis[node]] >= cut[node]).astype(int)
                at[inner] = child[node, side]
        return -at - 1


_FOUND = "size int, block int, q int, query_id long, vec_id long, score long"


def _search(trees: pd.DataFrame, blocks: pd.DataFrame, k: int) -> pd.DataFrame:
    """Of one shard's tree and some blocks: the rows of _FOUND."""
    made = []
    if len(trees):
        tree = pickle.loads(trees["tree"].iloc[0])
        for row in blocks.itertuples():
            ids, matrix = pickle.loads(row.queries)
            floor = np.full(len(ids), -np.inf) if row.floor is None else np.frombuffer(row.floor, dtype=np.float64)
            for q, (own, (near, scores)) in enumerate(zip(ids, tree.search(matrix, ids, k, floor))):
                made += [(row.size, row.block, q, int(own), int(i), int(s)) for i, s in zip(near, scores)]
    return pd.DataFrame(made, columns=[c.split()[0] for c in _FOUND.split(", ")])


def _placed(vectors: DataFrame, regions: dict[int, Regions]) -> DataFrame:
    """Add region."""
    kinds = {"id": pa.int64(), "size": pa.int32(), "v": pa.list_(pa.float64()), "query": pa.bool_()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).to_numpy(zero_copy_only=False)
            region = np.zeros(len(sizes), dtype=np.int32)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                own = batch.column(2).take(pa.array(rows))
                region[rows] = regions[int(size)].of(np.floor(own.flatten().to_numpy()).reshape(len(rows), int(size)))
            yield pa.RecordBatch.from_arrays([*[batch.column(i).cast(t) for i, t in enumerate(kinds.values())], pa.array(region)], names=[*kinds, "region"])

    return vectors.select(*kinds).mapInArrow(run, "id long, size int, v array<double>, query boolean, region int")


def top_k(vectors: DataFrame, is_query: Column, k: int, shard_rows: int = SHARD_ROWS, query_block: int = QUERY_BLOCK, steps: tuple[int, ...] = STEPS, report: dict | None = None) -> DataFrame:
    """query_id, rank, vec_id, score of the k best of each query.

    ``vectors`` comes from :func:`integer_vectors`; ``is_query`` is over its id.
    ``report`` gets the pairs of blocks and regions, and those that were searched.
    """
    prepare_workers(vectors.sparkSession)
    vectors = materialise(vectors.withColumn("query", is_query))
    counts = {r["size"]: r["n"] for r in vectors.groupBy("size").agg(F.count("*").alias("n")).collect()}  # lengths of vectors are few
    regions = {}
    for size, n in counts.items():
        wanted = min(-(-n // shard_rows), MAX_REGIONS)
        sample = vectors.where(F.col("size") == size).orderBy(F.xxhash64("id")).limit(SAMPLE_ROWS).select("v").toPandas()["v"] if wanted > 1 else pd.Series(dtype=object)
        regions[size] = Regions(_matrix(sample) if len(sample) else np.zeros((0, size)), wanted)
    placed = materialise(_placed(vectors, regions))
    of_region = materialise(placed.groupBy("size", "region").agg(F.count("*").alias("n"), F.count_if("query").alias("q")))
    spread = of_region.select("size", "region", F.ceil(F.col("n") / shard_rows).cast("int").alias("shards"), F.ceil(F.col("q") / query_block).cast("int").alias("blocks"))
    first = F.sum("blocks").over(Window.partitionBy("size").orderBy("region").rowsBetween(Window.unboundedPreceding, -1))
    spread = F.broadcast(spread.withColumn("first", F.coalesce(first, F.lit(0))))  # at most MAX_REGIONS rows a length

    def build(group: pd.DataFrame) -> pd.DataFrame:
        tree = KdTree(group["id"].to_numpy(dtype=np.int64), _matrix(group["v"]))
        one = {c: group[c].iloc[:1].to_numpy() for c in ("size", "region", "shard")}
        return pd.DataFrame(one | {"low": [tree.low[0].tolist()], "high": [tree.high[0].tolist()], "tree": [pickle.dumps(tree)]})

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id", kind="stable")
        return pd.DataFrame({"size": group["size"].iloc[:1], "block": group["block"].iloc[:1], "queries": [pickle.dumps((group["id"].to_numpy(dtype=np.int64), _matrix(group["v"])))]})

    # Rows of one id may be many: their number in the table spreads them.
    dealt = placed.join(spread, ["size", "region"]).withColumn("row", F.monotonically_increasing_id())
    shard = F.pmod(F.xxhash64("row", F.lit(5)), "shards").cast("int")
    block = (F.col("first") + F.pmod(F.xxhash64("row", F.lit(3)), "blocks")).cast("int")
    trees = dealt.withColumn("shard", shard).groupBy("size", "region", "shard").applyInPandas(build, "size int, region int, shard int, low array<double>, high array<double>, tree binary")
    queries = dealt.where("query").withColumn("block", block).groupBy("size", "block").applyInPandas(gather, "size int, block int, queries binary")
    trees, queries = materialise(trees), materialise(queries)
    # A box for each region: at most MAX_REGIONS a length on the driver.
    low = [F.array_agg("low").alias("low"), F.array_agg("high").alias("high")]
    corner = lambda c, pick: F.expr(f"transform(sequence(1, size), d -> {pick}(transform({c}, x -> x[d - 1])))")
    cornered = trees.groupBy("size", "region").agg(*low, F.count("*").alias("shards")).where("size > 0")
    boxes: dict[int, tuple] = {}
    for r in cornered.select("size", "region", "shards", corner("low", "array_min").alias("low"), corner("high", "array_max").alias("high")).orderBy("size", "region").collect():
        boxes.setdefault(r["size"], ([], [], [], []))
        for into, value in zip(boxes[r["size"]], (r["region"], r["shards"], r["low"], r["high"])):
            into.append(value)
    boxes = {size: tuple(np.array(x) for x in columns) for size, columns in boxes.items()}
    if 0 in counts:
        boxes[0] = (np.array([0]), np.array([-(-counts[0] // shard_rows)]), np.zeros((1, 0)), np.zeros((1, 0)))
    meets = "size int, block int, queries binary, floor binary, region int, shard int"

    def meeting(start: int, end: int):
        """Rows (block, shard) of the regions in places ``start`` to ``end`` of a block's
        order that some query's k-th score doesn't rule out."""

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                made = []
                for row in frame.itertuples():
                    region, shards, low, high = boxes[row.size]
                    ids, matrix = pickle.loads(row.queries)
                    floor = np.full(len(ids), -np.inf) if row.floor is None else np.frombuffer(row.floor, dtype=np.float64)
                    bounds = _bounds(matrix, low, high)
                    for at in np.argsort(-bounds.max(axis=0), kind="stable")[start:end]:
                        if (bounds[:, at] >= floor).any():
                            made += [(row.size, row.block, row.queries, row.floor, int(region[at]), s) for s in range(int(shards[at]))]
                yield pd.DataFrame(made, columns=[c.split()[0] for c in meets.split(", ")])

        return run

    def floors(group: pd.DataFrame) -> pd.DataFrame:
        """k-th scores of a block's queries, by their place in it."""
        values = np.full(int(group["q"].max()) + 1, -np.inf)
        full = group["n"] >= k
        values[group.loc[full, "q"]] = group.loc[full, "kth"].astype(float)
        return pd.DataFrame({"size": group["size"].iloc[:1], "block": group["block"].iloc[:1], "floor": [values.tobytes()]})

    def widened(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Floors as long as their block: its last queries may have found nothing."""
        for frame in frames:
            for at, row in zip(frame.index, frame.itertuples()):
                if row.floor is not None:
                    known = np.frombuffer(row.floor, dtype=np.float64)
                    frame.at[at, "floor"] = np.concatenate([known, np.full(len(pickle.loads(row.queries)[0]) - len(known), -np.inf)]).tobytes()
            yield frame

    best = Window.partitionBy("size", "block", "q").orderBy(F.desc("score"), "vec_id")
    most = max((len(x[0]) for x in boxes.values()), default=0)
    found = None
    edges = [0, *[s for s in steps if s < most], most]
    for start, end in zip(edges[:-1], edges[1:]):
        if found is None:
            asked = queries.withColumn("floor", F.lit(None).cast("binary"))
        else:
            kth = found.groupBy("size", "block", "q").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
            known = kth.groupBy("size", "block").applyInPandas(floors, "size int, block int, floor binary")
            asked = queries.join(known, ["size", "block"], "left").select("size", "block", "queries", "floor").mapInPandas(widened, "size int, block int, queries binary, floor binary")
        met = materialise(asked.mapInPandas(meeting(start, end), meets).withColumn("part", F.floor(F.col("block") / BLOCKS_AT_ONCE).cast("int")))
        if report is not None:
            report["searched"] = report.get("searched", 0) + met.select("size", "block", "region").distinct().count()
        place = ["size", "region", "shard", "part"]
        wanted = trees.select("size", "region", "shard", "tree").join(met.select(*[F.col(c).alias(c) for c in place]).distinct(), place[:3])
        rows = wanted.groupBy(*place).cogroup(met.groupBy(*place)).applyInPandas(lambda t, b: _search(t, b, k), _FOUND)
        rows = rows if found is None else rows.unionByName(found)
        found, last = materialise(rows.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k).drop("place")), found
        discard(met, *([last] if last is not None else []))
    if report is not None:
        report["pairs"] = sum(queries.where(F.col("size") == size).count() * len(x[0]) for size, x in boxes.items())
    if found is None:
        found = vectors.sparkSession.createDataFrame([], _FOUND)
    return found.select("query_id", F.row_number().over(best).alias("rank"), "vec_id", "score")


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(read_table(spark, sf_dir, "embeddings"))
    return top_k(vectors, F.pmod("id", F.lit(20)) == 0, k=20)


OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.c, v.c) AS BIGINT) AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id AND len(q.c) = len(v.c)
  WHERE q.vec_id % 20 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

"""N-gram Jaccard join with adaptive multi-match prefixes.

Documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more
are linked; each gets the smallest id that its links reach.

Equal sets are one node: its 64-bit digest. Shingles have one order for all: those
known to be frequent last. If x and y are similar, each of their prefixes of
n - ceil(0.8 n) + l shingles holds at least l shared ones. A node's l is a share of
its size that grows with its estimated number of candidates, the document counts of
its prefix's frequent shingles. A pair must share as many prefix shingles as its
smaller l asks for, and so a node that shares too few with all others goes before
any pair is made. Candidates must also pass two exact bounds, by place in the order
and by a small histogram of each set, before their whole sets are compared.

No group of copies makes all its pairs: nodes are first compared with one
representative for each of their min-hashes and linked ones merged to components.
Then only shingles that still join different components are looked at, found by
their least and greatest component with partial aggregation, and only pairs across
components, each at the first shingle that it shares. Shingles that share nodes meet
in one group where possible, so that a node's rows are few: by labels spread twice
between shingles and nodes. Large groups are split by shingle, and a shingle of more
than BLOCK nodes is a group of its own, split to pairs of blocks of nodes. A group
compares its candidates' whole sets where they meet and passes over those that its
links have joined by then: it gives fewer links than it has nodes, and candidate
pairs are never rows. Each of these steps is exact: none drops a link that could
join two components.

Defined results: a null or empty text, or one without words, has no shingles, no
links and its own id; equal sets are linked whatever the text; null ids are passed
over for component_id where a linked id is known; repeated rows stay; an empty
table gives no rows; extra columns are ignored. Digests are 64-bit: two different
sets share one with probability 2^-64.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import discard, hinted, materialise, prepare_workers, read_table, release, reserved
from tillroll.llm.components import connected
from tillroll.llm.shingles import mix, overlap, set_digest, shingle_sets

#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Min-hashes by which a node finds representatives.
MIN_HASHES = 8
#: Frequent shingles: a task reports those in TASK_DOCS of its nodes or more, the
#: FREQUENT most frequent of all are told from the rest. They change the order of
#: shingles, and with it only the cost.
TASK_DOCS, TASK_FREQUENT, FREQUENT = 2, 20_000, 200_000
#: Shared prefix shingles asked for, as percent of a set's size: at least and at most.
LEAST_MATCHES, MOST_MATCHES = 5, 10
#: Bits for each shingle in the map of those that join components, and bits at most.
MAP_BITS, MOST_MAP_BITS = 16, 1 << 28
#: Cells of a set's histogram; sets that overfill one go without.
CELLS = 256
#: Bytes of sets that a worker remembers from batch to batch.
HELD_BYTES = 64 << 20
#: Nodes of one shingle that meet in one group, and rows of shingles and nodes that do.
BLOCK, GROUP_ROWS = 2_000, 50_000
#: Times that each node is compared with one other before all pairs that are left.
ROUNDS = 3


def needed(n: np.ndarray | int, m: np.ndarray | int):
    """Least intersection of linked sets of sizes n and m: 80 (n + m) / 180, rounded up."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


def matches_for(n: int, cost: float) -> int:
    """l of a set of n shingles, given an estimate of its candidates."""
    percent = min(LEAST_MATCHES + log2(1 + cost) / 2, MOST_MATCHES)
    return 1 + int(n * percent) // 100


def least_matches(n: int) -> int:
    """The l that any similar set, of 0.8 n shingles or more, asks for at least."""
    return 1 + LEAST_MATCHES * -(-PERCENT * n // 100) // 100


class ShingleOrder:
    """Rare shingles first, by hash; then the frequent ones by their documents."""

    def __init__(self, shingles: np.ndarray, docs: np.ndarray):
        by_hash = np.argsort(shingles)
        self.known, self.docs = shingles[by_hash], docs[by_hash]

    def sort(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The hashes in order, and the documents known of each (0: rare)."""
        docs = np.zeros(len(hashes), dtype=np.int64)
        if len(self.known) and len(hashes):
            at = np.searchsorted(self.known, hashes)
            at[at == len(self.known)] = 0
            hit = self.known[at] == hashes
            docs[hit] = self.docs[at[hit]]
        order = np.argsort(docs, kind="stable")  # hashes come sorted
        return hashes[order], docs[order]

    def prefix(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The prefix in order, the documents of its shingles, and l."""
        ordered, docs = self.sort(hashes)
        least = -(-PERCENT * len(hashes) // 100)
        plain = len(hashes) - least
        matches = min(matches_for(len(hashes), float(docs[: plain + 1].sum())), least)
        return ordered[: plain + matches], docs[: plain + matches], matches


def _rows(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        yield batch, shingle_sets(batch.column(column).to_pylist())


def _nodes(docs: DataFrame, keys: list[str], text: str) -> DataFrame:
    """A row for each document: keys, text_hash, node, n and min-hashes (kind 0), and
    rows of frequent shingles of a task: shingle and its nodes (kind 1)."""
    names = [f"__k{i}" for i in range(len(keys))]
    source = docs.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)], F.xxhash64(f"`{text}`").alias("text_hash"), F.col(f"`{text}`").alias("__text"))
    types = [docs.schema[k].dataType.simpleString() for k in keys]
    schema = ", ".join([*[f"{n} {t}" for n, t in zip(names, types)], "text_hash long, kind int, node long, n long, mins array<long>"])
    width = len(keys)
    salts = mix(np.arange(1, MIN_HASHES + 1, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        seen: set[int] = set()
        last = None
        for batch, sets in _rows(batches, width + 1):
            last = batch
            nodes = [set_digest(s) for s in sets]
            mins = [mix(s.view(np.uint64)[:, None] ^ salts).min(axis=0).view(np.int64).tolist() if len(s) else [] for s in sets]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in range(width + 1)], pa.array([0] * len(sets), pa.int32()), pa.array(nodes, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(mins, pa.list_(pa.int64()))],
                names=[*names, "text_hash", "kind", "node", "n", "mins"],
            )
            fresh = [s for d, s in {d: s for d, s in zip(nodes, sets)}.items() if d not in seen]
            if len(seen) > 500_000:
                seen.clear()
            seen.update(nodes)
            if fresh:
                shingles, docs_of = np.unique(np.concatenate(fresh), return_counts=True)
                often = docs_of > 1
                if counts:
                    often |= np.isin(shingles, np.fromiter(counts, dtype=np.int64, count=len(counts)))
                for shingle, c in zip(shingles[often].tolist(), docs_of[often].tolist()):
                    counts[shingle] = counts.get(shingle, 0) + c
                if len(counts) > 10 * TASK_FREQUENT:
                    floor = sorted(counts.values())[-5 * TASK_FREQUENT]
                    counts = {k: c for k, c in counts.items() if c > floor}
        top = sorted((k for k, c in counts.items() if c >= TASK_DOCS), key=lambda k: -counts[k])[:TASK_FREQUENT]
        if top:
            none = [pa.nulls(len(top), last.column(k).type) for k in range(width + 1)]
            yield pa.RecordBatch.from_arrays(
                [*none, pa.array([1] * len(top), pa.int32()), pa.array(top, pa.int64()), pa.array([counts[k] for k in top], pa.int64()), pa.nulls(len(top), pa.list_(pa.int64()))],
                names=[*names, "text_hash", "kind", "node", "n", "mins"],
            )

    return source.mapInArrow(run, schema)


def _texts(docs: DataFrame, text: str, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, text of each wanted node: one of the texts that has its set."""
    chosen = materialise(nodes.join(wanted, "node", "left_semi").select("node", "text_hash"))
    found = docs.select(F.xxhash64(f"`{text}`").alias("text_hash"), F.col(f"`{text}`").alias("text")).join(hinted(chosen), "text_hash")
    return found.groupBy("node").agg(F.first("text").alias("text"))


def _verified(pairs: DataFrame, docs: DataFrame, text: str, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked, by comparing whole sets; written."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = materialise(_texts(docs, text, nodes, wanted))
    # Members meet their texts first: rows of a representative then share its text.
    both = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b").join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[int, np.ndarray] = {}
        held = 0
        for batch in batches:
            ids = [batch.column(0).to_pylist(), batch.column(1).to_pylist()]
            new: dict[int, int] = {}
            for side in (0, 1):
                for row, node in enumerate(ids[side]):
                    if node not in memory and node not in new:
                        new[node] = 2 * row + side
            texts_of = [batch.column(2 + at % 2)[at // 2].as_py() for at in new.values()]
            if held > HELD_BYTES:
                memory.clear()
                held = 0
                texts_of, new = [], {}
                for side in (0, 1):
                    for row, node in enumerate(ids[side]):
                        if node not in new:
                            new[node] = 2 * row + side
                texts_of = [batch.column(2 + at % 2)[at // 2].as_py() for at in new.values()]
            made = shingle_sets(texts_of)
            held += sum(x.nbytes for x in made)
            memory.update(zip(new, made))
            keep = []
            for a, b in zip(*ids):
                x, y = memory[a], memory[b]
                common = overlap(x, y)
                keep.append(100 * common >= PERCENT * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    linked = materialise(both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long"))
    discard(texts)
    return linked


def _prefix_rows(docs: DataFrame, text: str, order: ShingleOrder, bits: np.ndarray | None = None) -> DataFrame:
    """shingle, node, need for the prefix of each node, once for each task.

    With ``bits`` only shingles whose bits are all set.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, sets in _rows(batches, 0):
            nodes, needs, shingles = [], [], []
            if len(seen) > 500_000:
                seen.clear()
            for s in sets:
                node = set_digest(s)
                if len(s) and node not in seen:
                    seen.add(node)
                    prefix, _, matches = order.prefix(s)
                    nodes.append(node)
                    needs.append(min(matches, least_matches(len(s))))
                    shingles.append(prefix)
            if nodes:
                sizes = [len(s) for s in shingles]
                columns = [np.concatenate(shingles), np.repeat(np.array(nodes, dtype=np.int64), sizes), np.repeat(np.array(needs, dtype=np.int64), sizes)]
                if bits is not None:
                    keep = _has_bits(bits, columns[0])
                    columns = [c[keep] for c in columns]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["shingle", "node", "need"])

    return docs.select(text).mapInArrow(run, "shingle long, node long, need long")


def _has_bits(bits: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """Whether both of a shingle's bits are set in ``bits``, 64-bit words."""
    mask = np.uint64(len(bits) * 64 - 1)
    found = np.ones(len(shingles), dtype=bool)
    for shift in (0, 29):
        at = (shingles.view(np.uint64) >> np.uint64(shift)) & mask
        found &= (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
    return found


def _bit_map(shingles: DataFrame) -> np.ndarray:
    """A Bloom filter of a counted table of shingles, of bounded size."""
    size = 1 << min(max(MAP_BITS * shingles.count(), 1 << 12), MOST_MAP_BITS).bit_length() - 1
    at = F.explode(F.array(*[F.shiftrightunsigned("shingle", shift).bitwiseAND(F.lit(size - 1)) for shift in (0, 29)]))
    placed = shingles.select(at.alias("at"))
    # The bit's value: 1 << 63 has no literal, so bits are set by shifting.
    words = placed.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))")).alias("bits")).toArrow()
    out = np.zeros(size // 64, dtype=np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint64)


def _with_component(rows: DataFrame, component: DataFrame) -> DataFrame:
    return rows.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))


PAYLOAD = "node long, n int, size int, matches int, end_docs long, end_shingle long, cells binary, text string"


def _payloads(texts: DataFrame, order: ShingleOrder) -> DataFrame:
    """What a node brings to the comparison with others at a shingle: besides sizes
    and l, the end of its prefix in the order, the histogram of its set, and its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _rows(batches, 1):
            out = []
            for node, s in zip(batch.column(0).to_pylist(), sets):
                prefix, docs, matches = order.prefix(s)
                cells = np.bincount(s.view(np.uint64) >> np.uint64(56), minlength=CELLS).clip(0, 255).astype(np.uint8)
                if cells.max() == 255:
                    cells = cells[:0]
                out.append((node, len(s), len(prefix), matches, int(docs[-1]), int(prefix[-1]), cells.tobytes()))
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            made = [pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 7, kinds)]
            yield pa.RecordBatch.from_arrays([*made, batch.column(1)], names=[x.split()[0] for x in PAYLOAD.split(", ")])

    return texts.select("node", "text").mapInArrow(run, PAYLOAD)


def group_links(nodes: np.ndarray, components: np.ndarray, left: np.ndarray, right: np.ndarray, payload: list[tuple], whole: Callable[[int], np.ndarray]) -> list[tuple[int, int]]:
    """Links of a group's nodes that join its components as all links would do whose
    pair's first shared shingle is one of the group's: fewer than there are nodes.

    ``left``, ``right``: whether a node stands on that side of the pair of blocks.
    ``payload``: n, size of the prefix, l, end, shingles of the group, all shared
    shingles, and cells of each node; ``whole`` gives the set of the node at a place.
    """
    n, size, matches = (np.array([p[k] for p in payload]) for k in range(3))
    by_end = {e: k for k, e in enumerate(sorted({p[3] for p in payload}))}
    end = np.array([by_end[p[3]] for p in payload])
    own, shared = [p[4] for p in payload], [p[5] for p in payload]
    exact = np.array([bool(len(p[6])) for p in payload])
    cells = np.array([p[6] if len(p[6]) else np.full(CELLS, 255, dtype=np.uint8) for p in payload])
    # The nodes of each shingle, as ranges of one array.
    lengths = np.fromiter(map(len, own), dtype=np.int64, count=len(own))
    everything = np.concatenate(own)
    order = np.argsort(everything, kind="stable")
    holders = np.repeat(np.arange(len(own)), lengths)[order]
    ordered = everything[order]
    # What the links found so far have joined: pairs within it need no comparison.
    of = np.unique(components, return_inverse=True)[1]
    found = []
    for x in np.flatnonzero(left):
        first, last = np.searchsorted(ordered, own[x]), np.searchsorted(ordered, own[x], side="right")
        others = np.unique(np.concatenate([holders[a:b] for a, b in zip(first.tolist(), last.tolist())]))
        others = others[right[others] & (of[others] != of[x])]
        others = others[(others > x) | ~left[others]] if right[x] else others
        least = needed(n[x], n[others])
        fits = np.minimum(n[x], n[others]) >= least
        most = np.minimum(cells[others], cells[x]).sum(axis=1, dtype=np.int64)
        fits &= (most >= least) | ~exact[others] | ~exact[x]
        for y, need in zip(others[fits].tolist(), least[fits].tolist()):
            if of[x] == of[y]:
                continue
            common = np.intersect1d(shared[x], shared[y], assume_unique=True)
            at = np.searchsorted(own[x], common[0])
            if at == len(own[x]) or own[x][at] != common[0] or len(common) < min(matches[x], matches[y]):
                continue
            # Shingles past the earlier end: at most what is left of the set that ends there.
            rest = min(n[z] - size[z] for z in (x, y) if end[z] == min(end[x], end[y]))
            if len(common) + rest >= need and overlap(whole(x), whole(y)) >= need:
                found.append((int(nodes[x]), int(nodes[y])))
                of[of == of[y]] = of[x]
    return found


_GROUP = ("label", "part", "i", "j")


def _group_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group; a group that spans batches is carried over."""
    held: list[pa.RecordBatch] = []

    def solve(table: pa.Table) -> list[tuple[int, int]]:
        block = table.column("block").to_numpy()
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        lists = [table.column(c).to_numpy() for c in ("own", "shared")]
        ends = zip(table.column("end_docs").to_pylist(), table.column("end_shingle").to_pylist())
        cells = [np.frombuffer(c, dtype=np.uint8) for c in table.column("cells").to_pylist()]
        payload = list(zip(*[table.column(c).to_pylist() for c in ("n", "size", "matches")], ends, *lists, cells))
        texts, made = table.column("text"), {}

        def whole(at: int) -> np.ndarray:
            if at not in made:
                made[at] = shingle_sets([texts[at].as_py()])[0]
            return made[at]

        return group_links(table.column("node").to_numpy(), table.column("component").to_numpy(), block == i, block == j, payload, whole)

    def out(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        a, b = ([min(p) for p in pairs], [max(p) for p in pairs])
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def cuts_of(table: pa.Table) -> list[int]:
        change = np.zeros(table.num_rows, dtype=bool)
        for k in (table.column(c).to_numpy() for c in _GROUP):
            change[1:] |= k[1:] != k[:-1]
        return [0, *np.flatnonzero(change).tolist(), table.num_rows]

    def group_at(batch: pa.RecordBatch, row: int) -> list:
        return [batch.column(c)[row] for c in _GROUP]

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if group_at(held[0], 0) == group_at(batch, batch.num_rows - 1):
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        cuts = cuts_of(table)
        yield out([p for a, b in zip(cuts[:-2], cuts[1:-1]) for p in solve(table.slice(a, b - a))])
        held = table.slice(cuts[-2]).to_batches()
    if held:
        yield out(solve(pa.Table.from_batches(held).combine_chunks()))


def _labelled(members: DataFrame) -> DataFrame:
    """Add label: equal for shingles that share nodes, if not always. The least
    shingle of a node spreads to the node's shingles and, once more, on from there."""
    node = members.groupBy("node").agg(F.min("shingle").alias("first"))
    for _ in range(2):
        shingle = members.join(hinted(materialise(node)), "node").groupBy("shingle").agg(F.min("first").alias("label"))
        node = members.join(shingle, "shingle").groupBy("node").agg(F.min("label").alias("first"))
    return members.join(shingle, "shingle")


def _shared_minima(minima: DataFrame) -> DataFrame:
    """The min-hashes that several nodes have: (k, value) of more than one row."""
    several = minima.groupBy("k", "value").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("k", "value")
    return minima.join(hinted(materialise(several)), ["k", "value"], "left_semi")


def _star_pairs(minima: DataFrame) -> DataFrame:
    """Pairs (a, b) across components of each min-hash's representative a, the node of
    most links, and the other nodes b that have it.

    Even and odd min-hashes choose by a hash of their own, so that near copies have the
    same one for most of a half; only pairs that agree twice in a half are worth a
    comparison of whole sets.
    """
    half = F.col("k") % 2
    first = F.max_by(F.struct("node", "n", "component"), F.struct("links", F.xxhash64("node", half)))
    best = minima.groupBy("k", "value").agg(first.alias("best"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    near = F.least("n", "best.n") * 100 >= F.greatest("n", "best.n") * PERCENT
    met = minima.join(hinted(materialise(best.select("k", "value", "best"))), ["k", "value"]).where((F.col("component") != F.col("best.component")) & near)
    agreeing = met.groupBy(F.col("best.node").alias("a"), F.col("node").alias("b"), half).agg(F.count("*").alias("c"))
    return agreeing.where(F.col("c") >= min(2, MIN_HASHES)).select("a", "b").distinct()


def _joining(members: DataFrame) -> DataFrame:
    """shingle of those whose members are of different components."""
    return members.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("shingle")


def _cross_links(docs: DataFrame, text: str, nodes: DataFrame, order: ShingleOrder, component: DataFrame) -> DataFrame:
    """Links (a, b) that join what components all links across them would join; written."""
    component = hinted(component)
    joining = materialise(_joining(_with_component(_prefix_rows(docs, text, order), component)))
    members = _with_component(_prefix_rows(docs, text, order, _bit_map(joining)), component)
    members = members.groupBy("shingle", "node").agg(F.first("need").alias("need"), F.first("component").alias("component"))
    members = materialise(members)
    for _ in range(2):  # nodes that go leave shingles that no longer join any
        left = members.join(_joining(members), "shingle", "left_semi")
        # By broadcast if there are few: the rows of a long text's node needn't meet.
        enough = materialise(left.groupBy("node").agg(F.count("*").alias("c"), F.first("need").alias("need")).where("c >= need").select("node"))
        members, before = materialise(left.join(hinted(enough), "node", "left_semi")), members
        del left
        release(before, enough)
    discard(joining)
    shared = members.groupBy("node").agg(F.array_sort(F.collect_list("shingle")).alias("shared"))
    payload = _payloads(_texts(docs, text, nodes, shared.select("node")), order).join(shared, "node")
    sizes = members.groupBy("shingle").agg(F.count("*").alias("members"))
    placed = materialise(_labelled(members).join(sizes, "shingle"))
    large = F.col("members") > BLOCK
    # A set of n asks for 1 + 0.04 n shingles, so its bytes are bounded by that.
    set_bytes = F.first("need") * (8 * 10_000 // (LEAST_MATCHES * PERCENT))
    of_node = placed.where(~large).groupBy("label", "node").agg(F.count("*").alias("rows"), set_bytes.alias("bytes"))
    parts = F.greatest(F.ceil(F.sum("rows") / GROUP_ROWS), F.ceil(F.sum("bytes") / HELD_BYTES))
    of_label = of_node.groupBy("label").agg(parts.cast("int").alias("parts"))
    together = placed.where(~large).join(hinted(of_label), "label").withColumn("part", F.pmod(F.xxhash64("shingle"), F.col("parts")).cast("int"))
    together = together.select("label", "part", "node", "component", "shingle", F.lit(1).alias("blocks"))
    alone = placed.where(large).select(F.col("shingle").alias("label"), F.lit(-1).alias("part"), "node", "component", "shingle", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    rows = together.unionByName(alone).groupBy("label", "part", "node", "component", "blocks").agg(F.array_sort(F.collect_list("shingle")).alias("own"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other", "blocks")
    sorted_groups = rows.join(payload, "node").repartition(*_GROUP).sortWithinPartitions(*_GROUP)
    links = materialise(sorted_groups.mapInArrow(_group_links, "a long, b long"))
    release(members, placed)
    return links


def _joined(pairs: DataFrame, component: DataFrame, docs: DataFrame, text: str, nodes: DataFrame) -> DataFrame:
    """Components after the links among ``pairs`` (a, b), a written table of pairs at hand.

    A group of M components that are one has up to M x M pairs; a few links join it.
    So each node is first compared with the one of most pairs, and pairs that are
    within one component by then go; what is left after ROUNDS is compared whole.
    """
    for k in range(ROUNDS + 1):
        if pairs.isEmpty():
            break
        chosen = pairs
        if k < ROUNDS:
            most = hinted(materialise(pairs.groupBy("a").agg(F.count("*").alias("pairs"))))
            chosen = materialise(pairs.join(most, "a").groupBy("b").agg(F.max_by("a", F.struct("pairs", "a")).alias("a")).select("a", "b"))
        links = _verified(chosen, docs, text, nodes)
        component = connected(links.unionByName(component.select(F.col("node").alias("a"), F.col("component").alias("b"))))
        if k < ROUNDS:
            left = pairs.join(hinted(chosen), ["a", "b"], "left_anti")
            of = hinted(component)
            for side in ("a", "b"):
                left = left.join(of.select(F.col("node").alias(side), F.col("component").alias(f"of_{side}")), side, "left")
            apart = F.coalesce("of_a", "a") != F.coalesce("of_b", "b")
            pairs, before = materialise(left.where(apart).select("a", "b")), pairs
            del left, of
            release(before, chosen)
    return component


def jaccard_components(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys``, n_shingles, node and component of each document.

    Documents with the same component are joined by links; component is null for
    documents without shingles.
    """
    prepare_workers(docs.sparkSession)
    found = materialise(_nodes(docs, keys, text))
    rows = found.where("kind = 0")
    top = found.where("kind = 1").groupBy("node").agg(F.sum("n").alias("docs")).orderBy(F.desc("docs"), "node").limit(FREQUENT)
    # As arrays: a row object for each of them would take the driver 100 MB.
    top = top.toArrow()
    order = ShingleOrder(top.column("node").to_numpy(), top.column("docs").to_numpy())
    del top
    # One row a node: a large group of copies is counted down before it meets anything.
    nodes = materialise(rows.where("n > 0").groupBy("node").agg(F.min("text_hash").alias("text_hash")))

    minima = rows.where("n > 0").select("node", "n", F.posexplode("mins").alias("k", "value")).distinct()
    minima = materialise(_shared_minima(minima))
    stars = materialise(_star_pairs(minima.withColumns({"component": F.col("node"), "links": F.lit(0)})))
    links = _verified(stars, docs, text, nodes)
    component = connected(links)
    # Once more from the nodes that most were linked to: they are amid their group.
    linked = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("links"))
    again = _with_component(minima, hinted(component)).join(hinted(materialise(linked)), "node", "left").withColumn("links", F.coalesce("links", F.lit(0)))
    other = materialise(_star_pairs(again).join(hinted(stars), ["a", "b"], "left_anti"))
    links = links.unionByName(_verified(other, docs, text, nodes))
    component = connected(links)
    release(minima, stars, other)
    links = links.unionByName(_cross_links(docs, text, nodes, order, component))
    component = connected(links)
    labelled = _with_component(rows, hinted(component)).withColumn("component", F.when(F.col("n") > 0, F.col("component")))
    names = [F.col(f"__k{i}").alias(k) for i, k in enumerate(keys)]
    return labelled.select(*names, F.col("n").alias("n_shingles"), "node", "component")


def with_smallest(found: DataFrame, key: str) -> DataFrame:
    """Add component_id: the smallest ``key`` of the component."""
    # Components of several rows only, by broadcast if they are few: a large one's rows needn't meet.
    smallest = found.where(F.col("component").isNotNull()).groupBy("component").agg(F.min(key).alias("component_id"), F.count("*").alias("rows"))
    smallest = hinted(materialise(smallest.where("rows > 1").drop("rows")))
    return found.join(smallest, "component", "left").withColumn("component_id", F.coalesce("component_id", key))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest ``key``.

    Rows are told apart by key and text; of rows that agree in both one stays.
    Documents without shingles all stay.
    """
    hashed = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.xxhash64(f"`{text}`").alias("hash"))
    found = materialise(jaccard_components(hashed, ["key", "hash"], "text")).where(F.col("component").isNotNull())
    order = F.struct(F.col("key").isNull(), "key", "hash")
    kept = found.groupBy("component").agg(F.min(order).alias("kept"), F.count("*").alias("rows")).where("rows > 1")
    rows = materialise(found.join(hinted(materialise(kept)), "component").select("key", "hash", (order != F.col("kept")).alias("goes")))
    repeated = rows.where("NOT goes").groupBy("key", "hash").count().where("count > 1").select("key", "hash")
    gone = materialise(rows.where("goes").select("key", "hash").distinct().unionByName(repeated))
    own = reserved(docs, "key", "hash")
    marked = docs.withColumns({own["key"]: F.col(f"`{key}`"), own["hash"]: F.xxhash64(f"`{text}`")})
    same = lambda side: (F.col(own["hash"]) == side["hash"]) & F.col(own["key"]).eqNullSafe(side["key"])
    gone = hinted(gone)
    stays = marked.join(gone, same(gone), "left_anti")
    again = hinted(materialise(repeated))
    once = marked.join(again, same(again), "left_semi").dropDuplicates([own["key"], own["hash"]])
    return stays.unionByName(once).select(*[F.col(f"`{c}`") for c in docs.columns])


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_components(read_table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
    return with_smallest(materialise(found), "doc_id").select("doc_id", "n_shingles", "component_id")

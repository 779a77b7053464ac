"""Near-duplicate documents by SimHash fingerprints and vantage-point trees.

All pairs of fingerprints within ``distance`` bits are found through trees that split by Hamming distance to a
vantage point. Distances between random fingerprints lie too close together for such a tree to split them well, so
there is one tree for each of ``bands`` parts of the bits: two fingerprints that differ in at most ``distance`` bits
differ in at most ``distance // bands`` bits of some part, and that small radius is the overlap at each border. The
leaves are shards; a fingerprint goes to every shard whose border it is near, so each pair meets in some shard.
Shards link what is near as stars, not as pairs, and the stars are joined into components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from ..session import ship_package, stored
from .arrow import Sender, arrow_schema, fields, given_name, map_batches, unused

WORDS, DISTANCE, SEED = 4, 4, 42
BITS, BANDS = 64, 3
#: The trees are shaped by at most about so many fingerprints; only the balance of the shards depends on it.
SAMPLE = 1 << 15
#: Wanted fingerprints per shard, and the fewest of the sample that a shard is cut from.
SHARD, LEAST_SAMPLE = 1000, 8
VANTAGE_POINTS = 4
#: Fingerprints routed at once, and compared at once.
ROUTED, COMPARED = 200_000, 1 << 20
HASHED = 1 << 16
TRIES = 3


def fingerprint(text: str, words: int = WORDS) -> int:
    """The 64-bit SimHash of a text's word shingles; 0 if it has no words."""
    found = text.encode().lower().split()  # ASCII letters and ASCII white space
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        shingles, hashed = 1, [xxh64_intdigest(joined, SEED)]
        counts = _bit_counts(hashed)
    else:
        ends = np.cumsum([len(w) + 1 for w in found]) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        first, last = starts[:len(found) - words + 1].tolist(), ends[words - 1:].tolist()
        shingles, counts = len(first), np.zeros(BITS, np.int64)
        digest = partial(xxh64_intdigest, seed=SEED)
        for at in range(0, shingles, HASHED):
            counts += _bit_counts([digest(joined[a:b]) for a, b in zip(first[at:at + HASHED], last[at:at + HASHED])])
    bits = np.packbits(2 * counts > shingles, bitorder="little")
    return int(bits.view("<u8")[0])


def _bit_counts(hashes: list[int]) -> np.ndarray:
    octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprints(df: DataFrame, keep: list[str], text: str = "text", words: int = WORDS) -> DataFrame:
    """``keep`` columns and ``fp``, the fingerprint as a signed 64-bit integer, of every row.

    A null text has no words; a kept column called fp is replaced.
    """
    kept = [name for name in keep if name.lower() != "fp"]
    ddl = ", ".join([fields(df, *kept), "fp bigint"] if kept else ["fp bigint"])
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Sender(schema)
        for batch in batches:
            *columns, texts = batch.columns
            for row in zip(texts, *columns):
                fp = fingerprint(row[0].as_py() or "", words)
                own = [value.as_py() for value in row[1:]]
                size = 64 + sum(len(v) for v in own if isinstance(v, (str, bytes)))
                if out.add(*own, fp - (1 << BITS) if fp >> BITS - 1 else fp, size=size):
                    yield out.batch()
        yield out.batch()

    return map_batches(df.select(*kept, F.col(text).alias(unused(kept, "text"))), ddl, run)


def bands(count: int) -> list[np.uint64]:
    """Masks that share out the bits."""
    borders = [BITS * i // count for i in range(count + 1)]
    return [np.uint64((1 << b) - (1 << a)) for a, b in zip(borders, borders[1:])]


class Tree:
    """A vantage-point tree over the bits of a mask; its leaves are numbered from ``first``.

    A node sends to its near side what lies within ``limit + radius`` of the vantage point and to its far side what
    lies beyond ``limit``, so two fingerprints within ``radius`` of each other share a side, by the triangle bound.
    """

    def __init__(self, sample: np.ndarray, mask: np.uint64, radius: int, leaf: int, first: int):
        self.mask, self.radius, self.first, self.leaves = mask, radius, first, 0
        self.vantage: list[int] = []
        self.limit: list[int] = []
        self.sides: list[tuple[int, int]] = []
        todo = [(sample, -1, 0)]
        while todo:
            members, above, side = todo.pop()
            node = self._split(members, leaf)
            if node is None:
                number = -1 - self.leaves
                self.leaves += 1
            else:
                number = len(self.vantage)
                vantage, limit, near, far = node
                self.vantage.append(vantage)
                self.limit.append(limit)
                self.sides.append((0, 0))
                todo += [(members[near], number, 0), (members[far], number, 1)]
            if above >= 0:
                sides = list(self.sides[above])
                sides[side] = number
                self.sides[above] = (sides[0], sides[1])
            else:
                self.root = number

    def _split(self, members: np.ndarray, leaf: int):
        if len(members) <= leaf:
            return None
        best, found = 0.95 * 2 * len(members), None
        for vantage in members[:: max(1, len(members) // VANTAGE_POINTS)][:VANTAGE_POINTS]:
            distances = np.bitwise_count((members ^ vantage) & self.mask)
            for limit in {int(np.median(distances)), int(np.median(distances)) - 1}:
                near, far = distances <= limit + self.radius, distances > limit
                sizes = int(near.sum()), int(far.sum())
                if max(sizes) <= 0.9 * len(members) and sum(sizes) < best:
                    best, found = sum(sizes), (vantage, limit, near, far)
        return found

    def route(self, fps: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Numbers of leaves and the fingerprints that go there."""
        todo = [(self.root, fps)]
        while todo:
            number, members = todo.pop()
            if not len(members):
                continue
            if number < 0:
                yield self.first - 1 - number, members
                continue
            distances = np.bitwise_count((members ^ self.vantage[number]) & self.mask)
            near, far = self.sides[number]
            todo.append((near, members[distances <= self.limit[number] + self.radius]))
            todo.append((far, members[distances > self.limit[number]]))


def forest(sample: np.ndarray, total: int, distance: int, count: int = BANDS) -> list[Tree]:
    """Trees for ``total`` fingerprints, one per band, shaped by a sample of them."""
    leaf = max(LEAST_SAMPLE, SHARD * len(sample) // max(total, 1))
    trees, first = [], 0
    for mask in bands(count):
        trees.append(Tree(sample, mask, distance // count, leaf, first))
        first += trees[-1].leaves
    return trees


def stars(fps: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Components of a shard's fingerprints (all different): members but one, and that one.

    A shard too large to compare at once is split by a vantage point as the trees are, over all bits.
    """
    out, todo = [], [(fps, 0)]
    while todo:
        members, tried = todo.pop()
        vantage = members[(len(members) * (2 * tried + 1)) // (2 * TRIES)] if len(members) else 0
        distances = np.bitwise_count(members ^ vantage)
        if len(members) ** 2 > 16 * COMPARED and tried < TRIES:
            limit = int(np.median(distances))
            near, far = distances <= limit + distance, distances > limit
            if max(near.sum(), far.sum()) <= 0.95 * len(members):
                todo += [(members[near], 0), (members[far], 0)]
            else:
                todo.append((members, tried + 1))
            continue
        out += _linked(members, distances, distance)
    return out


def _linked(fps: np.ndarray, to_vantage: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Components among fingerprints with known distances to a vantage point, which bound what must be compared."""
    order = np.argsort(to_vantage, kind="stable")
    fps, ranks = fps[order], to_vantage[order].astype(np.int64)
    linked = np.zeros(len(fps), bool)
    at = 0
    while at < len(fps):
        low = np.searchsorted(ranks, ranks[at] - distance)
        size = max(1, COMPARED // (len(fps) - low))
        end = min(at + size, len(fps))
        high = np.searchsorted(ranks, ranks[end - 1] + distance, "right")
        near = np.bitwise_count(fps[at:end, None] ^ fps[None, low:high]) <= distance
        linked[at:end] = near.sum(axis=1) > 1  # itself is one
        at = end
    left, ranks = fps[linked], ranks[linked]
    out = []
    while len(left):
        frontier, members = [(left[0], ranks[0])], [left[:1]]
        left, ranks = left[1:], ranks[1:]
        while frontier and len(left):
            fp, rank = frontier.pop()
            low, high = np.searchsorted(ranks, [rank - distance, rank + distance + 1])
            near = np.flatnonzero(np.bitwise_count(left[low:high] ^ fp) <= distance) + low
            if len(near):
                members.append(left[near])
                frontier += zip(left[near], ranks[near])
                left, ranks = np.delete(left, near), np.delete(ranks, near)
        whole = np.concatenate(members)
        if len(whole) > 1:
            least = whole.view(np.int64).min()
            others = whole.view(np.int64)
            out.append((others[others != least], least))
    return out


def links(nodes: DataFrame, distance: int = DISTANCE, count: int = BANDS) -> DataFrame:
    """Edges (a, b) between different fingerprints ``fp`` that join all pairs within ``distance``, and no others, into
    components. Written to the shared folder."""
    spark = nodes.sparkSession
    total = nodes.count()
    share = min(1.0, SAMPLE / max(total, 1))
    steps = 1 << 30
    # chosen by hash, so always the same; twice the expected number is never reached, and only balance depends on it
    rows = nodes.where(F.pmod(F.xxhash64("fp", F.lit(7)), F.lit(steps)) < int(share * steps)).select("fp").limit(2 * SAMPLE)
    sample = np.sort(np.array([r["fp"] for r in rows.collect()], np.int64)).view(np.uint64)
    ship_package(spark)
    trees = spark.sparkContext.broadcast(forest(sample, total, distance, count))
    routed = arrow_schema("shard bigint, fp bigint")
    linked = arrow_schema("a bigint, b bigint")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(batch.column(0).to_numpy())
            if sum(map(len, held)) >= ROUTED:
                yield from sharded(held)
                held = []
        if held:
            yield from sharded(held)

    def sharded(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        fps = np.concatenate(held).view(np.uint64)
        shards, members, size = [], [], 0
        for tree in trees.value:
            for shard, found in tree.route(fps):
                shards.append(np.full(len(found), shard, np.int64))
                members.append(found.view(np.int64))
                size += len(found)
                if size >= ROUTED:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (shards, members)], schema=routed)
                    shards, members, size = [], [], 0
        if size:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (shards, members)], schema=routed)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for members in _runs(batches):
            found = stars(members.view(np.uint64), distance)
            if found:
                a = np.concatenate([others for others, _ in found])
                b = np.concatenate([np.full(len(others), least) for others, least in found])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=linked)

    shards = nodes.select("fp").mapInArrow(route, "shard bigint, fp bigint")
    found = shards.repartition("shard").sortWithinPartitions("shard").mapInArrow(compare, "a bigint, b bigint")
    return stored(found.distinct(), "links")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Fingerprints of one shard after the other, from rows sorted by shard."""
    held: list[np.ndarray] = []
    current = None
    for batch in batches:
        shards, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(shards):
            continue
        cuts = np.flatnonzero(np.diff(shards)) + 1
        for first, part in zip(np.concatenate([[0], cuts]), np.split(fps, cuts)):
            if shards[first] != current and held:
                yield np.concatenate(held)
                held = []
            current = shards[first]
            held.append(part)
    if held:
        yield np.concatenate(held)


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for all nodes of (a, b) edges.

    Alternates two steps until nothing changes: every node hands its larger neighbours its smallest one, then its
    smaller ones. The number of rounds grows with the logarithm of the longest chain. Every step is written to the
    shared folder, and a node with very many neighbours is split by adaptive execution.
    """
    def signature(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    def smallest(pairs: DataFrame) -> DataFrame:
        # pairs of (a, b): of every a its smallest b, or itself
        least = stored(pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        return pairs.join(least, "a")

    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                   "edges")
    before = signature(edges)
    while before[0]:
        both = edges.union(edges.select("b", "a"))
        large = smallest(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.where("a <> b").distinct(), "large")
        small = smallest(large)
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            small.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        edges = stored(small, "edges")
        after = signature(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS,
                    distance: int = DISTANCE) -> DataFrame:
    """``key``, ``fp``, ``component_id``, the smallest key reachable over links, and ``class_fp``, the smallest
    fingerprint reachable, for every row.

    Fingerprints of shingles of ``words`` words link at ``distance`` or fewer differing bits. Texts without words,
    null ones too, have fingerprint 0, which links like any other. Null keys are never smallest; a component of null
    keys only has a null id. Repeated rows are rows of their own with the same answer. Equal fingerprints are
    compared once. Other columns are left out; an empty table gives no rows. A key named like a new column is called
    ``<name>_given``.
    """
    if not 0 <= distance < BITS:
        raise ValueError("the distance must be from 0 to 63 bits")
    named = df.select(F.col(key).alias("id"), F.col(text).alias("text"))
    fps = stored(fingerprints(named, ["id"], "text", words), "fingerprints")
    nodes = stored(fps.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    roots = stored(components(links(nodes, distance)), "roots")
    linked = roots.join(nodes, roots["node"] == nodes["fp"]).select("fp", "root", "least")
    ids = stored(linked.groupBy("root").agg(F.min("least").alias("component_id")), "ids")
    of_linked = roots.join(ids, "root").select("node", "root", "component_id")
    is_linked = F.col("node").isNotNull()
    classes = stored(nodes.join(of_linked, nodes["fp"] == of_linked["node"], "left").select(
        "fp", F.when(is_linked, F.col("component_id")).otherwise(F.col("least")).alias("component_id"),
        F.coalesce("root", "fp").alias("class_fp")), "classes")
    called = given_name(key, ("fp", "component_id", "class_fp"))
    return fps.join(classes, "fp").select(F.col("id").alias(called), "fp", "component_id", "class_fp")

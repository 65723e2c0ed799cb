"""SimHash near-duplicates by vantage-point trees (operator 2).

Fingerprints: 64 bits, each the majority of that bit in the XXH64 hashes of a text's word shingles.
Texts with equal fingerprints are one point. Two points within ``max_bits`` (3) differ in at most one bit
of one 32-bit half, so there is one vantage-point tree per half with radius 1; a node whose half-distances
cannot split its points uses the whole 64 bits and radius 3.

1. A bounded sample (``SAMPLE_PER_SHARD`` points for each shard wanted) gives the upper tree: a node has a
   vantage point and a radius, its leaves are the shards.
2. Every point goes to its home shard and, by the triangle bound, to each later shard that its ball touches.
3. A shard builds the rest of the tree over its home points and runs all its points down at once, branch by
   branch; leaves compare whole fingerprints. It returns a star per connected set, never all pairs.
4. Large-star and small-star rounds join the stars into components, each round a table in shared storage.

Defined results: a null text is empty; a text without words has fingerprint zero and links like any other;
null doc_ids are never a component's id (a component of null doc_ids has id null); repeated rows are
separate rows of one component; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, packed_row, slices, table, texts_of

#: Fixed values of the fingerprint rule.
SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 3

SHARD_POINTS = 8192
SAMPLE_PER_SHARD = 64
LEAF_POINTS = 192
METRICS = {"left": (np.uint64(0xFFFFFFFF00000000), 2), "right": (np.uint64(0x00000000FFFFFFFF), 2), "whole": (np.uint64(0xFFFFFFFFFFFFFFFF), 1)}


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    words = text.lower().split()  # bytes: only A-Z change, only ASCII white space separates
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    n = len(words) - shingle + 1
    a, b = starts[:n].tolist(), ends[shingle - 1 :].tolist()
    for i in range(0, n, 1 << 16):
        h = np.fromiter([digest(joined[x:y], SEED) for x, y in zip(a[i : i + (1 << 16)], b[i : i + (1 << 16)])], ">u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big")


def fingerprinted(docs: DataFrame, shingle: int, carry: bool) -> DataFrame:
    """(part, pos, doc_id, fp) of every row and, with ``carry``, all its columns as the struct ``row``."""
    kind = docs.select(packed_row(docs).alias("row")).schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in slices(batches):
            fps = np.array([fingerprint(t, shingle) for t in texts_of(batch)], np.uint64).view(np.int64)
            out = {
                "part": pa.array(np.full(len(fps), part, np.int32)),
                "pos": pa.array(np.arange(at, at + len(fps))),
                "doc_id": batch.column("doc_id"),
                "fp": pa.array(fps),
            }
            yield pa.RecordBatch.from_pydict(out | ({"row": batch.column("row")} if carry else {}))
            at += len(fps)

    source = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text")]
    source += [packed_row(docs).alias("row")] if carry else []
    return map_batches(docs.select(*source), run, "part int, pos long, doc_id long, fp long" + (f", row {kind}" if carry else ""))


def distance(a: np.ndarray, b, metric: str) -> np.ndarray:
    return np.bitwise_count((a ^ b) & METRICS[metric][0])


def reach(metric: str, max_bits: int) -> int:
    """How far apart two linked points can be by a metric: pigeonhole over its share of the bits."""
    return max_bits // METRICS[metric][1]


def split(points: np.ndarray, metric: str, rng: np.random.Generator) -> tuple | None:
    """(metric, vantage point, radius) that halves ``points`` best; None if all tries are lopsided."""
    best = None
    for kind in dict.fromkeys((metric, "whole")):
        for vantage in rng.choice(points, min(6, len(points)), replace=False):
            d = distance(points, vantage, kind)
            radius = int(np.median(d))
            inside = float((d <= radius).mean())
            if inside > 0.9 and radius:
                radius -= 1
                inside = float((d <= radius).mean())
            if 0.1 <= inside <= 0.9 and (best is None or abs(inside - 0.5) < best[0]):
                best = (abs(inside - 0.5), kind, vantage, radius)
        if best:
            return best[1:]
    return None


def upper_tree(sample: np.ndarray, metric: str, most: float, start: int = 0) -> tuple:
    """Nested (metric, vantage, radius, inside, outside); a leaf is its number. ``most``: sample points
    of a leaf."""
    rng, numbers = np.random.default_rng(7), iter(range(start, 1 << 60))

    def grow(points):
        cut = split(points, metric, rng) if len(points) > most else None
        if cut is None:
            return next(numbers)
        near = distance(points, cut[1], cut[0]) <= cut[2]
        return (*cut, grow(points[near]), grow(points[~near]))

    tree = grow(sample)
    return tree, next(numbers)


def routes(tree, points: np.ndarray, max_bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(leaf, indices of points whose ball touches it, which of them are at home there)."""

    def walk(node, index, home):
        if not isinstance(node, tuple):
            yield node, index, home
            return
        metric, vantage, radius, inside, outside = node
        d, r = distance(points[index], vantage, metric).astype(np.int64), reach(metric, max_bits)
        for child, touched, own in ((inside, d <= radius + r, d <= radius), (outside, d > radius - r, d > radius)):
            if touched.any():
                yield from walk(child, index[touched], (home & own)[touched])

    if len(points):
        yield from walk(tree, np.arange(len(points)), np.ones(len(points), bool))


def roots_of(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    while True:
        up = parent[x]
        if (up == x).all():
            return x
        x = parent[up]


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    while len(a):
        a, b = roots_of(parent, a), roots_of(parent, b)
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def linked(points: np.ndarray, home: np.ndarray, metric: str, max_bits: int) -> np.ndarray:
    """The root index of every point, all points against the home points, by the lower tree."""
    parent, rng = np.arange(len(points)), np.random.default_rng(11)

    def compare(h, q):
        step = max(1, (1 << 21) // max(1, len(h)))
        for i in range(0, len(q), step):
            part = q[i : i + step]
            x, y = np.nonzero(np.bitwise_count(points[part][:, None] ^ points[h][None, :]) <= max_bits)
            if len(x):
                unite(parent, part[x], h[y])

    def walk(h, q):
        cut = split(points[h], metric, rng) if len(h) > LEAF_POINTS else None
        if cut is None:
            compare(h, q)
            return
        kind, vantage, radius = cut
        r, dh, dq = reach(kind, max_bits), distance(points[h], vantage, kind).astype(np.int64), distance(points[q], vantage, kind).astype(np.int64)
        walk(h[dh <= radius], q[dq <= radius + r])
        walk(h[dh > radius], q[dq > radius - r])

    walk(np.flatnonzero(home), np.arange(len(points)))
    return roots_of(parent, np.arange(len(points)))


def stars(points: DataFrame, max_bits: int, shard_points: int = SHARD_POINTS) -> DataFrame:
    """Edges (a, b), a > b, that connect exactly the points that links of ``max_bits`` connect."""
    n = points.count()
    shards = -(-n // shard_points)
    trees = {"left": 0, "right": 1}
    if shards > 1:
        wanted = SAMPLE_PER_SHARD * shards
        rows = points.select("fp").orderBy(F.xxhash64("fp")).limit(wanted).collect()  # bounded: a 128th of the points
        sample = np.array([r[0] for r in rows], np.int64).view(np.uint64)
        most = max(2, SAMPLE_PER_SHARD)
        left, after = upper_tree(sample, "left", most)
        right, _ = upper_tree(sample, "right", most, after)
        trees, first_right = {"left": left, "right": right}, after
    else:
        first_right = 1

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False)
            value = fp.view(np.uint64)
            for tree in trees.values():
                homes = np.empty(len(fp), np.int64)
                found = list(routes(tree, value, max_bits))
                for leaf, index, home in found:
                    homes[index[home]] = leaf
                for leaf, index, home in found:
                    take = home | (homes[index] < leaf)  # of two shards, the later one compares
                    yield pa.RecordBatch.from_pydict({"shard": pa.array(np.full(take.sum(), leaf)), "fp": pa.array(fp[index[take]]), "home": pa.array(home[take])})

    def search(shard: pa.Table) -> pa.Table:
        fp = shard.column("fp").to_numpy()
        home = shard.column("home").to_numpy()
        metric = "left" if shard.column("shard")[0].as_py() < first_right else "right"
        root = linked(fp.view(np.uint64), home, metric, max_bits)
        own = np.flatnonzero(root != np.arange(len(root)))
        a, b = fp[own], fp[root[own]]
        return pa.table({"a": np.maximum(a, b), "b": np.minimum(a, b)})

    dealt = map_batches(points.select("fp"), deal, "shard long, fp long, home boolean")
    return dealt.groupBy("shard").applyInArrow(search, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a > b), by alternating large-star and small-star rounds
    until the edges stop changing. The stars of the last round are the answer."""

    def summary(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = table(edges, "edges")
    seen = summary(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*").filter("a <> b").distinct()
        edges = table(small, "edges")
        now = summary(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def rooted(prints: DataFrame, max_bits: int, shard_points: int = SHARD_POINTS) -> DataFrame:
    """(fp, root, min_id) of every distinct fingerprint; copies are merged before any shuffle."""
    points = table(prints.groupBy("fp").agg(F.min("doc_id").alias("min_id")), "points")
    linked_points = components(stars(points, max_bits, shard_points))
    known = points.join(linked_points.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "min_id")
    return known


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, shard_points: int = SHARD_POINTS) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id."""
    prints = table(fingerprinted(docs, shingle, False), "prints")
    known = rooted(prints, max_bits, shard_points)
    ids = known.groupBy("root").agg(F.min("min_id").alias("component_id"))
    named = known.join(ids, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, shard_points: int = SHARD_POINTS) -> DataFrame:
    """The row with the smallest doc_id of each component, all columns kept."""
    prints = table(fingerprinted(docs, shingle, True), "prints", compression="zstd")
    known = rooted(prints, max_bits, shard_points).select("fp", "root")
    # rows of one fingerprint first choose their best, so a hot fingerprint is one row when roots meet
    best = prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "part", "pos")).alias("best"))
    winners = best.join(known, "fp").groupBy("root").agg(F.min("best").alias("best")).select("best.part", "best.pos")
    kept = prints.join(winners, ["part", "pos"], "left_semi")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])

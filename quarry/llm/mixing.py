"""Mixing overlapping sources to target weights by min-cost flow (operator 4).

A document belongs to one or more sources. Documents with the same set of sources form a pattern; only the
patterns' totals reach the driver, at most ``MOST_PATTERNS``: beyond that, sources must not overlap, and targets and
stretches are made as tables, with the same result. On the driver a min-cost flow routes words from
patterns to source quotas. Using a document once costs 1 a word and using it a second time costs 3 more, so
nothing repeats while fresh words can fill a quota.

Selection: a pattern's documents lie in seeded order along a line of words, cut into buckets of about a
thousand documents. A bucket that lies within one source's stretch is taken whole, one beyond the stretches
not at all; only buckets that a boundary crosses are looked at document by document, in seeded order, each
document going to the first stretch that still has room for it. Documents are taken whole, so a source
misses its quota by less than the smallest document that the boundary bucket left out.

Defined results: a null or empty text has size 0 and takes 0; a null source is a source of its own, last in
order; repeated rows are separate documents (copies of one row, doc_id and text alike, share a bucket); without any words all
targets are 0; an empty table gives an empty result; other columns stay, whatever their names.
"""

from __future__ import annotations

from collections import defaultdict, deque

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checked, packed_row, ship, table, word_count
from .merkle import numbered

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = 20
BUCKET_ROWS = 1000
MOST_BUCKETS = 1 << 20
MOST_PATTERNS = 50_000


def targets(sizes: dict, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST, total: int | None = None) -> dict:
    """Words wanted of each source. Sources by code point, null last, take the weights in turn; a target
    stops at ``most`` times the source's size and the excess is shared by weight among the others."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left = share * (sum(sizes.values()) if total is None else total)
    out: dict = {}
    while True:
        open_ = [s for s in names if s not in out]
        scale = left / sum(weight[s] for s in open_) if open_ else 0.0
        over = [s for s in open_ if weight[s] * scale > most * sizes[s]]
        if not over:
            return out | {s: float(weight[s] * scale) for s in open_}
        for s in over:
            out[s] = float(most * sizes[s])
            left -= out[s]


def min_cost_flow(patterns: list[tuple[tuple, int]], quotas: dict, most: int = MOST) -> dict:
    """(pattern number, use, source) -> words. ``patterns``: (their sources, words). The k-th use of a word
    costs 2k - 1, which is convex. Cheapest augmenting paths, all of one cost at a time."""
    names = list(quotas)
    at = {s: 2 + len(patterns) + i for i, s in enumerate(names)}
    heads: list[list[int]] = [[] for _ in range(2 + len(patterns) + len(names))]
    to: list[int] = []
    room: list[int] = []
    cost: list[int] = []

    def arc(a, b, capacity, price):
        for x, y, c, p in ((a, b, capacity, price), (b, a, 0, -price)):
            heads[x].append(len(to))
            to.append(y), room.append(c), cost.append(p)
        return len(to) - 2

    begin, end = 0, 1
    uses, ways = {}, {}
    for i, (members, words) in enumerate(patterns):
        for k in range(most):
            uses[i, k] = arc(begin, 2 + i, words, 2 * k + 1)
        for s in members:
            ways[i, s] = arc(2 + i, at[s], most * words, 0)
    for s in names:
        arc(at[s], end, quotas[s], 0)

    while True:
        away = [1 << 60] * len(heads)
        away[begin] = 0
        queue, waiting = deque([begin]), {begin}
        while queue:
            a = queue.popleft()
            waiting.discard(a)
            for e in heads[a]:
                if room[e] and away[a] + cost[e] < away[to[e]]:
                    away[to[e]] = away[a] + cost[e]
                    if to[e] not in waiting:
                        queue.append(to[e])
                        waiting.add(to[e])
        if away[end] == 1 << 60:
            break
        pointer = [0] * len(heads)
        while True:  # paths along arcs that keep the distance, an explicit stack instead of recursion
            path, seen, a = [], {begin}, begin
            while a != end:
                while pointer[a] < len(heads[a]):
                    e = heads[a][pointer[a]]
                    if room[e] and to[e] not in seen and away[to[e]] == away[a] + cost[e]:
                        break
                    pointer[a] += 1
                else:
                    if not path:
                        break
                    back = path.pop()
                    seen.discard(a)
                    a = to[back ^ 1]
                    pointer[a] += 1
                    continue
                path.append(e)
                a = to[e]
                seen.add(a)
            if a != end:
                break
            many = min(room[e] for e in path)
            for e in path:
                room[e] -= many
                room[e ^ 1] += many

    flow: dict = {}
    for i, (members, _) in enumerate(patterns):
        left = [room[uses[i, k] ^ 1] for k in range(most)]
        k = 0
        for s in members:
            want = room[ways[i, s] ^ 1]
            while want:
                while not left[k]:
                    k += 1
                many = min(want, left[k])
                flow[i, k, s] = many
                left[k] -= many
                want -= many
    return flow


def many_targets(sources: DataFrame, weights: tuple, share: float, most: int) -> DataFrame:
    """``targets`` for any number of sources: sources(source, size) with target. Sources are ranked by ranges; a round
    adds up the open ones' weights and closes those whose share exceeds their limit, until none does."""
    rows = numbered(sources.select(F.lit("").alias("key"), F.col("source").isNull().alias("last"), "source", "size"), ["last", "source"])
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("pos") % len(weights) + 1).cast("int"))
    rows = table(rows.select("source", "size", "pos", weight.alias("weight"), F.lit(None).cast("double").alias("target")), "sources")
    while True:
        sums = rows.agg(F.sum("size").alias("all"), F.sum("target").alias("given"), F.sum(F.when(F.col("target").isNull(), F.col("weight"))).alias("open")).first()
        scale = max(0.0, share * sums["all"] - (sums["given"] or 0.0)) / sums["open"] if sums["open"] else 0.0
        own = F.col("weight") * F.lit(scale)
        over = F.col("target").isNull() & (own > most * F.col("size"))
        if not rows.filter(over).limit(1).count():
            return rows.withColumn("target", F.coalesce("target", own))
        rows = table(rows.withColumn("target", F.when(over, most * F.col("size").cast("double")).otherwise(F.col("target"))), "sources")


def stretches_of(base: DataFrame, weights: tuple, share: float, most: int) -> tuple[DataFrame, DataFrame]:
    """(name, pattern_id, use, buckets, ends: where the words of a pattern's use go; source, source_size, target)."""
    spark = base.sparkSession
    patterns = base.groupBy("name").agg(F.first("pattern").alias("pattern"), F.sum("size").alias("size"), F.count("*").alias("rows"))
    totals = patterns.limit(MOST_PATTERNS + 1).collect()
    shape = "name string, pattern_id long, use int, buckets int, ends array<long>"
    if len(totals) > MOST_PATTERNS:
        patterns = table(patterns, "patterns")
        overlapping = patterns.filter(F.size("pattern") > 1).limit(1).count()
        checked(totals if overlapping else [], MOST_PATTERNS, "patterns of overlapping sources")
        # sources of their own do not compete: each takes its words once, then again, which is the flow's answer
        goal = many_targets(patterns.select(F.element_at("pattern", 1).alias("source"), "size"), weights, share, most)
        named = goal.select(F.to_json(F.struct(F.array("source").alias("pattern"))).alias("name"), "source", "pos", "target")
        quota, size = F.round("target").cast("long"), F.col("size")
        words = F.explode(F.array(*[F.struct(F.lit(k).alias("use"), F.least(size, F.greatest(quota - k * size, F.lit(0))).alias("words")) for k in range(most)])).alias("x")
        buckets = F.least(F.greatest(F.floor(F.col("rows") / BUCKET_ROWS), F.lit(1)), F.lit(MOST_BUCKETS)).cast("int")
        laid = patterns.join(named, "name").select("name", F.col("pos").alias("pattern_id"), buckets.alias("buckets"), words).filter("x.words > 0")
        found = laid.select("name", "pattern_id", F.col("x.use").alias("use"), "buckets", F.array("x.words").alias("ends"))
        return found, goal.select("source", F.col("size").alias("source_size"), "target")

    totals = sorted(totals, key=lambda r: r["name"])
    sizes: dict = defaultdict(int)
    for r in totals:
        for s in r["pattern"]:
            sizes[s] += r["size"]
    goal = targets(dict(sizes), weights, share, most, sum(r["size"] for r in totals))
    flow = min_cost_flow([(tuple(r["pattern"]), r["size"]) for r in totals], {s: round(t) for s, t in goal.items()}, most)
    stretches: dict = defaultdict(list)
    for (i, k, s), words in flow.items():
        stretches[i, k].append((s, words))

    rows = []
    for (i, k), found in stretches.items():
        ends = np.cumsum([w for _, w in found]).tolist()
        buckets = int(min(max(totals[i]["rows"] // BUCKET_ROWS, 1), MOST_BUCKETS))
        rows.append((totals[i]["name"], i, k, buckets, ends))
    by_source = spark.createDataFrame([(s, sizes[s], goal[s]) for s in sizes], "source string, source_size long, target double")
    return F.broadcast(spark.createDataFrame(rows, shape)), F.broadcast(by_source)  # at most ``most`` rows a pattern, checked above


def planned(docs: DataFrame, sources: Column, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED, carry: bool = True) -> tuple[DataFrame, DataFrame]:
    """(documents as id, doc_id, pattern, size, taken, uses and, with ``carry``, the struct ``row``; source, source_size and
    target of each source). ``sources``: the array of a document's sources."""
    spark = docs.sparkSession
    ship(spark)
    pattern = F.array_sort(F.array_distinct(sources.cast("array<string>")))
    kept = [packed_row(docs).alias("row")] if carry else []
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), word_count(F.col("text")).alias("size"), pattern.alias("pattern"), F.monotonically_increasing_id().alias("id"),
                       F.xxhash64("text").alias("mark"), *kept)
    base = base.withColumn("name", F.to_json(F.struct("pattern")))
    base = table(base, "sized", compression="zstd")
    stretch, by_source = stretches_of(base, weights, share, most)

    # where each use of each document lies: a seeded number in [0, 1), another for each use; the text counts too, as
    # doc_ids may be null or repeat
    spot = F.pmod(F.xxhash64(F.lit(seed), F.col("use"), F.col("doc_id"), F.col("mark")), F.lit(1 << 40))
    laid = base.drop("row").filter("size > 0").join(stretch, "name").withColumn("spot", spot)
    laid = laid.withColumn("bucket", F.floor(F.col("spot") * F.col("buckets") / F.lit(float(1 << 40))).cast("int")).drop("name", "pattern", "buckets")
    sums = laid.groupBy("pattern_id", "use", "bucket").agg(F.sum("size").alias("words"), F.first("ends").alias("ends"))
    sums = sums.selectExpr("*", "sum(words) over (partition by pattern_id, use order by bucket) as hi")
    sums = sums.withColumn("lo", F.col("hi") - F.col("words"))
    sums = sums.withColumn("stretch", F.size(F.filter("ends", lambda e: e <= F.col("lo")))).filter(F.col("stretch") < F.size("ends"))
    sums = table(sums.withColumn("whole", F.col("hi") <= F.element_at("ends", F.col("stretch") + 1)).drop("words"), "buckets")
    placed = laid.drop("ends").join(sums, ["pattern_id", "use", "bucket"])

    def cross(group: pa.Table) -> pa.Table:
        """Documents of a bucket that a boundary crosses."""
        lo, hi, ends = (group.column(c)[0].as_py() for c in ("lo", "hi", "ends"))
        room = [max(0, min(e, hi) - max(b, lo)) for b, e in zip([0, *ends[:-1]], ends)]
        size, ids = group.column("size").to_numpy(), group.column("id").to_numpy()
        order = np.lexsort((ids, group.column("spot").to_numpy()))
        taken, to = [], []
        for i in order.tolist():
            for k, left in enumerate(room):
                if left >= size[i]:
                    room[k] -= int(size[i])
                    taken.append(i)
                    to.append(k)
                    break
        return pa.table({"id": pa.array(ids[taken], pa.int64()), "use": pa.array(group.column("use").to_numpy()[taken], pa.int32()), "stretch": pa.array(to, pa.int32())})

    crossed = placed.filter("not whole").select("pattern_id", "use", "bucket", "id", "spot", "size", "lo", "hi", "ends")
    chosen = placed.filter("whole").select("id", "use", "stretch").union(crossed.groupBy("pattern_id", "use", "bucket").applyInArrow(cross, "id long, use int, stretch int"))
    counted = chosen.groupBy("id").agg(F.count("*").alias("uses"))
    mixed = base.join(counted, "id", "left").withColumn("uses", F.coalesce("uses", F.lit(0))).withColumn("taken", F.col("size") * F.col("uses"))
    return mixed, by_source


def mix(docs: DataFrame, sources: Column, **options) -> tuple[DataFrame, dict, dict]:
    """``planned`` with the words and the target per source as dictionaries, for few sources."""
    mixed, by_source = planned(docs, sources, **options)
    found = checked(by_source.limit(MOST_PATTERNS + 1).collect(), MOST_PATTERNS, "sources")
    return mixed, {r["source"]: r["source_size"] for r in found}, {r["source"]: r["target"] for r in found}


def mixture_report(docs: DataFrame, **options) -> DataFrame:
    """One row per document of single sources: doc_id, size, source_size, target, taken."""
    mixed, by_source = planned(docs, F.array("source"), carry=False, **options)
    mixed = mixed.withColumn("source", F.element_at("pattern", 1))
    joined = mixed.alias("m").join(by_source.alias("s"), F.expr("m.source <=> s.source"))
    return joined.select("doc_id", "size", "source_size", "target", "taken")


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix, all columns kept; a document used twice comes twice."""
    mixed, _ = planned(docs, F.array("source"), **options)
    again = mixed.filter("uses > 0").withColumn("use", F.explode(F.sequence(F.lit(1), F.col("uses").cast("int"))))
    return again.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])

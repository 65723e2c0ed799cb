"""Quality by a naive Bayes support vector machine (operator 11).

A text's features say which n-grams it holds: runs of 1 to 3 bytes, single words and pairs of words, and runs of 1 to 3
forms, a word's form being what kinds of characters follow each other in it, or that it repeats the word before.
Each n-gram falls into one of ``BUCKETS`` slots by hash; a slot is held or not, however often.

The log-count ratio of a slot says how much more often good texts hold it than others,

    r = log((p + SMOOTH) / |p|_1) - log((q + SMOOTH) / |q|_1)

with p and q the numbers of good and other texts that hold it, over all labelled rows that may teach. Texts become
vectors of the ratios of the slots they hold, scaled to length one, and a linear model with hinge loss is fitted by dual
coordinate descent: one text's dual variable at a time takes its best value in [0, C], the weights following, until
no text's violation exceeds ``CLOSE``. Labels weigh alike in C however frequent they are.

The fit reads a bounded sample: of each label at most ``TRAIN_ROWS`` texts, those with the smallest hash of doc_id,
together at most ``TRAIN_SLOTS`` held slots. A quarter of it takes no part in the descent; on it a logistic curve,
weighted by how many rows of each label there are, turns margins into probabilities. Counting and scoring
cover every whole text, in parallel.

Defined results: a null or empty text has no feature and scores by the curve alone; without rows of one label every
score is 1 (all good), 0 (none good) or 0.5 (no label); labels that repeat a doc_id count once, as good if any row says
so; null doc_ids teach nothing; repeated rows score alike; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, slices, table, texts_of

BUCKETS = 1 << 18
SMOOTH = 1.0
C = 1.0
CLOSE = 0.01
MOST_ROUNDS = 200
TRAIN_ROWS = 3000
TRAIN_SLOTS = 20_000_000
CUT = 0.3

#: The six ASCII white-space bytes; kinds of bytes in a word's form.
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
KIND = np.arange(256, dtype=np.uint8)
KIND[48:58], KIND[65:91], KIND[97:123], KIND[128:] = 48, 65, 97, 97


def mixed(x: np.ndarray) -> np.ndarray:
    """Slots of 64-bit codes; only which n-grams share a slot depends on it."""
    x = x ^ (x >> np.uint64(29))
    return ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - (BUCKETS.bit_length() - 1))).astype(np.int64)


def runs_of(x: np.ndarray, ends: np.ndarray, most: int, kind: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(slots, last item) of all runs of 1 to ``most`` items that lie in one text. ``ends``: items before each text's
    end."""
    left = np.arange(len(x)) - np.repeat(np.concatenate(([0], ends[:-1])), np.diff(ends, prepend=0))
    code = np.full(len(x), kind, np.uint64)
    for n in range(1, most + 1):
        # the run that ends at an item, from the run one shorter that ends there and the item before that
        code = code * np.uint64(0x100000001B3) + np.concatenate((np.zeros(n - 1, np.uint64), x))[: len(x)]
        own = np.flatnonzero(left >= n - 1)
        yield mixed(code[own] + np.uint64(n << 60)), own


def words_in(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, hash of each word's form, words before each text's end) of texts laid end to end."""
    solid = ~SPACE[data]
    before = np.concatenate(([False], solid[:-1]))
    before[ends[:-1][ends[:-1] < len(data)]] = False  # a text's first byte follows nothing
    first = np.flatnonzero(solid & ~before)
    if not len(first):
        return np.empty(0, np.uint64), np.empty(0, np.uint64), np.zeros(len(ends), np.int64)
    number = np.cumsum(solid & ~before) - 1
    at = np.arange(len(data)) - first[np.maximum(number, 0)]
    weight = POWERS[at % len(POWERS)]

    def hashed(x: np.ndarray, held: np.ndarray, weight: np.ndarray) -> np.ndarray:
        # sums of odd powers times bytes, modulo 2**64
        return np.add.reduceat(np.where(held, (x.astype(np.uint64) + np.uint64(1)) * weight, np.uint64(0)), first)

    kind = KIND[data]
    new = solid & (~before | (kind != np.concatenate(([0], kind[:-1]))))
    nth = np.cumsum(new)
    nth = nth - nth[first][np.maximum(number, 0)]
    words, forms = hashed(data, solid, weight), hashed(kind, new, POWERS[nth % len(POWERS)])
    counts = np.searchsorted(first, ends, "left")
    again = np.concatenate(([False], words[1:] == words[:-1]))
    again[counts[:-1][counts[:-1] < len(words)]] = False
    return words, np.where(again, np.uint64(1), forms), counts


POWERS = np.cumprod(np.full(4096, 0x2545F4914F6CDD1D, np.uint64), dtype=np.uint64)


class Features:
    """The slots that texts hold."""

    def __init__(self):
        self.seen = np.zeros(BUCKETS, bool)

    def held(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The slots of each text, ascending."""
        data = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum([len(t) for t in texts])
        found = [[] for _ in texts]
        if len(data):
            words, forms, counts = words_in(data, ends)
            for x, stop, most, kind in ((data.astype(np.uint64), ends, 3, 1), (words, counts, 2, 2), (forms, counts, 3, 3)):
                for slots, last in runs_of(x, stop, most, kind):
                    cuts = np.searchsorted(last, stop, "left").tolist()
                    for own, a, b in zip(found, [0, *cuts], cuts):
                        own.append(slots[a:b])
        for own in found:
            for slots in own:
                self.seen[slots] = True
            got = np.flatnonzero(self.seen)
            self.seen[got] = False
            yield got


def ratios(good: np.ndarray, other: np.ndarray) -> np.ndarray:
    p, q = good + SMOOTH, other + SMOOTH
    return (np.log(p / p.sum()) - np.log(q / q.sum())).astype(np.float32)


def vector(slots: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """The values at a text's slots: their ratios, scaled to length one."""
    x = ratio[slots]
    length = float(np.sqrt(x @ x))
    return x / length if length else x


def descended(docs: list[np.ndarray], values: list[np.ndarray], sign: np.ndarray, cost: np.ndarray, seed: int = 3) -> tuple[np.ndarray, float, np.ndarray]:
    """(weights, offset, dual variables) of min |w|^2 / 2 + sum cost * max(0, 1 - sign * (w x + offset)), the offset being
    the weight of a feature that every text has with value one."""
    rng = np.random.default_rng(seed)
    w, offset, dual = np.zeros(BUCKETS), 0.0, np.zeros(len(docs))
    square = np.array([v @ v + 1.0 for v in values])
    for _ in range(MOST_ROUNDS):
        worst = 0.0
        for i in rng.permutation(len(docs)).tolist():
            slots, x, y = docs[i], values[i], sign[i]
            slope = y * (w[slots] @ x + offset) - 1.0
            if dual[i] <= 0:
                slope = min(slope, 0.0)
            elif dual[i] >= cost[i]:
                slope = max(slope, 0.0)
            worst = max(worst, abs(slope))
            if slope:
                old = dual[i]
                dual[i] = min(max(old - slope / square[i], 0.0), cost[i])
                w[slots] += (dual[i] - old) * y * x
                offset += (dual[i] - old) * y
        if worst <= CLOSE:
            break
    return w, offset, dual


def curve(margin: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of the weighted logistic curve of best likelihood, targets drawn in a little; by Newton's method."""
    n_good, n_other = (weight * good).sum(), (weight * ~good).sum()
    target = np.where(good, (n_good + 1) / (n_good + 2), 1 / (n_other + 2))
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    at = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        push = x.T @ (weight * (target - p)) - 1e-3 * at
        move = np.linalg.solve(bend, push)
        at = at + move / max(1.0, np.abs(move).max())
        if np.abs(move).max() < 1e-6:
            break
    return float(at[0]), float(at[1])


def held_out() -> Column:
    """Fixed rule: rows whose crc32 of the doc_id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def taught(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """A row per labelled text that may teach: good, order_ (hash of its doc_id), slots. Slots are kept of texts only
    whose hash is among about three times ``rows`` of their label; ``counted`` are all."""
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("quality") > 0).alias("good"))
    base = docs.filter(~held_out() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return base.join(known.hint("merge"), "doc_id").withColumn("order_", F.xxhash64("doc_id"))


def counted(teaching: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(slot, n_good, n_other) and (good, n): how many texts of each label hold each slot, and how many there are.
    A task sends at most ``BUCKETS`` rows, whatever it reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, hits, rows = Features(), np.zeros((2, BUCKETS), np.int64), [0, 0]
        for batch in slices(batches, limit=2 << 20):
            for slots, good in zip(features.held(texts_of(batch)), batch.column("good").to_pylist()):
                hits[int(good)][slots] += 1
                rows[int(good)] += 1
        own = np.flatnonzero(hits.any(axis=0))
        yield pa.RecordBatch.from_pydict({
            "slot": pa.array(np.concatenate((own, [-1]))), "n_good": pa.array(np.concatenate((hits[1][own], [rows[1]]))),
            "n_other": pa.array(np.concatenate((hits[0][own], [rows[0]]))),
        })

    found = map_batches(teaching.select("good", "text"), run, "slot long, n_good long, n_other long")
    return found.groupBy("slot").agg(F.sum("n_good").alias("n_good"), F.sum("n_other").alias("n_other"))


def drawn(teaching: DataFrame, sizes: dict[bool, int], rows: int, most: int) -> list:
    """The bounded sample: good, slots. Rows are thinned by the hash of their ids, to about three times as many as
    wanted, before they are ranked; copies of a text count once."""
    span = 1 << 40
    below = {good: min(span, span * 3 * rows // n) if n else 0 for good, n in sizes.items()}
    place = F.pmod(F.col("order_"), F.lit(span))
    thin = teaching.withColumn("order_", place).filter(F.col("order_") < F.when(F.col("good"), below[True]).otherwise(below[False]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in slices(batches, limit=2 << 20):
            slots = [x.astype(np.int32) for x in features.held(texts_of(batch))]
            yield pa.RecordBatch.from_pydict({
                "good": batch.column("good"), "order_": batch.column("order_"), "same": batch.column("same"),
                "size": pa.array([len(x) for x in slots], pa.int64()), "slots": pa.array([x.tobytes() for x in slots], pa.binary()),
            })

    shape = "good boolean, order_ long, same long, size long, slots binary"
    found = map_batches(thin.select("good", "text", "order_", F.xxhash64("text").alias("same")), run, shape)
    found = table(found, "nbsvm-sample")  # about 3 * rows of each label
    kept = found.select("good", "order_", "same", "size").groupBy("good", "same").agg(F.min_by("size", "order_").alias("size"), F.min("order_").alias("order_"))
    kept = kept.selectExpr("*", "row_number() over (partition by good order by order_, same) as nth_").filter(F.col("nth_") <= rows)
    kept = kept.selectExpr("good", "same", "order_", "sum(size) over (order by nth_, good) as held_").filter(F.col("held_") <= most)  # 2 * rows rows
    return found.join(F.broadcast(kept), ["good", "same", "order_"]).orderBy("order_", "good", "same").select("good", "same", "slots").collect()


def trained(docs: DataFrame, labels: DataFrame, rows: int, most: int) -> dict:
    """What scoring needs: weights by slot (the ratios within), ratios, offset and curve, or a fixed score."""
    teaching = table(taught(docs, labels, rows), "teaching", compression="zstd")
    found = counted(teaching).toArrow()  # at most ``BUCKETS`` + 1 rows
    slot, good, other = (found.column(c).to_numpy() for c in ("slot", "n_good", "n_other"))
    total = slot < 0
    sizes = {True: int(good[total].sum()), False: int(other[total].sum())}
    if not sizes[True] or not sizes[False]:
        return {"fixed": 1.0 if sizes[True] else 0.0 if sizes[False] else 0.5}
    hits = np.zeros((2, BUCKETS))
    hits[0][slot[~total]], hits[1][slot[~total]] = good[~total], other[~total]
    ratio = ratios(hits[0], hits[1])
    sample = list({(r["good"], r["same"]): r for r in drawn(teaching, sizes, rows, most)}.values())
    held = [np.frombuffer(r["slots"], np.int32) for r in sample]
    label = np.array([r["good"] for r in sample], bool)
    values = [vector(x, ratio) for x in held]
    apart = np.array([r["same"] % 4 == 0 for r in sample], bool)
    own = ~apart if label[~apart].any() and not label[~apart].all() else np.ones(len(label), bool)
    base = apart if label[apart].any() and not label[apart].all() else np.ones(len(label), bool)
    at = np.flatnonzero(own).tolist()
    share = np.where(label, label[own].mean(), 1 - label[own].mean())
    w, offset, _ = descended([held[i] for i in at], [values[i] for i in at], np.where(label, 1.0, -1.0)[own], (C / (2 * share))[own])
    margin = np.array([w[x] @ v + offset for x, v in zip(held, values)])
    weight = np.where(label, sizes[True] / label.sum(), sizes[False] / (~label).sum())
    return {"weights": (w * ratio).astype(np.float32), "squares": ratio * ratio, "offset": offset, "curve": curve(margin[base], label[base], weight[base])}


def score(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, most: int = TRAIN_SLOTS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    sent = docs.sparkSession.sparkContext.broadcast(trained(docs, labels, rows, most))  # two numbers a slot, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, features = sent.value, Features()
        for batch in slices(batches, limit=2 << 20):
            if "fixed" in model:
                value = np.full(batch.num_rows, model["fixed"])
            else:
                sums = np.array([(model["weights"][x].sum(dtype=np.float64), model["squares"][x].sum(dtype=np.float64)) for x in features.held(texts_of(batch))])
                slope, offset = model["curve"]
                margin = sums[:, 0] / np.sqrt(np.maximum(sums[:, 1], 1e-12)) + model["offset"]
                value = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                "score": pa.array(value), "predicted": pa.array((value >= CUT).astype(np.int32)),
            })

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return map_batches(base, run, "doc_id long, held_out boolean, score double, predicted int")

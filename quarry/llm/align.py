"""Alignment of two tokenizers by galloping intersection (operator 13).

Both tokenizers cut the same bytes, a space and the text, so a token is a range of bytes and its end a number. The
shorter of the two lists of ends drives: each of its ends gallops through the longer list, from where its share
of the way would put it, with steps that double until they enclose it, then by binary search (all ends of a
document at once). Ends found in both lists cut the tokens into groups. The ranks of a token's two ends differ by
the tokens of the other side that it overlaps, and lie where these stand.

Links are pairs of overlapping tokens. How many links of the whole corpus hold a pair of ids is counted over
slices of text: a slice (at most ``SLICE`` bytes) has one row per different pair, rows of a pair meet and are added
up, and the sums go back to the slices that asked, sorted as the slice's own pairs are, so a reader merges them as
they stream by. A frequent pair is one row per slice. Nothing is collected on the driver.

Defined results: texts that are null or empty, or whose tokens do not spell a space and the text (a U+2581 in it, say)
have no tokens, zeros and an empty groups_sha256; repeated rows align and count each; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, slices, table, texts_of
from .tokens import PieceEncoder, TextEncoder, byte_level_bytes, bytes_of, tokenizer_path
from .xent import opened, packed

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
SLICE = 1 << 20
#: Entries of a word cache; there are six of them in a worker.
CACHED = 100_000


def gallop(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each of the ascending ``values`` the number of ``ends`` below it."""
    if not len(values):
        return np.empty(0, np.int64)
    n = len(ends)
    held = np.concatenate(([-1], ends, [np.iinfo(np.int64).max]))  # always held[low] < value <= held[high] in the end
    low = np.arange(len(values), dtype=np.int64) * n // len(values)
    high, step = low + 1, 1
    left, right = np.flatnonzero(held[low] >= values), np.flatnonzero(held[high] < values)
    while len(left) or len(right):
        high[left], low[right] = low[left], high[right]
        low[left] = np.maximum(low[left] - step, 0)
        high[right] = np.minimum(high[right] + step, n + 1)
        left, right, step = left[held[low[left]] >= values[left]], right[held[high[right]] < values[right]], 2 * step
    wide = np.flatnonzero(high - low > 1)
    while len(wide):
        middle = (low[wide] + high[wide]) >> 1
        below = held[middle] < values[wide]
        low[wide[below]], high[wide[~below]] = middle[below], middle[~below]
        wide = wide[high[wide] - low[wide] > 1]
    return low  # places in ``held`` are one more


def intersected(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """From the ends of two token lists over the same bytes: (last token of each group in a, in b, a's token and b's
    token of each link)."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    rank = gallop(short, long)
    common = long[rank] == short  # the last end is common, so every rank is a place
    first = np.concatenate(([0], (rank + common)[:-1]))
    many = rank - first + 1
    one = np.repeat(np.arange(len(short)), many)
    other = np.arange(len(one)) - np.repeat(np.cumsum(many) - many - first, many)
    cut = np.flatnonzero(common)
    return (cut, rank[cut], one, other) if short is a else (rank[cut], cut, other, one)


class Aligner:
    """The two tokenizers and what their ids stand for."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = TextEncoder(path_a, "spaced", CACHED, plain_added=True), PieceEncoder(path_b, CACHED)
        bytes_a, bytes_b = byte_level_bytes(path_a), self.b.token_bytes()
        self.n_b = len(bytes_b)
        self.spelt = tuple(pa.array(x, pa.binary()) for x in (bytes_a, bytes_b))
        self.sizes = tuple(np.array([len(t) for t in x], np.int64) for x in (bytes_a, bytes_b))
        # an id and what follows it: another of its side, or the end of the group there
        self.marks = pa.array([b"%d%c" % (i, c) for i in range(len(bytes_a)) for c in b",|"] + [b"%d%c" % (i, c) for i in range(self.n_b) for c in b",;"], pa.binary())
        self.shift = 2 * len(bytes_a)

    def tokens(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of each text on both sides, none where they do not spell it."""
        sides = []
        for found, spelt in ((self.a.many([b" " + t for t in texts]), self.spelt[0]), (self.b.many(texts), self.spelt[1])):
            ends = np.cumsum([0, *(len(x) // 4 for x in found)])
            flat = np.frombuffer(b"".join(found), "<u4")
            sides.append((flat, ends, bytes_of(spelt.take(pa.array(flat)), ends)))
        (a, a_ends, a_said), (b, b_ends, b_said) = sides
        none = np.empty(0, np.uint32)
        for i, text in enumerate(texts):
            if text and a_said[i] == b_said[i] == b" " + text:
                yield a[a_ends[i] : a_ends[i + 1]], b[b_ends[i] : b_ends[i + 1]]
            else:
                yield none, none

    def aligned(self, a: np.ndarray, b: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
        """(groups, their spelling as places in ``marks``, the pair of ids of each link)."""
        if not len(a):
            return 0, np.empty(0, np.int64), np.empty(0, np.int64)
        last_a, last_b, one, other = intersected(np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b]))
        pairs = a[one].astype(np.int64) * self.n_b + b[other]
        mark_a, mark_b = 2 * a.astype(np.int64), 2 * b.astype(np.int64) + self.shift
        mark_a[last_a] += 1
        mark_b[last_b] += 1
        spelling = np.empty(len(a) + len(b), np.int64)
        spelling[np.arange(len(a)) + np.repeat(np.concatenate(([0], last_b[:-1] + 1)), np.diff(last_a, prepend=-1))] = mark_a
        spelling[np.arange(len(b)) + np.repeat(last_a + 1, np.diff(last_b, prepend=-1))] = mark_b
        return len(last_a), spelling, pairs

    def spell(self, spellings: list[np.ndarray]) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each document."""
        ends = np.cumsum([0, *map(len, spellings)])
        return [x[:-1] for x in bytes_of(self.marks.take(pa.array(np.concatenate(spellings))), ends)]


_OPEN: dict = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One per worker process."""
    if (path_a, path_b) not in _OPEN:
        _OPEN[path_a, path_b] = Aligner(path_a, path_b)
    return _OPEN[path_a, path_b]


def sliced(docs: DataFrame, path_a: str, path_b: str, limit: int) -> DataFrame:
    """A row per slice: its documents with all that they say by themselves, the different pairs of its links, sorted,
    how often each is there, and the links as places among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, both = TaskContext.get().partitionId(), 0, aligner(path_a, path_b)
        for batch in slices(batches, limit=limit):
            n_a, n_b, n_groups, spellings, links = [], [], [], [], []
            for a, b in both.tokens(texts_of(batch)):
                groups, spelling, pairs = both.aligned(a, b)
                n_a.append(len(a)), n_b.append(len(b)), n_groups.append(groups), spellings.append(spelling), links.append(pairs)
            pairs, code, many = np.unique(np.concatenate(links), return_inverse=True, return_counts=True)
            said = [sha256(x).digest() if x else b"" for x in both.spell(spellings)]
            body = packed(batch.column("doc_id").to_pylist(), n_a, n_b, n_groups, [len(x) for x in links], said, code.astype(np.uint32))
            yield pa.RecordBatch.from_pydict({
                "slice": pa.array([part << 32 | number], pa.int64()), "pairs": pa.array([pairs], pa.list_(pa.int64())),
                "many": pa.array([many], pa.list_(pa.int64())), "body": pa.array([body], pa.binary()),
            })
            number += 1

    shape = "slice long, pairs array<long>, many array<long>, body binary"
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return table(map_batches(source, run, shape), "aligned")


def pair_counts(cut: DataFrame, n_b: int) -> tuple[DataFrame, DataFrame]:
    """((slice, pair): what each slice asks, (pair, total, best): how many links hold it, whether none of its second id's
    pairs is in more)."""
    asked = cut.select("slice", F.explode(F.arrays_zip("pairs", "many")).alias("x")).select("slice", "x.pairs", "x.many")
    totals = asked.groupBy("pairs").agg(F.sum("many").alias("total"))
    totals = table(totals, "pair-totals")
    most = totals.groupBy((F.col("pairs") % n_b).alias("b")).agg(F.max("total").alias("most"))
    judged = totals.withColumn("b", F.col("pairs") % n_b).join(most, "b").select("pairs", "total", (F.col("total") == F.col("most")).alias("best"))
    return asked.select("slice", "pairs"), judged


def streamed(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[bytes, list[np.ndarray]]]:
    """Rows sorted by slice, a slice's own row (``body`` is not null) before its answers: (that body, the answers'
    columns) of each slice in turn."""
    head, held = None, []

    def joined() -> list[np.ndarray]:
        return [np.concatenate(x) for x in zip(*held)] if held else [np.empty(0)] * len(columns)

    for batch in batches:
        answers, at = [batch.column(c) for c in columns], 0
        heads = np.flatnonzero(batch.column("body").is_valid().to_numpy(zero_copy_only=False)).tolist()
        for place in [*heads, batch.num_rows]:
            if at < place:
                held.append([x.slice(at, place - at).to_numpy(zero_copy_only=False) for x in answers])
            if place < batch.num_rows:
                if head is not None:
                    yield head, joined()
                head, held = batch.column("body")[place].as_py(), []
            at = place + 1
    if head is not None:
        yield head, joined()


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, limit: int = SLICE) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. ``limit``: bytes of
    text in a slice."""
    path_a, path_b = path_a or tokenizer_path(TOKENIZER_A), path_b or tokenizer_path(TOKENIZER_B)
    cut = sliced(docs, path_a, path_b, limit)
    asked, judged = pair_counts(cut, aligner(path_a, path_b).n_b)
    answers = asked.join(judged.hint("merge"), "pairs")
    whole = cut.drop("pairs", "many").unionByName(answers, allowMissingColumns=True)
    whole = whole.repartition("slice").sortWithinPartitions("slice", F.col("pairs").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for head, (total, best) in streamed(batches, ["total", "best"]):
            doc_ids, n_a, n_b, n_groups, n_links, said, code = opened(head)
            ends = np.cumsum([0, *n_links])
            sums = [np.concatenate(([0], np.cumsum(x.astype(np.int64)[code]))) if len(code) else np.zeros(1, np.int64) for x in (best, total)]
            n_best, count_sum = (x[ends[1:]] - x[ends[:-1]] for x in sums)
            own = zip(("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"), (doc_ids, n_a, n_b, n_groups, n_links, n_best, count_sum))
            yield pa.RecordBatch.from_pydict({**{c: pa.array(x, pa.int64()) for c, x in own}, "groups_sha256": pa.array([x.hex() for x in said], pa.string())})

    return map_batches(whole, run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")

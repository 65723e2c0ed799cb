"""Language-model scoring by cross-entropy difference (operator 8).

Two bigram models, one of the target texts and one of all texts (the background), are matched: one vocabulary
of real words, one smoothing, and background counts scaled to the target's number of tokens, so that both weigh
the prior alike. With counts c and word shares p(w), for every token w after v

    p(w | v) = (c(v, w) + PRIOR * p(w)) / (c(v) + PRIOR),    p(w) = (c(w) + ADD) / (n + ADD * V)

and a document's score is the mean of loss_target - loss_background over its tokens: below zero it reads
like the target.

Counts cover all documents and are exact: keys are the words themselves and pairs of words, without a limit to
their number. Texts become slices of at most ``SLICE`` bytes, each with its own sorted vocabulary. A slice asks
for the counts of its distinct words and pairs: its keys, with its own counts, go to buckets by hash, a bucket
adds up what equal keys have, compared byte by byte, and answers every slice in the order in which it asked. So
a frequent word or pair is one key a slice, wherever it stands. Buckets grow in number with the corpus
(``BUCKET_BYTES`` of text each), so neither a bucket nor a slice outgrows a task, and nothing but totals reaches
the driver. V is the number of different words, at least ``LEAST_SLOTS``, which leaves a small corpus room for
words that it does not show.

Defined results: a token is a run of bytes other than ASCII white space and punctuation, A-Z lower-cased; a
null, empty or wordless text has n_tokens 0 and score 0; without target texts or without labels both models
are alike but for counts, so scores are finite; labels that repeat a doc_id count once, as target if any row
says so; null doc_ids are never target; repeated rows count and score each; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from itertools import groupby
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, slices, table, texts_of

SLICE = 8 << 20
BUCKET_BYTES = 4 << 20
LEAST_BUCKETS = 64
LEAST_SLOTS = 1 << 16
PRIOR = 20.0
ADD = 0.1
#: ASCII white space and punctuation separate tokens; A-Z become a-z.
SPACED = bytes(32 if b < 128 and not chr(b).isalnum() else b + 32 if 65 <= b <= 90 else b for b in range(256))


def packed(*values) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(values, protocol=5))


def opened(data: bytes) -> tuple:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))


def pair_slots(before: np.ndarray, words: np.ndarray, slots: int) -> np.ndarray:
    """The bucket of each pair of word hashes; only where a key is counted depends on it."""
    mixed = (before * np.uint32(0x9E3779B1)) ^ words  # any odd multiplier serves
    mixed ^= mixed >> np.uint32(15)
    return (mixed * np.uint32(0x85EBCA77)) >> np.uint32(32 - (slots.bit_length() - 1))


def buckets_for(docs: DataFrame) -> int:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(LEAST_BUCKETS, 1 << max(0, size // BUCKET_BYTES - 1).bit_length())


def sliced(docs: DataFrame) -> DataFrame:
    """(slice, n_all, n_target, body) from (doc_id, text, target). ``body``: doc_ids, targets, tokens of each
    document, the sorted vocabulary and the tokens as numbers in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in slices(batches, limit=SLICE):
            lists = pc.ascii_split_whitespace(pa.array([t.translate(SPACED).strip() for t in texts_of(batch)], pa.binary()).view(pa.string()))
            words = lists.values.view(pa.binary())
            some = pc.not_equal(pc.binary_length(words), 0)  # an empty text splits into one empty word
            sizes = np.diff(np.concatenate(([0], np.cumsum(some.to_numpy(zero_copy_only=False))))[lists.offsets.to_numpy()])
            coded = words.filter(some).dictionary_encode()
            order = pc.array_sort_indices(coded.dictionary).to_numpy()
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order), dtype=np.int32)
            target = np.array(batch.column("target").to_pylist(), bool)
            body = packed(batch.column("doc_id").to_pylist(), target, sizes, coded.dictionary.take(pa.array(order)).to_pylist(), rank[coded.indices.to_numpy()])
            yield pa.RecordBatch.from_pydict({
                "slice": pa.array([part << 32 | number], pa.int64()), "n_all": pa.array([int(sizes.sum())], pa.int64()),
                "n_target": pa.array([int(sizes[target].sum())], pa.int64()), "body": pa.array([body], pa.binary()),
            })
            number += 1

    return table(map_batches(docs.select("doc_id", "text", "target"), run, "slice long, n_all long, n_target long, body binary"), "slices")


def keys_of(sizes: np.ndarray, vocabulary: list[bytes], ids: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The keys of a slice are its words, then its distinct pairs: (pairs as before * words + word, the pair of
    every token or -1 for a document's first, the keys in order of their buckets, ends of the buckets)."""
    n = len(vocabulary)
    pair = np.empty(len(ids), np.int64)
    pair[1:] = ids[:-1].astype(np.int64) * n + ids[1:]
    pair[(np.cumsum(sizes) - sizes)[sizes > 0]] = -1
    pairs, code = np.unique(pair, return_inverse=True)
    skip = int(len(pairs) > 0)  # a slice with tokens has a first one
    pairs, code = pairs[skip:], code - skip
    hashed = np.fromiter(map(crc32, vocabulary), np.uint32, n)
    bucket = np.concatenate([pair_slots(np.zeros(n, np.uint32), hashed, buckets), pair_slots(hashed[pairs // max(1, n)], hashed[pairs % max(1, n)], buckets)])
    return pairs, code, np.argsort(bucket, kind="stable"), np.cumsum(np.bincount(bucket, minlength=buckets))


def answered(asking: DataFrame, buckets: int) -> DataFrame:
    """(slice, bucket, fresh, body): the counts over all slices, (target, background), of the slice's keys in that
    bucket; ``fresh`` adds up to the number of different words."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column("slice").to_pylist(), batch.column("body")):
                _, target, sizes, vocabulary, ids = opened(data.as_buffer())
                n, own = len(vocabulary), np.repeat(target, sizes)
                pairs, code, order, ends = keys_of(sizes, vocabulary, ids, buckets)
                words = pa.array(vocabulary, pa.binary())
                both = pc.binary_join_element_wise(words.take(pa.array(pairs // max(1, n))), words.take(pa.array(pairs % max(1, n))), b" ")
                keys = pa.concat_arrays([words, both]).take(pa.array(order))
                inside = code >= 0
                found = [np.concatenate([np.bincount(ids[m], minlength=n), np.bincount(code[m & inside], minlength=len(pairs))])[order].astype(np.uint32) for m in (own, np.ones(len(ids), bool))]
                offsets = np.frombuffer(keys.buffers()[1], np.int32, len(keys) + 1, keys.offset * 4) if len(keys) else np.zeros(1, np.int32)
                text = keys.buffers()[2]
                numbers, bodies, a = [], [], 0
                for k, b in enumerate(ends.tolist()):
                    if a < b:
                        numbers.append(k)
                        bodies.append(packed(np.diff(offsets[a : b + 1]), bytes(text[offsets[a] : offsets[b]]), found[0][a:b], found[1][a:b]))
                    a = b
                yield pa.RecordBatch.from_pydict({"slice": pa.array([name] * len(numbers), pa.int64()), "bucket": pa.array(numbers, pa.int32()), "body": pa.array(bodies, pa.binary())})

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes]]:
        for batch in batches:
            yield from zip(batch.column("bucket").to_pylist(), batch.column("slice").to_pylist(), batch.column("body"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, group in groupby(rows(batches), key=lambda r: r[0]):
            names, lengths, texts, target, every = [], [], [], [], []
            for _, name, data in group:
                length, text, t, e = opened(data.as_buffer())
                names.append(name), lengths.append(length), texts.append(text), target.append(t), every.append(e)
            offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths), dtype=np.int64)])
            keys = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(texts))])
            coded = keys.dictionary_encode()
            code, fresh = coded.indices.to_numpy(), pc.sum(pc.equal(pc.find_substring(coded.dictionary, pattern=b" "), -1)).as_py()
            del keys, texts, coded
            sums = [np.bincount(code, np.concatenate(x)).astype(np.int64)[code] for x in (target, every)]
            ends = np.cumsum([len(x) for x in lengths])
            bodies = [packed(*(x[b - len(one) : b] for x in sums)) for b, one in zip(ends.tolist(), lengths)]
            many = len(names)
            yield pa.RecordBatch.from_pydict({
                "slice": pa.array(names, pa.int64()), "bucket": pa.array([bucket] * many, pa.int32()),
                "fresh": pa.array([fresh] + [0] * (many - 1), pa.int64()), "body": pa.array(bodies, pa.binary()),
            })

    asked = map_batches(asking, ask, "slice long, bucket int, body binary").repartition("bucket").sortWithinPartitions("bucket")
    return table(map_batches(asked, add, "slice long, bucket int, fresh long, body binary"), "counts")


def losses(w: np.ndarray, v: np.ndarray, both: np.ndarray, totals: np.ndarray, vocabulary: int) -> np.ndarray:
    """-log p of every token under (target, background), from the counts of words, words before and pairs."""
    scale = np.array([1.0, totals[0] / totals[1] if totals[0] and totals[1] else 1.0])
    share = (w * scale + ADD) / (totals * scale + ADD * vocabulary)
    return -np.log((both * scale + PRIOR * share) / (v * scale + PRIOR))


def score(docs: DataFrame, target: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_tokens, target_loss, background_loss (means), score.
    ``target``: the doc_ids of the target texts."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    wanted = target.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().withColumn("target", F.lit(True))
    buckets = buckets_for(base)
    # texts meet their flag by a shuffle at every size, as labels grow with the corpus
    cut = sliced(base.join(wanted.hint("merge"), "doc_id", "left").withColumn("target", F.coalesce("target", F.lit(False))))
    counts = answered(cut.select("slice", "body"), buckets)
    sums = cut.agg(F.sum("n_target"), F.sum("n_all")).first()
    totals = np.array([sums[0] or 0, sums[1] or 0], float)
    different = max(LEAST_SLOTS, counts.agg(F.sum("fresh")).first()[0] or 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, answers in zip(batch.column("body"), batch.column("answers")):  # one slice at a time
                doc_ids, _, sizes, vocabulary, ids = opened(data.as_buffer())
                n = len(vocabulary)
                pairs, code, order, _ = keys_of(sizes, vocabulary, ids, buckets)
                found = np.zeros((n + len(pairs), 2))
                if len(found):
                    parts = [opened(a["body"]) for a in sorted(answers.as_py(), key=lambda a: a["bucket"])]
                    found[order] = np.stack([np.concatenate(x) for x in zip(*parts)], axis=1)
                # a document's first token has no word before it: it weighs like the prior
                inside = (code >= 0)[:, None]
                before = np.concatenate([ids[:1], ids[:-1]])
                loss = losses(found[ids], np.where(inside, found[before], 0), np.where(inside, found[n + np.maximum(code, 0)] if len(pairs) else 0.0, 0), totals, different)
                ends = np.cumsum(sizes)
                added = np.vstack([np.zeros((1, 2)), np.cumsum(loss, axis=0)])
                mean = (added[ends] - added[ends - sizes]) / np.maximum(sizes, 1)[:, None]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(doc_ids, pa.int64()), "n_tokens": pa.array(sizes), "target_loss": pa.array(mean[:, 0]),
                    "background_loss": pa.array(mean[:, 1]), "score": pa.array(mean[:, 0] - mean[:, 1]),
                })

    replies = counts.groupBy("slice").agg(F.collect_list(F.struct("bucket", "body")).alias("answers"))  # at most the keys of one slice
    whole = cut.select("slice", "body").join(replies.hint("merge"), "slice", "left").select("body", "answers")
    return map_batches(whole, run, "doc_id long, n_tokens long, target_loss double, background_loss double, score double")

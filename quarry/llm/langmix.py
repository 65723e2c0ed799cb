"""Language identification by multilingual mixture inference (operator 6).

Each language has a smoothed distribution over hashed n-grams of letters (bytes of the lower-cased text;
everything that is no letter separates words). A document is a bag of n-grams drawn from a mixture of
languages: expectation-maximisation estimates the proportions, starting from all learned languages.

The language set is chosen by penalised likelihood: as long as leaving out the least used language and
re-estimating costs less likelihood than ``PENALTY`` * log(number of n-grams) for a parameter saved, it is
left out. A document whose full mixture cannot beat its best single language by one such penalty needs no
search, because no smaller set can beat the full one.

Training reads a bounded sample: of each label ``TRAIN_ROWS`` different texts with the smallest hashes.
Labels with fewer use all. Everything else runs over every whole text.

Defined results: null texts, empty texts and texts without a letter are ``und`` with score 0; the score is
the proportion of the predicted language; ties go to the label first in code-point order; without any
learned label every document is ``und``; repeated rows get equal results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checked, few_of_each, map_batches, packed_row, slices

UNKNOWN = "und"
BUCKETS = 1 << 13
ORDER = 3
SMOOTHING = 0.5
PENALTY = 12.0
ROUNDS = 12
TRAIN_ROWS = 2000
MOST_LANGUAGES = 500
CHUNK = 192
#: Evidence against all learned languages from which a text is held to be in none of them.
DOUBT = 10.0
SLACK = 1.0


def letters(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all lower-cased texts with non-letters as spaces; start of each and end). Bytes over 127
    count as letters here."""
    lowered = pc.utf8_lower(pc.fill_null(text, ""))
    kept = lowered.cast(pa.large_binary())
    offsets = np.frombuffer(kept.buffers()[1], np.int64, len(kept) + 1, kept.offset * 8)
    data = np.frombuffer(kept.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if kept.buffers()[2] else np.empty(0, np.uint8)
    return LETTER[data], offsets - offsets[0]


LETTER = np.full(256, 32, np.uint8)
LETTER[97:123] = np.arange(97, 123)
LETTER[128:] = np.arange(128, 256)


def counts(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket, count) of the n-grams of every document; an n-gram of one document never spans
    two, and one that ends at a space after a space is no n-gram."""
    n = len(starts) - 1
    wide = data.astype(np.uint32)
    code = wide.copy()
    for k in range(1, ORDER):
        code[k:] += wide[:-k] << np.uint32(8 * k)
    code[1:][(data[1:] == 32) & (data[:-1] == 32)] = 0
    doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(starts))
    valid = code != 0
    for k in range(ORDER - 1):
        at = starts[:-1] + k
        valid[at[at < len(data)]] = False
    bucket = ((code * np.uint32(2654435769)) >> np.uint32(32 - 13)).astype(np.int64)
    found = np.bincount(doc[valid] * BUCKETS + bucket[valid], minlength=n * BUCKETS)
    key = np.flatnonzero(found)
    return key // BUCKETS, key % BUCKETS, found[key].astype(np.float32)


def has_letter(texts: pa.Array, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    ascii_letter, high = (data >= 97) & (data < 123), data >= 128
    first = lambda mask: np.add.reduceat(np.append(mask, False), starts[:-1]) * (np.diff(starts) > 0) > 0
    some, other = first(ascii_letter), first(high)
    for i in np.flatnonzero(~some & other).tolist():
        some[i] = any(c.isalpha() for c in texts[i].as_py())
    return some


def proportions(doc: np.ndarray, bucket: np.ndarray, count: np.ndarray, n: int, model: np.ndarray) -> np.ndarray:
    """Language proportions of ``n`` documents over the chosen sets. ``model``: log-probabilities,
    buckets x languages."""
    languages = model.shape[1]
    weights = np.zeros((n, languages), np.float32)
    if not len(doc):
        return weights
    start = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    own = doc[start]
    logs = model[bucket]
    total = np.add.reduceat(count, start)
    # one language explains each n-gram with at most its best probability, so scale by that
    top = logs.max(axis=1, keepdims=True)
    likely = np.exp(logs - top)
    row = np.repeat(np.arange(len(own)), np.diff(np.r_[start, len(doc)]))
    single = np.add.reduceat((logs - top) * count[:, None], start, axis=0)

    def fit(w, active, rounds=ROUNDS):
        """EM on the documents ``active`` (a mask); returns weights and likelihoods of these."""
        take = active[row]
        r = np.cumsum(active)[row[take]] - 1
        p, c = likely[take], count[take]
        s = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
        m = total[active][:, None]
        w = w[active]
        for _ in range(rounds):
            joint = p * w[r]
            joint *= (c / np.maximum(joint.sum(axis=1), 1e-30))[:, None]
            w = np.add.reduceat(joint, s, axis=0) / m
        mixed = np.log(np.maximum((p * w[r]).sum(axis=1), 1e-30)) * c
        return w, np.add.reduceat(mixed, s)

    best_one = single.argmax(axis=1)
    cost = PENALTY * np.log(np.maximum(total, 2))
    w = np.zeros((len(own), languages), np.float32)
    w[np.arange(len(own)), best_one] = 1
    # the best bound for a mixture: every n-gram explained by its likeliest language (log 1 after scaling)
    search = (0 - single.max(axis=1) > cost) & (languages > 1)
    if search.any():
        full, score = fit(np.full((len(own), languages), 1 / languages, np.float32), search)
        better = score - single.max(axis=1)[search] > cost[search]
        at = np.flatnonzero(search)[better]
        current, now = full[better], score[better]
        left = np.ones(len(at), bool)
        while left.any():
            who = np.flatnonzero(left)
            trial = current[who].copy()
            used = (trial > 0).sum(axis=1)
            left[who[used <= 1]] = False
            who, trial = who[used > 1], trial[used > 1]
            if not len(who):
                break
            trial[np.arange(len(who)), np.where(trial > 0, trial, 2).argmin(axis=1)] = 0
            trial /= np.maximum(trial.sum(axis=1, keepdims=True), 1e-30)
            whole = np.zeros_like(w)
            whole[at[who]] = trial
            mask = np.zeros(len(own), bool)
            mask[at[who]] = True
            fitted, lower = fit(whole, mask)
            good = now[who] - lower <= cost[at[who]]
            current[who[good]], now[who[good]] = fitted[good], lower[good]
            left[who[~good]] = False
        w[at] = current
    weights[own] = w
    return weights


def evidence(doc: np.ndarray, bucket: np.ndarray, count: np.ndarray, weights: np.ndarray, model: np.ndarray) -> np.ndarray:
    """How much likelier, as a logarithm, each document's n-grams are under its mixture of languages than under a
    background in which all n-grams are alike, which is handicapped by ``SLACK`` an n-gram."""
    mixed = np.log(np.maximum((np.exp(model[bucket]) * weights[doc]).sum(axis=1), 1e-30)) + np.log(BUCKETS) + SLACK
    return np.bincount(doc, mixed * count, len(weights))


def trained(rows: DataFrame, train_rows: int) -> tuple[list[str], np.ndarray]:
    """(labels, log-probabilities) from the columns text and lang."""
    sample = few_of_each(rows, "lang", train_rows, MOST_LANGUAGES).select("lang", "text").repartition("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in slices(batches, limit=1 << 20):
            for part in (batch.slice(i, CHUNK) for i in range(0, batch.num_rows, CHUNK)):
                data, starts = letters(part.column("text"))
                doc, bucket, count = counts(data, starts)
                names = np.array(part.column("lang").to_pylist(), object)
                for name in set(names):
                    own = (names == name)[doc]
                    sums[name] = sums.get(name, 0) + np.bincount(bucket[own], count[own], BUCKETS)
        for name, found in sums.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(at), pa.string()), "bucket": pa.array(at), "n": pa.array(found[at].astype(np.float64))})

    grams = map_batches(sample, run, "lang string, bucket long, n double").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = checked(grams.limit(MOST_LANGUAGES * BUCKETS + 1).collect(), MOST_LANGUAGES * BUCKETS, "counts of n-grams")
    labels = sorted({r["lang"] for r in found})
    model = np.full((BUCKETS, max(1, len(labels))), SMOOTHING)
    at = {x: i for i, x in enumerate(labels)}
    for r in found:
        model[r["bucket"], at[r["lang"]]] += r["n"]
    return labels, np.log(model / model.sum(axis=0)).astype(np.float32)


def detect(docs: DataFrame, labels: list[str], model: np.ndarray, kept: dict[str, Column]) -> DataFrame:
    """``kept`` columns of every row, lang_pred, score and evidence (see ``evidence``; 0 without letters)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=1 << 20):
            for part in (batch.slice(i, CHUNK) for i in range(0, batch.num_rows, CHUNK)):
                text = part.column("text_")
                data, starts = letters(text)
                found = counts(data, starts)
                w = proportions(*found, part.num_rows, model)
                best = w.argmax(axis=1)
                score = w[np.arange(len(best)), best].astype(float)
                known = has_letter(text, data, starts) & bool(labels)
                none = known & (score == 0)  # letters, but fewer than an n-gram: the languages are alike
                names = [labels[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())]
                score = np.where(known, np.where(none, 1 / max(1, len(labels)), np.minimum(score, 1.0)), 0.0)
                shown = np.where(known, evidence(*found, w, model), 0.0)
                own = [c for c in part.schema.names if c != "text_"]
                columns = [*(part.column(c) for c in own), pa.array(names, pa.string()), pa.array(score), pa.array(shown)]
                yield pa.RecordBatch.from_arrays(columns, [*own, "lang_pred", "score", "evidence"])

    source = docs.select(*[c.alias(k) for k, c in kept.items()], F.col("text").alias("text_"))
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "text_")
    return map_batches(source, run, f"{shape}, lang_pred string, score double, evidence double")


def held_out() -> Column:
    """Fixed rule: rows whose crc32 of the doc_id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    labels, model = trained(docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text"), train_rows)
    return detect(docs, labels, model, {"doc_id": F.col("doc_id").cast("long"), "held_out": held_out()})


def recognised(docs: DataFrame, doubt: float = DOUBT, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows whose text reads like the learned languages, one or several, all columns kept. Texts without letters
    go, and texts whose n-grams a background in which all are alike explains better by ``doubt`` (a logarithm) than the best
    mixture of languages: other languages and noise. A few letters are no such evidence."""
    labels, model = trained(docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text"), train_rows)
    seen = detect(docs, labels, model, {"row": packed_row(docs)})
    kept = seen.filter((F.col("lang_pred") != UNKNOWN) & (F.col("evidence") >= -doubt))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])

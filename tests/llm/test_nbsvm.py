"""The quality classifier: features by brute force, the fit by its duality gap, scores on held-out rows."""

import random
import re
from zlib import crc32

import numpy as np
import pytest

from quarry.llm import nbsvm

from .conftest import ALL_IDS, ids

WORDS = ["the", "of", "eand", "thand", "étoile", "12", "a.b", "Th"]


def texts_of(seed, n=40):
    rng = random.Random(seed)
    return ["".join(rng.choice([*WORDS, " ", " ", "\n", "  ", "\t", "!!", "%%%", "日"]) for _ in range(rng.randrange(0, 25))).encode() for _ in range(n)]


def form(word):
    kinds = [int(nbsvm.KIND[b]) for b in word]
    return tuple(k for k, before in zip(kinds, [None, *kinds]) if k != before)


def brute(text):
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", text) if w]
    forms = ["again" if i and words[i - 1] == w else form(w) for i, w in enumerate(words)]
    grams = lambda kind, x, most: {(kind, tuple(x[i : i + n])) for n in range(1, most + 1) for i in range(len(x) - n + 1)}
    return grams("bytes", list(text), 3) | grams("words", words, 2) | grams("forms", forms, 3)


@pytest.mark.parametrize("seed", range(4))
def test_features_are_the_different_n_grams_of_each_text(seed):
    texts = [b"", *texts_of(seed), b"", b"one"]
    found = list(nbsvm.Features().held(texts))
    known: dict = {}
    for text, slots in zip(texts, found):
        grams = brute(text)
        assert len(grams) - 6 <= len(slots) <= len(grams)  # a few n-grams may share a slot
        assert slots.tolist() == next(nbsvm.Features().held([text])).tolist()  # neighbours do not matter
        for g in grams:  # a slot of an n-gram is in every text that holds it
            known[g] = known[g] & set(slots.tolist()) if g in known else set(slots.tolist())
    assert all(known.values())


def test_a_repeated_word_has_a_form_of_its_own():
    twice, varied = nbsvm.Features().held([b"other other", b"other there"])
    assert set(twice.tolist()) != set(varied.tolist())
    held = [set(x.tolist()) for x in nbsvm.Features().held([b"aa aa", b"bb bb", b"aa bb"])]
    assert held[0] & held[1] - held[2]


def test_descent_reaches_the_optimum():
    rng = np.random.default_rng(1)
    docs = [np.unique(rng.integers(0, 50, 12)) for _ in range(80)]
    values = [rng.normal(size=len(d)) for d in docs]
    sign = np.where(rng.random(80) < 0.4, 1.0, -1.0)
    cost = np.where(sign > 0, 1.5, 0.7)
    w, offset, dual = nbsvm.descended(docs, values, sign, cost)
    assert ((dual >= 0) & (dual <= cost)).all()
    back = np.zeros(nbsvm.BUCKETS)
    for d, v, s, a in zip(docs, values, sign, dual):
        back[d] += a * s * v
    assert np.allclose(back, w) and np.isclose(offset, (dual * sign).sum())
    margin = np.array([w[d] @ v + offset for d, v in zip(docs, values)])
    half = (w @ w + offset**2) / 2
    primal = half + (cost * np.maximum(0, 1 - sign * margin)).sum()
    assert 0 <= primal - (dual.sum() - half) < 0.01 * primal


def test_ratios_by_hand():
    got = nbsvm.ratios(np.array([3.0, 0, 1]), np.array([0.0, 0, 1]))
    p, q = np.array([4, 1, 2]) / 7, np.array([1, 1, 2]) / 4
    assert np.allclose(got, np.log(p / q))


def corpus(n=400):
    rng = random.Random(7)
    good = lambda: " ".join(rng.choice(["river", "stone", "walks", "under", "morning", "light"]) for _ in range(30))
    junk = lambda: " ".join(rng.choice(["buy!!", "CHEAP$$", "###", "click%%", "NOW!!"]) + rng.choice(["", "x"]) for _ in range(30))
    rows = [(i, good() if i % 5 else junk(), "en", "a") for i in range(n)]
    return rows, [(i, int(i % 5 > 0), 0) for i in range(n)]


def test_counts_are_those_of_all_labelled_rows(spark):
    rows, labels = corpus(100)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["slot"]: (r["n_good"], r["n_other"]) for r in nbsvm.counted(nbsvm.taught(docs, known, 10)).collect()}
    want: dict = {}
    for (i, text, *_), (_, good, _) in zip(rows, labels):
        if crc32(str(i).encode()) % 5:
            for slot in [-1, *next(nbsvm.Features().held([text.encode()])).tolist()]:
                n = want.setdefault(slot, [0, 0])
                n[1 - good] += 1
    assert got == {k: tuple(v) for k, v in want.items()}


def test_held_out_rows_are_told_apart(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    known = spark.createDataFrame(labels + [(3, None, 1), (None, 0, 0), (8, 0, 0)], "doc_id long, quality int, toxic int")
    got = nbsvm.score(docs, known, rows=60).collect()
    assert len(got) == len(rows)
    truth = {i: q for i, q, _ in labels}
    for r in got:
        assert r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.3)
        assert 0 <= r["score"] <= 1 and r["predicted"] == truth[r["doc_id"]]


def test_odd_rows_clashing_columns_and_missing_labels(spark, edge, nothing):
    for rows in ([(4, 1, 0), (9, 0, 0), (6, 1, 0), (1, 0, 0), (10, 1, 1), (2, 1, 0), (3, 0, 1)], [(4, 1, 0)], [(4, 0, 0)], []):
        known = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
        got = nbsvm.score(edge, known)
        assert ids(got) == ALL_IDS
        scores = got.filter("doc_id = 5").collect()
        assert scores[0]["score"] == scores[1]["score"]
        if len(rows) == 1 and crc32(b"4") % 5:
            assert {r["score"] for r in got.collect()} == {float(rows[0][1])}
        if not rows:
            assert {r["score"] for r in got.collect()} == {0.5}
        assert nbsvm.score(nothing, known).count() == 0

"""Language ID, toxicity, LM scoring and sanitisation."""

import copy
import hashlib
import math
import re
from collections import Counter
from itertools import combinations
from zlib import crc32

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from quarry.llm import langmix, sanitise, toxcnn, xent
from quarry.llm.common import few_of_each

from .conftest import ALL_IDS, ROWS, ids

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_language_held_out(docs):
    got = {r["doc_id"]: r for r in langmix.identify(docs).collect()}
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    assert all(r["held_out"] == (crc32(str(d).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for d, r in got.items())
    held = [d for d, r in got.items() if r["held_out"]]
    assert np.mean([got[d]["lang_pred"] == lang[d] for d in held]) > 0.97


def test_language_mixture_proportions(docs):
    labels, model = langmix.trained(docs.filter("lang is not null").select("lang", "text"), 200)
    pick = {lang: " ".join(r["text"] for r in docs.filter(F.col("lang") == lang).limit(4).collect())[:6000] for lang in ("en", "de")}
    spark = docs.sparkSession
    mixed = spark.createDataFrame([(1, pick["en"] + "\n" + pick["de"][:3000]), (2, pick["de"])], "doc_id long, text string")
    got = {r["doc_id"]: r for r in langmix.detect(mixed, labels, model, {"doc_id": F.col("doc_id")}).collect()}
    assert got[1]["lang_pred"] == "en" and 0.5 < got[1]["score"] < 0.85
    assert got[2]["lang_pred"] == "de" and got[2]["score"] > 0.95


def test_other_languages_and_noise_go_and_mixtures_stay(docs):
    """The rule of the pipeline: likelihood against a background, not the share of the first language."""
    langs = [r[0] for r in docs.filter("lang is not null").select("lang").distinct().orderBy("lang").collect()]
    parts = [docs.filter((F.col("lang") == x) & (F.length("text") > 600)).orderBy("doc_id").first()["text"][:500] for x in langs]
    known = [(100_001, "\n".join(parts)), (100_002, parts[0]), (100_003, "of"), (100_004, parts[1][:60])]
    strange = [(200_001, "Привет мир, это русский текст о погоде и о море"), (200_002, "これは日本語の文章です。天気について書きます。"),
               (200_003, "qxzv wkjq zzxq vvkw jjqx qzxw kkvj xqzz wvkq zqxj"), (200_004, "4711 // 0815"), (200_005, None)]
    rows = docs.sparkSession.createDataFrame([(i, t, None, "x", 0) for i, t in known + strange], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in langmix.recognised(docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(rows)).select("doc_id").collect()}
    assert {i for i, _ in known} <= kept and not {i for i, _ in strange} & kept
    letters = docs.filter("text rlike '[A-Za-z]'")
    assert len(kept) - len(known) >= 0.999 * letters.count()


def test_language_sets_by_brute_force():
    """The set that EM and pruning choose: none that costs a penalty less explains a short bag of n-grams better."""
    rng = np.random.default_rng(8)
    model = np.log(rng.dirichlet(np.full(langmix.BUCKETS, 0.02), 3).T + 1e-9).astype(np.float32)
    for share in ([1, 0, 0], [0.5, 0.5, 0], [0.4, 0.3, 0.3], [0.8, 0.2, 0]):
        buckets = np.concatenate([rng.choice(langmix.BUCKETS, int(600 * x), p=np.exp(model[:, k].astype(float)) / np.exp(model[:, k].astype(float)).sum()) for k, x in enumerate(share) if x])
        at, count = np.unique(buckets, return_counts=True)
        got = langmix.proportions(np.zeros(len(at), np.int64), at, count.astype(np.float32), 1, model)[0]

        def likelihood(weights):
            return float((np.log((np.exp(model[at].astype(float)) * weights).sum(axis=1)) * count).sum())

        def fitted(members):
            w = np.zeros(3)
            w[list(members)] = 1 / len(members)
            for _ in range(300):
                joint = np.exp(model[at].astype(float)) * w
                w = (joint / joint.sum(axis=1, keepdims=True) * count[:, None]).sum(axis=0) / count.sum()
            return w

        sets = [m for n in (1, 2, 3) for m in combinations(range(3), n)]
        cost = langmix.PENALTY * np.log(count.sum())
        best = max(sets, key=lambda m: likelihood(fitted(m)) - cost * len(m))
        assert tuple(np.flatnonzero(got > 0)) == best, share
        assert np.allclose(got, fitted(best), atol=0.05)


def test_language_of_odd_texts(edge, nothing):
    got = langmix.identify(edge)
    assert ids(got) == ALL_IDS
    for r in got.collect():
        if r["doc_id"] in (1, 2, 3, 8, 9):
            assert r["lang_pred"] == "und" and r["score"] == 0
        else:
            assert r["lang_pred"] in ("en", "de", "fr")
    assert langmix.recognised(edge).columns == edge.columns
    assert langmix.identify(nothing).count() == 0 == langmix.recognised(nothing).count()


def test_copies_do_not_thin_out_texts(spark):
    """A label of few texts with many copies keeps all of them, next to one with many texts."""
    rows = spark.range(6000).selectExpr("concat('text ', id % 30) as text", "'aa' as lang")
    rows = rows.union(spark.range(3000).selectExpr("concat('other ', id) as text", "'bb' as lang"))
    got = few_of_each(rows, "lang", 40, 10).groupBy("lang").agg(F.count("*").alias("n"), F.countDistinct("text").alias("texts")).collect()
    assert {r["lang"]: (r["n"], r["texts"]) for r in got} == {"aa": (30, 30), "bb": (40, 40)}
    docs = spark.range(4000).selectExpr("id as doc_id", "concat(if(id % 2000 < 1980, 'wort ', 'word '), id % 3) as text", "if(id % 2000 < 1980, 'de', 'en') as lang")
    labels, _ = langmix.trained(docs.select("lang", "text"), 5)
    assert labels == ["de", "en"]


def test_em_finds_proportions():
    rng = np.random.default_rng(1)
    model = np.log(np.array([[0.7, 0.1], [0.2, 0.2], [0.1, 0.7]], np.float32))
    counts = np.array([0.3 * 0.7 + 0.7 * 0.1, 0.2, 0.3 * 0.1 + 0.7 * 0.7]) * 5000
    w = langmix.proportions(np.zeros(3, int), np.arange(3), counts.astype(np.float32), 1, model)[0]
    assert abs(w[0] - 0.3) < 0.08 and rng is not None


def test_toxicity_held_out(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = toxcnn.score(docs, labels).join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id").filter("held_out and lang = 'en'").collect()
    toxic = [r["score"] for r in got if r["toxic"]]
    clean = [r["score"] for r in got if not r["toxic"]]
    assert np.mean([a > b for a in toxic for b in clean]) > 0.9  # few positives to learn from at this size


def test_toxicity_gradients_match_differences():
    """Every kind of weight against the change of the loss when it is moved a little."""
    rng = np.random.default_rng(4)
    net, words = toxcnn.Net(), toxcnn.Words()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    net.p["v"] += 0.2
    net.p["e"][1:] *= 8
    for w in toxcnn.WIDTHS:  # away from 0, where the loss has a kink
        net.p[f"b{w}"] += 0.05
    docs = [words.sequence([" ".join(rng.choice(["alpha", "beta", "gamma", "delta"], 6)).encode()])[0] for _ in range(4)]
    slots, label = np.array(words.slots, np.int64), np.array([1, 0, 1, 0])

    def loss():
        z = np.array([net.logits(net.p["e"][slots[d]].sum(axis=1), np.array([0]))[0] for d in docs])
        return float(np.mean(np.log1p(np.exp(-z * (2 * label - 1)))))

    grad, touched, push = net.gradients(docs, slots, label)
    whole = {**grad, "e": np.zeros_like(net.p["e"])}
    whole["e"][touched] = push
    for k, g in whole.items():
        moved = [i for i in zip(*np.nonzero(np.abs(g) > 1e-4))][:: max(1, int((np.abs(g) > 1e-4).sum()) // 12)]
        assert moved or k == "c"
        for i in moved:
            before = net.p[k][i]
            net.p[k][i] = before + 1e-5
            up = loss()
            net.p[k][i] = before - 1e-5
            assert abs((up - loss()) / 2e-5 - g[i]) < 1e-3 * max(1, abs(g[i])), (k, i)
            net.p[k][i] = before


def test_toxicity_pools_each_text_alone():
    rng = np.random.default_rng(2)
    net, x = toxcnn.Net(), rng.normal(size=(9, toxcnn.DIM)).astype(np.float32)
    want = [max(float((x[i : i + w].reshape(-1) @ net.p[f"k{w}"].reshape(-1, toxcnn.FILTERS))[f]) for i in range(10 - w)) for w in toxcnn.WIDTHS for f in range(toxcnn.FILTERS)]
    assert np.allclose(net.pooled(x, np.array([0]))[0], want, atol=1e-4)
    both = net.pooled(np.concatenate((x, x[:4])), np.array([0, 9]))
    assert np.allclose(both[0], want, atol=1e-4) and np.allclose(both[1], net.pooled(x[:4], np.array([0]))[0], atol=1e-4)


def labelled_rows(spark):
    """(docs, labels, (text, label) of each row to learn from): copies, a very long text, a repeated id, a null text."""
    rows = [(i, f"word{i} stem{i % 7} {'vile' if i % 3 == 0 else 'kind'} tail{i % 11}", ("en", "de", None)[i % 4 % 3]) for i in range(160)]
    rows += [(i, "a copy of one text", "en") for i in range(160, 200)] + [(200, "long text " * 30_000, "en"), (201, None, "en"), (1, rows[1][1], "en")]
    labels = [(i, int(i % 3 == 0)) for i in range(202)]
    want = {(t, int(i % 3 == 0)) for i, t, _ in rows if t is not None and crc32(str(i).encode()) % 5}
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int"), want


def test_toxicity_learns_from_every_row(spark):
    """No label, length or number of rows is cut: rows, counts and a round of training against plain Python."""
    docs, labels, want = labelled_rows(spark)
    texts, shards = toxcnn.learnable(docs, labels, 40, 1 << 20)
    got = texts.collect()
    assert shards > 3 and len(got) == len(want) and {(r["text"], r["toxic"]) for r in got} == want
    checks = {t: crc32(t.encode(), 1) % 4 == 0 for t, _ in want}
    sums = toxcnn.counted(texts)
    own = [(t, y) for t, y in want if not checks[t]]
    assert toxcnn.whole(sums, "rows", 4).tolist() == [len(own), sum(y for _, y in own), len(want) - len(own), sum(y for t, y in want if checks[t])]
    hits = np.zeros(toxcnn.BUCKETS, np.int64)
    for t, y in own:
        words = toxcnn.Words()
        at = words.sequence([t.encode()])[0]
        hits[np.unique(np.array(words.slots)[at])] += y
    assert (toxcnn.whole(sums, "hits", toxcnn.BUCKETS) == hits).all()

    net = toxcnn.Net()
    net.prepared(toxcnn.whole(sums, "seen", toxcnn.BUCKETS), hits, sum(y for _, y in own) / len(own))
    before, moves, steps, rows = {k: v.copy() for k, v in net.p.items()}, {k: 0.0 for k in net.p}, 0, 0
    for shard in sorted({r["shard_"] for r in got}):
        mine, words, part = copy.deepcopy(net), toxcnn.Words(), [r for r in got if r["shard_"] == shard and not checks[r["text"]]]
        seqs = [words.sequence([r["text"].encode()])[0] for r in part]
        moved = mine.fit(seqs, np.array(words.slots, np.int64), np.array([r["toxic"] for r in part]), 1, [1, shard])
        for k in moves:
            moves[k] = moves[k] + (mine.p[k] - before[k]).astype(float) * (moved[:, None] if k == "e" else len(part))
        steps, rows = steps + moved, rows + len(part)
    toxcnn.one_round(net, texts, 1, 1)
    for k in moves:
        assert np.allclose(net.p[k], before[k] + moves[k] / (np.maximum(steps, 1)[:, None] if k == "e" else rows), atol=1e-5), k
    assert steps.any()


def test_toxicity_keeps_a_shard_in_one_task(spark):
    """However Spark joins and deals rows: each task that holds some of a shard trains a net of its own."""
    docs, labels, want = labelled_rows(spark)
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "23"}
    old = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        texts, shards = toxcnn.learnable(docs, labels, 40, 1 << 20)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    got = texts.select("shard_", "text", "toxic", F.input_file_name().alias("file")).collect()
    assert shards > 3 and {(r["text"], r["toxic"]) for r in got} == want and len(got) == len(want)
    assert len({(r["shard_"], r["file"]) for r in got}) == len({r["shard_"] for r in got})


def test_toxicity_thresholds_against_all_cuts(spark):
    rng = np.random.default_rng(3)
    rows = [(int(k), float(x), int(y)) for k, x, y in zip(rng.integers(0, 3, 600), np.round(rng.normal(0, 3, 600), 2), rng.integers(0, 2, 600))]
    rows += [(0, 900.0, 1), (0, -900.0, 0), (1, -70.5, 0)]
    got = toxcnn.thresholds(spark.createDataFrame(rows, "guess int, logit double, toxic int").repartition(4))
    for k in (-1, 0, 1, 2):
        own = [(x, y) for g, x, y in rows if k in (-1, g)]
        values, pos = sorted({x for x, _ in own}, reverse=True), sum(y for _, y in own)
        f1 = [2 * sum(y for x, y in own if x >= v) / (sum(x >= v for x, _ in own) + pos) for v in values]
        at = int(np.argmax(f1))
        low = values[at + 1] if at + 1 < len(values) else values[at] - 1
        assert got[k][1:] == (pos, len(own) - pos) and abs(got[k][0] - (values[at] + low) / 2) < 1e-9


def test_toxicity_of_odd_texts(spark, edge, nothing):
    labels = spark.createDataFrame([(4, 1, 1), (4, 0, 0), (7, 1, 0), (10, 1, None), (6, 1, 0)], "doc_id long, quality int, toxic int")
    got = toxcnn.score(edge, labels)
    assert ids(got) == ALL_IDS
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.collect())
    assert toxcnn.score(nothing, labels).count() == 0
    assert toxcnn.score(edge, labels.limit(0)).count() == len(ROWS)


def plain_losses(rows, target, slots):
    """The formulas of the docstring with dictionaries instead of arrays."""
    words = [[crc32(w.lower().encode()) % slots for w in re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", t or "")] for _, t in rows]
    full = [[crc32(w.lower().encode()) for w in re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", t or "")] for _, t in rows]
    pair = lambda v, w: int(xent.pair_slots(np.array([v], np.uint32), np.array([w], np.uint32), slots)[0])
    one, two = [Counter(), Counter()], [Counter(), Counter()]
    for (d, _), ws, fs in zip(rows, words, full):
        for m in (0, 1) if d in target else (1,):
            one[m].update(ws)
            two[m].update(pair(v, w) for v, w in zip([0, *fs], fs))
    n = [sum(c.values()) for c in one]
    scale = [1.0, n[0] / n[1]]
    out = []
    for ws, fs in zip(words, full):
        sums = [0.0, 0.0]
        for i, (w, f) in enumerate(zip(ws, fs)):
            for m in (0, 1):
                v = one[m][ws[i - 1]] if i else 0
                both = min(two[m][pair(fs[i - 1] if i else 0, f)], v) * scale[m]
                share = (one[m][w] * scale[m] + xent.ADD) / (n[m] * scale[m] + xent.ADD * slots)
                sums[m] -= math.log((both + xent.PRIOR * share) / (v * scale[m] + xent.PRIOR))
        out.append([s / max(1, len(ws)) for s in sums])
    return out


def test_cross_entropy_against_dictionaries(spark):
    rows = [(i, f"alpha beta {'gamma' * (i % 3)} Delta-{i % 5} é{i % 2}, alpha beta.") for i in range(40)] + [(40, ""), (41, None)]
    target = {i for i in range(40) if i % 3 == 0}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in xent.score(docs, spark.createDataFrame([(i,) for i in target], "doc_id long")).collect()}
    for (d, _), (t, b) in zip(rows, plain_losses(rows, target, xent.LEAST_SLOTS)):
        assert abs(got[d]["target_loss"] - t) < 1e-4 and abs(got[d]["background_loss"] - b) < 1e-4
        assert abs(got[d]["score"] - (t - b)) < 1e-4
    assert got[40]["n_tokens"] == got[41]["n_tokens"] == 0 and got[41]["score"] == 0


def test_cross_entropy_of_odd_texts(spark, edge, nothing):
    good = spark.createDataFrame([(4,), (4,), (None,)], "doc_id long")
    got = xent.score(edge, good)
    assert ids(got) == ALL_IDS and got.filter("isnan(score) or score is null").count() == 0
    assert xent.score(edge, good.limit(0)).filter("isnan(score)").count() == 0
    assert xent.score(nothing, good).count() == 0


def plain_spans(text):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()][::-1]
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits))
        out += [(2, *m.span())] if 16 <= len(digits) <= 19 and total % 10 == 0 else []
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def test_base_rules_against_plain_patterns():
    import random

    rng = random.Random(2)
    bits = ["a", "b.", "@", "@x.y", "1.2.3.4", "255", "256", ".", " ", "-", "+", "+1 (375) 555-4393", "4863730426282943", "4863 7304 2628 2943", "9", "é", "00", "(", ")", "a@b.c", "\n", "_", "%"]
    for _ in range(8000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(12)))
        assert sanitise.base_spans(text) == plain_spans(text), repr(text)


@pytest.mark.parametrize("text", ["a" * 10**6, "1" * 10**6, "1." * 300_000, "+1" + " " * 10**6, "a@" * 300_000, "1 " * 300_000])
def test_base_rules_are_linear(text):
    import time

    began = time.time()
    sanitise.base_spans(text)
    assert time.time() - began < 5


def test_report(edge, nothing):
    got = {r["doc_id"]: r for r in sanitise.report(edge).filter("doc_id <> 5").collect()}
    for d, t, *_ in ROWS:
        if d not in (5, None):
            base = ",".join(f"{sanitise.KINDS[k]}:{a}:{b}" for k, a, b in plain_spans(t or ""))
            assert got[d]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest() and got[d]["spans"] == base
    assert [got[10][f"n_{k}"] for k in sanitise.KINDS[:4]] == [1, 1, 1, 1]
    assert sanitise.report(edge).count() == len(ROWS) and sanitise.report(nothing).count() == 0


def test_disclosing_terms(spark):
    rows = [(i, f"case {'xyz' * (i + 1)} zorblat asked bob@corp.example about the plan and {'abc' * (i + 1)}") for i in range(4)]
    rows += [(i, f"the plan and the case about nothing {'qrs' * (i % 7 + 1)} asked") for i in range(4, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    spans = {r["doc_id"]: r["spans"] for r in sanitise.report(docs).collect()}
    for i, text in rows:
        marked = [(k, text[int(a) : int(b)]) for k, a, b in (s.split(":") for s in spans[i].split(",") if s)]
        assert marked == ([("email", "bob@corp.example"), ("remove", "zorblat")] if i < 4 else [])
    clean = {r["doc_id"]: r["text"] for r in sanitise.sanitised(docs).collect()}
    assert "zorblat" not in clean[0] and "<EMAIL>" in clean[0] and clean[10] == rows[10][1]


def test_disclosure_against_a_recount(docs):
    """PMI of every (entity, term) from its own sets of documents."""
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()][:400] + [(9001, None), (9002, "")]
    df = docs.sparkSession.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sanitise.scan(df, False)
    pairs = found.filter("size(pairs) > 0").select("part", "pos", "digest", F.explode("pairs").alias("p")).select("part", "pos", "digest", "p.*")
    got = {(r["entity"], r["term"]): r["kind"] for r in sanitise.disclosing(df, pairs, 0.5, 0.6, 0.8).collect()}
    together, holders, has = {}, {}, Counter()
    for doc_id, text in rows:
        has.update(set(regex.findall(sanitise.TERM, (text or "").lower())))
        for e, t, _ in sanitise.neighbours(text, sanitise.base_spans(text)) if text and sanitise.base_spans(text) else []:
            together.setdefault((e, t), []).append((doc_id, text))
            holders.setdefault(e, set()).add(doc_id)
    want = {}
    for (e, t), where in together.items():
        n_e, texts = len(holders[e]), len({x for _, x in where})
        mutual = math.log(len(where) * (1 - 0.5 / texts) * len(rows) / (n_e * has[t])) if has[t] else -1
        share = mutual / -math.log(n_e / len(rows)) if n_e < len(rows) else 0
        if share >= 0.6:
            want[e, t] = 5 if share >= 0.8 else 4
    assert len(want) > 20 and set(want.values()) == {4, 5}
    assert got == want


def test_disclosing_terms_of_the_given_documents(docs):
    """Entities of one text have disclosing terms: rare words near them, never words that many documents hold."""
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    held = Counter(w for t in texts.values() for w in set(sanitise.WORDS.findall(t.lower())))
    added = {}
    for r in sanitise.report(docs).collect():
        found = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in r["spans"].split(",") if s)]
        base = [s for s in found if s[0] in sanitise.KINDS[:4]]
        added[r["doc_id"]] = [texts[r["doc_id"]][a:b].lower() for k, a, b in found if k in sanitise.KINDS[4:]]
        assert base or not found
        assert [(k, a, b) for k, a, b in base] == [(sanitise.KINDS[k], a, b) for k, a, b in sanitise.base_spans(texts[r["doc_id"]])]
    terms = [w for found in added.values() for w in found]
    assert terms and max(held[w] for w in terms) <= 4


def test_masked_overlaps():
    assert sanitise.masked("ab cd ef", [(1, 0, 5), (0, 3, 5), (4, 6, 8)]) == "<IP> <TERM>"


def test_cross_entropy_counts_real_words(spark):
    """Words and pairs far beyond the old slots of a small corpus keep counts of their own."""
    rows = [(i, " ".join(f"w{(i * 7919 + j * j) % 90_000}x" for j in range(1500))) for i in range(160)] + [(160, None), (161, "w1x")]
    target = {i for i in range(160) if i % 4 == 0}
    words = [(t or "").split() for _, t in rows]
    one, two = [Counter(), Counter()], [Counter(), Counter()]
    for (d, _), ws in zip(rows, words):
        for m in (0, 1) if d in target else (1,):
            one[m].update(ws)
            two[m].update(zip(ws, ws[1:]))
    n, size = [sum(c.values()) for c in one], max(len(one[1]), xent.LEAST_SLOTS)
    assert len(one[1]) > xent.LEAST_SLOTS
    got = {r["doc_id"]: r for r in xent.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), spark.createDataFrame([(i,) for i in target], "doc_id long")).collect()}
    for (d, _), ws in zip(rows, words):
        for m, name in enumerate(("target_loss", "background_loss")):
            scale, loss = 1.0 if m == 0 else n[0] / n[1], 0.0
            for v, w in zip([None, *ws], ws):
                share = (one[m][w] * scale + xent.ADD) / (n[m] * scale + xent.ADD * size)
                loss -= math.log((two[m][v, w] * scale + xent.PRIOR * share) / (one[m][v] * scale + xent.PRIOR))
            assert abs(got[d][name] - loss / max(1, len(ws))) < 1e-6

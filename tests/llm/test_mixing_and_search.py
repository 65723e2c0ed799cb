"""Source mixing and exact search against brute force; the pipeline and the registered queries."""

import math
import random
import re
from collections import Counter
from zlib import crc32

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from quarry.llm import mixing, packing, topk
from quarry.llm.oracle import ORACLE
from quarry.llm.queries import QUERIES
from quarry.llm.tokens import tokenizer_path

from .conftest import ALL_IDS, CLASH, ids

SF = "/root/testdata/sf0.001"


def test_targets():
    sizes = {"b": 100, "a": 1000, None: 10, "c": 400}
    got = mixing.targets(sizes)
    assert abs(sum(got.values()) - 1.5 * 1510) < 1e-6 and got[None] <= 20
    free = {s: t for s, t in got.items() if t < 2 * sizes[s]}
    weight = {"a": 5, "b": 2, "c": 1, None: 5}
    assert len({round(t / weight[s], 6) for s, t in free.items()}) <= 1
    assert mixing.targets({"a": 0, "b": 0}) == {"a": 0.0, "b": 0.0} and mixing.targets({}) == {}


def test_flow_prefers_fresh_words():
    patterns = [(("a",), 100), (("a", "b"), 50), (("b",), 10)]
    assert mixing.min_cost_flow(patterns, {"a": 120, "b": 60}) == {(0, 0, "a"): 100, (0, 1, "a"): 20, (1, 0, "b"): 50, (2, 0, "b"): 10}


@pytest.mark.parametrize("seed", range(15))
def test_flow_is_feasible_and_most(seed):
    rng = random.Random(seed)
    names = "abcd"
    patterns = [(tuple(sorted(rng.sample(names, rng.randint(1, 3)))), rng.randint(1, 60)) for _ in range(6)]
    quotas = {s: rng.randint(0, 120) for s in names}
    flow = mixing.min_cost_flow(patterns, quotas)
    for i, (members, words) in enumerate(patterns):
        for k in (0, 1):
            assert sum(f for (p, u, _), f in flow.items() if (p, u) == (i, k)) <= words
        assert all(s in members for p, _, s in flow if p == i)
        used = [sum(f for (p, u, _), f in flow.items() if (p, u) == (i, k)) for k in (0, 1)]
        assert used[1] == 0 or used[0] == words
    # max flow = min cut over sets of sources
    cuts = []
    for mask in range(16):
        inside = {s for j, s in enumerate(names) if mask >> j & 1}
        cuts.append(sum(quotas[s] for s in names if s not in inside) + sum(2 * w for m, w in patterns if inside & set(m)))
    assert sum(flow.values()) == min(cuts)


def test_mixture_report(spark, edge, nothing):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randint(1, 60), rng.choice(["x", "x", "x", "y", None, "z"])) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = mixing.mixture_report(docs).collect()
    again = mixing.mixture_report(docs.repartition(7)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again)) and len(got) == 4000
    source = {d: s for d, _, s in rows}
    sizes = {s: sum(len(t.split()) for _, t, q in rows if q == s) for s in set(source.values())}
    want = mixing.targets(sizes)
    for s in sizes:
        own = [r for r in got if source[r["doc_id"]] == s]
        assert abs(sum(r["taken"] for r in own) - want[s]) <= 10
        assert all(r["source_size"] == sizes[s] and abs(r["target"] - want[s]) < 1e-6 and r["taken"] in (0, r["size"], 2 * r["size"]) for r in own)
    odd = mixing.mixture_report(edge)
    assert ids(odd) == ALL_IDS and odd.filter("taken > 2 * size").count() == 0
    assert mixing.mixed_rows(edge).columns == edge.columns
    assert mixing.mixture_report(nothing).count() == 0 == mixing.mixed_rows(nothing).count()


def test_more_sources_than_the_driver_takes(spark, monkeypatch):
    """The tables beyond the limit say what the flow says below it."""
    rng = random.Random(6)
    rows = [(i, "w " * rng.randint(0, 40), rng.choice([None, "x", *(f"s{k}" for k in range(30))] + ["big"] * 30)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    shape = lambda df: sorted((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in df.collect())
    want = shape(mixing.mixture_report(docs))
    monkeypatch.setattr(mixing, "MOST_PATTERNS", 5)
    got = shape(mixing.mixture_report(docs))
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert sum(a != b for a, b in zip(got, want)) <= 2 * 32  # a quota of half a word may round either way
    both = spark.createDataFrame([(i, "a b", [f"s{i}", "t"]) for i in range(9)], "doc_id long, text string, names array<string>")
    with pytest.raises(ValueError, match="overlapping"):
        mixing.planned(both, both["names"])


def test_overlapping_sources(spark):
    rows = [(i, "w " * 10, ["a", "b"] if i % 2 else ["a"]) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, names array<string>")
    mixed, sizes, goal = mixing.mix(docs, docs["names"], carry=False)
    assert sizes == {"a": 2000, "b": 1000} and abs(sum(goal.values()) - 3000) < 1e-6
    assert abs(mixed.groupBy().sum("taken").first()[0] - 3000) <= 20


def brute(vectors, k=10):
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in vectors if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if q % 100 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("tile, parts", [(16, 2), (2048, 300)])
def test_search_against_all_products(spark, tile, parts):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 0.3, 8).astype(np.float32).tolist()) for i in range(701)]
    rows += [(i, rows[i - 800][1]) for i in range(800, 850)]  # ties
    rows += [(900, None), (901, []), (902, [1.0, None]), (903, [float("nan")]), (904, [float("inf"), 1.0]), (None, [1.0] * 8), (905, [1.0, 2.0])]
    docs = spark.createDataFrame(rows, "vec_id long, vec array<float>").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts if parts < 100 else 24)
    try:
        got = topk.search(docs, tile=tile).select("query_id", "rank", "vec_id", "score").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(map(tuple, got)) == brute(rows)
    assert topk.search(docs.limit(0)).count() == 0


def test_search_large_numbers_and_ties():
    big = np.array([[3.0e9, 1.0]])
    assert topk.product(big, big).tolist() == [[9 * 10**18 + 1]]
    with pytest.raises(OverflowError):
        topk.product(big * 2, big * 2)
    scores, found = topk.best(np.zeros((1, 50), np.int64), np.arange(50)[None, ::-1].copy(), 10)
    assert found.tolist() == [list(range(10))] and scores.shape == (1, 10)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(ORACLE[name])
    got = QUERIES[name](spark, SF).select(*want.columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


def test_thirteen_queries():
    assert [int(q[2:].split("_")[0]) for q in QUERIES] == list(range(1, 14))


@pytest.fixture(scope="module")
def odd_tables(spark, edge, tmp_path_factory):
    """Tables of odd rows in which every column that an operator might call its own is there already."""
    folder = str(tmp_path_factory.mktemp("odd"))
    edge.write.parquet(f"{folder}/documents.parquet")
    extra = ", ".join(f"cast(null as {x.split()[1]}) as {x.split()[0]}" for x in (*CLASH.split(", "), "vec array<float>", "query_id long", "rank int", "tile int", "shard int", "slice long"))
    vectors = [(i, [float(i % 7), 1.5]) for i in range(205)] + [(300, None), (301, []), (302, [float("nan"), 1.0]), (None, [1.0, 2.0])]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").selectExpr("*", *extra.split(", ")).write.parquet(f"{folder}/embeddings.parquet")
    labels = spark.createDataFrame([(4, 1, 1), (4, 0, 0), (7, 1, 0), (10, 1, None), (6, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    labels.selectExpr("*", *[x for x in extra.split(", ") if x.split(" as ")[-1] not in ("score",)]).write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.mark.parametrize("name", [*QUERIES, "pipeline"])
def test_registered_queries_on_clashing_columns(spark, odd_tables, name):
    import corpus_pipeline as c

    df = {**QUERIES, "pipeline": c.run}[name](spark, odd_tables)
    rows = df.collect()
    if name == "op5_exact_topk":
        assert [tuple(r) for r in sorted(rows)] == brute([(i, [float(i % 7), 1.5]) for i in range(205)])
    elif name in ("pipeline", "op9_best_fit_packing"):
        assert {r["doc_id"] for r in rows} <= set(ALL_IDS)
    else:
        assert ids(df) == ALL_IDS


def test_pipeline_against_brute_force(spark):
    import corpus_pipeline as c
    from quarry.llm import simhash

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, names = docs, [n for n, _ in c.STAGES]
    assert names == ["language_id", "exact_dedup", "near_dedup", "source_mixing", "best_fit_packing"]
    seen = []
    for name, stage in c.STAGES[:-1]:
        kept = c.table(stage(spark, kept, SF), name)
        assert kept.columns == docs.columns
        seen.append({r["doc_id"]: r["text"] for r in kept.collect()})
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(any(ch.isalpha() for ch in t) for t in seen[0].values()) and len(seen[0]) == len(texts)
    assert seen[1] == {max(d for d, u in seen[0].items() if u == t): t for t in seen[0].values()}
    prints = {d: simhash.fingerprint(t.encode()) for d, t in seen[1].items()}
    left = dict(prints)
    for d in sorted(prints):
        if d in left:
            group, wave = {d}, {d}
            while wave:
                wave = {x for x in left if x not in group and any((left[x] ^ left[y]).bit_count() <= 3 for y in wave)}
                group |= wave
            for x in group - {d}:
                del left[x]
    assert set(seen[2]) == set(left)
    assert set(seen[3]) <= set(seen[2])
    # mixing: of each source as many words as its target asks, a document at most twice
    mixed = Counter(r["doc_id"] for r in kept.select("doc_id").collect())
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    sizes = {s: sum(words(seen[2][d]) for d in seen[2] if source[d] == s) for s in {source[d] for d in seen[2]}}
    goal, largest = mixing.targets(sizes), max(map(words, seen[2].values()))
    assert max(mixed.values()) <= 2
    for s in sizes:
        assert abs(sum(words(seen[2][d]) * n for d, n in mixed.items() if source[d] == s) - goal[s]) <= largest
    # packing: the pieces are the library's ids, cut from the end, and fill their sequences without gaps
    tokenizer = Tokenizer.from_file(tokenizer_path(packing.TOKENIZER))
    want: Counter = Counter()
    for d, n in mixed.items():
        all_ids = np.array([*tokenizer.encode(texts[d], add_special_tokens=False).ids, 2], "<u4")
        cuts = [0, *range(len(all_ids) % 1024 or 1024, len(all_ids) + 1, 1024)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[d, i, a, b - a, crc32(all_ids[a:b].tobytes())] += n
    packed = c.run(spark, SF).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == want
    places: dict = {}
    for r in packed:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for found in places.values():
        found.sort()
        assert [o for o, _ in found] == [sum(n for _, n in found[:i]) for i in range(len(found))] and sum(n for _, n in found) <= 1024

"""Exact and near duplicates against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quarry.llm import grace, simhash

from .conftest import ALL_IDS, ROWS, ids


def test_report_against_groups(spark, edge):
    got = sorted(map(tuple, grace.duplicate_report(edge).collect()), key=str)
    want, kept = [], set()
    for d, t, *_ in ROWS:
        same = [x for x, u, *_ in ROWS if (u or "") == (t or "")]
        keep = max((x for x in same if x is not None), default=None)
        stays = d == keep and (t or "") not in kept
        kept |= {t or ""} if stays else set()
        want.append((d, keep, len(same), stays, hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_deduplicate_keeps_all_columns(edge):
    kept = grace.deduplicate(edge)
    assert kept.columns == edge.columns
    assert ids(kept) == [3, 5, 6, 7, 8, 9, 10, None]


def test_spilling_changes_nothing(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["hot", f"text {rng.randrange(300)} " * rng.randrange(1, 40)])) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    small, large = (sorted(map(tuple, grace.duplicate_report(docs, b).collect())) for b in (2000, 1 << 26))
    assert small == large and len(small) == 3000


def test_grace_recursion(tmp_path):
    texts = [f"{i % 500}".encode() * 20 for i in range(2000)]
    seen = {}
    for numbers, groups, contents in grace.grace(enumerate(texts), 3000, str(tmp_path)):
        for n, g in zip(numbers, groups):
            assert contents[g] == texts[n]
            seen[n] = contents[g]
        assert len(set(contents)) == len(contents)
    assert len(seen) == 2000 and not list(tmp_path.iterdir())


def test_table_compares_contents():
    t = grace.ContentTable(8)
    assert [t.find(7, c) for c in (b"a", b"b", b"a", b"c")] == [0, 1, 0, 2]
    assert [t.find(i, b"%d" % i) for i in range(50)] == list(range(3, 53))


def plain_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\n", " ").replace("\t", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_components(edge):
    got = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in simhash.near_duplicates(edge).collect()}
    prints = [(d, plain_fingerprint(t)) for d, t, *_ in ROWS]
    assert set(got) == {(d, f"{f:016x}") for d, f in prints}
    for d, f in prints:
        group = {f}
        while True:
            more = {g for _, g in prints if any((g ^ x).bit_count() <= 3 for x in group)}
            if more == group:
                break
            group = more
        assert got[d, f"{f:016x}"] == min((x for x, g in prints if g in group and x is not None), default=None)


def test_shingle_hash_is_spark_xxhash64(spark):
    assert simhash.fingerprint("One two\tTHREE".encode()) == spark.sql("select xxhash64('one two three')").first()[0] % (1 << 64)


@pytest.mark.parametrize("shard", [150, 100_000])
def test_trees_against_all_pairs(spark, shard):
    rng = np.random.default_rng(3)
    points = set(rng.integers(0, 2**63, 500).tolist())
    for b in list(points)[:150]:
        for _ in range(3):
            x = b
            for k in rng.integers(0, 64, rng.integers(1, 5)):
                x ^= 1 << int(k)
            points.add(x)
    points |= {(0xABCDEF01 << 32) | int(x) for x in rng.integers(0, 2**32, 400)}  # one half alike
    p = np.array(sorted(points), np.uint64)
    parent = np.arange(len(p))
    for i in range(len(p)):
        near = np.flatnonzero(np.bitwise_count(p ^ p[i]) <= 3)
        simhash.unite(parent, np.full(len(near), i), near)
    want: dict = {}
    for x, r in zip(p.view(np.int64).tolist(), simhash.roots_of(parent, np.arange(len(p))).tolist()):
        want.setdefault(r, set()).add(x)
    df = spark.createDataFrame([(x,) for x in p.view(np.int64).tolist()], "fp long").withColumn("doc_id", F.lit(1).cast("long"))
    got: dict = {}
    for r in simhash.rooted(df, 3, shard).collect():
        got.setdefault(r["root"], set()).add(r["fp"])
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_one_of_each(edge):
    kept = simhash.one_of_each(edge)
    assert kept.columns == edge.columns
    assert ids(kept) == [1, 4, 6, 7, 9, 10, None]


def test_empty_table(nothing):
    assert grace.duplicate_report(nothing).count() == 0 == grace.deduplicate(nothing).count()
    assert simhash.near_duplicates(nothing).count() == 0 == simhash.one_of_each(nothing).count()
    assert ALL_IDS

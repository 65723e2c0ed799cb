"""The Merkle manifest against a tree built node by node."""

import random
import zlib
from hashlib import sha256

import pytest

from quarry.llm import merkle


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def value(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def grown(leaves):
    """Levels of a tree, the leaves first."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def met(levels, place):
    """(slot, siblings) of each level from a leaf up."""
    for nodes in levels[:-1]:
        run, slot = nodes[place - place % 3 :][:3], place % 3
        yield slot, run[:slot] + run[slot + 1 :]
        place //= 3


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    leaf = lambda r, text: h(*map(value, (*r[:4], text)))
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    groups = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4]))) for s in sources}
    trees = {s: grown([leaf(r, r[4]) for r in g]) for s, g in groups.items()}
    top = grown([trees[s][-1][0] for s in sources])
    out = []
    for nth, s in enumerate(sources):
        for i, r in enumerate(groups[s]):
            steps = [*met(trees[s], i), *met(top, nth)]
            odd = r[0] is None or zlib.crc32(str(r[0]).encode()) % 2
            end = leaf(r, r[4] if odd or r[4] is None else r[4].replace("\n", ""))
            for slot, siblings in steps:
                end = h(*siblings[:slot], end, *siblings[slot:])
            out.append((r[0], leaf(r, r[4]), trees[s][-1][0], top[-1][0], h(*(x for _, xs in steps for x in xs)), end, end == top[-1][0]))
    return out


def made(seed, n, sources):
    rng = random.Random(seed)
    return [(rng.choice([i, i, i, 7, None]), rng.choice(sources), rng.choice(["en", None]), rng.choice([i % 9, None]), rng.choice(["", None, "é\nb", "x\n" * (i % 4), "same"])) for i in range(n)]


SHAPE = "doc_id long, source string, lang string, n_chars long, text string"
KEY = str


@pytest.mark.parametrize("height, n, sources", [(1, 90, ["a", "b", None, "é", ""]), (2, 250, ["a"] * 9 + ["b", None]), (1, 30, [f"s{i}" for i in range(25)]), (6, 40, ["a", "b"]), (1, 1, ["x"]), (1, 9, ["one"])])
def test_manifest_against_brute_force(spark, height, n, sources):
    rows = made(n, n, sources)
    got = merkle.manifest(spark.createDataFrame(rows, SHAPE).repartition(3), height)
    assert sorted(map(tuple, got.collect()), key=KEY) == sorted(brute(rows), key=KEY)


def test_odd_rows_and_clashing_columns(edge):
    rows = [tuple(r) for r in edge.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = merkle.manifest(edge).collect()
    assert sorted(map(tuple, got), key=KEY) == sorted(brute(rows), key=KEY)


def test_empty_table(nothing):
    assert merkle.manifest(nothing).count() == 0


@pytest.mark.parametrize("most", [0, 500, 1 << 30])
def test_queue_keeps_order_on_disk(most):
    rng, queue = random.Random(most), merkle.ExternalQueue(most)
    held = []
    for _ in range(600):
        if held and rng.random() < 0.4:
            assert queue.pop() == held.pop(0)
        else:
            entry = (rng.randrange(40), rng.randrange(10**9), bytes(rng.randrange(9)))
            queue.push(*entry)
            held = sorted([*held, entry])
    while held:
        assert queue.first() == held[0][0]
        assert queue.pop() == held.pop(0)
    assert queue.first() is None


@pytest.mark.parametrize("n", [1, 2, 3, 4, 10, 80, 700])
def test_sweeps_with_spilling_queues(n):
    leaves = [h(str(i)) for i in range(n)]
    levels = grown(leaves)
    root, nodes = merkle.forward([x.encode() for x in leaves], merkle.height_of(n), merkle.ExternalQueue(300))
    assert root.decode() == levels[-1][0]
    proofs = dict(merkle.backward(nodes, b"", merkle.ExternalQueue(300)))
    for i, leaf in enumerate(leaves):
        assert [(s, [x.decode() for x in xs]) for s, xs in merkle.steps(proofs[i])] == list(met(levels, i))
        assert merkle.folded(leaf.encode(), proofs[i]) == root

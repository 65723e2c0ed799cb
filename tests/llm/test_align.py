"""Tokenizer alignment against all overlaps, found pair by pair with fresh tokenizers."""

import base64
import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from quarry.llm import align
from quarry.llm.tokens import byte_letters, tokenizer_path

from .conftest import ROWS

SHA = "groups_sha256"


def sides():
    a = Tokenizer.from_file(tokenizer_path(align.TOKENIZER_A))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(align.TOKENIZER_B))
    back = {c: i for i, c in byte_letters().items()}
    said_a = lambda i: bytes(back[c] for c in a.id_to_token(i))
    said_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    return (lambda t: a.encode(" " + t, add_special_tokens=False).ids), said_a, b.encode, said_b


def brute(rows):
    ids_a, said_a, ids_b, said_b = sides()
    docs, counts = [], Counter()
    for doc_id, text in rows:
        a, b = (ids_a(text), ids_b(text)) if text else ([], [])
        if b"".join(map(said_a, a)) != b"".join(map(said_b, b)) or text and b"".join(map(said_a, a)) != (" " + text).encode():
            a, b = [], []
        ranges = []
        for ids, said in ((a, said_a), (b, said_b)):
            ends = np.cumsum([0, *(len(said(i)) for i in ids)]).tolist()
            ranges.append(list(zip(ends, ends[1:], ids)))
        links, at = [], 0
        for s, e, x in ranges[0]:
            while ranges[1][at][1] <= s:
                at += 1
            links += [(x, y) for s2, e2, y in ranges[1][at : at + e - s] if s2 < e and s < e2]
        cuts = sorted({r[1] for r in ranges[0]} & {r[1] for r in ranges[1]})
        said = ";".join("|".join(",".join(str(i) for s, e, i in side if lo < e <= hi) for side in ranges) for lo, hi in zip([0, *cuts], cuts)) if len(a) < 3000 else None
        counts.update(links)
        docs.append((doc_id, len(a), len(b), len(cuts), links, said))
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return sorted(((d, n_a, n_b, n, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), None if said is None else sha256(said.encode()).hexdigest() if said else "") for d, n_a, n_b, n, links, said in docs), key=str)


def rows_of(got, want):
    """Rows as sorted tuples; group digests that brute force leaves out are left out here too."""
    without = {w[:7] for w in want if w[7] is None}
    return sorted(((*r[:7], None if tuple(r[:7]) in without else r[7]) for r in map(tuple, got)), key=str)


def test_against_brute_force(spark):
    rng = random.Random(2)
    bits = ["the ", "of", " Eand ", "ing", "  ", "\n", "é", "日本", "🙂", "▁", "<s>", "<|endoftext|>", "12", "'s", "ÄÖ", "tion", "\t", "\x00", " "]
    rows = [(i % 90, "".join(rng.choice(bits) for _ in range(rng.randrange(1, 30)))) for i in range(120)] + [(500, None), (501, ""), (None, "of of"), (502, " ")]
    want = brute(rows)
    for limit in (1 << 22, 200):
        got = align.align(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), limit=limit).collect()
        assert rows_of(got, want) == want


def test_odd_rows_and_clashing_columns(edge):
    want = brute([(r[0], r[1]) for r in ROWS])
    assert rows_of(align.align(edge).collect(), want) == want


def test_empty_table(nothing):
    assert align.align(nothing).count() == 0


@pytest.mark.parametrize("seed", range(60))
def test_gallop_finds_lower_bounds(seed):
    rng = np.random.default_rng(seed)
    ends = np.unique(rng.integers(1, rng.choice([10, 300, 5000]), rng.integers(1, 400)))
    values = np.sort(rng.integers(0, ends[-1] + 1, rng.integers(0, 300)))
    assert align.gallop(values, ends).tolist() == np.searchsorted(ends, values).tolist()


def test_long_lists_drive_from_the_shorter_side():
    ends = np.arange(1, 10_001)
    few = np.array([1, 2, 9_998, 10_000])
    for a, b in ((few, ends), (ends, few)):
        cut_a, cut_b, one, other = align.intersected(a, b)
        assert a[cut_a].tolist() == b[cut_b].tolist() == few.tolist() and len(one) == 10_000
        assert (np.maximum(np.append(0, a)[one], np.append(0, b)[other]) < np.minimum(a[one], b[other])).all()


def test_token_bytes_are_the_vocabulary_s():
    both = align.aligner(tokenizer_path(align.TOKENIZER_A), tokenizer_path(align.TOKENIZER_B))
    with open(tokenizer_path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {int(b): base64.b64decode(a) for a, b in (line.split() for line in f)}
    spelt = both.spelt[0].to_pylist()
    assert sorted(ranks.values()) == sorted(spelt[i] for i in ranks)

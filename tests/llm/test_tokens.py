"""Token output and packing against the tokenizers library."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from quarry.llm import packing, wavelet
from quarry.llm.tokens import PieceEncoder, TextEncoder, tokenizer_path

from .conftest import ROWS

BITS = ["a", "B", " ", "  ", "\n", "\t", "\x1c", "\xa0", "　", "É", "ß", "Σ", "'s", "'", "12", ".", "é", "İ", "日本", "<|endoftext|>", "don't", "\x85", "😀", "²", " x", " 's"]


@pytest.mark.parametrize("name, style", [("word_bpe_49k.json", "words"), ("byte_bpe_50k.json", "spaced")])
def test_chunks_encode_like_whole_texts(name, style):
    enc, rng = TextEncoder(tokenizer_path(name), style, limit=500), random.Random(1)
    for _ in range(4000):
        text = "".join(rng.choice(BITS) for _ in range(rng.randrange(14)))
        assert enc.ids(text.encode()) == enc.by_library(text), repr(text)
    texts = ["", *("".join(rng.choice(BITS) for _ in range(rng.randrange(14))) for _ in range(3000)), ""]
    assert enc.many([t.encode() for t in texts]) == [enc.by_library(t) for t in texts]
    assert enc.many([]) == [] and enc.many([b""]) == [b""]


@pytest.mark.parametrize("name, style", [("word_bpe_49k.json", "words"), ("byte_bpe_50k.json", "spaced")])
def test_added_tokens_encode_like_the_library(name, style):
    fresh, enc, rng = Tokenizer.from_file(tokenizer_path(name)), TextEncoder(tokenizer_path(name), style, limit=500), random.Random(3)
    bits = [*BITS, "<|startoftext|>", "<|endoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "|>", "\x01", "\x7f"]
    texts = ["a <|endoftext|> b", "<|ENDOFTEXT|>\x01", "<|startoftext|>a<|endoftext|>", *("".join(rng.choice(bits) for _ in range(rng.randrange(14))) for _ in range(4000))]
    assert fresh.token_to_id("<|endoftext|>") in np.frombuffer(enc.ids(texts[0].encode()), "<u4")
    for text in texts:
        assert np.frombuffer(enc.ids(text.encode()), "<u4").tolist() == fresh.encode(text, add_special_tokens=False).ids, repr(text)


def test_pieces_encode_like_the_library():
    enc, rng = PieceEncoder(tokenizer_path("piece_bpe_32k.model"), limit=500), random.Random(5)
    bits = [*BITS, "▁", "<s>", "<0x41>", "\x00", "   ", "the", " of"]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(14)))
        assert np.frombuffer(enc.ids(text.encode()), "<u4").tolist() == enc.whole.encode(text), repr(text)
    texts = ["", *("".join(rng.choice(bits) for _ in range(rng.randrange(14))) for _ in range(3000)), ""]
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.many([t.encode() for t in texts])] == enc.whole.encode(texts)


@pytest.mark.parametrize("n, top", [(0, 1), (1, 5), (511, 100), (512, 49408), (5000, 300), (3000, 70000)])
def test_wavelet_shard(n, top):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, top, n).astype(np.uint32)
    shard = wavelet.WaveletShard(wavelet.shard_bytes(ids, [1, None], np.array([0, n // 2])))
    assert (shard.decode() == ids).all() and (shard.access(np.arange(n)) == ids).all()
    for token in {0, 1, top - 1, 10**6, *ids[:5].tolist()}:
        assert (shard.occurrences(token) == np.flatnonzero(ids == token)).all()
        assert shard.rank(token, n // 2) == (ids[: n // 2] == token).sum()
        assert shard.count(token) == (ids == token).sum()
    assert shard.documents()[0] == [1, None] and shard.documents()[1].tolist() == [0, n // 2, n]


def encoded(name, text):
    return np.array([*Tokenizer.from_file(tokenizer_path(name)).encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def test_wavelet_files_round_trip(edge):
    got = wavelet.digest(edge, shard_ids=50).collect()
    rows = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    start, want = 0, []
    for d, t, *_ in rows:
        ids = encoded(wavelet.TOKENIZER, t)
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    key = lambda r: r[1]
    assert sorted(map(tuple, got), key=key) == want


def test_wavelet_lookup(spark, edge):
    shards = wavelet.read(spark, wavelet.write(edge, shard_ids=60))
    whole = {r["doc_id"]: np.frombuffer(r["ids"], "<u4") for r in wavelet.documents(shards).collect() if r["doc_id"] != 5}
    token = int(whole[4][1])
    found = wavelet.lookup(shards, [token, 2]).filter("doc_id is null or doc_id <> 5").collect()
    want = {(t, d, i) for d, ids in whole.items() for t in (token, 2) for i in np.flatnonzero(ids == t).tolist()}
    assert {(r["token"], r["doc_id"], r["in_document"]) for r in found} == want


@pytest.mark.parametrize("seed", range(40))
def test_plan_places_every_piece_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 30, 100])
    counts = {rng.randint(1, capacity): rng.randint(1, 30) for _ in range(rng.randint(1, 40))}
    seen, rows = Counter(), defaultdict(list)
    for length, number, many, first, offset in packing.plan(dict(counts), capacity):
        for i in range(many):
            seen[length, number + i] += 1
            rows[first + i].append((offset, length))
    assert seen == Counter((n, i) for n, c in counts.items() for i in range(c))
    for found in rows.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= capacity
    gaps: list = []  # best-fit decreasing, one by one
    for length in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        fits = [i for i, g in enumerate(gaps) if g >= length]
        if fits:
            gaps[min(fits, key=lambda i: gaps[i])] -= length
        else:
            gaps.append(capacity - length)
    assert len(rows) <= len(gaps) + 1


def test_pack_whole_documents(edge):
    got = packing.pack(edge).collect()
    name = packing.TOKENIZER
    want = Counter()
    for d, t, *_ in ROWS:
        ids = encoded(name, t)
        cut = len(ids) % 1024 or 1024
        cuts = [0, *range(cut, len(ids) + 1, 1024)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[d, i, a, b - a, zlib.crc32(ids[a:b].tobytes()), ids[a:b].tobytes()] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], bytes(r["ids"])) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for found in places.values():
        assert [o for o, _ in sorted(found)] == [sum(n for _, n in sorted(found)[:i]) for i in range(len(found))]
        assert sum(n for _, n in found) <= 1024


def test_sequences_join_their_pieces(edge):
    packed = packing.pack(edge)
    joined = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert joined[r["sequence_id"]][4 * r["offset"] : 4 * (r["offset"] + r["length"])] == bytes(r["ids"])


def test_empty_table(nothing):
    assert wavelet.digest(nothing).count() == 0 == packing.pack(nothing).count()

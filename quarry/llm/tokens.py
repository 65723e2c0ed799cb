"""Token ids of whole texts from the public tokenizer files, with a cache of words per worker.

Encoding a text costs far more than looking its words up, and words repeat. Both vocabularies split a
text before any merge, so the ids of a text are the ids of its chunks, one after the other:

* ``words``: white space is dropped, so a text splits at ASCII white space;
* ``spaced``: a space before a character that is not white space always begins a new piece, so a
  text splits before such spaces.

A chunk of plain Latin characters is split by the tokenizer's own pattern and each piece goes to the library's
merge model; any other chunk goes through the library's whole ``encode``. So does a whole text that holds the
string of an added token, which the library finds before it splits.

``PieceEncoder`` does the same for the sentencepiece file: no piece of it holds a space mark after another
character, so no merge crosses from a word to the spaces behind it, and a text splits before each run of spaces.
"""

from __future__ import annotations

import os
import re
import sys
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: The patterns by which the two files split a text, and their added strings.
WORDS_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPACED_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

PLAIN = re.compile("[\n\x20-\x7e\xa1-ɏ]*")
ODD_SPACE = re.compile(rb" (?![!-~\xc3-\xdf])")
END_ID = 2
_OPEN: dict = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in set(kept)]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(moved)}


class Cache(dict):
    """What ``make`` says of each key, kept for ``limit`` keys and the ``limit`` before them, from which what comes
    again is taken over."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        got = self.old.get(key)
        if got is None:
            got = self.make(key)
        self[key] = got
        return got

    def turn(self) -> None:
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()


class TextEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes. Each cache holds up to ``limit`` entries and the
    ``limit`` before them. ``plain_added``: the strings of added tokens are ordinary text."""

    def __init__(self, path: str, style: str, limit: int = 150_000, plain_added: bool = False):
        from tokenizers import Tokenizer

        assert sys.byteorder == "little" and array("I").itemsize == 4
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = plain_added
        self.tokenize = self.whole.model.tokenize
        self.style = style
        self.pattern = regex.compile(WORDS_PATTERN if style == "words" else SPACED_PATTERN)
        self.letters = byte_letters()
        added = [] if plain_added else self.whole.get_added_tokens_decoder().values()
        self.added = re.compile(b"|".join(re.escape(t.content.encode()) for t in added) or b"(?!)")
        self.chunks = Cache(self.of_word if style == "words" else self.of_spaced, limit)
        self.pieces = Cache(self.merged, limit)

    def by_library(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def merged(self, piece: str) -> bytes:
        """The ids of a piece that the pattern does not split further."""
        mapped = piece if piece.isalnum() and piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.tokenize(mapped)]).tobytes()

    def of_word(self, chunk: bytes) -> bytes:
        """The ids of a chunk between white space (style ``words``)."""
        if chunk.isalpha():
            return self.pieces[chunk.lower().decode()]
        if chunk[:-1].isalpha() and chunk[-1] in b".,":
            return self.pieces[chunk[:-1].lower().decode()] + self.pieces[chunk[-1:].decode()]
        text = chunk.decode("utf-8", "replace")
        if not PLAIN.fullmatch(text):  # as it stands: lower case could make an added string of it
            return self.by_library(text)
        lowered = unicodedata.normalize("NFC", text).lower()
        return self.pieces[lowered] if lowered.isalpha() else self.split(lowered)

    def of_spaced(self, chunk: bytes) -> bytes:
        """The ids of a chunk and the space before it (style ``spaced``)."""
        if chunk.isalpha():
            return array("I", [t.id for t in self.tokenize("Ġ" + chunk.decode())]).tobytes()
        if chunk[:-1].isalpha() and chunk[-1] in b".,":
            return self.chunks[chunk[:-1]] + self.pieces[chunk[-1:].decode()]
        text = chunk.decode("utf-8", "replace")
        if text.isalpha() and PLAIN.fullmatch(text):
            return self.merged(" " + text)
        return self.of_text(" " + text)

    def of_text(self, text: str) -> bytes:
        return self.split(text) if PLAIN.fullmatch(text) else self.by_library(text)

    def split(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(text)))

    def ids(self, text: bytes) -> bytes:
        """The ids of one whole text, without an end id."""
        if self.added.search(text):
            return self.by_library(text.decode("utf-8", "replace"))
        self.chunks.turn(), self.pieces.turn()
        if self.style == "words":
            return b"".join(map(self.chunks.__getitem__, text.split()))
        if not text:
            return b""
        if ODD_SPACE.search(text):
            parts = [x.encode() for x in re.split(r" (?=\S)", text.decode("utf-8", "replace"))]
        else:
            parts = text.split(b" ")
        first = self.of_text(parts[0].decode("utf-8", "replace")) if parts[0] else b""
        return first + b"".join(map(self.chunks.__getitem__, parts[1:]))


    def many(self, texts: list[bytes]) -> list[bytes]:
        """``ids`` of each text. Arrow finds the distinct chunks of all texts, so each meets the cache once."""
        apart = [bool(self.added.search(t) or self.style == "spaced" and ODD_SPACE.search(t)) for t in texts]
        column = pa.array([b"" if odd else t for t, odd in zip(texts, apart)], pa.binary()).view(pa.string())
        lists = pc.ascii_split_whitespace(column) if self.style == "words" else pc.split_pattern(column, " ")
        got = self.gathered(lists)
        return [self.ids(t) if odd else x for t, odd, x in zip(texts, apart, got)]

    def gathered(self, lists: pa.Array) -> list[bytes]:
        """The joined ids of each list of chunks; in style ``spaced`` no space stands before a list's first chunk."""
        self.chunks.turn(), self.pieces.turn()
        coded = lists.values.dictionary_encode()
        values = list(map(self.chunks.__getitem__, bytes_of(coded.dictionary)))
        at, ends = coded.indices.to_numpy(), lists.offsets.to_numpy()
        if self.style == "spaced":
            first = ends[:-1][np.diff(ends) > 0]
            at = at.copy()
            at[first] = np.arange(len(values), len(values) + len(first))
            values += [self.of_text(c.decode("utf-8", "replace")) if c else b"" for c in bytes_of(lists.values.take(pa.array(first)))]
        joined = pa.array(values, pa.binary()).take(pa.array(at))
        return bytes_of(joined, ends)


def bytes_of(column: pa.Array, ends: np.ndarray | None = None) -> list[bytes]:
    """The values of a string or binary column, or those between ``ends`` joined."""
    if not len(column):
        return [] if ends is None else [b""] * (len(ends) - 1)
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset)
    data = column.buffers()[2].to_pybytes() if column.buffers()[2] else b""
    cuts = (offsets if ends is None else offsets[ends]).tolist()
    return [data[a:b] for a, b in zip(cuts, cuts[1:])]


class PieceEncoder:
    """Ids of texts by a sentencepiece file, as little-endian unsigned 32-bit bytes, with a cache like that of
    ``TextEncoder``. The file's own space before a text is part of it."""

    #: A run of spaces and what follows it.
    CHUNK = re.compile(rb" *[^ ]+| +")

    def __init__(self, path: str, limit: int = 150_000):
        import sentencepiece

        self.whole = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.whole.id_to_piece(i) for i in range(self.whole.get_piece_size())]
        if any("\u2581" in n.lstrip("\u2581") for n in names):
            raise ValueError("a piece reaches over a space")
        self.limit = limit
        self.space = array("I", [self.whole.piece_to_id("\u2581")]).tobytes()
        self.chunks: dict[bytes, bytes] = {}
        self.old_chunks: dict[bytes, bytes] = {}

    def token_bytes(self) -> list[bytes]:
        """The bytes that each id stands for."""
        out = []
        for i in range(self.whole.get_piece_size()):
            name = self.whole.id_to_piece(i)
            out.append(bytes([int(name[3:5], 16)]) if self.whole.is_byte(i) else name.replace("\u2581", " ").encode())
        return out

    def fill(self, chunks: list[bytes]) -> None:
        if len(self.chunks) >= self.limit:
            self.old_chunks, self.chunks = self.chunks, {}
        fresh: list[bytes] = []
        for c in set(chunks).difference(self.chunks):
            got = self.old_chunks.get(c)
            if got is None:
                fresh.append(c)
            else:
                self.chunks[c] = got
        for c, ids in zip(fresh, self.whole.encode([c.decode("utf-8", "replace") for c in fresh], num_threads=1)):
            self.chunks[c] = array("I", ids).tobytes() if c else self.space

    def ids(self, text: bytes) -> bytes:
        """The ids of one whole text. A chunk stands in the cache without its first space, which the file adds."""
        if not text:
            return b""
        if b"\xe2\x96\x81" in text:  # the mark that stands for a space, written in the text
            return array("I", self.whole.encode(text.decode("utf-8", "replace"))).tobytes()
        if b"  " in text or text[0] == 32 or text[-1] == 32:
            chunks = [c[1:] if c[0] == 32 else c for c in self.CHUNK.findall(b" " + text)]
        else:
            chunks = text.split(b" ")
        self.fill(chunks)
        return b"".join(map(self.chunks.__getitem__, chunks))

    def many(self, texts: list[bytes]) -> list[bytes]:
        """``ids`` of each text; texts with single spaces between chunks share one search for distinct chunks."""
        apart = [not t or t[0] == 32 or t[-1] == 32 or b"  " in t or b"\xe2\x96\x81" in t for t in texts]
        lists = pc.split_pattern(pa.array([b"" if odd else t for t, odd in zip(texts, apart)], pa.binary()).view(pa.string()), " ")
        coded = lists.values.dictionary_encode()
        chunks = bytes_of(coded.dictionary)
        self.fill(chunks)
        values = [self.chunks[c] if c else b"" for c in chunks]
        joined = pa.array(values, pa.binary()).take(coded.indices)
        return [self.ids(t) if odd else x for t, odd, x in zip(texts, apart, bytes_of(joined, lists.offsets.to_numpy()))]


def byte_level_bytes(path: str) -> list[bytes]:
    """The bytes that each id of a byte-level file stands for."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    back = {letter: byte for byte, letter in byte_letters().items()}
    out = [b""] * whole.get_vocab_size()
    for name, i in whole.get_vocab().items():
        out[i] = bytes(back[c] for c in name) if all(c in back for c in name) else name.encode()
    return out


def encoder(path: str, style: str) -> TextEncoder:
    """One encoder per worker process; tasks that follow find its caches warm."""
    if (path, style) not in _OPEN:
        _OPEN[path, style] = TextEncoder(path, style)
    return _OPEN[path, style]

"""Information-theoretic sanitisation of personal data (operator 3).

Protected entities are the e-mail addresses, IP addresses, card and phone numbers that fixed rules find.
Terms can give an entity away even where it is masked, so the corpus tells how much each term reveals: with
N documents, of which n_e hold entity e, n_t term t and n_et both (t within ``WINDOW`` words of e),

    information of e    IC(e)     = -log(n_e / N)
    disclosure by t     PMI(t; e) = log(n_et * (1 - DISCOUNT / texts) * N / (n_e * n_t))

where ``texts`` is the number of different texts that show the pair. A pair seen in few texts is thus believed
less, but entities of a single text have disclosing terms too: the fewer other documents hold a term, the more
it gives away. A term whose PMI reaches ``GENERALISE_AT`` of IC(e) is generalised in the documents that hold e,
one that reaches ``REMOVE_AT`` is removed, wherever it stands in them. Documents without an entity stay as they
are.

The entities, their counts and the pairs come from one scan, written once; pairs and term counts are plain
aggregations over all documents, joined by key.

Defined results: a null text is empty; spans are in code points, end exclusive, and do not change the base
spans; an empty or clean text has no span; null doc_ids stay null; copies count as documents but not as
different texts; repeated rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, packed_row, slices, table, texts_of

WINDOW = 8
DISCOUNT = 0.5
GENERALISE_AT = 0.8
REMOVE_AT = 0.95
#: Kinds in the order of reports, and what stands for each in sanitised text.
KINDS = ("email", "ip", "card", "phone", "generalise", "remove")
MARKS = ("<EMAIL>", "<IP>", "<CARD>", "<PHONE>", "<TERM>", "")
#: The base rules. An address is found by its domain and grown leftwards; the others begin
#: at the first digit of a run or at a plus sign, so every rule reads a text once.
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TERM = r"\p{L}{3,}"
WORDS = regex.compile(TERM)
MAYBE = re.compile(rb"[0-9@]")


def luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    out, last = [], 0
    for m in DOMAIN.finditer(text):
        at = start = m.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            out.append((start, m.end()))
            last = m.end()
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), by kind and start; kinds may overlap each other."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    out += [(1, *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) < 256 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= sum(map(str.isdigit, m[0])) <= 15]
    return out


def neighbours(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[str, str, list[tuple[int, int]]]]:
    """(entity, term, places of the term in the text) for terms within WINDOW words of an entity."""
    words = [(m.start(), m.end()) for m in WORDS.finditer(text) if not any(a < m.end() and m.start() < b for _, a, b in spans)]
    starts = [a for a, _ in words]
    places: dict[str, list[tuple[int, int]]] = {}
    for a, b in words:
        places.setdefault(text[a:b].lower(), []).append((a, b))
    found: dict[tuple[str, str], None] = {}
    for kind, a, b in spans:
        left, right = bisect_left(starts, a), bisect_left(starts, b)
        for x, y in words[max(0, left - WINDOW) : left] + words[right : right + WINDOW]:
            found[f"{KINDS[kind]}:{text[a:b].lower()}", text[x:y].lower()] = None
    return [(e, t, places[t]) for e, t in found]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


SPANS = "array<struct<kind:int,start:int,end:int>>"
PAIRS = "array<struct<entity:string,term:string,places:array<struct<start:int,end:int>>>>"
SPAN_TYPE = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
PAIR_TYPE = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string()), ("places", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]))


def scan(docs: DataFrame, carry: bool) -> DataFrame:
    """(part, pos, doc_id, digest, base, pairs) of every row and, with ``carry``, its columns as ``row``."""
    kind = docs.select(packed_row(docs).alias("row")).schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in slices(batches):
            base, pairs, digest = [], [], []
            for raw in texts_of(batch):
                spans, near = [], []
                if MAYBE.search(raw):
                    text = raw.decode("utf-8", "replace")
                    spans = base_spans(text)
                    near = neighbours(text, spans) if spans else []
                base.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
                pairs.append([{"entity": e, "term": t, "places": [{"start": a, "end": b} for a, b in p]} for e, t, p in near])
                digest.append(hashlib.blake2b(raw, digest_size=16).digest() if spans else None)
            out = {
                "part": pa.array([part] * len(base), pa.int32()), "pos": pa.array(range(at, at + len(base)), pa.int64()), "doc_id": batch.column("doc_id"),
                "digest": pa.array(digest, pa.binary()), "base": pa.array(base, SPAN_TYPE), "pairs": pa.array(pairs, PAIR_TYPE),
            }
            yield pa.RecordBatch.from_pydict(out | ({"row": batch.column("row")} if carry else {}))
            at += len(base)

    source = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text")] + ([packed_row(docs).alias("row")] if carry else [])
    shape = f"part int, pos long, doc_id long, digest binary, base {SPANS}, pairs {PAIRS}" + (f", row {kind}" if carry else "")
    return table(map_batches(docs.select(*source), run, shape), "entities", compression="zstd")


def disclosing(docs: DataFrame, pairs: DataFrame, discount: float, generalise_at: float, remove_at: float) -> DataFrame:
    """(entity, term, kind) of the terms that reveal an entity too strongly, over the whole corpus."""
    total = docs.count()
    together = pairs.groupBy("entity", "term", "digest").agg(F.count("*").alias("n")).groupBy("entity", "term").agg(F.sum("n").alias("n_et"), F.count("*").alias("texts"))
    holders = pairs.groupBy("entity", "part", "pos").agg(F.lit(1).alias("one")).groupBy("entity").agg(F.count("*").alias("n_e"))
    asked = table(together.join(holders, "entity"), "together")
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(f"({TERM})"), F.lit(1)))).alias("term"))
    frequency = words.groupBy("term").agg(F.count("*").alias("n_t"))  # counted before it meets the pairs
    scored = asked.join(frequency, "term")
    information = -F.log(F.col("n_e") / F.lit(total))
    mutual = F.log(F.col("n_et") * (1 - F.lit(discount) / F.col("texts")) * F.lit(float(total)) / (F.col("n_e") * F.col("n_t")))
    scored = scored.withColumn("share", F.when(information > 0, mutual / information).otherwise(0.0)).filter(F.col("share") >= generalise_at)
    return scored.select("entity", "term", F.when(F.col("share") >= remove_at, 5).otherwise(4).alias("kind"))


def spans(docs: DataFrame, carry: bool = False, discount: float = DISCOUNT, generalise_at: float = GENERALISE_AT, remove_at: float = REMOVE_AT) -> DataFrame:
    """(doc_id, base, added and, with ``carry``, row) of every document."""
    found = scan(docs, carry)
    pairs = found.filter("size(pairs) > 0").select("part", "pos", "digest", F.explode("pairs").alias("p")).select("part", "pos", "digest", "p.*")
    strong = table(disclosing(docs, pairs, discount, generalise_at, remove_at), "disclosing")
    added = pairs.join(strong, ["entity", "term"]).select("part", "pos", "kind", F.explode("places").alias("at"))
    added = added.groupBy("part", "pos", "at").agg(F.max("kind").alias("kind"))  # a term may reveal several entities
    added = added.groupBy("part", "pos").agg(F.collect_list(F.struct("kind", "at.start", "at.end")).alias("added"))  # at most the terms of one document
    return found.drop("pairs", "digest").join(added, ["part", "pos"], "left")


def report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""

    def text_of(column):
        named = F.element_at(F.array(*map(F.lit, KINDS)), column["kind"] + 1)
        return F.concat_ws(":", named, column["start"].cast("string"), column["end"].cast("string"))

    base = F.array_join(F.transform("base", text_of), ",")
    ordered = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(SPANS))))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = {k})) as long)").alias(f"n_{KINDS[k]}") for k in range(4)]
    return spans(docs, **options).select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), F.array_join(F.transform(ordered, text_of), ",").alias("spans"))


def masked(text: str, found: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by its mark; of overlapping spans the earlier, then longer one."""
    out, at = [], 0
    for kind, a, b in sorted(found, key=lambda s: (s[1], -s[2], s[0])):
        if a >= at:
            out += [text[at:a], MARKS[kind]]
            at = b
        else:
            at = max(at, b)
    return "".join([*out, text[at:]])


def sanitised(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with entities masked and disclosing terms generalised or removed in ``text``."""
    whole = spans(docs, carry=True, **options)
    kind = whole.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for raw, spots in zip(batch.column("text").to_pylist(), batch.column("spots").to_pylist()):
                texts.append(masked(raw, [(s["kind"], s["start"], s["end"]) for s in spots]) if raw and spots else raw)
            yield pa.RecordBatch.from_pydict({"row": batch.column("row"), "text": pa.array(texts, pa.string())})

    spots = F.concat("base", F.coalesce("added", F.array().cast(SPANS))).alias("spots")
    clean = map_batches(whole.select("row", F.col("row.text").alias("text"), spots), run, f"row {kind}, text string")
    return clean.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])

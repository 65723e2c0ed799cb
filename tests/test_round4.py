"""Findings F2-F19 of round 4: what queries of larger tables did more often, or with more rows, than they needed."""

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions.patterns import PatternSet, classifier_branches
from quarry.functions.prefix import asof_last, running_sums
from quarry.operators import client as C
from quarry.operators import resolve as R
from quarry.operators import schema as S
from quarry.sources.files import file_line_counts, to_lines

from conftest import files_df


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_sums_of_small_keys_meet_no_totals(spark):
    rows = [(k, i * 1000, i % 3) for k in "abc" for i in range(50)] + [(None, 5, 1), ("a", None, 1)]
    df = spark.createDataFrame(rows, "k string, pos int, v int")
    got = running_sums(df, ["k"], "pos", {"n": F.lit(1), "s": "v"})
    assert "Join" not in _plan(got)
    assert {(r.k, r.pos): (r.n, r.s) for r in got.collect()} == {
        **{(k, i * 1000): (i + 1, sum(j % 3 for j in range(i + 1))) for k in "abc" for i in range(50)}, (None, 5): (None, None), ("a", None): (None, None)}


@pytest.mark.parametrize("chunk_rows", [8, 1 << 16])
def test_sums_and_asof_of_large_and_small_keys(spark, chunk_rows):
    rng = random.Random(chunk_rows)
    rows = [("big", i, rng.randrange(9), rng.choice([None, i])) for i in range(300)] + [(f"k{i}", j * 50, 1, i + j) for i in range(20) for j in range(3)]
    df = spark.createDataFrame(rows, "k string, pos int, v int, val int").repartition(4)
    sums, last, want = {}, {}, {}
    for k, pos, v, val in rows:
        sums[k] = sums.get(k, 0) + v
        last[k] = val if val is not None else last.get(k)
        want[k, pos] = (sums[k], last[k])
    got = asof_last(running_sums(df, ["k"], "pos", {"s": "v"}, chunk_rows), ["k"], "pos", "pos", "val", "o", chunk_rows)
    assert {(r.k, r.pos): (r.s, r.o) for r in got.collect()} == want


def test_asof_of_small_keys_meets_no_join(spark):
    df = spark.createDataFrame([("a", 1, 1, 7), ("a", 900000, 0, None)], "k string, pos int, kind int, val int")
    got = asof_last(df, ["k"], "pos", "kind", "val", "o")
    assert "Join" not in _plan(got) and [r.o for r in got.orderBy("pos").collect()] == [7, 7]


def test_plain_nodes_meet_neither_blocks_nor_files(spark):
    text = "type Query {\n  a: Int\n  b(x: In): Int\n}\ninput In { v: Int }\n"
    files = files_df(spark, [("x.gql", text), ("y.gql", "type A {\n  c: Int")])
    lines = to_lines(files)
    d, nodes, _ = S.build_nodes(lines)
    rows, still, span = S.enclosing_blocks(d, nodes)
    assert span == 1 and rows.filter("not unnamed and is_container and not single_line").count() == 2
    above = spark.createDataFrame([("x.gql", 1, 1), ("y.gql", 1, 1)], "path string, up_line int, up_level long") \
        .withColumn("near", F.create_map(F.lit("Type"), F.struct(F.col("up_line").alias("line"), F.col("up_level").alias("level"), F.lit("N").alias("name"))))
    met = S.standing(still, above)
    assert "Join" not in _plan(met)
    assert {(r.path, r.line): r.up_line for r in met.collect()} == {("x.gql", 2): 1, ("x.gql", 3): 1, ("x.gql", 5): None, ("y.gql", 2): 1}
    twice = S.standing(still, above.unionByName(above))
    assert twice.filter("line = 2").count() == 4  # blocks that come twice are met twice


@pytest.mark.parametrize("copies", [1, 2])
def test_nodes_of_files_that_come_several_times(spark, copies):
    files = files_df(spark, [("x.gql", "type Query {\n  a: Int\n}")])
    counts = file_line_counts(files)
    for _ in range(copies - 1):
        counts = counts.unionByName(file_line_counts(files))
    assert S.extract_objects(to_lines(files), counts)["nodes"].count() == 2 * copies


def test_classifier_names_groups_by_number():
    ps = PatternSet(patterns=[("a", [r"^\s*a[(]\s+(?:x|y)(?P<n>[A-Z(]+)", r"^\s*b\s+(q)(z)"]), ("m", [r"^\s*m\s+\((?P<receiver>r+)\)\s+(?P<n>[a-z]+)"])],
                    objects=[("A", "file", ["a"]), ("M", "file", ["m"])])
    for branches in (classifier_branches(), classifier_branches(ps)):
        for _, _, regex, repl, _ in branches:
            assert "${" not in repl
            numbers = re.compile("(?is)" + re.sub(r"^(\(\?\w+\))+", "", regex).replace("(?<", "(?P<")).groupindex
            parts = [int(x) for x in re.findall(r"\$(\d+)", repl.split("\u0002")[0])]
            assert parts == [numbers[f"a{i}"] for i in range(len(parts))]
            names = [int(x) for x in re.findall(r"\$(\d+)", repl.split("\u0002")[1].split("\u0003")[0])]
            assert names == [numbers[f"n{i}"] for i in range(len(names))]


def test_events_of_small_files_share_a_batch(spark, monkeypatch):
    sizes = []
    files = spark.createDataFrame([(f"{i}.js", f"const A{i} = gql`query Q{i} {{ f{i}(a: 1) {{ b }} }}`") for i in range(40)] + [("e.js", None)], "path string, content string")

    def run_here(df, func, schema):
        batch = pa.RecordBatch.from_pylist([r.asDict() for r in df.collect()], pa.schema([("path", pa.string()), ("content", pa.string())]))
        out = list(func(iter([batch])))
        sizes.extend(b.num_rows for b in out)
        return spark.createDataFrame(sum((b.to_pylist() for b in out), []), schema)

    monkeypatch.setattr(C, "map_rows", run_here)
    found = C.client_events(files)
    assert sizes == [40] and sorted(r.path for r in found.collect()) == sorted(f"{i}.js" for i in range(40))


def test_arguments_are_one_token(spark):
    text = 'query Q($a: T = {x: 1}) { a: b(x: {y: [1]}, z: "(") @d(if: $a) { c } e(f: g(h)) ... on T { i(\n j: 1) } k # (\n}'
    df = spark.createDataFrame([(text,)], "t string")
    tokens = df.select(F.explode(F.regexp_extract_all("t", F.lit(C.OP_TOKEN_RE), 0)).alias("x"))
    assert "($a: T = {x: 1})" in {r.x for r in tokens.collect()}
    assert df.select(C.root_fields(F.col("t")).alias("f")).first().f == ["b", "e", "i", "k"]


@pytest.mark.parametrize("text", [" a ", "\t\n\x0b\f\r", "", "a \u0085", " a  ", "a  ", "a\u0085 ", " a ", "a b", None])
def test_strip_is_what_the_regex_did(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    a, b = df.select(T.strip_ws(F.col("t")).alias("a"), F.regexp_replace("t", r"^\s+|\s+$", "").alias("b")).first()
    assert a == b


def test_import_clause_begins_with_its_word(spark):
    texts = ["import a from 'x'", "ximport a from 'x'", "$import a from 'x'", ".import a from 'x'", " import {\n a } from 'x'", "importa from 'x'"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.regexp_extract("t", C.IMPORT_CLAUSE_RE, 1).alias("c"))
    assert {r.t: r.c for r in df.collect()} == dict(zip(texts, ["a", "", "", "", "{\n a }", ""]))
    assert C.IMPORT_CLAUSE_RE.startswith("import")  # what Java's matcher searches for as a literal


def test_prefixes_and_suffixes_by_depth(spark):
    rng = random.Random(3)
    names = ["".join(rng.choice("a.b:.") for _ in range(rng.randrange(1, 9))) for _ in range(200)] + [".", ":", "a", "p/x.gql.Query.f"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    n = F.col("n")
    cols = [T.prefixes(n), T.prefixes(n, list(range(9))), T.prefixes(n, [0, 2]), T.suffixes(n), T.suffixes(n, list(range(9))), T.suffixes(n, [1])]
    for r in df.select("n", *[F.coalesce(c, F.array().cast("array<string>")).alias(f"c{i}") for i, c in enumerate(cols)]).collect():
        pre = [r.n[:i] for i, x in enumerate(r.n) if x == "."]
        post = [r.n[i + 1:] for i, x in enumerate(r.n) if x in ".:"]
        assert (r.c0, sorted(r.c1), sorted(r.c2)) == (pre, sorted(pre), sorted(x for x in pre if x.count(".") in (0, 2)))
        assert (r.c3, sorted(r.c4), sorted(r.c5)) == (post, sorted(post), sorted(x for x in post if x.count(".") + x.count(":") == 1))
    assert T.depths(df, n, ".:") == sorted({x.count(".") + x.count(":") for x in names})


def test_exact_names_ask_for_nothing_more(spark, monkeypatch):
    stored, kept = R.stored, {}
    monkeypatch.setattr(R, "stored", lambda df, name="step": kept.setdefault(name, stored(df, name)))
    objs = spark.createDataFrame([("S", "a.gql.S"), ("f", "a.gql.S.f"), ("f", "b.gql.S.f")], "name string, fullname string")
    reqs = spark.createDataFrame([(1, "a.gql.S.f", "a.gql", False, None), (2, "a.gql.S", None, None, None)],
                                 "req_id long, name string, context_path string, restrict_to_file boolean, restrict_to_class string")
    got = {r.req_id: (r.target, r.rule) for r in R.generic_resolve(reqs, objs).collect()}
    assert got == {1: ("a.gql.S.f", "exact"), 2: ("a.gql.S", "exact")} and set(kept) == {"resolver-requests", "resolver-exact"}

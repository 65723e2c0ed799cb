"""Sources, sinks and streaming ingestion."""

import os
import random
import tempfile

import pytest

from pyspark.sql import functions as F

from conftest import files_df
from quarry.functions import materialize as M
from quarry.functions.text import mask_source
from quarry.functions.patterns import PatternSet
from quarry.operators.extend import HandlerRegistry, count_by_key
from quarry.sources.catalog import inherited, meta_type_category
from quarry.sources.files import filter_extensions, listed, scan_folder, scan_lines, split_lines
from quarry.sources.sinks import write_links, write_objects
from quarry.streaming import ingest
from quarry.plans.pipeline import Analysis

SF = "/root/testdata/sf0.001"
SCHEMA = "type Query {\n  a(x: In): Int\n}\ninput In {\n  v: Int\n}\n"


def test_scan_folder_decodes_and_filters(spark):
    root = tempfile.mkdtemp(prefix="quarry-scan-")
    os.makedirs(os.path.join(root, "sub"))
    with open(os.path.join(root, "sub", "a.GraphQL"), "w", encoding="utf-8") as f:
        f.write(SCHEMA)
    with open(os.path.join(root, "b.gql"), "wb") as f:
        f.write("type Caf\xe9 {\n}\n".encode("latin-1"))  # not UTF-8 -> Latin-1 fallback
    with open(os.path.join(root, "c.txt"), "w") as f:
        f.write("type X {\n}\n")
    files = {os.path.basename(r["path"]): r["content"] for r in scan_folder(spark, root).collect()}
    assert set(files) == {"a.GraphQL", "b.gql"}
    assert files["b.gql"].startswith("type Café")
    assert scan_folder(spark, root, extensions=None).count() == 0  # S3: language not configured
    assert filter_extensions(files_df(spark, [("x.TXT", "")]), ["txt"]).count() == 1


def test_split_lines_like_python(spark):
    texts = ["a\r\nb\rc\n", "", "x", "a\n\nb", "a\x0bb\x1cc d"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(split_lines(F.col("t"))).collect()]
    assert got == [t.splitlines() for t in texts]


def test_sinks_partition_by_kind(spark):
    a = Analysis(spark, schema_files=files_df(spark, [("s.graphqls", SCHEMA)]), materialize=False)
    out = tempfile.mkdtemp(prefix="quarry-sink-")
    write_objects(a.objects(), os.path.join(out, "objects"))
    write_links(a.schema_links(), os.path.join(out, "links"))
    assert [d for d in os.listdir(os.path.join(out, "links")) if d.startswith("link_type=")] == ["link_type=useLink"]
    back = spark.read.parquet(os.path.join(out, "objects"))
    assert back.filter("type = 'GraphQLInput'").count() == 1
    marks = sorted((r["name"], r["bookmark"]["line"], r["bookmark"]["end_line"])
                   for r in back.filter("type = 'GraphQLField'").collect())
    assert marks == [("a", 2, 3), ("v", 5, 6)]


def test_streaming_per_file_pass_then_barrier(spark):
    base = tempfile.mkdtemp(prefix="quarry-stream-")
    src, objs, ckpt = (os.path.join(base, x) for x in ("src", "objects", "ckpt"))
    files_df(spark, [("s1.graphqls", SCHEMA)]).write.mode("append").parquet(src)
    files_df(spark, [("s2.graphqls", "type T {\n  b(y: In): Int\n}\n")]).write.mode("append").parquet(src)
    q = ingest.start(spark, src, objs, ckpt)
    q.awaitTermination()
    o = ingest.latest_objects(spark, objs)
    assert o.filter("type = 'GraphQLProgram'").count() == 2
    want = [("s1.graphqls.Query.a", "s1.graphqls.In"), ("s2.graphqls.T.b", "s1.graphqls.In")]
    assert sorted((r["caller"], r["callee"]) for r in ingest.finish(spark, objs).collect()) == want
    # a path delivered again, with another text: as if only the new text had ever been there
    changed = "type T {\n  other: Int\n  b(y: In): Int\n  c(z: In): Int\n}\n"
    files_df(spark, [("s2.graphqls", changed)]).write.mode("append").parquet(src)
    ingest.start(spark, src, objs, ckpt).awaitTermination()
    M.release()
    streamed = ingest.finish(spark, objs)
    assert not M._held()  # the barrier leaves no cache behind
    batch = Analysis(spark, schema_files=files_df(spark, [("s1.graphqls", SCHEMA), ("s2.graphqls", changed)]), materialize=False)
    both = [sorted((r["caller"], r["callee"], r["line"]) for r in df.collect()) for df in (streamed, batch.schema_links())]
    assert both[0] == both[1] and len(both[0]) == 3


def test_scan_lists_only_the_extensions(spark):
    root = tempfile.mkdtemp(prefix="quarry-glob-")
    for name in ("a.GraphQL", "b.txt"):
        with open(os.path.join(root, name), "w") as f:
            f.write("type X {\n}\n")
    assert [os.path.basename(f) for f in scan_folder(spark, root).inputFiles()] == ["a.GraphQL"]


def test_mask_long_literals(spark):
    texts = ['a "' + "x" * 1_000_000 + '" b', "a '" + "\\'" * 400_000 + "' b", "# c\nd", 'e """f\ng""" h', "no literal"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(mask_source(F.col("t"))).collect()]
    assert [g.replace(" ", "") for g in got] == ["ab", "ab", "\nd", "e\nh", "noliteral"]
    assert [len(g) for g in got] == [len(t) for t in texts]


def made(files):
    root = tempfile.mkdtemp(prefix="quarry-files-")
    for name, data in files.items():
        os.makedirs(os.path.dirname(os.path.join(root, name)), exist_ok=True)
        with open(os.path.join(root, name), "wb") as f:
            f.write(data)
    return root


def test_lines_of_files_longer_than_a_block(spark):
    """Files are read in blocks of a few bytes here, so every form of line end meets a border somewhere."""
    rng = random.Random(3)
    ends = ["\n", "\r\n", "\r", "\n\n", "\x0b", "\u2028"]
    texts = {f"d/f {i}+%.gql": "".join(rng.choice("abé{}") * rng.randrange(12) + rng.choice(ends) for _ in range(300)) + "end" for i in range(3)}
    root = made({n: t.encode() for n, t in texts.items()} | {"latin.gql": "caf\xe9\nb\x85c\n".encode("latin-1"), "empty.gql": b"", "x.txt": b"no"})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "97"), spark.conf.set("spark.sql.files.openCostInBytes", "0")
        df = scan_lines(spark, root)
        got: dict = {}
        for r in df.collect():
            got.setdefault(os.path.basename(r["path"]), []).append((r["line"], r["text"]))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0]), spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    want = {os.path.basename(n): list(enumerate(t.splitlines(), 1)) for n, t in texts.items()}
    want["latin.gql"] = [(1, "café"), (2, "b"), (3, "c")]
    assert {n: sorted(x) for n, x in got.items()} == want


def test_bad_files_are_error_rows(spark):
    schema = SCHEMA.encode()
    root = made({"a.graphqls": schema, "long.graphqls": b"# " + b"x" * 5000, "bad.graphqls": schema, ".bad.graphqls.crc": b"crc\x00\x00\x00\x02\x00\x01\x02\x03\x04"})
    web = made({"p.jsx": b'import { useQuery } from "x";\nfunction A() { useQuery(Q) }\n', "q.jsx": b"x" * 5000})
    a = Analysis.from_folders(spark, root, web, max_bytes=4000, materialize=False)
    assert sorted((os.path.basename(r["path"]), r["stage"], r["error"]) for r in a.errors().collect()) == [
        ("bad.graphqls", "scan", "not readable"), ("long.graphqls", "scan", "5002 bytes, more than 4000"), ("q.jsx", "scan", "5000 bytes, more than 4000")]
    assert a.report_totals().first().asDict() == {"n_files": 1, "n_objects": 5, "n_links": 1, "n_errors": 3}
    assert [r["parent"].rsplit(".", 1)[1] for r in a.requests().collect()] == ["A"]
    assert listed(spark, root).count() == 3


def test_failing_handlers_leave_the_others(spark):
    def breaks(df):
        return df.select(F.raise_error(F.lit("broken handler")).alias("x"))

    def no_plan(df):
        return df.select("missing")

    reg = HandlerRegistry()
    reg.register("type_def", count_by_key), reg.register("type_def", breaks), reg.register_pattern("input_.*", no_plan)
    reg.register_pattern("input", count_by_key)
    a = Analysis(spark, schema_files=files_df(spark, [("s.graphqls", SCHEMA)]), handlers=reg)
    assert sorted(tuple(r) for r in a.handled().collect()) == [("input_def", 1), ("type_def", 1)]
    got = {r["handler"]: (r["n_rows"], r["error"] is not None) for r in a.handler_outcomes().collect()}
    assert got == {"count_by_key:type_def": (1, False), "breaks:type_def": (0, True), "no_plan:input_.*": (0, True), "count_by_key:input": (1, False)}
    assert sorted(r["stage"] for r in a.errors().collect()) == ["handler breaks:type_def", "handler no_plan:input_.*"]
    assert "broken handler" in " ".join(r["error"] or "" for r in a.handler_outcomes().collect())


def test_pattern_sets_in_an_analysis(spark):
    ps = PatternSet(patterns=[("kind_kw", [r"^\s*kind\s+([A-Za-z]+)"])], objects=[("Program", "file", []), ("Kind", "file", ["kind_kw"])])
    a = Analysis(spark, schema_files=files_df(spark, [("k.src", "kind Box {\n}\ntype T {\n}\n")]), patterns=ps, materialize=False)
    assert sorted(r["fullname"] for r in a.objects().collect()) == ["k.src", "k.src.Box"]
    with pytest.raises(ValueError, match="mask_first"):
        Analysis(spark, SF, mask_first=True)


def test_categories_inherit(spark):
    own = spark.createDataFrame([("T", "a"), ("U", "b")], "type string, category string")
    parents = spark.createDataFrame([("a", "b"), ("b", "c"), ("b", "d"), ("d", "c")], "category string, parent string")
    assert sorted(map(tuple, inherited(own, parents).collect())) == [("T", c) for c in "abcd"] + [("U", c) for c in "bcd"]
    found = {r["category"] for r in meta_type_category(spark).filter("type = 'GraphQLField'").collect()}
    assert found == {"UAObject", "GraphQL_Artifacts", "APM Client Language Artifacts"}

"""Steps that several tables need are done once: findings F1-F9 of round 3 (time of the schema and client passes)."""

import pytest
from pyspark.sql import functions as F

from quarry.functions.prefix import asof_last
from quarry.operators import client as C
from quarry.operators import schema as S
from quarry.plans.pipeline import Analysis
from quarry.sources import corpus as K


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_schema_corpus_is_built_once(spark, monkeypatch):
    built = []

    def corpus(spark, d):
        built.append(d)
        lines = spark.createDataFrame([("a.graphqls", 1, "type Query {"), ("a.graphqls", 2, "}")], "path string, line int, text string")
        return lines, lines.groupBy("path").agg(F.max("line").alias("n_lines"))

    monkeypatch.setattr(K, "schema_corpus", corpus)
    lines, files = Analysis(spark, "/nowhere").schema_input()
    assert (lines.count(), [tuple(r) for r in files.collect()], built) == (2, [("a.graphqls", 2)], ["/nowhere"])


def test_first_word_of_a_line_is_read_once(spark):
    lines = spark.createDataFrame([("a", 1, "type A {"), ("a", 2, "  f: Int"), ("a", 3, "")], "path string, line int, text string")
    out = S.classify(lines)
    assert _plan(out).count(r"^\s*([A-Za-z][A-Za-z0-9_]*)") == 1
    assert {(r.line, r.pattern_key, r.name, r.obj_type, r.expected_parent) for r in out.collect()} == {
        (1, "type_def", "A", "Type", "Schema"), (2, "field_def", "f", "Field", "Type"), (3, None, None, None, None)}


def test_operation_header_is_read_once(spark):
    text = "import { gql } from 'x'\nconst A = gql`query Q($a: ID) { x: user(id: $a) { id } }`"
    files = spark.createDataFrame([("a.js", text)], "path string, content string")
    out = C.client_definitions(files)
    assert _plan(out).count(C.ALIAS_RE) <= 2
    r = out.first()
    assert (r.type, r.op.operationName, r.op.variables, r.op.fieldsSelected, r.op.aliases) == ("GraphQLClientQuery", "Q", ["$a"], ["user"], {"x": "user"})


@pytest.mark.parametrize("second, kept", [("nothing", 2), ("import {\n  gql\n} from 'x'", 2), (None, 2)])
def test_files_of_one_path_are_kept_together(spark, second, kept):
    rows = [("a.js", "import React, { gql } from 'x'"), ("a.js", second), ("b.js", "import React from 'x'"),
            ("c.js", "const useQuery = 1"), ("d.js", "import gql"), (None, "import { gql } from 'x'")]
    found = C.client_files(spark.createDataFrame(rows, "path string, content string")).collect()
    assert sorted(r.path for r in found) == ["a.js"] * kept + ["d.js"]


def test_text_of_files_with_a_clause_meets_no_join(spark):
    files = spark.createDataFrame([("a.js", "import { gql } from 'x'")], "path string, content string")
    top = C.client_files(files)._jdf.queryExecution().optimizedPlan()
    assert top.nodeName() == "Union"  # the files with a clause; those of the others that the join finds


def test_only_repeated_names_are_compared(spark, monkeypatch):
    """Findings F3-F8, F15-F29 of round 3: names that come once met in a sort of all order keys."""
    kept, stored = {}, S.stored

    def keep(df, name="step"):
        kept[name] = stored(df, name)
        return kept[name]

    monkeypatch.setattr(S, "stored", keep)
    text = ["type Query {", "  a: Int", "}", "type B {", "  a: Int", "}", "extend type Query {", "  a: Int", "  c: Int", "}"]
    lines = spark.createDataFrame([("x", k, t) for k, t in enumerate(text, 1)] + [("y", 1, "type Query {"), ("y", 2, "}")], "path string, line int, text string")
    out = S.extract_objects(lines, lines.groupBy("path").agg(F.max("line").alias("n_lines")))
    assert sorted((r.path, r.fullname) for r in kept["names-first"].collect()) == [("x", "x.Query"), ("x", "x.Query.a")]
    assert sorted((r.path, r.fullname, r.start_line) for r in out["objects"].collect()) == [
        ("x", "x", 1), ("x", "x.B", 4), ("x", "x.B.a", 5), ("x", "x.Query", 1), ("x", "x.Query.a", 2), ("x", "x.Query.c", 9), ("y", "y", 1), ("y", "y.Query", 1)]
    assert sorted((r.path, r.line, r.enclosing) for r in out["nodes"].filter("not is_registered").collect()) == [("x", 7, None), ("x", 8, None)]


def test_asof_orders_only_rows_with_a_value(spark):
    rows = [("a", 1, 1, 7), ("a", 5, 0, None), ("a", 9, 0, None), ("a", 6, 1, 8), ("b", 5, 0, None), (None, 3, 1, 4), (None, 4, 0, None)]
    got = asof_last(spark.createDataFrame(rows, "k string, pos int, kind int, val int"), ["k"], "pos", "kind", "val", "o", chunk_rows=4)
    assert {(r.k, r.pos): r.o for r in got.collect()} == {("a", 1): 7, ("a", 5): 7, ("a", 6): 8, ("a", 9): 8, ("b", 5): None, (None, 3): 4, (None, 4): None}
    ordered = [x for x in _plan(got).split("\n") if "max_by" in x and "Aggregate" in x]
    assert ordered and "CASE WHEN isnotnull" not in ordered[0]  # rows without a value are left out before


def test_lines_are_classified_once(spark, monkeypatch):
    """The depth is a sum that reads its rows twice: the lines' totals come from the lines as they were, not as classified."""
    seen = {}
    monkeypatch.setattr(S, "stored", lambda df, name="step": seen.setdefault(name, df))
    lines = spark.createDataFrame([("a", 1, "type A {"), ("a", 2, "  f: Int"), ("a", 3, "}"), ("b", 1, "enum E {")], "path string, line int, text string")
    S.build_nodes(lines)
    rows = seen["classified"]
    assert _plan(rows).count("Generate ") == 1
    got = {(r["path"], r["line"]): (r["name"], r["depth_prev"], r["depth"]) for r in rows.collect()}
    assert got == {("a", 1): ("A", 0, 1), ("a", 2): ("f", 1, 1), ("a", 3): (None, 1, 0), ("b", 1): ("E", 0, 1)}

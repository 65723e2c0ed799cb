"""One small input per behaviour decision. All schema quirks run as
files of one analysis so the plan is built once."""

import pytest
from pyspark.sql import functions as F

from conftest import files_df, kb_df
from quarry.functions.text import mask_source
from quarry.operators import client as C
from quarry.operators import imports as I
from quarry.operators import link as L
from quarry.plans.pipeline import Analysis
from quarry.sources.files import to_lines

SCHEMA_FILES = {
    "d1.graphqls": "schema {\n  query: Query\n}\n",
    "d2.graphqls": "type A {\n  id\n}\n",
    "d3.graphqls": 'type A {\n  """d""" name: String\n}\n',
    "d4.graphqls": "directive @a(x: Int) repeatable on FIELD\n",
    "d5.graphqls": "$a: ID!\n  $b: ID!\n",
    "d6.graphqls": "query ($id: ID!) {\n  x\n}\nmutation {\n  y\n}\n",
    "d7.graphqls": "type A\n{\n  x: Int\n}\n",
    "d8.graphqls": "type A { x: Int }\n",
    "d9.graphqls": "# {\ntype A {\n  x: Int\n}\n",
    "d22.graphqls": "type A {\n  x: Int\n}\nenum A {\n  RED\n}\n",
    "d23.graphqls": "type T {\n  f(a: In, b: In): T\n}\ninput In {\n  v: Int\n}\n",
    "ext.graphqls": "type Q {\n  a: Int\n}\nextend type Q {\n  b: Int\n}\n",
    "deep.graphqls": "type A {\n  input B {\n    x: Int\n  }\n  y: Int\n}\n",
    "eof.graphqls": "type Open {\n  x: Int\n",
    "neg.graphqls": "}\n}\ntype A {\n  x: Int\n}\n",
    "empty.graphqls": "",
}


@pytest.fixture(scope="module")
def objs(spark):
    a = Analysis(spark, schema_files=files_df(spark, list(SCHEMA_FILES.items())), materialize=False)
    rows = a.objects().collect()
    by = {}
    for r in rows:
        by.setdefault(r["path"], []).append(r)
    return a, by


def _names(by, path):
    return sorted((r["type"], r["fullname"].split(path + ".", 1)[-1], r["start_line"], r["end_line"])
                  for r in by[path] if r["type"] != "GraphQLProgram")


def test_d1_schema_block_has_no_object(objs):
    _, by = objs
    assert _names(by, "d1.graphqls") == [("GraphQLField", "query", 2, 2)]


def test_d2_bare_word_is_enum_value(objs):
    _, by = objs
    assert ("GraphQLEnumValue", "A.id", 2, 2) in _names(by, "d2.graphqls")


def test_d3_description_key_shadows_fields(objs):
    _, by = objs
    assert ("GraphQLEnumValue", "A.name", 2, 2) in _names(by, "d3.graphqls")


def test_d4_directive_line_is_enum_value(objs):
    # enum_value_directive (NAME @x, case-insensitive) is tried before every directive key, so a
    # `directive @a ...` line yields EnumValue 'directive' (correcting SURVEY D4)
    _, by = objs
    assert _names(by, "d4.graphqls") == [("GraphQLEnumValue", "directive", 1, 1)]


def test_d5_variables_only_at_column_zero(objs):
    _, by = objs
    assert _names(by, "d5.graphqls") == [("GraphQLVariable", "a", 1, 1)]


def test_d6_anonymous_operations(objs):
    _, by = objs
    got = _names(by, "d6.graphqls")
    assert ("GraphQLMutation", "mutation", 4, 6) in got
    assert not [g for g in got if g[0] == "GraphQLQuery"]


def test_d7_brace_on_next_line(objs):
    _, by = objs
    assert _names(by, "d7.graphqls") == [("GraphQLField", "x", 3, 3), ("GraphQLType", "A", 1, 1)]


def test_d8_single_line_block(objs):
    _, by = objs
    assert _names(by, "d8.graphqls") == [("GraphQLType", "A", 1, 1)]


def test_d9_braces_in_comments_count(objs):
    _, by = objs
    assert ("GraphQLType", "A", 2, 4) in _names(by, "d9.graphqls")


def test_d22_second_kind_dropped_children_merged(objs):
    _, by = objs
    got = _names(by, "d22.graphqls")
    assert ("GraphQLType", "A", 1, 3) in got
    assert not [g for g in got if g[0] == "GraphQLEnum"]
    assert ("GraphQLEnumValue", "A.RED", 5, 5) in got


def test_extend_merges_children(objs):
    _, by = objs
    got = _names(by, "ext.graphqls")
    assert got == [("GraphQLField", "Q.a", 2, 2), ("GraphQLField", "Q.b", 5, 5), ("GraphQLType", "Q", 1, 3)]


def test_expected_parent_skips_inner_container(objs):
    _, by = objs
    got = _names(by, "deep.graphqls")
    # Field x expects a Type: the outer type A wins over the inner input B
    assert ("GraphQLField", "A.x", 3, 3) in got
    assert ("GraphQLInput", "A.B", 2, 4) in got
    assert ("GraphQLField", "A.y", 5, 5) in got


def test_block_open_at_eof_ends_on_last_line(objs):
    _, by = objs
    assert ("GraphQLType", "Open", 1, 2) in _names(by, "eof.graphqls")


def test_negative_depth(objs):
    _, by = objs
    assert ("GraphQLType", "A", 3, 5) in _names(by, "neg.graphqls")


def test_empty_file_has_program(objs):
    _, by = objs
    assert [(r["type"], r["end_line"]) for r in by["empty.graphqls"]] == [("GraphQLProgram", 1)]


def test_d23_two_links(objs):
    a, _ = objs
    links = [r for r in a.schema_links().collect() if r["path"] == "d23.graphqls"]
    assert sorted((r["caller"], r["callee"], r["arg_pos"]) for r in links) == [
        ("d23.graphqls.T.f", "d23.graphqls.In", 0), ("d23.graphqls.T.f", "d23.graphqls.In", 1)]


def test_d10_masking_keeps_newlines(spark):
    df = spark.createDataFrame([("a # b\nc",), ('x "s\\"t" y /* c\nd */ e',), ("'''a\nb''' z",)], "t string")
    got = [r[0] for r in df.select(mask_source(F.col("t"))).collect()]
    assert got == ["a    \nc", "x        y     \n     e", "    \n     z"]


def test_d11_imports(spark):
    lines = to_lines(files_df(spark, [("m.py", "from a.b import c\nimport X from 'm'\nimport { a, b as c } from 'm'\n"
                                                "import (\n  \"fmt\"\n\t)\n\"x\"\n")]))
    got = sorted((r["line"], r["name"], r["source"]) for r in I.extract_imports(lines).collect())
    # a quoted line counts as an import even outside a block (D11); a tab-indented closer ends the block
    assert got == [(1, "a.b", "c"), (2, "X", "X"), (3, "a", "m"), (3, "b", "m"), (3, "c", "m"), (5, "fmt", "fmt"),
                   (7, "x", "x")]


CLIENT_FILES = [
    ("c1.jsx", "import { gql, useQuery } from '@apollo/client';\n"
               "function A() {\n  useQuery(LATER);\n  useQuery(gql`query { ping }`);\n}\n"
               "const T = gql`query Q {\n\tusers { id } }`;\n"
               "gql`query Q { b { x: a(i: 1) } }`;\n"),
    ("c2.jsx", "import { gql, useQuery } from '@apollo/client';\n"
               "const LATER = gql`query L { users { id } posts { id } }`;\n"
               "const V = gql`query V { version }`;\n"
               "const M = gql`query M { m: user(id: 1) { id } }`;\n"
               "function B() {\n  useQuery(LATER, { fetchPolicy: 'cache-first' });\n  useQuery(later);\n}\n"),
]


@pytest.fixture(scope="module")
def client(spark):
    a = Analysis(spark, client_files=files_df(spark, CLIENT_FILES), materialize=False)
    return a, {r["name"]: r for r in a.definitions().collect()}, a.requests().collect()


def test_d12_tab_indented_template(client):
    _, defs, _ = client
    assert defs["T"]["op"]["fieldsSelected"] == ["users"]


def test_d13_anonymous_name_and_sorted_fields(client):
    _, defs, _ = client
    anon = [d for n, d in defs.items() if n.startswith("anonymous_gql_")]
    assert len(anon) == 1 and anon[0]["name"] == "anonymous_gql_c1.jsx:8"
    assert anon[0]["op"]["fieldsSelected"] == ["a", "b"]


def test_d14_first_block_only(client):
    _, defs, _ = client
    assert defs["LATER"]["op"]["fieldsSelected"] == ["users"]
    assert defs["V"]["op"]["fieldsSelected"] == []
    assert defs["M"]["op"]["fieldsSelected"] == ["user"] and defs["M"]["op"]["aliases"] == {"m": "user"}


ROOT_FIELDS = [
    ("query Q { users { id } posts { id } }", ["users", "posts"]), ("query Q { version }", ["version"]), ("query Q { m: user(id: 1) { id } }", ["user"]),
    ("query Q($a: T = { b: 1 }) @live { x(in: { y: { z: 1 } }) @include(if: $a) { y } w: v }", ["x", "v"]), ("{ a b, c }", ["a", "b", "c"]),
    ("query { ...F a ...on T { b { on } c } ... @skip(if: $x) { d } ... on U @include(if: $y) { e } ...G @live f }", ["a", "b", "c", "d", "e", "f"]),
    ("query { a(s: \"} b {\") # } x\n b } fragment F on T { c }", ["a", "b"]), ("query { a { ... on T { b } } a c: a }", ["a"]), ("query {", []), ("", []),
    ("mutation M { on: query { on } fragment }", ["query", "fragment"]),
]


def test_d14_root_fields_exact(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(ROOT_FIELDS)], "i int, t string")
    got = {r["i"]: r["f"] for r in df.select("i", C.root_fields(F.col("t")).alias("f")).collect()}
    assert got == {i: f for i, (_, f) in enumerate(ROOT_FIELDS)}
    files = files_df(spark, [("r.jsx", "import { gql } from 'x';\nconst Q = gql`query Q { users { id } version }`;\n")])
    exact, plain = (Analysis(spark, client_files=files, materialize=False, root_fields_exact=x).definitions().first()["op"]["fieldsSelected"] for x in (True, False))
    assert (exact, plain) == (["users", "version"], ["users"])


def test_d15_inline_template_hook(client):
    _, defs, reqs = client
    r = [x for x in reqs if x["path"] == "c1.jsx" and x["line"] == 4][0]
    assert r["name"] == "useQuery:gql" and r["definition"] is None
    assert defs["useQuery"]["line"] == 4  # the inline template takes the enclosing call's name


def test_d16_definition_lookup_follows_file_order(client):
    _, _, reqs = client
    by = {(x["path"], x["line"]): x for x in reqs}
    assert by[("c1.jsx", 3)]["definition"] is None          # defined only in a later file
    assert by[("c2.jsx", 6)]["definition"] == "c2.jsx:2"
    assert by[("c2.jsx", 6)]["fetch_policy"] == "cache-first"
    assert by[("c2.jsx", 7)]["definition"] is None and by[("c2.jsx", 7)]["case_mismatch"] is True


def test_d18_first_class_by_name_decides(spark):
    kb = kb_df(spark, [(1, "JV_CLASS", "S", "a.S", []), (2, "JV_CLASS", "S", "b.S", ["@Controller"]),
                       (3, "JV_METHOD", "m", "a.S.m", ["@QueryMapping"]), (4, "JV_METHOD", "n", "b.S.n", ["@QueryMapping"])])
    got = {r["name"]: r["controller_ok"] for r in L.controller_methods(kb).collect()}
    assert got == {"m": False, "n": False}


def test_options_strict_case_and_mask_first(spark):
    src = "type A {\n  x: Int # {\n  id\n}\ntype B {\n}\n"
    base = Analysis(spark, schema_files=files_df(spark, [("o.graphqls", src)]), materialize=False)
    opt = Analysis(spark, schema_files=files_df(spark, [("o.graphqls", src)]), materialize=False,
                   strict_case=True, mask_first=True)
    b = {r["fullname"]: r["end_line"] for r in base.objects().collect()}
    o = {r["fullname"]: r["end_line"] for r in opt.objects().collect()}
    # D9 reproduced: the brace in the comment keeps A open, so B nests under it
    assert b["o.graphqls.A"] == 6 and "o.graphqls.A.B" in b and b["o.graphqls.A.x"] == 4 and "o.graphqls.A.x.id" in b
    # mask_first removes the comment brace; strict_case stops `id` from being an EnumValue
    assert o["o.graphqls.A"] == 4 and o["o.graphqls.B"] == 6 and o["o.graphqls.A.x"] == 2
    assert not [k for k in o if k.endswith(".id")]


def test_pre_parsed_calls_path(spark):
    from quarry.operators import client as C
    from quarry.operators import lineage as G
    calls = spark.createDataFrame([
        ("a.jsx", 4, 0, "gql", "`\n query Q { users { id } }\n`", None, "Q_USERS", None),
        ("a.jsx", 9, 1, "useQuery", "Q_USERS", "{ fetchPolicy: 'no-cache' }", None, "a.jsx.App"),
        ("a.jsx", 10, 2, "useMutation", "X", None, None, None),
    ], "path string, line int, pos int, callee string, arg0 string, arg1_text string, assigned_to string, enclosing string")
    defs = C.definitions_from_calls(calls)
    reqs = C.requests_from_calls(calls)
    d = defs.first()
    assert (d["name"], d["type"], d["op"]["fieldsSelected"]) == ("Q_USERS", "GraphQLClientQuery", ["users"])
    r = [tuple(x) for x in reqs.select("name", "parent", "fetch_policy").collect()]
    assert r == [("useQuery:Q_USERS", "a.jsx.App", "no-cache")]
    looked = C.definition_lookup(reqs, defs).first()
    assert looked["definition"] == "a.jsx:4"
    props = C.definition_properties(defs)
    s = G.search_objects(defs.select("fullname", "name", "type"), props, name="Q_USERS").first()
    assert s["properties"]["GraphQL_Client_Definition.fieldsSelected"] == "users"


def test_x16_receiver_and_unnamed_group_patterns(spark):
    from quarry.functions.patterns import PatternSet
    from quarry.operators import schema as S
    ps = PatternSet(patterns=[("method", [r"^\s*func\s+\((?P<receiver>\*?[A-Za-z]+)\)\s+(?P<n>[A-Za-z]+)"]),
                              ("type_kw", [r"^\s*kind\s+([A-Za-z]+)"])],
                    objects=[("Program", "file", []), ("Method", "Kind", ["method"]), ("Kind", "file", ["type_kw"])])
    src = "kind Box {\n  func (*Crate) Open\n}\n"
    lines = to_lines(files_df(spark, [("g.src", src)]))
    from quarry.sources.files import file_line_counts
    objs = {r["fullname"]: (r["type"], r["parent_fullname"])
            for r in S.extract_objects(lines, file_line_counts(files_df(spark, [("g.src", src)])), ps)["objects"].collect()}
    assert objs["g.src.Box"] == ("GraphQLKind", "g.src")
    # receiver '*Crate' replaces the ancestor prefix; the parent object stays the enclosing Box
    assert objs["g.src.Crate.Open"] == ("GraphQLMethod", "g.src.Box")

"""Hand-derived goldens for one schema file, one client file and a backend catalogue (FIXTURES §1)."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import files_df, kb_df
from quarry.operators import link as L
from quarry.plans.pipeline import Analysis

HERE = os.path.dirname(os.path.abspath(__file__))
P = "app/library.graphqls"
J = "web/Library.jsx"


def _read(name):
    with open(os.path.join(HERE, "data", name), encoding="utf-8") as f:
        return f.read()


def _analysis(spark, kb=None):
    return Analysis(spark, schema_files=files_df(spark, [(P, _read("library.graphqls"))]),
                    client_files=files_df(spark, [(J, _read("Library.jsx"))]), kb=kb, materialize=False)


@pytest.fixture(scope="module")
def lib(spark):
    return _analysis(spark, kb=kb_df(spark, KB_ROWS))


KB_ROWS = [
    (1, "JV_CLASS", "BookController", "x.BookController", ["@Controller"]),
    (2, "JV_METHOD", "books", "x.BookController.books", ["@QueryMapping"]),
    (3, "JV_METHOD", "addBook", "x.BookController.addBook", ["@QueryMapping"]),
    (4, "JV_METHOD", "helper", "x.BookController.helper", []),
    (5, "JV_CLASS", "PlainService", "x.PlainService", ["@Service"]),
    (6, "JV_METHOD", "book", "x.PlainService.book", ["@QueryMapping"]),
    (7, "JV_CLASS", "Adv", "x.Adv", ["@ControllerAdvice"]),
    (8, "JV_CLASS", "Rest", "x.Rest", ["@RestController"]),
]


def test_schema_objects(lib):
    a = lib
    rows = sorted((r["start_line"], r["type"], r["name"], r["fullname"], r["parent_fullname"], r["end_line"])
                  for r in a.objects().collect())
    assert len(rows) == 14
    expect = [
        (1, "GraphQLProgram", "library.graphqls", P, None, 20),
        (1, "GraphQLType", "Query", P + ".Query", P, 4),
        (2, "GraphQLField", "book", P + ".Query.book", P + ".Query", 2),
        (3, "GraphQLField", "books", P + ".Query.books", P + ".Query", 3),
        (6, "GraphQLType", "Mutation", P + ".Mutation", P, 8),
        (7, "GraphQLField", "addBook", P + ".Mutation.addBook", P + ".Mutation", 7),
        (10, "GraphQLInput", "AddBookInput", P + ".AddBookInput", P, 14),
        (11, "GraphQLField", "id", P + ".AddBookInput.id", P + ".AddBookInput", 11),
        (12, "GraphQLField", "title", P + ".AddBookInput.title", P + ".AddBookInput", 12),
        (13, "GraphQLField", "author", P + ".AddBookInput.author", P + ".AddBookInput", 13),
        (16, "GraphQLType", "Book", P + ".Book", P, 20),
        (17, "GraphQLField", "id", P + ".Book.id", P + ".Book", 17),
        (18, "GraphQLField", "title", P + ".Book.title", P + ".Book", 18),
        (19, "GraphQLField", "author", P + ".Book.author", P + ".Book", 19),
    ]
    assert rows == sorted(expect, key=lambda r: (r[0], r[1], r[2], r[3], r[4] or "", r[5]))
    guid = a.objects().filter(F.col("name") == "addBook").first()["guid"]
    assert guid == f"GraphQLField?[{P}].{P}.Mutation.addBook@7"


def test_schema_link(lib):
    a = lib
    links = a.schema_links().collect()
    assert [(r["link_type"], r["caller"], r["callee"], r["line"]) for r in links] == \
        [("useLink", P + ".Mutation.addBook", P + ".AddBookInput", 7)]
    bm = links[0]["bookmark"]
    assert (bm["line"], bm["col"], bm["end_line"], bm["end_col"]) == (7, 1, 7, -1)


def test_client_definitions_and_requests(lib):
    a = lib
    defs = {r["name"]: r for r in a.definitions().collect()}
    assert set(defs) == {"LIST_BOOKS", "ADD_BOOK"}
    q, m = defs["LIST_BOOKS"], defs["ADD_BOOK"]
    assert (q["line"], q["type"], q["op"]["operationName"], q["op"]["variables"], q["op"]["fieldsSelected"]) == \
        (4, "GraphQLClientQuery", "ListBooks", [], ["books"])
    assert (m["line"], m["type"], m["op"]["operationName"], m["op"]["variables"], m["op"]["fieldsSelected"]) == \
        (10, "GraphQLClientMutation", "AddBook", ["$input"], ["addBook"])
    assert q["fullname"] == J + ":4"
    reqs = sorted((r["line"], r["name"], r["type"], r["parent"], r["definition"]) for r in a.requests().collect())
    assert reqs == [(17, "useQuery:LIST_BOOKS", "GraphQLQueryRequest", J + ".Library", J + ":4"),
                    (18, "useMutation:ADD_BOOK", "GraphQLMutationRequest", J + ".Library", J + ":10")]
    links = sorted((r["link_type"], r["caller"], r["callee"]) for r in a.client_links().collect())
    assert links == sorted([("callLink", J + ".Library", J + ":17"), ("callLink", J + ".Library", J + ":18"),
                            ("useLink", J + ":17", J + ":4"), ("useLink", J + ":18", J + ":10")])


def test_definition_field_links(lib):
    a = lib
    got = sorted((r["caller"], r["callee"]) for r in a.definition_field_links().collect())
    assert got == [(J + ":10", P + ".Mutation.addBook"), (J + ":4", P + ".Query.books")]


def test_backend_links_and_summary(spark, lib):
    a = lib
    st = {r["method_fullname"]: r["status"] for r in a.method_matches().collect()}
    assert st == {"x.BookController.books": "linked", "x.BookController.addBook": "missing_annotation",
                  "x.BookController.helper": "not_matched", "x.PlainService.book": "gated_out"}
    links = [(r["caller"], r["callee"]) for r in a.field_method_links().collect()]
    assert links == [(P + ".Query.books", "x.BookController.books")]
    s = L.link_summary(a.method_matches(), a.schema_index()).first().asDict()
    assert s == {"query_links": 1, "mutation_links": 0, "subscription_links": 0, "total_links": 1, "not_matched": 1}
    adv = L.controller_methods(kb_df(spark, KB_ROWS + [(9, "JV_METHOD", "m1", "x.Adv.m1", []),
                                                        (10, "JV_METHOD", "m2", "x.Rest.m2", [])]))
    g = {r["name"]: r["controller_ok"] for r in adv.collect()}
    assert g["m1"] is True and g["m2"] is False  # D17: substring test


def test_full_stack_trace(lib):
    from quarry.operators import lineage as G
    a = lib
    trace = G.full_stack_trace(a.requests(), a.definition_field_links(), a.field_method_links())
    t = sorted(tuple(r) for r in trace.drop("request_key").collect())
    assert t == [(J + ".Library", J + ":17", J + ":4", P + ".Query.books", 1),
                 (J + ".Library", J + ":18", J + ":10", P + ".Mutation.addBook", 0)]
    assert [tuple(r) for r in G.trace_methods(trace, a.field_method_links()).collect()] == [(P + ".Query.books", "x.BookController.books")]


def test_trace_reaches_every_method(spark):
    from quarry.operators import lineage as G
    reqs = spark.createDataFrame([("C", "f:1", "f#r#0", "f:9", "f#d#1"), ("C", "f:1", "f#r#1", "f:9", "f#d#2"), ("D", "f:2", "f#r#2", None, None)],
                                 "parent string, fullname string, key string, definition string, definition_key string")
    dfl = spark.createDataFrame([("f#d#1", "Query.a"), ("f#d#2", "Query.b")], "caller_key string, callee string")
    fml = spark.createDataFrame([("Query.a", "m1"), ("Query.a", "m2"), ("Query.b", "m3"), ("Query.z", "m4")], "caller string, callee string")
    trace = G.full_stack_trace(reqs, dfl, fml)
    assert sorted((r["request_key"], r["field"], r["n_methods"]) for r in trace.collect()) == [
        ("f#r#0", "Query.a", 2), ("f#r#1", "Query.b", 1), ("f#r#2", None, 0)]
    assert sorted(tuple(r) for r in G.trace_methods(trace, fml).collect()) == [("Query.a", "m1"), ("Query.a", "m2"), ("Query.b", "m3")]
    one = spark.createDataFrame([("C",)], "component string")
    assert sorted((r["request_key"], r["method"]) for r in G.expand_trace(trace, fml, components=one).collect()) == [
        ("f#r#0", "m1"), ("f#r#0", "m2"), ("f#r#1", "m3")]
    up = spark.createDataFrame([("m3",)], "method string")
    assert [(r["component"], r["request_key"]) for r in G.expand_trace(trace, fml, methods=up).collect()] == [("C", "f#r#1")]


ORDINARY = """import React, {
  useQuery,
  gql,
} from "@apollo/client";
const Q: DocumentNode = gql(`query A { users(id: 1) { x } }`); const Q2 = gql`query B { b(x: 1) }`;
export default function App({ id }) {
  const pick = ({ id }) => { return id; };
  const r = useQuery<Data, Vars>(Q, { variables: { id: { in: [1] } }, fetchPolicy: 'network-only' }), s = useQuery(Q2);
}
const top = useQuery(Q);
const Page: React.FC<{ a: string }> = () => {
  if (x) { y(); } else {
    useQuery(Q);
  }
  return null;
};
const useThing = () =>
{
  useQuery(Q2);
};
export const Wide = memo((
  a,
  b
) => {
  useQuery(Q);
});
class K extends C {
  render() {
    useQuery(Q);
  }
}
"""


def test_client_pass_on_ordinary_code(spark):
    a = Analysis(spark, client_files=files_df(spark, [("a.jsx", ORDINARY)]), materialize=False)
    one, two = (f"a.jsx#d#{ORDINARY.index(tag)}" for tag in ("gql(`", "gql`"))
    assert sorted((r["name"], r["key"], r["line"]) for r in a.definitions().collect()) == sorted([("Q", one, 5), ("Q2", two, 5)])
    got = [(r["line"], r["query_name"], r["parent"], r["fetch_policy"], r["definition_key"]) for r in a.requests().orderBy("line", "pos").collect()]
    p = "a.jsx."
    assert got == [(8, "Q", p + "App", "network-only", one), (8, "Q2", p + "App", None, two), (13, "Q", p + "Page", None, one),
                   (19, "Q2", p + "useThing", None, two), (25, "Q", p + "Wide", None, one), (29, "Q", p + "render", None, one)]

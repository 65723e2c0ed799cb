"""The lexical scan of client sources, and what the client pass makes of ordinary code."""

import time

import pytest

from quarry.functions.lexer import scan
from quarry.operators import client as C

from conftest import files_df


def hooks(text):
    return [(e.name, e.text.strip()) for e in scan(text) if e.kind == "hook"]


@pytest.mark.parametrize("text", [
    '"useQuery(Q)"', "'useQuery(Q)'", "`useQuery(Q)`", "// useQuery(Q)", "/* useQuery(Q)\n useQuery(Q) */", "x = /useQuery(Q)/.test(y)",
    "`a ${ `useQuery(Q)` } useQuery(Q)`", r"'\'useQuery(Q)'", r"`\`useQuery(Q)`", "my_useQuery(Q)", "useQuery", "useQueryX(Q)", "return /[/]useQuery(Q)/",
])
def test_no_code_no_call(text):
    assert hooks(text) == []


@pytest.mark.parametrize("text", [
    "useQuery(Q)", "a / b; useQuery(Q); c / d", "'x' + useQuery(Q)", "`${ useQuery(Q) }`", "`${ `${ useQuery(Q) }` }`", "/* a */ useQuery(Q)",
    "// a\nuseQuery(Q)", "x = /\"/; useQuery(Q)", "x = /[/\"]/g; useQuery(Q)", "useQuery<D, { a: string }>(Q)", "useQuery( // c )\n Q)", "'open\nuseQuery(Q)",
    "<a href=\"http://x.y\">Don't</a>\nuseQuery(Q)", "<a>http://x {useQuery(Q)}</a>", "<X a={1} /> ; useQuery(Q) /* / */", "Apollo.useQuery(Q)", "}) ] useQuery(Q)",
])
def test_code_is_found(text):
    assert hooks(text) == [("useQuery", "Q")]


def test_unclosed_texts_end():
    for text in ("`${", "`", "'", "/*", "useQuery(", "useQuery(Q", "gql`query", "{" * 50, "((" * 50 + "}" * 50, "", "/", "=>", "gql(`"):
        assert [e for e in scan(text) if e.kind != "body"] == []


def test_bodies_nest_by_place():
    text = "function A(){ x.map(i => useQuery(Q)); useMutation(M) } function B(){ if (x) { useQuery(R) } }"
    found = scan(text)
    at = {e.pos: e.head.strip() for e in found if e.kind == "body"}
    got = {e.text: [at[p] for p in e.bodies] for e in found if e.kind == "hook"}
    assert got == {"Q": ["x.map(i =>", "function A()"], "M": ["function A()"], "R": ["if ()", "function B()"]}


def test_an_arrow_s_expression_ends():
    text = "const a = () => useQuery(A)\nconst b = useQuery(B), c = x => x, d = useQuery(D); f(y => useQuery(E), useQuery(F))\nconst g = () =>\n  useQuery(G)\n    .data\nuseQuery(H)"
    got = {e.text: len(e.bodies) for e in scan(text) if e.kind == "hook"}
    assert got == {"A": 1, "B": 0, "D": 0, "E": 1, "F": 0, "G": 1, "H": 0}


@pytest.mark.parametrize("text, n", [
    ("const data = (" + "a, " * 350_000 + ") => { useQuery(Q) }", 1), ("const data = (" * 20_000 + "a" + ")" * 20_000 + " => { useQuery(Q) }", 1),
    ("function A(){return useQuery(Q)};" * 30_000, 30_000), ("x = '" + r"\'" * 500_000 + "'; useQuery(Q)", 1), ("{" * 100_000 + "useQuery(Q)" + "}" * 100_000, 1),
    ("`${" * 20_000 + "useQuery(Q)" + "}`" * 20_000, 1), ("x = () => y\n" * 50_000 + "useQuery(Q)", 1),
])
def test_long_lines_take_linear_time(text, n):
    start = time.process_time()
    assert len(hooks(text)) == n
    assert time.process_time() - start < 20


PROBES = """import { useQuery, useMutation, gql } from "@apollo/client";
const Q = gql`query Q { a(x: 1) { b } }`;
/* const Old = gql`query Old { a(x: 1) { b } }`; */
export function One() {
  const s = "}"; // } useQuery(NO)
  const r = /}/.test(s);
  return useQuery(Q, { variables: { a: { b: { c: { d: { e: { f: 1 } } } } } }, fetchPolicy: "no-cache", onDone: () => { f({ errorPolicy: "x" }) }, errorPolicy: 'all' });
}
function Two(){ return useQuery(Q9) } function Three(){ return useQuery(Q10) }
class K { load = async () => { useMutation(Q5) } }
export const Four = ({ a }) =>

  // the body stands below

{
  useQuery(Q);
};
const Five = memo(forwardRef(function Inner(props: P, ref): JSX.Element { return useQuery(Q) }));
const useSix = <T,>(x: T): T => useQuery(Q).data
const handlers = { async load(x) { useMutation(Q7) } };
useQuery(OUTSIDE);
"""


def test_client_pass_on_probes(spark):
    got = C.requests(files_df(spark, [("p.tsx", PROBES)])).orderBy("pos").collect()
    assert [(r["line"], r["query_name"], r["parent"], r["fetch_policy"], r["error_policy"]) for r in got] == [
        (7, "Q", "p.tsx.One", "no-cache", "all"), (9, "Q9", "p.tsx.Two", None, None), (9, "Q10", "p.tsx.Three", None, None),
        (10, "Q5", "p.tsx.load", None, None), (16, "Q", "p.tsx.Four", None, None), (18, "Q", "p.tsx.Inner", None, None),
        (19, "Q", "p.tsx.useSix", None, None), (20, "Q7", "p.tsx.load", None, None)]
    assert [r["name"] for r in C.client_definitions(files_df(spark, [("p.tsx", PROBES)])).collect()] == ["Q"]


def test_client_pass_on_a_long_line(spark):
    """A parenthesised line of a megabyte, as bundles have, and headers of that length."""
    bundle = 'import { useQuery } from "x";const data = (' + "a, " * 350_000 + ") => { return useQuery(Q) };function B(){ return useQuery(R) }"
    got = C.requests(files_df(spark, [("b.js", bundle)])).orderBy("pos").collect()
    assert [(r["query_name"], r["parent"]) for r in got] == [("Q", "b.js.data"), ("R", "b.js.B")]
    assert C.client_files(files_df(spark, [("b.js", bundle)])).count() == 1

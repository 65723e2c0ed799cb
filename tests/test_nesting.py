"""Nested blocks of the schema pass against a stack kept line by line."""

import random
import time

import pytest

from quarry.operators import resolve as R
from quarry.operators import schema as S
from quarry.functions.patterns import DEFAULT_PATTERNS as PS
from quarry.sources.files import file_line_counts, to_lines

from conftest import files_df

HEADS = ["type A%d {", "input B%d {", "enum C%d {", "interface D%d {", "extend type A%d {", "# note {", "  f%d: T", "  g%d(a: In%d): T", "}", "} }", "}}", "  h%d: T }", "", "X%d"]


def by_stack(text, kinds):
    """(line, name, end, parent's line or 0) of every node, with a stack of open containers."""
    lines, stack, depth, out, ends = text.splitlines(), [], 0, [], {}
    parents = PS.key_to_expected_parent()
    for i, line in enumerate(lines, 1):
        opens, closes = line.count("{"), line.count("}")
        depth += opens - closes
        while stack and depth <= stack[-1][1]:
            ends[stack.pop()[0]] = i
        if i not in kinds:
            continue
        key, kind, name = kinds[i]
        expected = parents.get(key)
        found = 0
        if stack and expected not in (None, "Program", "file"):
            found = next((at for at, _, k in reversed(stack) if k == expected), stack[-1][0])
        out.append((i, name, found))
        if opens and opens != closes:
            stack.append((i, depth - opens, kind))
    return out, {at: ends.get(at, len(lines)) for at, *_ in out}


@pytest.mark.parametrize("seed", range(2))
def test_parents_and_names_against_a_stack(spark, seed):
    rng = random.Random(seed)
    files = []
    for k in range(60):
        text, depth, lines = None, 0, []
        for i in range(rng.randrange(1, 60)):
            line = rng.choice(HEADS if depth > 0 else HEADS[:7])  # depth never falls below what a line may close
            line = line if depth + line.count("{") - line.count("}") >= 0 else ""
            depth += line.count("{") - line.count("}")
            lines.append(line % ((i,) * line.count("%d")))
        files.append((f"f{k}.graphqls", "\n".join(lines)))
    df = files_df(spark, files)
    got = S.extract_objects(to_lines(df), file_line_counts(df))["nodes"].collect()
    by = {}
    for r in got:
        by.setdefault(r["path"], {})[r["line"]] = r
    for path, text in files:
        rows = by.get(path, {})
        want, _ = by_stack(text, {i: (r["pattern_key"], r["obj_type"], r["name"]) for i, r in rows.items()})
        chain = {0: ([], [])}
        for line, name, up in want:
            chain[line] = ([*chain[up][0], name], [*chain[up][1], line])
            r = rows[line]
            assert (r["chain"]["names"], r["chain"]["starts"]) == chain[up], (path, line, text)
            assert r["fullname"] == ".".join([path, *chain[line][0]]) and r["order_key"] == chain[line][1]


def test_many_open_blocks_cost_linear_rows(spark):
    """Ten thousand blocks open at once, in a form in which names stay short: fields under one unnamed block each."""
    n = 10_000
    text = "type A {\n" + "# {\n" * n + "  f(a: In): T\n" + "# }\n" * n + "  g: T\n}\ninput In {\n  x: Int\n}\n"
    df = files_df(spark, [("deep.graphqls", text)])
    start = time.time()
    r = S.extract_objects(to_lines(df), file_line_counts(df))
    objs = {o["fullname"] for o in r["objects"].collect()}
    assert {"deep.graphqls.A.f", "deep.graphqls.A.g", "deep.graphqls.In.x"} <= objs
    refs = R.reference_callers(R.type_references(to_lines(df)), r["nodes"]).collect()
    assert [(x["line"], x["caller"]) for x in refs] == [(n + 2, "deep.graphqls.A.f")]
    assert time.time() - start < 120


def test_callers_inside_unregistered_containers(spark):
    text = "type A {\n  x: Int\n}\nextend type A {\n  input B {\n    v: Int\n  }\n  x(a: In): T\n}\n"
    df = files_df(spark, [("p.graphqls", text)])
    nodes = S.extract_objects(to_lines(df), file_line_counts(df))["nodes"]
    refs = R.reference_callers(R.type_references(to_lines(df)), nodes).collect()
    # line 8 is not registered (A.x is taken), nor is its container; B is closed: the file itself calls
    assert [(r["line"], r["caller"]) for r in refs] == [(8, "p.graphqls")]

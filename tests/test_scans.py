"""Chunked scans and block styles against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from quarry.functions.prefix import next_at_most, path_order, running_floor
from quarry.operators import blocks as B
from quarry.operators import imports as I

from conftest import files_df
from quarry.sources.files import to_lines


def test_running_floor_matches_a_loop(spark):
    rng = random.Random(4)
    rows = [(k, i, rng.choice([-1, -1, 1, 1, 0])) for k in "ab" for i in range(700)]
    want = {}
    for k in "ab":
        total = floor = 0
        for _, i, d in (r for r in rows if r[0] == k):
            before, total = floor, total + d
            floor = min(floor, total)
            want[k, i] = (total, floor, before)
    got = running_floor(spark.createDataFrame(rows, "k string, pos int, d int").repartition(3), ["k"], "pos", "d", chunk_rows=32).collect()
    assert {(r["k"], r["pos"]): (r["total"], r["floor"], r["floor_before"]) for r in got} == want


@pytest.mark.parametrize("fan, top", [(4, 3), (4, 40), (64, 10)])
def test_next_at_most_matches_a_loop(spark, fan, top):
    rng = random.Random(fan + top)
    rows = [(p, i, rng.randrange(top)) for p in "xy" for i in range(1, 400) if rng.random() < 0.8] + [("z", i, 500 - i) for i in range(1, 400)] + [("w", i, i) for i in range(1, 400)]
    df = spark.createDataFrame(rows, "path string, line int, v int")
    want = {(p, i): next((j for q, j, w in rows if q == p and j > i and w <= v), None) for p, i, v in rows}
    assert {(r["path"], r["line"]): r["found"] for r in next_at_most(df, df, fan).collect()} == want


def test_path_order_grows_with_the_path(spark):
    paths = [f"p{i * 7919 % 1000:04d}" for i in range(1000)] * 2
    got = path_order(spark.createDataFrame([(p,) for p in paths], "path string").repartition(5)).orderBy("place").collect()
    assert [r["path"] for r in got] == sorted(set(paths))


def nodes_of(text, mark):
    return [i for i, line in enumerate(text.split("\n"), 1) if mark in line]


def test_end_keywords_against_a_stack(spark):
    rng = random.Random(9)
    files, want = [], {}
    for k in range(12):
        lines = [rng.choice(["class A", "def f", "  x = 1", "end", "end", "if y", "each do |z|", ""]) + rng.choice(["", "", " # n"]) for _ in range(40)]
        path, stack = f"k{k}.rb", []
        files.append((path, "\n".join([*lines, "x"])))
        for i, line in enumerate(lines, 1):
            if line.startswith("end") and stack:
                want[path, stack.pop()] = i
            if "# n" in line:
                want[path, i] = i
                if line.startswith(("class", "def", "if")):
                    stack.append(i)
        want |= {(path, i): len(lines) + 1 for i in stack}
    df = to_lines(files_df(spark, files))
    nodes = df.filter(F.col("text").contains("# n"))
    assert {(r["path"], r["line"]): r["end_line"] for r in B.end_keyword_ends(df, nodes).collect()} == want


def test_indentation_against_a_loop(spark):
    rng = random.Random(5)
    files, want = [], {}
    for k in range(8):
        lines = [rng.choice([" " * rng.randrange(9) + rng.choice(["n", "x"]), "", "   "]) for _ in range(150)]
        files.append((f"i{k}.py", "\n".join([*lines, "x"])))
        whole = [*lines, "x"]
        for i, line in enumerate(whole, 1):
            if line.strip() == "n":
                indent = len(line) - 1
                want[f"i{k}.py", i] = next((j - 1 for j, other in enumerate(whole, 1) if j > i and other.strip() and len(other) - 1 <= indent), len(whole))
    df = to_lines(files_df(spark, files))
    nodes = df.filter(F.trim("text") == "n")
    assert {(r["path"], r["line"]): r["end_line"] for r in B.indentation_ends(df, nodes).collect()} == want


def test_sequential_blocks(spark):
    rows = [("p", 2, "A"), ("p", 5, "A"), ("p", 7, "B"), ("p", 9, "Program"), ("p", 12, "B"), ("q", 1, "A")]
    lines = spark.createDataFrame([("p", i, "") for i in range(1, 21)] + [("q", i, "") for i in range(1, 5)], "path string, line int, text string")
    got = B.sequential_ends(lines, spark.createDataFrame(rows, "path string, line int, expected_parent string")).collect()
    assert {(r["path"], r["line"]): r["end_line"] for r in got} == {("p", 2): 4, ("p", 5): 8, ("p", 7): 8, ("p", 9): 20, ("p", 12): 20, ("q", 1): 4}


def test_import_blocks(spark):
    text = 'import (\n"a/b"\n)\n"c"\nimport x\nimport (\n  "d.e"\n)\n)\nimport y'
    got = I.extract_imports(to_lines(files_df(spark, [("g.go", text)]))).orderBy("line").collect()
    assert [(r["line"], r["name"]) for r in got] == [(2, "b"), (4, "c"), (5, "x"), (7, "e"), (10, "y")]

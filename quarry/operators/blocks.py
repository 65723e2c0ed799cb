"""Other block delimiter styles (X13-X15): end lines of classified nodes when blocks are closed by an
``end`` keyword, by indentation, or by the next block (sequential). The analysed tool implements them
but always runs in brace mode; they are offered as operators over ``nodes(path, line, …)`` and
``lines(path, line, text)``. Each is a set of chunked scans and equi-joins: no per-file loop, and no window over
a whole file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.prefix import next_at_most, next_line, running_floor

# FIXED VALUES: block keywords of the end-keyword style.
OPEN_KW_RE = r"^\s*(class|module|def|do|if|unless|case|while|until|for|begin|function)\b"
OPEN_DO_RE = r"\bdo\s*(\|[^|]*\|)?\s*$"
CLOSE_KW_RE = r"^\s*end\b"
ROOT_PARENTS = ("Program", "file")


def _n_lines(lines: DataFrame) -> DataFrame:
    return lines.groupBy("path").agg(F.max("line").alias("n_lines"))


def end_keyword_ends(lines: DataFrame, nodes: DataFrame) -> DataFrame:
    """A matched node on a line with an opening keyword is pushed; every ``end`` line pops the
    top of the stack of pushed nodes (whatever opened the ``end``'s own block). Per line the pop comes
    before the push. Height after each event = prefix sum minus the running minimum (clamped at 0), from
    a chunked scan; a node pushed to height p ends at the first later pop from p to p - 1 (as-of per
    (path, level))."""
    txt = F.col("text")
    opens = txt.rlike(OPEN_KW_RE) | txt.rlike(OPEN_DO_RE)
    closes = F.trim(txt).rlike(CLOSE_KW_RE)
    ln = lines.select("path", "line", opens.alias("op"), closes.alias("cl"))
    pushed = nodes.select("path", "line").join(ln.filter("op"), ["path", "line"], "left_semi")
    ev = ln.filter("cl").select("path", "line", F.lit(0).alias("o"), F.lit(-1).alias("d")) \
        .unionByName(pushed.select("path", "line", F.lit(1).alias("o"), F.lit(1).alias("d")))
    ev = running_floor(ev.withColumn("pos", F.col("line") * 2 + F.col("o")), ["path"], "pos", "d")
    height = F.col("total") - F.col("floor")
    # a pop that the clamp absorbed met an empty stack; any other left height H and came from H + 1
    pops = ev.filter("d = -1 and floor = floor_before").select("path", (height + 1).alias("level"), "line")
    pushes = ev.filter("d = 1").select("path", height.alias("level"), "line")
    ends = next_line(pushes, pops, ["path", "level"], "end_line").select("path", "line", "end_line")
    out = nodes.select("path", "line").join(ends, ["path", "line"], "left").join(_n_lines(lines), "path", "left")
    tracked = nodes.select("path", "line").join(pushed, ["path", "line"], "left_semi").withColumn("t", F.lit(True))
    out = out.join(tracked, ["path", "line"], "left")
    return out.select("path", "line", F.when(F.col("t"), F.coalesce("end_line", "n_lines"))
                      .otherwise(F.col("line")).alias("end_line"))


def indentation_ends(lines: DataFrame, nodes: DataFrame) -> DataFrame:
    """Every matched node is a block with marker = its line's indent; it ends on the line before
    the first later non-blank line whose indent is <= the marker, else at the last line: a search for the
    next value not greater, over bundles of lines and their least indents."""
    nb = lines.filter(F.trim(F.col("text")) != "").select(
        "path", "line", (F.length("text") - F.length(F.regexp_replace("text", r"^\s+", ""))).alias("v"))
    node_ind = nodes.select("path", "line").join(nb, ["path", "line"], "inner")
    nxt = next_at_most(node_ind, nb).withColumnRenamed("found", "next")
    out = nodes.select("path", "line").join(nxt, ["path", "line"], "left").join(_n_lines(lines), "path", "left")
    return out.select("path", "line", F.coalesce(F.col("next") - 1, F.col("n_lines")).alias("end_line"))


def sequential_ends(lines: DataFrame, nodes: DataFrame) -> DataFrame:
    """A block ends before the very next node if that node has the same expected parent or is a
    reset (expected parent Program/file); otherwise it is covered and ends before the next reset, or at
    the last line. ``nodes`` needs (path, line, expected_parent)."""
    reset = F.col("expected_parent").isin(*ROOT_PARENTS)
    own = nodes.select("path", "line", "expected_parent")
    following = next_line(own, own, ["path"], "nxt")
    resets = next_line(own, own.filter(reset), ["path"], "next_reset")
    after = own.select("path", F.col("line").alias("nxt"), F.col("expected_parent").alias("nxt_parent"))
    n = own.join(following, ["path", "line"]).join(resets, ["path", "line"]).join(after, ["path", "nxt"], "left").join(_n_lines(lines), "path", "left")
    same = (F.col("nxt_parent") == F.col("expected_parent")) | F.col("nxt_parent").isin(*ROOT_PARENTS)
    end = F.when(F.col("nxt").isNotNull() & same, F.col("nxt") - 1) \
        .when(F.col("next_reset").isNotNull(), F.col("next_reset") - 1).otherwise(F.col("n_lines"))
    return n.select("path", "line", end.alias("end_line"))

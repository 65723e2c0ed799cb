"""Handler registry.

A handler is a ``DataFrame -> DataFrame`` transform applied to the *root* nodes (direct children of
the Program) of one pattern key (U1) or of every key matching a regex (U2), before default object
extraction. Handlers run on Spark like every other operator; their outputs are unioned by name.
A failing handler is skipped, like the analysed tool which swallows handler errors, but leaves an
error row. Pluggable pattern sets (U3) are ``functions.patterns.PatternSet`` values passed to
``plans.pipeline.Analysis`` or the classifier.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.materialize import stored

Handler = Callable[[DataFrame], DataFrame]


class HandlerRegistry:
    def __init__(self):
        self._by_key: dict[str, list[Handler]] = {}
        self._by_pattern: list[tuple[str, Handler]] = []

    def register(self, pattern_key: str, handler: Handler) -> None:
        self._by_key.setdefault(pattern_key, []).append(handler)

    def register_pattern(self, regex: str, handler: Handler) -> None:
        re.compile(regex)
        self._by_pattern.append((regex, handler))

    def run(self, nodes: DataFrame) -> tuple[DataFrame | None, DataFrame]:
        """(union of the handlers' outputs or None, outcomes(handler, n_rows, error)). Every handler is a job of its own
        whose output is written before it counts, so one that fails, when its plan is made or in a task, leaves the
        others' rows; its error is a row of the outcomes."""
        roots = nodes.filter(F.size("chain.names") == 0)
        asked = [(f"{h.__name__}:{key}", h, F.col("pattern_key") == key) for key, hs in self._by_key.items() for h in hs]
        # Python re.match semantics: anchored at the start of the key
        asked += [(f"{h.__name__}:{regex}", h, F.col("pattern_key").rlike("^(?:" + regex + ")")) for regex, h in self._by_pattern]
        outputs, outcomes = [], []
        for name, handler, which in asked:
            try:
                out = stored(handler(roots.filter(which)), "handler")
                outcomes.append((name, out.count(), None))
                outputs.append(out)
            except Exception as e:  # noqa: BLE001 - a handler's error is a row, as the analysed tool logs it and goes on
                outcomes.append((name, 0, f"{type(e).__name__}: {e}".split("\n")[0][:500]))
        union = outputs[0] if outputs else None
        for o in outputs[1:]:
            union = union.unionByName(o, allowMissingColumns=True)
        return union, nodes.sparkSession.createDataFrame(outcomes, "handler string, n_rows long, error string")

    def apply(self, nodes: DataFrame) -> DataFrame | None:
        """Run every handler on its root nodes; returns the union of their outputs (or None)."""
        return self.run(nodes)[0]


def count_by_key(df: DataFrame) -> DataFrame:
    """Example handler: root nodes per pattern key."""
    return df.groupBy("pattern_key").agg(F.count("*").cast("bigint").alias("n_roots"))

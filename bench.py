"""Benchmark: end-to-end analysis stages at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each run builds a fresh ``Analysis`` (no cached stage is reused between runs): the generated corpora
are materialised first (input preparation, reported as ``corpus``), then every analysis stage is
forced in dependency order and timed. Reported per stage: median of 3 runs after one warm-up.
``value`` is the sum of the analysis stages (corpus preparation excluded).
Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.operators import lineage as G  # noqa: E402
from quarry.plans.pipeline import Analysis  # noqa: E402
from quarry.session import get_session  # noqa: E402


def run_once(spark, sf_dir):
    a = Analysis(spark, sf_dir)
    t = {}
    rows = {}

    def stage(name, fn):
        t0 = time.perf_counter()
        df = fn()
        rows[name] = df.count()
        t[name] = time.perf_counter() - t0

    stage("corpus", lambda: (a.schema_input()[0], a.client_input(), a.backend())[0])
    stage("schema_objects", a.objects)
    stage("schema_links", lambda: a.references().filter("target is not null"))
    stage("client_definitions", a.definitions)
    stage("hook_requests", a.requests)
    stage("definition_field_links", a.definition_field_links)
    stage("field_method_links", a.method_matches)
    stage("full_stack_trace", lambda: G.full_stack_trace(a.requests(), a.definition_field_links(),
                                                         a.field_method_links()))
    return t, rows


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE", cpus)))
    run_once(spark, sf_dir)  # warm-up
    runs = [run_once(spark, sf_dir) for _ in range(int(os.environ.get("BENCH_RUNS", "3")))]
    names = list(runs[0][0].keys())
    med = {n: round(statistics.median(r[0][n] for r in runs), 3) for n in names}
    analysis = {n: v for n, v in med.items() if n != "corpus"}
    sf = sf_dir.rsplit("sf", 1)[-1]
    out = {"metric": "analysis_seconds", "value": round(sum(analysis.values()), 3), "unit": "sec",
           "queries": med, "rows_out": runs[0][1], "sf": sf, "cpus": int(cpus),
           "spark": spark.version}
    print(json.dumps(out))


if __name__ == "__main__":
    main()

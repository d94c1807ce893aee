"""Headline-query timings.

Runs each query end to end (the full plan is executed into Spark's ``noop``
sink, nothing is collected) on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and prints one JSON line.
Before timing, every headline query runs once on the smallest tables
(``$BENCH_WARMUP_DIR``, default sf0.001) so JIT compilation, code generation
and Python worker start-up are not charged to the first timed query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from polyeval.plans.catalog import QUERIES  # noqa: E402
from polyeval.session import build_session  # noqa: E402

HEADLINE = ["merge_scores", "corpus_bleu", "corpus_chrf", "rouge_l", "meteor",
            "metric_row", "backfill_metric", "pearson_by_benchmark"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", app="polyeval-bench", shuffle_partitions=int(cpus) * 2)
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if warm and os.path.isdir(warm):
        for n in names:
            QUERIES[n](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.perf_counter()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_queries_total_wall", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()

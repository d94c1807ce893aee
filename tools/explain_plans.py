"""Write the physical plans of the headline queries to PLANS.md.

usage: python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import io
import sys
from contextlib import redirect_stdout

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from polyeval.plans.catalog import QUERIES  # noqa: E402
from polyeval.session import build_session  # noqa: E402

NAMES = ["merge_scores", "corpus_bleu", "metric_row", "backfill_metric", "pearson_by_benchmark",
         "generate_translations", "select_pair_columns"]
KEEP = ("Scan", "ReadSchema", "PushedFilters", "Exchange", "Aggregate", "Join", "MapInPandas",
        "ArrowEvalPython", "Window", "Generate", "Broadcast", "Keys", "Join type", "Output")


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    out = ["# Physical plans of the headline queries", "",
           f"`tools/explain_plans.py` on `{sf_dir}` (local[8]); `explain('formatted')`, node list",
           "and the lines that show scans, pushed filters, shuffles, joins and Python stages.", ""]
    for n in NAMES:
        buf = io.StringIO()
        with redirect_stdout(buf):
            QUERIES[n](spark, sf_dir).explain("formatted")
        text = buf.getvalue()
        tree, _, details = text.partition("\n\n\n")
        lines = [ln for ln in details.splitlines()
                 if ln.startswith("(") or ln.strip().startswith(KEEP[1:3]) or "Join type" in ln
                 or ln.startswith("Keys") or ln.startswith("Arguments")]
        out += [f"## {n}", "", "```", tree.strip(), "```", "", "```", *lines[:120], "```", ""]
    open("PLANS.md", "w").write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()

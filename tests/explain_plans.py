"""Write the physical plans of the headline queries to PLANS.md.

Usage: python -m tests.explain_plans [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import sys

KEYS = ["sales_by_customer", "top_customer_per_category", "latest_per_key", "merge_upsert", "scd2_apply",
        "user_sessions", "filter_funnel", "rls_filter_mapping"]


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from lakekit.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    qs = entry.queries()
    out = ["# Physical plans of headline queries", "",
           f"Generated by `python -m tests.explain_plans` on `{sf_dir}` (local[8], AQE on; the final plan",
           "may still change at run time, e.g. a sort-merge join turned into a broadcast).", ""]
    for k in KEYS:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            qs[k](spark, sf_dir).explain("formatted")
        text = buf.getvalue()
        tree = text.split("\n\n")[0]
        keep = [ln for ln in text.splitlines() if ln.startswith(("PushedFilters", "ReadSchema", "PartitionFilters"))]
        out += [f"## {k}", "", "```", tree.rstrip(), "", *keep, "```", ""]
    with open("PLANS.md", "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])

"""Physical-plan summary of every registered query (written to PLANS.md).

Counts per query, with broadcasts off (the plan at scale, where no side is small):
hash exchanges, sort-merge joins, parquet scans, scans with pushed filters, scalar
subqueries and windows; and how many joins Spark broadcasts at this size.
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")
from mcrunstat.plans.queries import queries  # noqa: E402
from mcrunstat.session import get_spark  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark()
    key = "spark.sql.autoBroadcastJoinThreshold"
    usual = spark.conf.get(key)
    lines = ["# PLANS", "",
             f"Planned physical plans of the library's queries at `{sf}` with broadcasts off; the last "
             "column is the number of joins that Spark broadcasts here by its own size check.", "",
             "| query | shuffles | sort-merge joins | scans | pushed-filter scans | subqueries | windows | broadcast here |",
             "| --- | --- | --- | --- | --- | --- | --- | --- |"]

    def plan(fn, threshold):
        spark.conf.set(key, threshold)
        return fn(spark, sf)._jdf.queryExecution().executedPlan().toString()

    for k, fn in sorted(queries().items()):
        if k == "sink_roundtrip":  # writes when it is called
            continue
        p = plan(fn, "-1")
        scans = re.findall(r"FileScan parquet.*", p)
        pushed = [s for s in scans if re.search(r"PushedFilters: \[[^\]]", s)]
        lines.append(f"| {k} | {p.count('Exchange hashpartitioning')} | {p.count('SortMergeJoin')} | {len(scans)} | "
                     f"{len(pushed)} | {p.count('Subquery ')} | {p.count('Window [')} | "
                     f"{plan(fn, usual).count('BroadcastHashJoin')} |")
    lines += ["", "Notes:", "",
              "* Broadcasts at this size are the fixture views' joins to customer, nation and the run list, and in "
              "`detailed_ip_*` and its kin the baseline itself; the library never calls `broadcast()` here.",
              "* `sink_roundtrip` is left out: it writes when it is called.  `fill_missing_groups` writes its reduced "
              "per-run table when it is built, so its plan shows no scan of the inputs.",
              "* Regenerate with `python tools/plan_report.py /root/testdata/sf0.1`."]
    with open("PLANS.md", "w") as f:
        f.write("\n".join(lines) + "\n")


if __name__ == "__main__":
    main()

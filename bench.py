"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries": {key: sec}, "sf", ...}.
Each query is timed to a full materialisation (a noop write of every row): the median
of three runs, so that code generation is not counted.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mcrunstat.plans.queries import queries  # noqa: E402
from mcrunstat.session import get_spark  # noqa: E402

HEADLINE = [
    "detailed_ip_standard", "detailed_ip_hrg", "detailed_op_standard", "detailed_aae_standard",
    "attach_baseline_ip", "activity_avoided", "custom_baseline_ip", "national_results",
    "fill_missing_groups", "collect_runs", "compare_results", "mitigators_op", "release_check_ip",
    "pipeline_hrg_baseline",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    keys = sys.argv[1:] or HEADLINE
    spark = get_spark(master=f"local[{cpus}]")
    qs = queries()
    # warm-up: JVM, parquet footers, codegen caches
    qs["baseline_ip"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for k in keys:
        runs = []
        for _ in range(3):
            t0 = time.perf_counter()
            qs[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[k] = round(median(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_sec_headline_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "spark": spark.version,
        "cpus": int(cpus),
        "n_runs": {"ip": 256, "op": 16, "aae": 16},
    }))


if __name__ == "__main__":
    main()

"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
{"metric": "headline_total", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query runs to completion with the ``noop`` sink (full execution, no
collection to the driver), twice, with Spark's cache cleared before each run;
``queries`` has the second run, ``first`` the first one, which carries
compilation, and ``build`` the share of the second spent before the builder
returned.  The ``*_part`` queries have one entity per part (about 20k at
sf0.1), the shape that matters at scale: many entities, few periods each.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarterline.plans import catalog  # noqa: E402
from quarterline.session import local_session  # noqa: E402

HEADLINE = ["quarterly_analytics_part", "derive_q4_part", "segment_contribution_part", "grounded_figures_part",
            "claim_status_part", "quarterly_analytics", "annual_growth", "derive_q4", "facts_from_json",
            "segment_contribution", "asof_annual", "grounded_figures", "claim_status", "dq_summary",
            "briefing_violations", "plain_english", "answer_mode"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, app="quarterline-bench")
    catalog.load_all()

    def timed(name: str) -> tuple[float, float]:
        spark.catalog.clearCache()
        t0 = time.perf_counter()
        df = catalog.QUERIES[name](spark, sf_dir)
        built = time.perf_counter() - t0
        df.write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - t0, 3), round(built, 3)

    # warm-up: JVM class loading and first-scan metadata
    timed("quarterly_wide")
    first = {name: timed(name)[0] for name in HEADLINE}
    second = {name: timed(name) for name in HEADLINE}
    timings = {name: total for name, (total, _) in second.items()}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({"metric": "headline_total", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": sf, "cpus": cpus, "first": first,
                      "build": {name: built for name, (_, built) in second.items()}}))
    spark.stop()


if __name__ == "__main__":
    main()

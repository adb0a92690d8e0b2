"""Headline queries, timed: one JSON line. Each runs twice; the second, warm run counts.

``BENCH_SF_DIR`` names the input folder, ``BENCH_CPUS`` the number of local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import REGISTRY  # noqa: E402
from revrecon.session import build_session  # noqa: E402

HEADLINE = (
    "executive_summary",
    "provider_performance",
    "collection_pipeline",
    "visit_monthly_summary",
    "all_metrics",
    "validation_summary",
    "summary_stats",
    "claims_patient_match",
    "name_dob_match",
    "outstanding_ar",
    "needs_posting",
    "reconciliation_overview",
    "match_status",
    "billing_master",
    "combined_dedup",
    "commercial_rollups",
    "deposits_dedup",
    "recon_deposits_monthly",
    "recon_pl_monthly",
    "monthly_collections",
    "ar_aging",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    REGISTRY["billing_stage_counts"](spark, sf_dir).collect()  # start-up cost is not part of any query
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            spark.catalog.clearCache()  # nothing that an earlier run kept may answer this one
            start = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

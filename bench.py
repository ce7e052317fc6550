"""Bench: wall time of the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (no collect to the
driver).  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "d6_offer_next_week",
    "w1_w8_feature_matrix",
    "a9_lrmfp",
    "c9_numeric_summary",
    "k4_roc_auc",
    "k5_average_precision",
    "h5_sample_negatives",
    "v1_chunk",
    "v2_cosine_topk",
    "d2_ks_drift",
    "g6_convolve_box7",
    "r2_stream_weekly_activity",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from cartwheel.session import local_session
    from cartwheel.plans.catalog import all_queries

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2)
    qs = all_queries()
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in qs]
    # warm-up: JVM class loading and parquet footers, not timed
    qs["c1_clean_transactions"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.time()
        qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_wall", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()

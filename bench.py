"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is built as ``__spark_entry__.queries()`` returns it and executed in full with
the no-op sink (no driver collect). Queries of one run share stage tables, so only the
first user of a stage pays for it (``queries``); ``cold`` holds the seconds of the heavy ones with
every stage built anew from the raw tables.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["clean_reviews", "popular_products", "user_stats", "user_history", "rating_distribution",
            "global_metrics", "similar_items", "similar_items_top", "content_recs", "blend_scores",
            "als_metrics", "als_user_recs", "hybrid_recs"]


COLD = ["clean_reviews", "similar_items", "similar_items_top", "content_recs", "als_metrics"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    cold = COLD if not sys.argv[1:] else []
    from revue.conf import local_session
    from revue.plans.catalog import QUERIES
    from revue.plans.stages import forget
    spark = local_session(cpus=cpus, shuffle_partitions=max(8, cpus))
    # JVM / scan warm-up so the first timed query does not pay for class loading.
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey").write.format("noop").mode(
        "overwrite").save()

    def seconds(name: str) -> float:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.time() - t0, 3)

    times = {name: seconds(name) for name in names}
    fresh = {}
    for name in cold:
        forget()
        fresh[name] = seconds(name)
    sf = os.path.basename(sf_dir).replace("sf", "")
    out = {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "cold": fresh, "sf": float(sf) if sf.replace(".", "").isdigit() else sf_dir,
           "cpus": cpus}
    print(json.dumps(out))


if __name__ == "__main__":
    main()

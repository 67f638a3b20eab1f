"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the cores.
Every query runs from the raw tables, results go to a sink that keeps nothing, and one query on the
same tables warms the JVM up first.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hourpanel.plans.queries import QUERIES  # noqa: E402
from hourpanel.session import build_session, release  # noqa: E402

HEADLINE = (
    "stg_counts",
    "localize_wall_clock",
    "location_hour",
    "nearest_block",
    "precinct_hour",
    "lag_24h",
    "feature_matrix",
    "baseline_error",
    "fold_scale",
    "rolling_origin_baseline",
    "pooled_mase",
    "export_wide",
    "check_all",
    "check_gaps_global",
    "check_churn",
    "profile_counts",
    "string_agg_ordered",
    "day_range_replace",
    "gbt_train_predict",
    "rolling_origin_learner",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "hourpanel-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - start
        release(spark)
        return took

    run("precinct_hour")
    seconds = {name: round(run(name), 3) for name in wanted}
    print(
        json.dumps(
            {
                "metric": "headline queries, summed wall clock",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
